"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark plans, over the same driver tables.
"""

from __future__ import annotations

from contrail.schemas import MESSAGE_FIELDS
from contrail.fixtures import AIRCRAFT_SQL, FLIGHTS_SQL, REPORTS_SQL

FLIGHT_COLS = ("icao24, callsign, origin_country, time_position, last_contact, longitude, latitude, "
               "baro_altitude, on_ground, velocity, true_track, vertical_rate, geo_altitude, squawk, ingestion_ts")
DIM_COLS = "registration, manufacturername, model, typecode, operator"



def _half_up(units: str, n: str) -> str:
    """``units`` / 1e8 / ``n`` rounded half-up to 2 dp in integers; 0 if there is nothing."""
    d = f"(CAST({n} AS HUGEINT) * 1000000)"
    return f"CASE WHEN {n} > 0 THEN sign({units}) * CAST((2 * abs({units}) + {d}) // (2 * {d}) AS DOUBLE) / 100 + 0.0 ELSE 0.0 END"


def _mean(c: str) -> str:
    """The exact sum of the values in whole 1e-8 units, divided once; null if there is none."""
    x = f"CASE WHEN abs({c}) < 9e10 THEN {c} END"
    return f"CAST(sum(CAST(floor({x} * 1e8 + 0.5) AS HUGEINT)) AS DOUBLE) / 1e8 / NULLIF(count({x}), 0)"


BASE = f"""
flights AS ({FLIGHTS_SQL}),
aircraft AS ({AIRCRAFT_SQL}),
enriched AS (
  SELECT f.*, a.registration, a.manufacturername, a.model, a.typecode, a.operator
  FROM flights f LEFT JOIN aircraft a ON f.icao24 = a.icao24),
live AS (
  SELECT COALESCE(NULLIF(icao24, ''), 'unknown') AS icao24, callsign, origin_country, latitude, longitude,
    baro_altitude, geo_altitude, velocity, true_track, vertical_rate, on_ground, last_contact, ingestion_ts,
    operator, model, manufacturername, typecode, registration
  FROM enriched
  QUALIFY row_number() OVER (PARTITION BY COALESCE(NULLIF(icao24, ''), 'unknown')
                             ORDER BY ingestion_ts DESC, last_contact DESC) = 1),
agg0 AS (
  SELECT origin_country AS country, ws AS window_start, ws + 300 AS window_end,
    count(*) AS flight_count,
    {_half_up("sum(CAST(floor(alt * 1e8 + 0.5) AS HUGEINT))", "count(alt)")} AS avg_alt,
    {_half_up("CAST(floor(max(alt) * 1e8 + 0.5) AS HUGEINT)", "least(count(alt), 1)")} AS max_alt,
    {_half_up("sum(CAST(floor(vel * 1e8 + 0.5) AS HUGEINT))", "count(vel)")} AS avg_velocity
  FROM (SELECT origin_country, (last_contact // 60) * 60 - k * 60 AS ws,
          CASE WHEN abs(baro_altitude) < 9e10 THEN baro_altitude END AS alt, CASE WHEN abs(velocity) < 9e10 THEN velocity END AS vel
        FROM enriched e, range(0, 5) t(k)
        WHERE origin_country IS NOT NULL AND last_contact IS NOT NULL)
  GROUP BY origin_country, ws),
agg AS (
  SELECT *, replace(COALESCE(NULLIF(country, ''), 'UNKNOWN'), '|', '_') AS country_key,
    replace(COALESCE(NULLIF(country, ''), 'UNKNOWN'), '|', '_') || '|' || CAST(9999999999 - window_end AS VARCHAR) AS row_key
  FROM agg0),
alerts AS (
  SELECT icao24, ingestion_ts, vrate, alt, callsign, operator, country, ts,
    icao24 || '|' || CAST(9999999999 - ingestion_ts AS VARCHAR) AS row_key
  FROM (SELECT COALESCE(NULLIF(icao24, ''), 'unknown') AS icao24,
          CAST(COALESCE(ingestion_ts, 0) AS BIGINT) AS ingestion_ts, vertical_rate AS vrate,
          baro_altitude AS alt, callsign, operator, origin_country AS country,
          CAST(COALESCE(ingestion_ts, 0) AS BIGINT) AS ts, last_contact
        FROM enriched
        WHERE on_ground = false AND vertical_rate IS NOT NULL AND vertical_rate < -15
        QUALIFY row_number() OVER (PARTITION BY COALESCE(NULLIF(icao24, ''), 'unknown'), COALESCE(ingestion_ts, 0)
                                   ORDER BY last_contact DESC) = 1)),
airborne AS (
  SELECT * FROM (
    SELECT icao24, regexp_replace(COALESCE(callsign, ''), '^\\s+|\\s+$', '', 'g') AS callsign,
      COALESCE(origin_country, '') AS country,
      COALESCE(latitude, 0.0) AS lat, COALESCE(longitude, 0.0) AS lon,
      COALESCE(baro_altitude, 0.0) AS altitude, COALESCE(velocity, 0.0) AS velocity,
      COALESCE(vertical_rate, 0.0) AS vrate, COALESCE(true_track, 0.0) AS track,
      COALESCE(on_ground, false) AS on_ground,
      COALESCE(operator, '') AS operator, COALESCE(model, '') AS model,
      COALESCE(manufacturername, '') AS mfr, COALESCE(typecode, '') AS typecode
    FROM live
    WHERE NOT (COALESCE(latitude, 0.0) = 0 AND COALESCE(longitude, 0.0) = 0))
  WHERE NOT on_ground AND altitude > 0),
fleet AS (SELECT * FROM airborne WHERE operator <> '' AND model <> ''),
agg_rows AS (
  SELECT split_part(row_key, '|', 1) AS country, window_end, flight_count AS count,
    COALESCE(avg_alt, 0.0) AS avg_alt, COALESCE(max_alt, 0.0) AS max_alt, COALESCE(avg_velocity, 0.0) AS avg_vel
  FROM agg),
latest_country AS (
  SELECT * FROM agg_rows QUALIFY row_number() OVER (PARTITION BY country ORDER BY window_end DESC) = 1),
top_countries AS (
  SELECT *, CAST(row_number() OVER (ORDER BY count DESC, country ASC) AS INTEGER) AS rank
  FROM latest_country ORDER BY count DESC, country ASC LIMIT 20),
alert_frame AS (
  SELECT row_key, split_part(row_key, '|', 1) AS icao24, COALESCE(callsign, '') AS callsign,
    COALESCE(operator, '') AS operator, COALESCE(country, '') AS country,
    COALESCE(vrate, 0.0) AS vrate, COALESCE(alt, 0.0) AS altitude,
    CASE WHEN COALESCE(ts, 0) <> 0 THEN COALESCE(ts, 0) END AS ts
  FROM alerts)
"""


def _with(body: str) -> str:
    return "WITH " + BASE.strip() + "\n" + body.strip()


def _hist(src: str, col: str, count_name: str, extra: str = "") -> str:
    return f"""
, hv AS (SELECT {col} AS x FROM {src} WHERE {col} IS NOT NULL),
hs AS (SELECT min(x) AS lo, max(x) AS hi FROM hv),
hb AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / ((hi - lo) / 30.0)), 29) END AS INTEGER) AS bin
       FROM hv, hs)
SELECT bin, lo + bin * ((hi - lo) / 30.0) AS bin_lo, lo + (bin + 1) * ((hi - lo) / 30.0) AS bin_hi,
  COALESCE(n, 0) AS {count_name}{extra}
FROM hs, (SELECT CAST(unnest(range(30)) AS INTEGER) AS bin) LEFT JOIN (SELECT bin, count(*) AS n FROM hb GROUP BY bin) USING (bin)
WHERE hi > lo OR (hi = lo AND bin = 0)
"""


def _top(src: str, col: str, n: int, count_name: str) -> str:
    return _with(f"SELECT {col}, count(*) AS {count_name} FROM {src} GROUP BY {col} "
                 f"ORDER BY {count_name} DESC, {col} ASC LIMIT {n}")


ENRICHED_SELECT = f"SELECT {FLIGHT_COLS}, {DIM_COLS} FROM enriched"
AGG_SELECT = "SELECT country, window_start, window_end, flight_count, avg_alt, max_alt, avg_velocity FROM agg"
LIVE_SELECT = "SELECT * FROM live"

# Keyed publish: the message as JSON text, fields in schema order, nulls kept.
# DuckDB and Spark write the same text for this data's numbers; they would
# differ for doubles printed in exponent form (Spark 1.0E7, DuckDB 10000000.0).
KEYED_JSON = (
    "SELECT icao24 AS key, CAST(to_json({" + ", ".join(f"'{c}': {c}" for c in MESSAGE_FIELDS)
    + f"}}) AS VARCHAR) AS value FROM ({REPORTS_SQL})")

ORACLE: dict[str, str] = {
    "json_decode": f"SELECT {FLIGHT_COLS} FROM ({FLIGHTS_SQL})",
    "src_snapshot_decode": (
        f"SELECT {FLIGHT_COLS}, CAST(to_json(sensors) AS VARCHAR) AS sensors, spi, position_source FROM ({REPORTS_SQL})"),
    "src_replay": f"SELECT {FLIGHT_COLS} FROM ({FLIGHTS_SQL})",
    "src_csv_dimension": (
        "SELECT NULLIF(icao24, '') AS icao24, NULLIF(registration, '') AS registration, "
        "NULLIF(manufacturername, '') AS manufacturername, NULLIF(model, '') AS model, "
        f"NULLIF(typecode, '') AS typecode, NULLIF(operator, '') AS operator FROM ({AIRCRAFT_SQL})"),
    "dim_row_count": f"SELECT count(*) AS aircraft_rows FROM ({AIRCRAFT_SQL})",
    "event_time": (
        f"SELECT icao24, last_contact, last_contact AS event_epoch, "
        f"strftime(epoch_ms(last_contact * 1000), '%Y-%m-%d %H:%M:%S') AS event_text FROM ({FLIGHTS_SQL})"),
    "messages_per_poll": f"SELECT ingestion_ts, count(*) AS sent FROM ({FLIGHTS_SQL}) GROUP BY ingestion_ts",
    "sink_keyed_json": KEYED_JSON,
    "scalar_clean": (
        "SELECT COALESCE(NULLIF(icao24, ''), 'unknown') AS key, "
        "' ' || chr(9) || callsign || '  ' || chr(10) AS callsign_raw, "
        f"callsign AS callsign_clean FROM ({FLIGHTS_SQL})"),
    "reverse_epoch_key": _with(
        "SELECT country, window_end, country_key, 9999999999 - window_end AS reverse_epoch, row_key, "
        "split_part(row_key, '|', 1) AS key_head FROM agg"),
    "cell_codec": _with("""
, c AS (SELECT *, CASE last_contact % 8 WHEN 0 THEN '12.5' WHEN 1 THEN 'n/a' WHEN 2 THEN '' WHEN 3 THEN NULL
                  ELSE CAST(last_contact AS VARCHAR) END AS time_cell,
          CASE WHEN last_contact % 11 = 0 THEN 'fast' END AS bad_velocity,
          CASE last_contact % 5 WHEN 0 THEN NULL WHEN 1 THEN ''
               ELSE CASE WHEN on_ground IS NULL THEN 'None' WHEN on_ground THEN 'True' ELSE 'False' END END AS on_ground_cell
        FROM live)
SELECT icao24, COALESCE(latitude, 0.0) AS latitude, COALESCE(longitude, 0.0) AS longitude,
  COALESCE(baro_altitude, 0.0) AS baro_altitude, COALESCE(geo_altitude, 0.0) AS geo_altitude,
  CASE WHEN bad_velocity IS NULL THEN COALESCE(velocity, 0.0) ELSE 0.0 END AS velocity,
  COALESCE(true_track, 0.0) AS true_track, COALESCE(vertical_rate, 0.0) AS vertical_rate,
  CASE WHEN COALESCE(true_track, 0.0) = 0 THEN '' ELSE CAST(true_track AS VARCHAR) END AS true_track_cell,
  time_cell, CASE WHEN last_contact % 8 < 4 THEN 0 ELSE last_contact END AS time, on_ground_cell,
  COALESCE(NULLIF(on_ground_cell, ''), 'True') = 'True' AS on_ground,
  CAST(CASE WHEN bad_velocity IS NULL THEN 0 ELSE 1 END + CASE WHEN last_contact % 8 < 2 THEN 1 ELSE 0 END AS INTEGER) AS bad_cells
FROM c"""),
    "enrich_left_join": _with(ENRICHED_SELECT),
    "country_window_agg": _with(AGG_SELECT),
    "rapid_descent_alerts": _with(
        ENRICHED_SELECT + " WHERE on_ground = false AND vertical_rate IS NOT NULL AND vertical_rate < -15"),
    "live_snapshot": _with(LIVE_SELECT),
    "enriched_latest": _with(
        "SELECT icao24, callsign, origin_country, latitude, longitude, baro_altitude, velocity, vertical_rate, "
        "on_ground, last_contact, operator, model, manufacturername, typecode, registration FROM live"),
    "alerts_table": _with("SELECT * FROM alerts"),
    "scan_live": _with(LIVE_SELECT),
    "live_airborne": _with("SELECT * FROM airborne"),
    "kpi_summary": _with(f"""
, k AS (SELECT count(*) AS airborne, count(DISTINCT country) AS countries,
          COALESCE(round_even({_mean("altitude")}, 0), 0.0) AS avg_altitude,
          COALESCE(round_even({_mean("velocity")}, 1), 0.0) AS avg_velocity,
          CAST(count(*) FILTER (WHERE operator <> '') AS BIGINT) AS enriched FROM airborne),
  n AS (SELECT count(*) AS alerts_total FROM alerts)
SELECT airborne, countries, avg_altitude, avg_velocity, round_even(avg_velocity * 1.944, 0) AS avg_velocity_kt,
  enriched, CAST(alerts_total AS BIGINT) AS alerts, alerts_total,
  CASE WHEN alerts_total > 0 THEN 'rapid descents' ELSE 'all clear' END AS alert_status
FROM k, n"""),
    "map_points": _with(
        "SELECT icao24, lat, lon, altitude, printf('%s<br>Alt: %d m<br>Speed: %d m/s<br>%s', "
        "COALESCE(NULLIF(callsign, ''), icao24), CAST(round_even(altitude, 0) AS BIGINT), "
        "CAST(round_even(velocity, 0) AS BIGINT), country) AS label FROM airborne"),
    "altitude_bands": _with("""
, bands AS (SELECT * FROM (VALUES (0, '(0, 3000]', '<3k', 0.0, 3000.0),
    (1, '(3000, 6000]', '3-6k', 3000.0, 6000.0), (2, '(6000, 9000]', '6-9k', 6000.0, 9000.0),
    (3, '(9000, 10000]', '9-10k', 9000.0, 10000.0), (4, '(10000, 11000]', '10-11k', 10000.0, 11000.0),
    (5, '(11000, 12000]', '11-12k', 11000.0, 12000.0),
    (6, '(12000, 14000]', '>12k', 12000.0, 14000.0)) v(band_order, band, label, lo, hi))
SELECT CAST(b.band_order AS INTEGER) AS band_order, b.band, b.label, CAST(b.lo AS DOUBLE) AS lo,
  CAST(b.hi AS DOUBLE) AS hi,
  CAST((SELECT count(*) FROM airborne a WHERE a.altitude > b.lo AND a.altitude <= b.hi) AS BIGINT) AS flights
FROM bands b"""),
    "velocity_histogram": _with(_hist("airborne WHERE velocity > 20 AND", "velocity", "flights")
                                .replace("FROM airborne WHERE velocity > 20 AND WHERE", "FROM airborne WHERE velocity > 20 AND")),
    "latest_country_window": _with("SELECT * FROM latest_country"),
    "top_countries": _with("SELECT * FROM top_countries"),
    "heatmap_countries": _with("SELECT * FROM top_countries WHERE rank <= 15"),
    "trend_top_countries": _with(
        "SELECT * FROM agg_rows WHERE country IN (SELECT country FROM top_countries WHERE rank <= 4)"),
    "scan_agg_limit": _with(
        "SELECT row_key, split_part(row_key, '|', 1) AS country, window_end, flight_count AS count, "
        "COALESCE(avg_alt, 0.0) AS avg_alt, COALESCE(max_alt, 0.0) AS max_alt, "
        "COALESCE(avg_velocity, 0.0) AS avg_vel FROM agg ORDER BY row_key LIMIT 5000"),
    "enriched_flights": _with("SELECT * FROM fleet"),
    "top_operators": _top("fleet", "operator", 15, "flights"),
    "top_models": _top("fleet", "model", 15, "flights"),
    "top_manufacturers": _top("fleet", "mfr", 8, "count"),
    "top_typecodes": _top("fleet", "typecode", 10, "count"),
    "manufacturer_share": _with("""
, top AS (SELECT mfr, count(*) AS count FROM fleet GROUP BY mfr ORDER BY count DESC, mfr ASC LIMIT 8)
SELECT mfr, count, CAST(count AS DOUBLE) * 100.0 / CAST(sum(count) OVER () AS DOUBLE) AS pct,
  (SELECT count(*) FROM fleet) AS enriched_total FROM top"""),
    "scatter_top_operators": _with("""
, ops AS (SELECT operator, count(*) AS n FROM fleet GROUP BY operator ORDER BY n DESC, operator ASC LIMIT 8)
SELECT icao24, velocity, altitude, operator, callsign, model, country FROM fleet
WHERE operator IN (SELECT operator FROM ops)"""),
    "alert_log": _with("""
SELECT ts, strftime(epoch_ms(ts * 1000), '%Y-%m-%d %H:%M:%S') AS timestamp,
  CASE WHEN vrate < -30 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
  callsign, operator, country, icao24, vrate AS vrate_ms, round_even(vrate * 196.85, 0) AS vrate_fpm,
  altitude AS alt_m, round_even(altitude * 3.281, 0) AS alt_ft
FROM alert_frame ORDER BY ts DESC NULLS LAST, icao24"""),
    "worst_descent": _with("""
SELECT min(vrate) AS worst_vrate, abs(min(vrate)) AS worst_abs,
  CASE WHEN abs(min(vrate)) < 20 THEN 'low' WHEN abs(min(vrate)) < 35 THEN 'elevated'
       WHEN abs(min(vrate)) < 60 THEN 'severe' ELSE 'off_scale' END AS gauge_band,
  abs(min(vrate)) > 30 AS above_marker, count(*) AS alerts
FROM alert_frame HAVING count(*) > 0"""),
    "descent_histogram": _with(_hist("alert_frame", "vrate", "events",
                                     ", lo + (bin + 1) * ((hi - lo) / 30.0) <= -15.0 AS below_threshold")),
    "alerts_by_country": _top("alert_frame", "country", 10, "alerts"),
    "scan_alerts_limit": _with("SELECT * FROM alert_frame ORDER BY row_key LIMIT 200"),
    "clustered_first_alerts": _with("SELECT * FROM alert_frame ORDER BY row_key LIMIT 200"),
    "clustered_country_windows": _with("SELECT * FROM agg WHERE starts_with(row_key, 'NATION_3|') ORDER BY row_key LIMIT 100"),
    # the sketch of aircraft counts a few hundred exactly, as at this size; beyond, tests hold it to its bound
    "rollup_summary": _with(f"""
, r AS (SELECT *, CASE WHEN abs(baro_altitude) < 9e10 THEN baro_altitude END AS a, CASE WHEN abs(velocity) < 9e10 THEN velocity END AS v
        FROM enriched WHERE origin_country IS NOT NULL AND last_contact IS NOT NULL),
ops AS (SELECT origin_country, operator, count(*) AS n FROM r WHERE operator <> '' GROUP BY origin_country, operator
        QUALIFY row_number() OVER (PARTITION BY origin_country ORDER BY n DESC, operator) <= 3),
tops AS (SELECT origin_country, string_agg(operator || ':' || n, ',' ORDER BY n DESC, operator) AS top FROM ops GROUP BY origin_country)
SELECT origin_country AS country, count(*) AS reports, count(DISTINCT icao24) AS aircraft,
  {_half_up("sum(CAST(floor(a * 1e8 + 0.5) AS HUGEINT))", "count(a)")} AS avg_alt,
  {_half_up("CAST(floor(max(a) * 1e8 + 0.5) AS HUGEINT)", "least(count(a), 1)")} AS max_alt,
  {_half_up("sum(CAST(floor(v * 1e8 + 0.5) AS HUGEINT))", "count(v)")} AS avg_velocity, COALESCE(any_value(top), '') AS top_operators
FROM r LEFT JOIN tops USING (origin_country) GROUP BY origin_country"""),
    # the exact quantile, then the middle of its bucket of 64 to a doubling
    "rollup_quantiles": _with("""
, m AS (SELECT origin_country AS country, unnest(['baro_altitude', 'velocity']) AS measure, unnest([baro_altitude, velocity]) AS x
        FROM enriched WHERE origin_country IS NOT NULL AND last_contact IS NOT NULL),
u AS (SELECT country, measure, CAST(floor(x * 1e8 + 0.5) AS BIGINT) AS u, row_number() OVER (PARTITION BY country, measure ORDER BY x) AS place,
        count(*) OVER (PARTITION BY country, measure) AS total FROM m WHERE abs(x) < 9e10),
p AS (SELECT *, CAST(pow(2, greatest(CASE WHEN u = 0 THEN 1 ELSE length(ltrim(bin(abs(u)), '0')) END - 7, 0)) AS BIGINT) AS width
      FROM u, (SELECT unnest([0.5, 0.9, 0.99]) AS q) WHERE place = greatest(ceil(CAST(q AS DOUBLE) * total), 1))
SELECT country, measure, CAST(q AS DOUBLE) AS q, (sign(u) * (abs(u) // width * width) + sign(u) * (width - 1) / 2) / 1e8 AS value FROM p"""),
    "src_poll_feed": f"""
WITH f AS (SELECT *, (ingestion_ts - 1704067200) // 10 AS poll FROM ({FLIGHTS_SQL})),
polls AS (SELECT unnest(range(min(poll), max(poll) + 1)) AS poll FROM f),
recorded AS (SELECT * FROM f WHERE poll = (SELECT min(poll) FROM f))
SELECT {FLIGHT_COLS} FROM f WHERE poll % 9 NOT IN (3, 6)
UNION ALL
SELECT {FLIGHT_COLS.replace("ingestion_ts", "1704067200 + 10 * p.poll AS ingestion_ts")}
FROM recorded CROSS JOIN polls p WHERE p.poll % 9 IN (3, 6)""",
    "src_stream_files": f"SELECT {FLIGHT_COLS} FROM ({FLIGHTS_SQL})",
    "stream_enrich": _with(ENRICHED_SELECT),
    "stream_country_window_agg": _with(AGG_SELECT),
    "stream_pane_windows": _with(AGG_SELECT),
    "stream_live_snapshot": _with(LIVE_SELECT),
    "stream_batch_metrics": f"""
WITH f AS (SELECT time_position AS t FROM ({FLIGHTS_SQL})),
size AS (SELECT min(t) AS lo, max(t) - min(t) + 1 AS span, greatest(5, (count(*) + 4999999) // 5000000) AS n FROM f),
m AS (SELECT (t - lo) // ((span + n - 1) // n) AS batch_id, t % 10 = 7 AS bad,
        CASE t % 10 WHEN 3 THEN t - 1200 WHEN 4 THEN NULL WHEN 7 THEN NULL ELSE t END AS lc FROM f, size),
per AS (SELECT batch_id, max(lc) AS seen FROM m GROUP BY batch_id),
marks AS (SELECT batch_id, max(seen) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 120 AS mark FROM per)
SELECT batch_id, count(*) AS rows, count(*) FILTER (WHERE bad) AS rejected, count(*) FILTER (WHERE NOT bad AND lc IS NULL) AS untimed,
  count(*) FILTER (WHERE lc // 60 * 60 + 300 <= mark) AS late,
  count(*) FILTER (WHERE lc // 60 * 60 + 300 > mark AND lc // 60 * 60 + 60 <= mark) AS partly_late
FROM m JOIN marks USING (batch_id) GROUP BY batch_id""",
    "stream_pipeline_alerts": _with("SELECT * FROM alerts"),
}
# spoilt messages by the last digit of their time: 0 velocity, 1 last_contact, 2 cut, 3 in a list, 4 a quoted number, 5 null
_SPOILT = f"""
SELECT """ + ", ".join("CASE WHEN time_position % 10 IN (2, 3, 5{}) THEN NULL ELSE {} END AS {}".format(
    {"velocity": ", 0", "last_contact": ", 1"}.get(c, ""), c, c) for c in FLIGHT_COLS.split(", ")) + f""",
  CASE time_position % 10 WHEN 0 THEN 'bad field:velocity' WHEN 1 THEN 'bad field:last_contact' WHEN 2 THEN 'not json'
    WHEN 3 THEN 'not an object' WHEN 5 THEN 'absent' ELSE '' END AS faults
FROM ({FLIGHTS_SQL})"""
ORACLE["src_tolerant_decode"] = _SPOILT
ORACLE["stream_quarantine"] = f"""
SELECT split_part(told, ':', 1) AS reason, NULLIF(split_part(told, ':', 2), '') AS field, count(*) AS faults
FROM (SELECT faults AS told FROM ({_SPOILT})) WHERE told <> '' GROUP BY ALL"""
ORACLE["src_tolerant_states"] = f"""
SELECT {FLIGHT_COLS}, CAST(to_json(sensors) AS VARCHAR) AS sensors, spi, position_source,
  CAST(CASE WHEN (ingestion_ts // 10) % 7 = 0 THEN 3 END AS BIGINT) AS category
FROM ({REPORTS_SQL}) WHERE (ingestion_ts // 10) % 7 <> 2"""
ORACLE["colocated_enrich"] = ORACLE["enrich_left_join"]
ORACLE["stream_state_latest"] = _with(
    "SELECT icao24, callsign, origin_country, latitude, longitude, baro_altitude, geo_altitude, velocity, true_track, "
    "vertical_rate, on_ground, last_contact, ingestion_ts FROM live")
ORACLE["incremental_kpis"] = ORACLE["kpi_summary"]


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
