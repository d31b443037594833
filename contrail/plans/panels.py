"""Dashboard panels, one lazy DataFrame function each, over the result tables.

The keyed store reads null and zero back as 0 and null strings as ""; the
panels apply the same defaults to the typed tables so their numbers match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.scalars import (
    blank, clean_callsign, gauge_band, GAUGE_MARKER, key_head, point_label, severity,
    to_feet, to_fpm, to_knots, unit_sums, units_of, UNITS,
)
from contrail.operators.aggregate import altitude_band_counts, equal_width_histogram, value_counts
from contrail.operators.rank import key_ordered_scan, latest_by_key, with_rank

# Fixed values of the dashboard.
TOP_N = 20
MAX_ALERTS = 200
MAX_AGG_ROWS = 5000
TREND_CHOICES = 10
TREND_DEFAULT = 4
HEATMAP_N = 15
HIST_BINS = 30
MIN_HIST_VELOCITY = 20.0


def _num(c):
    return F.coalesce(F.col(c), F.lit(0.0))


# --- live table ---------------------------------------------------------------

def live_positions(live: DataFrame) -> DataFrame:
    """Decoded live rows, dropping only positions with both coordinates zero/missing."""
    lat, lon = _num("latitude"), _num("longitude")
    return live.where(~((lat == 0) & (lon == 0))).select(
        F.col("icao24"),
        clean_callsign("callsign").alias("callsign"),
        blank("origin_country").alias("country"),
        lat.alias("lat"), lon.alias("lon"),
        _num("baro_altitude").alias("altitude"),
        _num("velocity").alias("velocity"),
        _num("vertical_rate").alias("vrate"),
        _num("true_track").alias("track"),
        # stored "None" reads as not "True": a null flag counts as airborne
        F.coalesce(F.col("on_ground"), F.lit(False)).alias("on_ground"),
        blank("operator").alias("operator"),
        blank("model").alias("model"),
        blank("manufacturername").alias("mfr"),
        blank("typecode").alias("typecode"),
    )


def live_airborne(live: DataFrame) -> DataFrame:
    """Airborne aircraft with a positive altitude (the dashboard's flight frame)."""
    pos = live_positions(live)
    return pos.where(~F.col("on_ground") & (F.col("altitude") > 0))


def kpi_summary(airborne: DataFrame, alerts: DataFrame, alert_cap: int | None = None) -> DataFrame:
    """One row: airborne, countries, mean altitude/velocity, knots, enriched, alerts.

    Means are those of exact sums in whole 1e-8 units, so no order of rows can move them.
    ``alert_cap`` bounds ``alerts`` as the dashboard's limited scan does; ``alerts_total`` never is.
    """
    a = airborne.agg(
        F.count(F.lit(1)).alias("airborne"),
        F.count_distinct("country").alias("countries"),
        *unit_sums("altitude", "alt"), *unit_sums("velocity", "vel"),
        F.count_if(F.col("operator") != "").alias("enriched"),
    )
    alerts_total = alerts.select(F.count(F.lit(1))).scalar()
    alt, vel = (units_of(c).cast("double") / float(UNITS) / F.nullif(F.col(f"{c}_n"), F.lit(0)) for c in ("alt", "vel"))
    avg_vel = F.coalesce(F.bround(vel, 1), F.lit(0.0))
    n_alerts = alerts_total if alert_cap is None else F.least(alerts_total, F.lit(alert_cap))
    return a.select(
        "airborne", "countries",
        F.coalesce(F.bround(alt, 0), F.lit(0.0)).alias("avg_altitude"),
        avg_vel.alias("avg_velocity"),
        to_knots(avg_vel).alias("avg_velocity_kt"),
        F.col("enriched").cast("long").alias("enriched"),
        n_alerts.cast("long").alias("alerts"),
        alerts_total.cast("long").alias("alerts_total"),
        F.when(n_alerts > 0, "rapid descents").otherwise("all clear").alias("alert_status"),
    )


def map_points(airborne: DataFrame) -> DataFrame:
    return airborne.select(
        "icao24", "lat", "lon", "altitude",
        point_label("callsign", "icao24", "altitude", "velocity", "country").alias("label"),
    )


def altitude_bands(airborne: DataFrame) -> DataFrame:
    return altitude_band_counts(airborne, "altitude")


def velocity_histogram(airborne: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    fast = airborne.where(F.col("velocity") > MIN_HIST_VELOCITY)
    return equal_width_histogram(fast, "velocity", bins, "flights")


# --- aggregate table ------------------------------------------------------------

def agg_rows(agg: DataFrame) -> DataFrame:
    """Decoded aggregate rows: country from the key, counts and rounded measures."""
    return agg.select(
        key_head("row_key").alias("country"),
        F.col("window_end"),
        F.col("flight_count").alias("count"),
        _num("avg_alt").alias("avg_alt"),
        _num("max_alt").alias("max_alt"),
        _num("avg_velocity").alias("avg_vel"),
    )


def latest_country_window(agg: DataFrame) -> DataFrame:
    """Latest window per country over the whole aggregate table."""
    rows = agg_rows(agg)
    return latest_by_key(rows, ["country"], ["window_end"], ["window_end", "count", "avg_alt", "max_alt", "avg_vel"])


def _by_count():
    return [F.desc("count"), F.asc("country")]


def top_countries(agg: DataFrame, n: int = TOP_N) -> DataFrame:
    """Countries ranked by their latest window's message count."""
    return with_rank(latest_country_window(agg), _by_count(), n)


def heatmap_countries(agg: DataFrame, n: int = HEATMAP_N) -> DataFrame:
    return top_countries(agg).where(F.col("rank") <= n)


def trend_top_countries(agg: DataFrame, countries: list[str] | None = None,
                        choices: int = TREND_CHOICES, default: int = TREND_DEFAULT) -> DataFrame:
    """Every window of the selected countries (default: first 4 of the top 10), by time."""
    rows = agg_rows(agg)
    if countries is None:
        picked = top_countries(agg).where(F.col("rank") <= min(choices, default)).select("country")
    else:
        picked = rows.sparkSession.createDataFrame([(c,) for c in countries], "country string")
    # At most ``choices`` countries on the build side: a broadcast of proven size.
    # ``agg`` is read twice (ranking, then rows), so pass a stored table, not a plan.
    return rows.join(F.broadcast(picked), "country", "left_semi").orderBy("window_end", "country")


def scan_agg_limit(agg: DataFrame, n: int = MAX_AGG_ROWS) -> DataFrame:
    """The dashboard's store scan: first ``n`` aggregate rows in key order."""
    return key_ordered_scan(_agg_scan_rows(agg), "row_key", n)


def _agg_scan_rows(agg: DataFrame) -> DataFrame:
    return agg.select("row_key", key_head("row_key").alias("country"), "window_end",
                      F.col("flight_count").alias("count"), _num("avg_alt").alias("avg_alt"),
                      _num("max_alt").alias("max_alt"), _num("avg_velocity").alias("avg_vel"))


# --- enriched fleet panels -----------------------------------------------------

def enriched_flights(airborne: DataFrame) -> DataFrame:
    return airborne.where((F.col("operator") != "") & (F.col("model") != ""))


def top_operators(enriched: DataFrame, n: int = 15) -> DataFrame:
    return value_counts(enriched, "operator", n, "flights")


def top_models(enriched: DataFrame, n: int = 15) -> DataFrame:
    return value_counts(enriched, "model", n, "flights")


def top_manufacturers(enriched: DataFrame, n: int = 8) -> DataFrame:
    return value_counts(enriched, "mfr", n, "count")


def top_typecodes(enriched: DataFrame, n: int = 10) -> DataFrame:
    return value_counts(enriched, "typecode", n, "count")


def manufacturer_share(enriched: DataFrame, n: int = 8) -> DataFrame:
    """Top manufacturers with their percentage of the slices shown, plus the ring total."""
    from pyspark.sql.window import Window
    top = top_manufacturers(enriched, n)
    total = enriched.select(F.count(F.lit(1))).scalar()
    # the window sees only the n rows left after the limit
    shown = F.sum("count").over(Window.partitionBy())
    return top.select("mfr", "count",
                      (F.col("count").cast("double") * F.lit(100.0) / shown.cast("double")).alias("pct"),
                      total.alias("enriched_total"))


def scatter_top_operators(enriched: DataFrame, n: int = 8) -> DataFrame:
    ops = top_operators(enriched, n).select("operator")
    return (enriched.join(F.broadcast(ops), "operator", "left_semi")
            .select("icao24", "velocity", "altitude", "operator", "callsign", "model", "country"))


# --- alerts table ---------------------------------------------------------------

def alert_frame(alerts: DataFrame) -> DataFrame:
    """Decoded alert rows: missing numbers -> 0, missing strings -> "", ts 0 -> no time."""
    ts = F.coalesce(F.col("ts"), F.lit(0))
    return alerts.select(
        "row_key",
        key_head("row_key").alias("icao24"),
        blank("callsign").alias("callsign"),
        blank("operator").alias("operator"),
        blank("country").alias("country"),
        _num("vrate").alias("vrate"),
        _num("alt").alias("altitude"),
        F.when(ts != 0, ts).alias("ts"),
    )


def scan_alerts_limit(alerts: DataFrame, n: int = MAX_ALERTS) -> DataFrame:
    """The dashboard's store scan: first ``n`` alerts in key order (lowest addresses)."""
    return key_ordered_scan(alert_frame(alerts), "row_key", n)


# The alert table's display headers.
ALERT_LOG_HEADERS = {
    "vrate_ms": "V-rate (m/s)",
    "vrate_fpm": "V-rate (fpm)",
    "alt_m": "Alt (m)",
    "alt_ft": "Alt (ft)",
}


def alert_log(alerts: DataFrame, display_headers: bool = False) -> DataFrame:
    """Alert table with severity and unit conversions, newest first, missing times last."""
    a = alert_frame(alerts)
    out = a.select(
        "ts",
        F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        severity("vrate").alias("severity"),
        "callsign", "operator", "country", "icao24",
        F.col("vrate").alias("vrate_ms"),
        to_fpm("vrate").alias("vrate_fpm"),
        F.col("altitude").alias("alt_m"),
        to_feet("altitude").alias("alt_ft"),
    ).orderBy(F.desc_nulls_last("ts"), F.asc("icao24"))
    return out.withColumnsRenamed(ALERT_LOG_HEADERS) if display_headers else out


def worst_descent(alerts: DataFrame) -> DataFrame:
    a = alert_frame(alerts).agg(F.min("vrate").alias("worst_vrate"), F.count(F.lit(1)).alias("alerts"))
    worst_abs = F.abs(F.col("worst_vrate"))
    return a.where(F.col("alerts") > 0).select(
        "worst_vrate", worst_abs.alias("worst_abs"), gauge_band(worst_abs).alias("gauge_band"),
        (worst_abs > F.lit(GAUGE_MARKER)).alias("above_marker"), "alerts")


def descent_histogram(alerts: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    h = equal_width_histogram(alert_frame(alerts), "vrate", bins, "events")
    return h.withColumn("below_threshold", F.col("bin_hi") <= F.lit(-15.0))


def alerts_by_country(alerts: DataFrame, n: int = 10) -> DataFrame:
    return value_counts(alert_frame(alerts), "country", n, "alerts")
