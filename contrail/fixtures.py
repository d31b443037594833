"""The ``flights`` and ``aircraft`` views over the driver tables.

``events`` becomes a stream of flight messages (``event_id`` is the clock,
one report per second) and ``customer`` becomes the aircraft dimension.
Both are pure projections, so Catalyst prunes the scans to the few
columns used and the views scale with their tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contrail.session import spread

# Epoch of the first report, poll length in seconds.
EPOCH0 = 1704067200
POLL_SECONDS = 10


# The columns of the driver tables that the two views read.
TABLE_COLUMNS = {
    "events": "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_mktsegment STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Known tables are read with their declared columns: Parquet
    maps them by name, and no job is spent inferring a schema from file footers."""
    reader = spark.read
    if name in TABLE_COLUMNS:
        reader = reader.schema(TABLE_COLUMNS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hex(x: str, digits: int) -> str:
    """Lower-case hex of a column, padded to ``digits`` and never cut: ids beyond 16 ** digits stay distinct."""
    return f"lpad(lower(hex({x})), greatest({digits}, length(hex({x}))), '0')"


# The two views as Spark SQL expressions: the text of FIXTURES.md §2-3 with the
# Spark forms of {HEX} and {DIV10}.
FLIGHT_EXPRS = [
    f"{_hex('user_id', 6)} AS icao24",
    "trim(concat('C', CAST(event_id % 1000 AS STRING), '  ')) AS callsign",
    "concat('NATION_', CAST(user_id % 25 AS STRING)) AS origin_country",
    f"{EPOCH0} + event_id AS time_position",
    f"{EPOCH0} + event_id AS last_contact",
    "CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(event_id % 360 - 180 AS DOUBLE) END AS longitude",
    "CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(event_id % 181 - 90 AS DOUBLE) END AS latitude",
    "CASE WHEN event_id % 50 = 0 THEN NULL ELSE value * 100 END AS baro_altitude",
    "CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_type = 'signup' END AS on_ground",
    "value * 3 AS velocity",
    "CAST(event_id % 360 AS DOUBLE) AS true_track",
    "CASE WHEN event_id % 37 = 0 THEN NULL ELSE 10 - value / 2 END AS vertical_rate",
    "CASE WHEN event_id % 50 = 0 THEN NULL ELSE value * 100 END + 50 AS geo_altitude",
    "lpad(CAST(event_id % 7778 AS STRING), 4, '0') AS squawk",  # four digits at most
    f"(({EPOCH0} + event_id) div {POLL_SECONDS}) * {POLL_SECONDS} + {POLL_SECONDS} AS ingestion_ts",
]

# The three fields that are published and archived but that the stream consumer does not read.
EXTRA_EXPRS = [
    "CASE WHEN event_id % 13 = 0 THEN array(event_id % 5, 7L) END AS sensors",
    "event_id % 41 = 0 AS spi",
    "event_id % 4 AS position_source",
]

AIRCRAFT_EXPRS = [
    # one aircraft in seven has an address that no report carries ('z' is not a hex digit)
    f"CASE WHEN c_custkey % 7 = 3 THEN concat('z', {_hex('c_custkey', 5)}) ELSE {_hex('c_custkey', 6)} END AS icao24",
    "c_name AS registration",
    "CASE WHEN c_custkey % 5 = 0 THEN '' ELSE concat('MFR_', CAST(c_custkey % 9 AS STRING)) END AS manufacturername",
    "concat('M', CAST(c_custkey % 40 AS STRING)) AS model",
    "concat('T', CAST(c_custkey % 20 AS STRING)) AS typecode",
    "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS operator",
]


def flights_from_events(events: DataFrame) -> DataFrame:
    """Flight messages (the 15 message fields) derived from ``events``."""
    return events.selectExpr(*FLIGHT_EXPRS)


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``flights`` with all 18 published fields."""
    return table(spark, sf_dir, "events").selectExpr(*FLIGHT_EXPRS, *EXTRA_EXPRS)


def spread_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``flights`` in order of time over many tasks, however few row groups the table has: for work that costs much on every report."""
    return flights_from_events(spread(table(spark, sf_dir, "events"), "event_id", "user_id"))


def aircraft_from_customer(customer: DataFrame) -> DataFrame:
    """Aircraft dimension (six string columns) derived from ``customer``."""
    return customer.selectExpr(*AIRCRAFT_EXPRS)


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights_from_events(table(spark, sf_dir, "events"))


def aircraft(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aircraft_from_customer(table(spark, sf_dir, "customer"))


# DuckDB text of the same two views, used by the SQL oracle.
FLIGHTS_SQL = f"""
SELECT printf('%06x', user_id) AS icao24,
  trim(concat('C', CAST(event_id % 1000 AS VARCHAR), '  ')) AS callsign,
  concat('NATION_', CAST(user_id % 25 AS VARCHAR)) AS origin_country,
  {EPOCH0} + event_id AS time_position,
  {EPOCH0} + event_id AS last_contact,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(event_id % 360 - 180 AS DOUBLE) END AS longitude,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(event_id % 181 - 90 AS DOUBLE) END AS latitude,
  CASE WHEN event_id % 50 = 0 THEN NULL ELSE value * 100 END AS baro_altitude,
  CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_type = 'signup' END AS on_ground,
  value * 3 AS velocity,
  CAST(event_id % 360 AS DOUBLE) AS true_track,
  CASE WHEN event_id % 37 = 0 THEN NULL ELSE 10 - value / 2 END AS vertical_rate,
  CASE WHEN event_id % 50 = 0 THEN NULL ELSE value * 100 END + 50 AS geo_altitude,
  lpad(CAST(event_id % 7778 AS VARCHAR), 4, '0') AS squawk,
  CAST((({EPOCH0} + event_id) // {POLL_SECONDS}) * {POLL_SECONDS} + {POLL_SECONDS} AS BIGINT) AS ingestion_ts
FROM events
"""

REPORTS_SQL = FLIGHTS_SQL.replace("AS ingestion_ts\n", """AS ingestion_ts,
  CASE WHEN event_id % 13 = 0 THEN [event_id % 5, 7] END AS sensors,
  event_id % 41 = 0 AS spi, event_id % 4 AS position_source
""")

AIRCRAFT_SQL = """
SELECT CASE WHEN c_custkey % 7 = 3 THEN printf('z%05x', c_custkey) ELSE printf('%06x', c_custkey) END AS icao24,
  c_name AS registration,
  CASE WHEN c_custkey % 5 = 0 THEN '' ELSE concat('MFR_', CAST(c_custkey % 9 AS VARCHAR)) END AS manufacturername,
  concat('M', CAST(c_custkey % 40 AS VARCHAR)) AS model,
  concat('T', CAST(c_custkey % 20 AS VARCHAR)) AS typecode,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS operator
FROM customer
"""
