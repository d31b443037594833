"""Batch equivalents of the four result tables, from enriched flight rows.

The streaming pipeline upserts the same rows micro-batch by micro-batch; a
current view of those tables equals these functions over all input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.scalars import aircraft_key, country_key, row_key
from contrail.operators.aggregate import country_window_agg
from contrail.operators.enrich import enrich, rapid_descent
from contrail.operators.rank import latest_by_key
from contrail.schemas import ALERT_COLUMNS, DIMENSION_COLUMNS, ENRICHED_COLUMNS, LIVE_COLUMNS

# Arrival order of file/table input: poll, then report time. A Kafka source
# would order by (partition, offset) instead.
ARRIVAL_ORDER = ("ingestion_ts", "last_contact")


def live_rows(enriched: DataFrame) -> DataFrame:
    """Rows as the live table stores them: key ``icao24`` (null/empty -> ``unknown``)."""
    return enriched.withColumn("icao24", aircraft_key("icao24"))


def live_table(enriched: DataFrame, order=ARRIVAL_ORDER) -> DataFrame:
    """Latest state per aircraft (last arrival wins)."""
    return latest_by_key(live_rows(enriched), ["icao24"], list(order), LIVE_COLUMNS)


def enriched_table(enriched: DataFrame, order=ARRIVAL_ORDER) -> DataFrame:
    """Full enriched record per aircraft; keyed on ``icao24`` with one version."""
    return latest_by_key(live_rows(enriched), ["icao24"], list(order), ENRICHED_COLUMNS)


def latest_then_enrich(flights: DataFrame, aircraft: DataFrame, columns=LIVE_COLUMNS,
                       order=ARRIVAL_ORDER, **enrich_options) -> DataFrame:
    """Per-aircraft table computed as "latest report, then join" instead of "join, then latest".

    The dimension join then touches one row per aircraft instead of every
    report, and a dimension too large to broadcast never forces a shuffle of
    all reports. Equal to ``live_table(enrich(flights, aircraft))``: a key
    repeated in the dimension fans the surviving report out and the same
    ordering (order columns, then report columns, then metadata) picks one.
    """
    order = list(order)
    report_cols = [c for c in columns if c not in DIMENSION_COLUMNS and c != "icao24"]
    carried = report_cols + [o for o in order if o not in report_cols] + ["_raw_icao24"]
    keyed = flights.withColumn("_raw_icao24", F.col("icao24")).withColumn("icao24", aircraft_key("icao24"))
    latest = latest_by_key(keyed, ["icao24"], order, carried)
    probe = latest.withColumnRenamed("icao24", "_key").withColumnRenamed("_raw_icao24", "icao24")
    joined = enrich(probe, aircraft, **enrich_options).drop("icao24").withColumnRenamed("_key", "icao24")
    # one row per key again (only a repeated dimension key can break that); K rows, cheap
    return latest_by_key(joined, ["icao24"], order, [c for c in columns if c != "icao24"]).select(*columns)


def alert_rows(enriched: DataFrame, extra=()) -> DataFrame:
    """Rapid-descent reports in the alerts table's shape, before the keyed overwrite.

    ``extra`` carries further ordering columns (e.g. a Kafka ``offset``)."""
    return rapid_descent(enriched).select(
        aircraft_key("icao24").alias("icao24"),
        F.coalesce(F.col("ingestion_ts"), F.lit(0)).cast("long").alias("ingestion_ts"),
        F.col("vertical_rate").alias("vrate"),
        F.col("baro_altitude").alias("alt"),
        F.col("callsign"),
        F.col("operator"),
        F.col("origin_country").alias("country"),
        F.coalesce(F.col("ingestion_ts"), F.lit(0)).cast("long").alias("ts"),
        F.col("last_contact"),
        *[F.col(c) for c in extra],
    )


def alerts_then_enrich(flights: DataFrame, aircraft: DataFrame, order=("last_contact",), extra=(), **enrich_options) -> DataFrame:
    """``alerts_table`` computed as "one report per pair, then join": the join sees only the alerts.

    Equal to the reduction of joined alerts: the same order picks the report, then the metadata.
    """
    order = list(order)
    keys = ["icao24", "ingestion_ts"]
    bare = flights.withColumn("operator", F.lit(None).cast("string")).withColumn("_raw_icao24", F.col("icao24"))
    rows = alert_rows(bare, [*extra, "_raw_icao24"]).drop("operator")
    carried = [c for c in rows.columns if c not in keys]
    first = latest_by_key(rows, keys, order, carried)
    probe = first.withColumnRenamed("icao24", "_key").withColumnRenamed("_raw_icao24", "icao24")
    joined = enrich(probe, aircraft, **enrich_options).drop("icao24").withColumnRenamed("_key", "icao24")
    columns = [c for c in ALERT_COLUMNS if c not in keys] + [o for o in order if o not in ALERT_COLUMNS]
    latest = latest_by_key(joined, keys, order, columns)
    return latest.withColumn("row_key", row_key(F.col("icao24"), F.col("ingestion_ts")))


def alert_pairs(flights: DataFrame) -> DataFrame:
    """The keys of the alerts table, for those who only count them: no join, no report column."""
    return rapid_descent(flights).select(
        aircraft_key("icao24").alias("icao24"), F.coalesce(F.col("ingestion_ts"), F.lit(0)).cast("long").alias("ingestion_ts")).distinct()


def alerts_table(enriched: DataFrame) -> DataFrame:
    """One alert per (icao24, ingestion_ts); a repeat of the pair overwrites (last arrival wins)."""
    rows = alert_rows(enriched)
    latest = latest_by_key(rows, ["icao24", "ingestion_ts"], ["last_contact"],
                           [c for c in ALERT_COLUMNS if c not in ("icao24", "ingestion_ts")])
    return latest.withColumn("row_key", row_key(F.col("icao24"), F.col("ingestion_ts")))


def agg_table(enriched: DataFrame) -> DataFrame:
    """Sliding-window aggregates keyed (country, window_end) plus the store's row key."""
    agg = country_window_agg(enriched)
    return with_agg_key(agg)


def with_agg_key(agg: DataFrame) -> DataFrame:
    ck = country_key("country")
    return agg.withColumn("country_key", ck).withColumn("row_key", row_key(ck, F.col("window_end")))
