"""Aggregations: the sliding-window traffic aggregate, value counts, bands, histograms.

All are two-phase hash aggregates (partial aggregate before the shuffle), so a
hot group costs one buffer per map task rather than one task holding its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.scalars import epoch_seconds, half_up, in_units, unit_sums, units_of

WINDOW_LENGTH = "5 minutes"
WINDOW_SLIDE = "1 minute"
# Right-closed altitude bands in metres (above 14000 m is in none)
# and the dashboard's label of each band, in band order.
ALTITUDE_EDGES = [0, 3000, 6000, 9000, 10000, 11000, 12000, 14000]
ALTITUDE_LABELS = ["<3k", "3-6k", "6-9k", "9-10k", "10-11k", "11-12k", ">12k"]


#: Partial sums of a group of reports, in the order of ``pane_sums``; every one adds up or is a maximum.
PANE_SUMS = ["n", "alt_hi", "alt_lo", "alt_n", "alt_max", "vel_hi", "vel_lo", "vel_n"]


def pane_sums() -> list[Column]:
    """Aggregates of reports that make their partial sums."""
    return [F.count(F.lit(1)).alias("n"), *unit_sums("baro_altitude", "alt"), F.max(in_units("baro_altitude")).alias("alt_max"),
            *unit_sums("velocity", "vel")]


def merge_sums() -> list[Column]:
    """Aggregates that put partial sums together."""
    return [(F.max if c == "alt_max" else F.sum)(c).alias(c) for c in PANE_SUMS]


def _shown(agg: DataFrame, start: Column, end: Column) -> DataFrame:
    """Sums by (window, ``country``) as the aggregate table shows them."""
    agg = agg.withColumns({"_alt": units_of("alt"), "_vel": units_of("vel"), "_max": F.col("alt_max").cast("decimal(28,0)"), "_one": F.least("alt_n", F.lit(1))})
    return agg.select("country", start.alias("window_start"), end.alias("window_end"), F.col("n").alias("flight_count"),
                      half_up("_alt", "alt_n").alias("avg_alt"), half_up("_max", "_one").alias("max_alt"), half_up("_vel", "vel_n").alias("avg_velocity"))


def seconds_of(interval: str) -> int:
    """Whole seconds of an interval in minutes or seconds, such as ``5 minutes``."""
    n, unit = interval.split()
    return int(n) * {"second": 1, "minute": 60}[unit.rstrip("s")]


def country_panes(df: DataFrame, slide: str = WINDOW_SLIDE, extra: Sequence[Column] = ()) -> DataFrame:
    """Partial sums by (country, ``pane_start``): the stretches of one slide that sliding windows are made of.

    ``extra``: further aggregates.
    """
    agg = (df.where(F.col("origin_country").isNotNull())
           .groupBy(F.window("event_time", slide).alias("w"), F.col("origin_country").alias("country")).agg(*extra, *pane_sums()))
    return agg.withColumn("pane_start", epoch_seconds(F.col("w.start"))).drop("w")


def windows_of_panes(panes: DataFrame, length: str = WINDOW_LENGTH, slide: str = WINDOW_SLIDE, closed: str | None = None) -> DataFrame:
    """The window aggregate, each pane being added to every window that it lies in.

    ``closed``: a column with a time; the windows that end by then do not take the pane (null: all do).
    """
    size, step = seconds_of(length), seconds_of(slide)
    starts = panes.withColumn("start", F.explode(F.sequence(F.col("pane_start") - (size - step), F.col("pane_start"), F.lit(step))))
    if closed is not None:
        starts = starts.where(F.col(closed).isNull() | (F.col("start") + size > F.col(closed)))
    return _shown(starts.groupBy("country", "start").agg(*merge_sums()), F.col("start"), F.col("start") + size)


def country_window_agg(df: DataFrame, length: str = WINDOW_LENGTH, slide: str = WINDOW_SLIDE) -> DataFrame:
    """Per (sliding window, origin_country): messages, avg/max altitude, avg velocity.

    Rows with a null country or null ``event_time`` are in no window. Averages and maxima of groups without a value read
    as 0; values without a whole number of units (NaN, or from 9e10 on) count as missing. Averages are exact: values are
    summed in whole 1e-8 units and rounded half-up to 2 dp, whatever order rows come in. A batch is reduced to
    panes of one slide first, so a report is looked at once, and only panes are repeated for their windows; a stream keeps
    the sums of its windows as state.
    """
    if not df.isStreaming and seconds_of(length) % seconds_of(slide) == 0:
        return windows_of_panes(country_panes(df, slide), length, slide)
    agg = (df.where(F.col("origin_country").isNotNull())
           .groupBy(F.window("event_time", length, slide).alias("w"), F.col("origin_country").alias("country")).agg(*pane_sums()))
    return _shown(agg, epoch_seconds(F.col("w.start")), epoch_seconds(F.col("w.end")))


def value_counts(df: DataFrame, col: str, n: int, count_name: str = "count") -> DataFrame:
    """Most frequent values of ``col`` (ties by value ascending), at most ``n``."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
            .orderBy(F.desc(count_name), F.asc(col)).limit(n))


def band_label(lo: float, hi: float) -> str:
    return f"({lo}, {hi}]"


def altitude_band_counts(df: DataFrame, col: str = "altitude") -> DataFrame:
    """Counts in the seven right-closed bands, every band present (empty = 0)."""
    x = F.col(col)
    idx = None
    for i in range(len(ALTITUDE_EDGES) - 1):
        cond = (x > ALTITUDE_EDGES[i]) & (x <= ALTITUDE_EDGES[i + 1])
        idx = F.when(cond, i) if idx is None else idx.when(cond, i)
    counted = df.select(idx.alias("band_order")).where(F.col("band_order").isNotNull()) \
        .groupBy("band_order").agg(F.count(F.lit(1)).alias("flights"))
    spark = df.sparkSession
    bands = spark.createDataFrame(
        [(i, band_label(ALTITUDE_EDGES[i], ALTITUDE_EDGES[i + 1]), ALTITUDE_LABELS[i],
          float(ALTITUDE_EDGES[i]), float(ALTITUDE_EDGES[i + 1]))
         for i in range(len(ALTITUDE_EDGES) - 1)],
        "band_order int, band string, label string, lo double, hi double")
    # Seven fixed rows on the build side: a broadcast of proven size.
    return (bands.join(F.broadcast(counted), "band_order", "left")
            .select("band_order", "band", "label", "lo", "hi",
                    F.coalesce("flights", F.lit(0)).cast("long").alias("flights")))


def equal_width_histogram(df: DataFrame, col: str, bins: int = 30, count_name: str = "count") -> DataFrame:
    """``bins`` equal-width bins between min and max of ``col``, those without a value too (0).

    No value gives no bin; values that are all equal give one bin of no width. min and max come from one scalar
    subquery (``DataFrame.scalar``, run once however often it is referenced), so the whole thing is one lazy plan:
    two aggregates, no driver round trip, and a join of at most ``bins`` counts with the ``bins`` numbers.
    """
    x = F.col(col)
    vals = df.where(x.isNotNull()).select(x.alias("x"))
    bounds = vals.select(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    lo, hi = bounds.getField("lo"), bounds.getField("hi")
    width = (hi - lo) / F.lit(float(bins))
    raw = F.floor(F.try_divide(F.col("x") - lo, width))
    b = F.when(hi == lo, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")
    counted = vals.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias(count_name))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).where((hi > lo) | ((hi == lo) & (F.col("bin") == 0)))
    # at most ``bins`` rows on the build side: a broadcast of proven size
    return every.join(F.broadcast(counted), "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_lo"),
        (lo + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(count_name, F.lit(0)).cast("long").alias(count_name),
    )
