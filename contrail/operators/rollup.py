"""Mergeable roll-ups by period and country, put together for any range of periods without the reports.

A partial row holds what adds up exactly (reports, whole-unit sums, maxima) and two sketches: a HyperLogLog of the
aircraft and a frequent-items sketch of the operators. Beside it lie bucket counts of altitude and velocity for quantiles.
Merging is adding, taking the larger or uniting, so neither order nor grouping of the partials matters (but for
``aircraft``: a sketch that was never united estimates a little closer, so its number may move within its bound).

Stated bounds, whatever the range: reports, means and maxima are exact; ``aircraft`` has a relative standard error of
1.04 / sqrt(2 ** HLL_BITS) (0.016), and is exact for a few hundred; an operator's count is at most 4.7 * reports /
TRACKED off and exact up to 0.75 * TRACKED operators; a quantile is the middle of the bucket in which the exact one lies,
so within 1 / 2 ** (BUCKET_BITS + 1) (0.008) of its value.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.functions.scalars import UNITS, half_up, in_units, units_of
from contrail.operators.aggregate import merge_sums, pane_sums
from contrail.session import session_conf

HLL_BITS = 12
TRACKED = 1024
BUCKET_BITS = 6
MEASURES = ("baro_altitude", "velocity")
PERIODS = {"hour": 3600, "day": 86400}


def bucket_of(c) -> Column:
    """Bucket of a value: its whole 1e-8 units with all but the first ``BUCKET_BITS`` + 1 binary digits set to zero.

    Signed; the buckets of one sign and length are equally wide. Null where the value has no whole number of units.
    """
    u = in_units(c)
    cut = F.greatest(F.length(F.bin(F.abs(u))) - F.lit(BUCKET_BITS + 1), F.lit(0))
    size = F.abs(u)
    low = F.call_function("shiftleft", F.call_function("shiftright", size, cut), cut)
    return F.when(u < 0, -low).otherwise(low)


def bucket_middle(bucket) -> Column:
    """The value that stands for a bucket; of a bucket that holds one number, that number."""
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"),
                            F.greatest(F.length(F.bin(F.abs(b))) - F.lit(BUCKET_BITS + 1), F.lit(0)))
    return (b + F.signum(b) * ((width - 1) / 2)) / float(UNITS)


def _sketches() -> list[Column]:
    named = F.when(F.col("operator") != "", F.col("operator"))
    return [F.hll_sketch_agg("icao24", HLL_BITS).alias("aircraft"),
            F.call_function("approx_top_k_accumulate", F.coalesce(named, F.lit("")), F.lit(TRACKED)).alias("operators")]


def _merge_sketches() -> list[Column]:
    return [F.hll_union_agg("aircraft").alias("aircraft"),
            F.call_function("approx_top_k_combine", F.col("operators"), F.lit(TRACKED)).alias("operators")]


@dataclass
class RollupTable:
    """Partials of enriched reports under ``path``, by period and batch.

    Each batch adds its own partials, so a period may be added to at any time; a replayed batch replaces its folders.
    Reports without a country or a time are in no roll-up.
    """

    path: str
    unit: str = "day"

    def _at(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    def add(self, reports: DataFrame, batch: int) -> "RollupTable":
        """Add a batch of enriched reports (``icao24``, ``origin_country``, ``last_contact``, ``operator`` and the measures)."""
        step = PERIODS[self.unit]
        rows = (reports.where(F.col("origin_country").isNotNull() & F.col("last_contact").isNotNull())
                .withColumns({"period": F.floor(F.col("last_contact") / step) * step, "country": F.col("origin_country")}))
        sums = rows.groupBy("period", "country").agg(*pane_sums(), *_sketches())
        values = rows.select("period", "country", F.explode(F.array(*[
            F.struct(F.lit(m).alias("measure"), bucket_of(m).alias("bucket")) for m in MEASURES])).alias("v"))
        buckets = (values.select("period", "country", "v.*").where("bucket is not null")
                   .groupBy("period", "country", "measure", "bucket").agg(F.count(F.lit(1)).alias("n")))
        with session_conf(reports.sparkSession, spark__sql__sources__partitionOverwriteMode="dynamic"):
            for name, part in (("sums", sums), ("buckets", buckets)):
                (part.withColumn("batch", F.lit(batch)).repartition("period").write.mode("overwrite")
                 .partitionBy("period", "batch").parquet(self._at(name)))
        return self

    def _partials(self, spark: SparkSession, name: str, since: int | None, until: int | None) -> DataFrame:
        rows = spark.read.parquet(self._at(name))
        if since is not None:
            rows = rows.where(F.col("period") >= since)
        return rows if until is None else rows.where(F.col("period") < until)

    def merged(self, spark: SparkSession, since: int | None = None, until: int | None = None, by: tuple[str, ...] = ("country",)) -> DataFrame:
        """Partials of the periods in [since, until) (epoch seconds) merged by ``by``: country, period, both or nothing."""
        return self._partials(spark, "sums", since, until).groupBy(*by).agg(*merge_sums(), *_merge_sketches())

    def summary(self, spark: SparkSession, since: int | None = None, until: int | None = None,
                by: tuple[str, ...] = ("country",), top: int = 3) -> DataFrame:
        """``by``, reports, aircraft, avg_alt, max_alt, avg_velocity and the ``top`` operators with their counts."""
        m = self.merged(spark, since, until, by).withColumns({
            "_alt": units_of("alt"), "_vel": units_of("vel"), "_max": F.col("alt_max").cast("decimal(28,0)"), "_one": F.least("alt_n", F.lit(1)),
            "_top": F.call_function("approx_top_k_estimate", F.col("operators"), F.lit(TRACKED))})
        held = F.transform(F.filter("_top", lambda t: t["item"] != ""), lambda t: F.struct((-t["count"]).alias("least"), t["item"].alias("item")))
        first = F.slice(F.array_sort(held), 1, top)
        return m.select(*by, F.col("n").alias("reports"), F.hll_sketch_estimate("aircraft").alias("aircraft"),
                        half_up("_alt", "alt_n").alias("avg_alt"), half_up("_max", "_one").alias("max_alt"), half_up("_vel", "vel_n").alias("avg_velocity"),
                        F.array_join(F.transform(first, lambda t: F.concat_ws(":", t["item"], (-t["least"]).cast("string"))), ",").alias("top_operators"))

    def quantiles(self, spark: SparkSession, qs: tuple[float, ...], since: int | None = None, until: int | None = None,
                  by: tuple[str, ...] = ("country",)) -> DataFrame:
        """(by, measure, q, value): the least value with at least a share ``q`` of the values at or below it, to its bucket.

        The running sum is over the buckets of one group: some 64 for each doubling of the values, however many reports.
        """
        counts = self._partials(spark, "buckets", since, until).groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
        group = Window.partitionBy(*by, "measure")
        run = counts.withColumns({"upto": F.sum("n").over(group.orderBy("bucket")), "total": F.sum("n").over(group)})
        wanted = run.withColumn("q", F.explode(F.array(*map(F.lit, qs))))
        at = F.greatest(F.ceil(F.col("q") * F.col("total")), F.lit(1))
        return (wanted.where((F.col("upto") >= at) & (F.col("upto") - F.col("n") < at))
                .select(*by, "measure", "q", bucket_middle("bucket").alias("value")))
