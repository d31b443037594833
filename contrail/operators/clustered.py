"""Key-clustered tables: the first rows in key order, or those of one key prefix, without reading the table.

A clustered table is dealt out by ranges of its key and sorted within each file, and keeps a small zone table:
rows, least and largest key of every row group's worth of a file. Zones give a bound below which there are
surely enough rows; the scan then opens the few files whose zones reach below it and Parquet's own row-group
statistics skip the rest of those. Nothing is sorted but the rows below the bound.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a zone and bytes of a Parquet row group: small, since a scan wants hundreds of rows.
ZONE_ROWS = 8192
GROUP_BYTES = 1 << 20


@dataclass
class ClusteredTable:
    """A table under ``path`` in order of a string column ``key``; rows with a null key come first, as in a sort."""

    path: str
    key: str

    @property
    def _data(self) -> str:
        return f"{self.path.rstrip('/')}/data"

    @property
    def _zones(self) -> str:
        return f"{self.path.rstrip('/')}/zones"

    def write(self, df: DataFrame, zone_rows: int = ZONE_ROWS) -> "ClusteredTable":
        """Write ``df`` once, then read its key column back for the zones."""
        spark = df.sparkSession
        order = F.col(self.key).asc_nulls_first()
        (df.repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite")
         .option("parquet.block.size", GROUP_BYTES).option("parquet.page.size", GROUP_BYTES // 8)
         .option("parquet.page.row.count.limit", zone_rows).parquet(self._data))
        rows = spark.read.schema(df.schema).parquet(self._data).select(
            F.col(self.key).alias("k"), F.col("_metadata.file_path").alias("file"),
            F.expr(f"_metadata.row_index div {zone_rows}").alias("zone"))
        (rows.groupBy("file", "zone").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("least"), F.max("k").alias("most"),
                                          F.count_if(F.col("k").isNull()).alias("nulls"))
         .coalesce(1).write.mode("overwrite").parquet(self._zones))
        return self

    def zones(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("file string, zone bigint, n bigint, least string, most string, nulls bigint").parquet(self._zones)

    def _files(self, spark: SparkSession, zones: DataFrame) -> DataFrame | None:
        """The rows of the files that some of ``zones`` lie in; None if there are none.

        Only their names reach the driver, which has to name files to open them; a bounded scan finds few.
        """
        names = [r.file for r in zones.select("file").distinct().collect()]
        schema = spark.read.parquet(self._data).schema
        return spark.read.schema(schema).parquet(*names) if names else None

    def _empty(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self._data).where(F.lit(False))

    def first(self, spark: SparkSession, n: int) -> DataFrame:
        """The first ``n`` rows in key order (ties at the end: any of them); the whole table if it has fewer."""
        zones = self.zones(spark)
        files = zones.groupBy("file").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n").alias("n"), F.sum("nulls").alias("nulls"))
        reach = _reach(files, n)
        if reach.z:  # among the zones of the files that far, which are few
            zones = zones.where(_below(reach.most))
            reach = _reach(zones, n)
        if reach.z == 0:
            rows = spark.read.parquet(self._data)
        else:
            rows = self._files(spark, zones.where(_below(reach.most)))
            wanted = F.col(self.key).isNull() if reach.most is None else F.col(self.key).isNull() | (F.col(self.key) <= reach.most)
            rows = rows.where(wanted)
        return rows.orderBy(F.col(self.key).asc_nulls_first()).limit(n)

    def prefix(self, spark: SparkSession, prefix: str, n: int | None = None) -> DataFrame:
        """Rows whose key starts with ``prefix`` in key order, at most ``n``."""
        inside = F.col("most") >= prefix
        end = _after(prefix)
        if end is not None:
            inside = inside & (F.col("least") < end)
        rows = self._files(spark, self.zones(spark).where(inside))
        if rows is None:
            return self._empty(spark)
        wanted = F.col(self.key) >= prefix
        if end is not None:
            wanted = wanted & (F.col(self.key) < end)
        rows = rows.where(wanted).orderBy(self.key)
        return rows if n is None else rows.limit(n)


def _reach(parts: DataFrame, n: int):
    """(most, z): parts in order of their largest key, up to the first with which they hold ``n`` rows in all: its largest key.

    All their rows are at or below that key. z is 0 if there are fewer rows.
    """
    run = Window.orderBy(F.col("most").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = parts.select("most", F.sum("n").over(run).alias("total"))
    # a part whose keys are all null comes first, and min passes over it
    first = F.when(F.count_if(F.col("most").isNull()) == 0, F.min("most"))
    return held.where(F.col("total") >= n).agg(first.alias("most"), F.count(F.lit(1)).alias("z")).first()


def _below(most: str | None) -> Column:
    return F.col("nulls") > 0 if most is None else (F.col("nulls") > 0) | (F.col("least") <= most)


def _after(prefix: str) -> str | None:
    """The least string above all that start with ``prefix`` in code-point order; None if there is none."""
    kept = prefix.rstrip("\U0010ffff")
    if not kept:
        return None
    last = ord(kept[-1]) + 1
    return kept[:-1] + chr(0xE000 if last == 0xD800 else last)
