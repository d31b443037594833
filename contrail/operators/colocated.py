"""Reports and a dimension too large to broadcast, laid out alike so that their join moves neither.

Both tables are bucketed and sorted by (key, salt). A key with over twice a bucket's share of the reports is salted: its
reports are dealt over as many salts as fair shares it holds and its dimension rows repeated once a salt, as the salted
join does, but once, when the tables are written; reports without a key are dealt over the buckets. The join then reads
bucket by bucket: no exchange on either side, one task a bucket, however often it is run.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators.enrich import hot_keys

SALT = "_salt"


@dataclass
class ColocatedTables:
    """Reports and dimension under ``path``, in ``buckets`` files of each a write.

    The tables are known to the session's catalog by names made from the path; ``open`` makes them known to a new
    session. ``buckets`` is part of the layout and must not change: about the bytes of all reports / 1 GB, and at
    least the task slots.
    """

    path: str
    key: str = "icao24"
    buckets: int = 200

    def _at(self, part: str) -> str:
        return f"{self.path.rstrip('/')}/{part}"

    def _name(self, part: str) -> str:
        return f"colocated_{part}_{hashlib.md5(self.path.rstrip('/').encode()).hexdigest()[:12]}"

    def write(self, reports: DataFrame, dimension: DataFrame, min_rows: int = 10_000) -> "ColocatedTables":
        """Measure the hot keys of ``reports`` (one counting pass) and write both tables anew."""
        hot_keys(reports, self.key, self.buckets, min_rows).coalesce(1).write.mode("overwrite").parquet(self._at("hot"))
        salted = dimension.where(F.col(self.key).isNotNull()).join(self._hot(dimension.sparkSession), self.key, "left")
        salts = F.coalesce(F.col("_salts"), F.lit(1))
        rows = salted.select(*[F.col(c) for c in dimension.columns], F.explode(F.sequence(F.lit(0), salts - 1)).alias(SALT))
        self._save(rows, "dimension", "overwrite")
        return self._save(self._dealt(reports), "reports", "overwrite")

    def add(self, reports: DataFrame) -> "ColocatedTables":
        """Append reports, salted by the keys that were hot when the tables were written."""
        return self._save(self._dealt(reports), "reports", "append")

    def _hot(self, spark: SparkSession) -> DataFrame:
        # at most half as many rows as there are buckets
        return F.broadcast(spark.read.schema(f"{self.key} string, _salts int").parquet(self._at("hot")))

    def _dealt(self, reports: DataFrame) -> DataFrame:
        number = F.monotonically_increasing_id()
        salts = F.when(F.col(self.key).isNull(), F.lit(16 * self.buckets)).otherwise(F.coalesce(F.col("_salts"), F.lit(1)))
        joined = reports.join(self._hot(reports.sparkSession), self.key, "left").withColumn("_number", number)
        return joined.select(*[F.col(c) for c in reports.columns], F.pmod(F.col("_number"), salts).cast("int").alias(SALT))

    def _save(self, rows: DataFrame, part: str, mode: str) -> "ColocatedTables":
        # repartition deals rows out as bucketing does, so that a write leaves one file a bucket
        (rows.repartition(self.buckets, self.key, SALT).write.mode(mode).format("parquet").option("path", self._at(part))
         .bucketBy(self.buckets, self.key, SALT).sortBy(self.key, SALT).saveAsTable(self._name(part)))
        return self

    def open(self, spark: SparkSession) -> "ColocatedTables":
        """Make written tables known to this session."""
        for part in ("reports", "dimension"):
            if not spark.catalog.tableExists(self._name(part)):
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(self._at(part)).schema.fields)
                spark.sql(f"CREATE TABLE {self._name(part)} ({columns}) USING parquet CLUSTERED BY (`{self.key}`, `{SALT}`) "
                          f"SORTED BY (`{self.key}`, `{SALT}`) INTO {self.buckets} BUCKETS LOCATION '{self._at(part)}'")
        return self

    def joined(self, spark: SparkSession, where: Column | None = None) -> DataFrame:
        """Left join of the reports (those that ``where`` holds for) with the dimension."""
        reports = spark.table(self._name("reports"))
        if where is not None:
            reports = reports.where(where)
        return reports.join(spark.table(self._name("dimension")).hint("merge"), [self.key, SALT], "left").drop(SALT)
