"""Turns in order: the place of each row within its key, also where one key holds a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import stash


def ranked(rows: DataFrame, key: str, order: Sequence[Column], name: str = "ranked") -> DataFrame:
    """``rows`` with ``pos``, the 0-based place of a row among those of its ``key`` by ``order``.

    Rows are dealt out by ranges of (key, order), so a key with many rows is spread over several tasks.
    Each task numbers its own stretch of a key; a key that reaches into further stretches adds the
    lengths of those before. Such stretches are at most twice as many as there are tasks, so they are
    sent to every task. Rows that are alike in ``order`` are numbered in any order. Null keys are a key.
    """
    # alike rows are dealt out too, by the place they were read from
    marked = rows.withColumn("read_at", F.monotonically_increasing_id())
    dealt = (marked.repartitionByRange(F.col(key).asc_nulls_first(), *order, F.col("read_at"))
             .withColumn("part", F.spark_partition_id()))
    dealt = stash(dealt, name)
    stretches = dealt.groupBy(key, "part").agg(F.count("*").alias("n"))
    crossing = stretches.groupBy(F.col(key).alias("crossing")).agg(F.count("*").alias("parts")).filter("parts > 1")
    before = (stretches.join(F.broadcast(crossing), F.col(key).eqNullSafe(F.col("crossing")))
              .withColumn("before", F.sum("n").over(Window.partitionBy("crossing").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
              .filter("before is not null").select("crossing", F.col("part").alias("crossing_part"), "before"))
    local = F.row_number().over(Window.partitionBy(key, "part").orderBy(*order, F.col("read_at"))) - 1
    return (dealt.withColumn("pos", local.cast("bigint"))
            .join(F.broadcast(before), F.col(key).eqNullSafe(F.col("crossing")) & (F.col("part") == F.col("crossing_part")), "left")
            .withColumn("pos", F.col("pos") + F.coalesce("before", F.lit(0)))
            .drop("read_at", "part", "crossing", "crossing_part", "before"))
