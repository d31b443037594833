"""Helpers that several operators share: table access, scratch tables, bounded samples of labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import scratch_dir

#: Characters that separate words: space and U+0009 to U+000D.
WORD_GAP = r"[\x20\x09-\x0D]+"
_GAP_CHARS = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh folder under the shared checkpoint folder and read it back.

    Cuts the lineage: what follows never recomputes ``df``, and a lost executor costs a reread only.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once for each row, also where body's lambdas use it often."""
    return F.get(F.transform(F.array(value), body), 0)


def words_of(text: Column) -> Column:
    """array<string> of the words of a text; a null text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_GAP_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))


def sample_by_hash(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows at most, chosen by a hash of ``key``; all rows when there are fewer.

    The share kept follows from one count, so the size of the result is fixed by ``bound`` (its spread
    is that of a coin toss for each row) and no task gathers rows.
    """
    n = rows.count()
    if n <= bound:
        return rows
    share = int(bound / n * 2**40)
    return rows.filter(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(2**40)) < share)


def one_label(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, y): the largest label of each document; rows without an id or a label are left out."""
    return (labels.select(F.col("doc_id").alias("doc_id"), F.col(column).cast("int").alias("y"))
            .filter("doc_id is not null and y is not null")
            .groupBy("doc_id").agg(F.max("y").alias("y")))
