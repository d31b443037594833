"""The aircraft dimension: header-named CSV, all strings, six columns kept."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from contrail.schemas import AIRCRAFT_COLUMNS


def read_aircraft_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header row, no type inference; columns matched by name, not position."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return raw.select(*AIRCRAFT_COLUMNS)


def write_aircraft_csv(df: DataFrame, path: str) -> None:
    df.select(*AIRCRAFT_COLUMNS).write.mode("overwrite").option("header", True).csv(path)


def pin_dimension(df: DataFrame) -> tuple[DataFrame, int]:
    """Persist the dimension (memory, spill to disk) and count it, filling the cache."""
    pinned = df.persist(StorageLevel.MEMORY_AND_DISK)
    return pinned, pinned.count()


def release_dimension(df: DataFrame) -> None:
    """Drop the pinned dimension from the cache (on pipeline stop)."""
    df.unpersist()
