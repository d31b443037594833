"""The latest report of each aircraft kept as streaming state, and that state read back from the checkpoint.

The table of latest reports is the state itself: one row an aircraft in a RocksDB store, updated by each micro-batch,
which writes only the aircraft that reported. ``read_latest_state`` opens the store of a stopped (or running) query as a
table, at any batch that the checkpoint still keeps, to check or to rebuild the result table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from contrail.functions.scalars import aircraft_key
from contrail.operators.rank import latest_by_key
from contrail.plans.tables import ARRIVAL_ORDER
from contrail.session import session_conf, stream_partitions
from contrail.streaming.pipeline import DEFAULT_TRIGGER, ROCKSDB_PROVIDER
from contrail.streaming.sinks import KeyedTable


def latest_state(reports: DataFrame, columns: Sequence[str], order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """Latest report by ``order`` of each aircraft (``icao24`` and ``columns``); of a stream, in update mode."""
    carried = [c for c in columns if c != "icao24"]
    keyed = reports.withColumn("icao24", aircraft_key("icao24"))
    return latest_by_key(keyed, ["icao24"], list(order), carried)


def start_latest(reports: DataFrame, table: KeyedTable, checkpoint: str, columns: Sequence[str], order: Sequence[str] = ARRIVAL_ORDER,
                 trigger: dict | None = None, state_partitions: int | None = None, state_store: str = "rocksdb") -> StreamingQuery:
    """Keep the latest reports as state under ``checkpoint`` and write those that changed to ``table``."""
    spark = reports.sparkSession
    conf = {"spark.sql.shuffle.partitions": state_partitions or stream_partitions(spark)}
    if state_store == "rocksdb":
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    with session_conf(spark, **conf):
        return (latest_state(reports, columns, order).writeStream.outputMode("update").trigger(**(trigger or DEFAULT_TRIGGER))
                .option("checkpointLocation", checkpoint).foreachBatch(table.write_batch).start())


def read_latest_state(spark: SparkSession, checkpoint: str, columns: Sequence[str], order: Sequence[str] = ARRIVAL_ORDER,
                      batch: int | None = None) -> DataFrame:
    """The state after ``batch`` (the last one, if not given) as the table of latest reports.

    One task a state partition reads its store; nothing is shuffled, as a key is in one partition only.
    """
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    rows = reader.load(checkpoint)
    held = rows.schema["value"].dataType.fieldNames()[0]  # the aggregate's one buffer: order values, then columns
    fields = rows.schema["value"].dataType[held].dataType.fieldNames()[len(order):]
    best = F.col("value").getField(held)
    out = rows.select(F.col("key").getField("icao24").alias("icao24"), *[best.getField(f).alias(f) for f in fields])
    return out.select(*columns)


def state_stores(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Operators of a checkpoint with their stores, partitions and the batches whose state can still be read."""
    return spark.read.format("state-metadata").load(checkpoint)
