"""Message sources: Kafka topic or landing folder of JSON lines -> flight rows.

``decode_messages`` only needs a column holding the JSON payload, so the same
plan serves a Kafka stream, a file stream and a batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from contrail.schemas import FLIGHT_SCHEMA, MESSAGE_FIELDS

CORRUPT_COLUMN = "_corrupt_record"


def read_kafka(spark: SparkSession, bootstrap_servers: str, topic: str, *,
               starting_offsets: str = "latest", fail_on_data_loss: bool = False,
               max_offsets_per_trigger: int | None = None, streaming: bool = True) -> DataFrame:
    """Subscribe to one topic (needs the spark-sql-kafka connector on the classpath).

    Keeps ``partition``/``offset`` so arrival order can order the latest-state table.
    ``max_offsets_per_trigger`` caps a micro-batch (5000 reproduces the original
    setting); uncapped by default, since a fixed cap below the arrival rate
    makes the stream fall further behind every trigger.
    """
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = (reader.option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if streaming:
        reader = reader.option("startingOffsets", starting_offsets)
        if max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    return reader.load()


def read_message_files(spark: SparkSession, path: str, *, streaming: bool = True,
                       max_files_per_trigger: int | None = None,
                       max_bytes_per_trigger: str | None = None, recursive: bool = False) -> DataFrame:
    """JSON-lines landing folder as a ``value`` column (one message per line).

    A trigger takes all that has landed; ``max_bytes_per_trigger`` (such as
    ``"64g"``) bounds a catch-up batch by size, ``max_files_per_trigger`` by files.
    ``recursive`` also reads folders that land inside ``path``.
    """
    reader = (spark.readStream if streaming else spark.read).format("text")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if not streaming:
        return reader.load(path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.load(path)


def decode_messages(df: DataFrame, value_col: str = "value", *, keep: tuple[str, ...] = (),
                    keep_corrupt: bool = False) -> DataFrame:
    """Payload bytes/text -> the 15 typed message fields (PERMISSIVE parsing).

    A malformed message yields an all-null row; a bad field nulls only that
    field. ``keep`` carries extra source columns (e.g. Kafka partition/offset).
    ``keep_corrupt`` adds ``_corrupt_record`` with the raw text of bad messages.
    """
    schema = FLIGHT_SCHEMA
    opts = {}
    if keep_corrupt:
        schema = StructType(FLIGHT_SCHEMA.fields + [StructField(CORRUPT_COLUMN, StringType(), True)])
        opts = {"columnNameOfCorruptRecord": CORRUPT_COLUMN}
    text = F.col(value_col).cast("string")
    parsed = df.select(*[F.col(c) for c in keep], F.from_json(text, schema, opts).alias("d"))
    return parsed.select(*keep, "d.*")


def to_messages(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Keyed JSON publish form: ``key`` = icao24, ``value`` = the message with nulls kept.

    The message has the published fields that ``df`` has, in their fixed order.
    ``keep`` carries further columns alongside (they are not part of the message)."""
    fields = [c for c in MESSAGE_FIELDS if c in df.columns]
    return df.select(
        F.col("icao24").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
        *[F.col(c) for c in keep],
    )


def publish_kafka(df: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str | None = None):
    """Write keyed messages to Kafka (acks=all, 3 retries); batch or stream."""
    out = to_messages(df)
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic,
            "kafka.acks": "all", "kafka.retries": "3"}
    if out.isStreaming:
        w = out.writeStream.format("kafka").options(**opts)
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        return w.start()
    out.write.format("kafka").options(**opts).save()
    return None
