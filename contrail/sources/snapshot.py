"""Positional state-vector snapshots and replay files.

A snapshot is ``{"time": t, "states": [[17 mixed values], ...]}``; a replay
file is the bare ``states`` list. Decoding is ``from_json`` into
``array<array<string>>`` (numbers, booleans and nested arrays arrive as their
JSON text), ``explode``, then ``try_cast`` per slot. Null or empty states and
states without an address are dropped.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from contrail.functions.scalars import clean_callsign
from contrail.schemas import EXTRA_SCHEMA, FLIGHT_SCHEMA, STATE_SLOTS, STATE_WIDTH

SNAPSHOT_SCHEMA = "struct<time: bigint, states: array<array<string>>>"
REPLAY_SCHEMA = "array<array<string>>"
DEFAULT_CHUNK_ROWS = 5000


def _json_text(c: Column, quoted: bool) -> Column:
    """JSON text of one scalar (``"abc"``, ``1.5``, ``false``, ``null``).

    Only strings need JSON quoting and escaping (``to_json`` of a one-element
    array, brackets cut off); numbers and booleans print as Spark casts them,
    which parses back to the same value.
    """
    if quoted:
        arr = F.to_json(F.array(c))
        return arr.substr(F.lit(2), F.length(arr) - 2)
    return F.coalesce(c.cast("string"), F.lit("null"))


def state_vectors(df: DataFrame) -> DataFrame:
    """Flight rows -> one positional state array (JSON text) per row.

    Fields beyond the 15 of a flight row (sensors, spi, position_source) are taken where ``df`` has them.
    """
    slot_of = {v: k for k, v in STATE_SLOTS.items()}
    types = {f.name: f.dataType for f in FLIGHT_SCHEMA.fields + EXTRA_SCHEMA.fields}
    absent = {"sensors": "null", "spi": "false", "position_source": "0"}
    elems = []
    for i in range(STATE_WIDTH):
        name = slot_of[i]
        if name in absent and name not in df.columns:
            elems.append(F.lit(absent[name]))
        elif isinstance(types[name], ArrayType):
            elems.append(F.coalesce(F.to_json(F.col(name)), F.lit("null")))
        else:
            elems.append(_json_text(F.col(name), isinstance(types[name], StringType)))
    return df.select("*", F.concat(F.lit("["), F.concat_ws(",", *elems), F.lit("]")).alias("state_json"))


def snapshot_documents(df: DataFrame, *, chunk_rows: int = DEFAULT_CHUNK_ROWS, bare: bool = False) -> DataFrame:
    """Group state vectors into documents, one poll (``ingestion_ts``) per document.

    A poll is cut into chunks of at most ``chunk_rows`` consecutive rows of one
    input partition, so no document (and no aggregation group) grows with a hot
    poll. ``bare=True`` writes the replay form (a bare list).
    """
    sv = state_vectors(df).select(
        "ingestion_ts", "state_json",
        F.floor(F.monotonically_increasing_id() / F.lit(chunk_rows)).alias("chunk"),
    )
    grouped = sv.groupBy("ingestion_ts", "chunk").agg(F.concat_ws(",", F.collect_list("state_json")).alias("s"))
    if bare:
        doc = F.concat(F.lit("["), F.col("s"), F.lit("]"))
    else:
        doc = F.concat(F.lit('{"time":'), F.col("ingestion_ts").cast("string"), F.lit(',"states":['),
                       F.col("s"), F.lit("]}"))
    return grouped.select("ingestion_ts", "chunk", doc.alias("doc"))


def _states_to_rows(exploded: DataFrame, all_fields: bool) -> DataFrame:
    s = F.col("s")
    valid = exploded.where((F.size(s) > 0) & F.get(s, 0).isNotNull())
    cols = []
    for field in FLIGHT_SCHEMA.fields + (EXTRA_SCHEMA.fields if all_fields else []):
        if field.name == "ingestion_ts":
            cols.append(F.col("t").cast("long").alias("ingestion_ts"))
        elif field.name == "callsign":
            cols.append(clean_callsign(F.get(s, STATE_SLOTS["callsign"])).alias("callsign"))
        elif isinstance(field.dataType, ArrayType):
            cols.append(F.from_json(F.get(s, STATE_SLOTS[field.name]), field.dataType).alias(field.name))
        else:
            cols.append(F.get(s, STATE_SLOTS[field.name]).try_cast(field.dataType).alias(field.name))
    return valid.select(*cols)


def _poll_stamp(ingestion_ts: Column | None) -> Column:
    """The given stamp, else the time of this read: one value for all rows of a poll."""
    return ingestion_ts if ingestion_ts is not None else F.unix_timestamp(F.current_timestamp())


def decode_snapshot(df: DataFrame, doc_col: str = "doc", ingestion_ts: Column | None = None,
                    all_fields: bool = False) -> DataFrame:
    """Snapshot documents -> flight rows; ``all_fields`` adds sensors, spi and position_source.

    ``ingestion_ts`` may be any column of ``df``; it defaults to the time of the read, as a poll stamps it.
    """
    states = F.from_json(F.col(doc_col), SNAPSHOT_SCHEMA).getField("states")
    return _states_to_rows(df.select(_poll_stamp(ingestion_ts).alias("t"), F.explode(states).alias("s")), all_fields)


def decode_replay(df: DataFrame, doc_col: str = "doc", ingestion_ts: Column | None = None,
                  all_fields: bool = False) -> DataFrame:
    """Replay documents (bare lists) -> flight rows; bad or missing documents give none."""
    states = F.from_json(F.col(doc_col), REPLAY_SCHEMA)
    return _states_to_rows(df.select(_poll_stamp(ingestion_ts).alias("t"), F.explode(states).alias("s")), all_fields)


def read_replay(spark: SparkSession, path: str, ingestion_ts: Column | None = None) -> DataFrame:
    """Replay files (one bare list per file) -> flight rows; a missing path gives no rows, other errors are raised."""
    try:
        docs = spark.read.text(path, wholetext=True).withColumnRenamed("value", "doc")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FLIGHT_SCHEMA)
    return decode_replay(docs, "doc", ingestion_ts)
