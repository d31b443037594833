"""Tolerant decoding: what can be read of a message is kept, and what cannot is set aside with its reason.

A payload is parsed once into a VARIANT. Each field is then read by itself, so a bad one does not cost its neighbours,
a number in quotes still counts (-0.0 reads as 0.0), and a state vector that is no list does not cost its snapshot. A report carries its
``faults``; ``quarantine`` turns them into rows with the raw text, for a table beside the archive.

Reasons: ``absent`` (a null payload), ``not json``, ``not an object`` (``not a list`` for a state vector), ``no address``
and ``bad field``. A report is kept if it has an address; one without is quarantined whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, LongType, StructField

from contrail.schemas import EXTRA_SCHEMA, FLIGHT_SCHEMA, STATE_SLOTS
from contrail.streaming.pipeline import DEFAULT_TRIGGER
from contrail.streaming.sinks import append_batch

#: Fixed value: place of the aircraft category in the longer state vectors.
CATEGORY_SLOT = 17
CATEGORY = StructField("category", LongType(), True)
FAULT = "struct<reason:string,field:string,text:string>"


def _value(text: Column, kind: DataType) -> Column:
    """Text of one JSON value as ``kind``, or null: whole numbers for bigint, finite ones for double, true/false for boolean."""
    if isinstance(kind, LongType):
        return F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(text)).try_cast(kind)
    if isinstance(kind, DoubleType):
        number = text.try_cast(kind)
        return F.when(F.abs(number) < float("inf"), number)  # NaN is above all numbers
    if isinstance(kind, BooleanType):
        return F.when(text.isin("true", "false"), text == "true")
    if isinstance(kind, ArrayType):
        whole = F.try_variant_get(F.try_parse_json(text), "$", "array<string>")
        return F.when(~F.exists(whole, lambda x: x.isNotNull() & ~x.rlike(r"^[+-]?[0-9]{1,18}$")), whole.cast(kind))
    return text.cast(kind)


def _fault(reason: str, field: Column, text: Column) -> Column:
    return F.struct(F.lit(reason).alias("reason"), field.cast("string").alias("field"), text.alias("text"))


def _fields(df: DataFrame, doc: str, paths: dict[str, str], fields: Sequence[StructField]) -> tuple[DataFrame, list[Column], Column]:
    """(``df`` with working columns, a column for each field of the VARIANT column ``doc``, the array of its field faults).

    Each text and each value is a column of its own, so that it is read once and not again wherever it is named.
    """
    texts = df.select("*", *[F.try_variant_get(doc, paths[f.name], "string").alias(f"__text_{f.name}") for f in fields])
    read = texts.select("*", *[_value(F.col(f"__text_{f.name}"), f.dataType).alias(f"__value_{f.name}") for f in fields])
    values, faults = [], []
    for f in fields:
        text, value = F.col(f"__text_{f.name}"), F.col(f"__value_{f.name}")
        values.append(value.alias(f.name))
        faults.append(F.when(text.isNotNull() & value.isNull(), _fault("bad field", F.lit(f.name), text)))
    return read, values, F.array_compact(F.array(*faults))


def decode_tolerant(df: DataFrame, value_col: str = "value", *, keep: Sequence[str] = (), extra: bool = False) -> DataFrame:
    """Messages -> ``keep``, the message fields, ``raw`` (the payload's text) and ``faults`` (empty if all could be read).

    ``extra`` adds the three fields that the stream does not read. A null or absent field is no fault. Every message has
    one row; one that is no JSON object has all fields null and one fault. Repeated field names make a message no JSON.
    """
    fields = FLIGHT_SCHEMA.fields + (EXTRA_SCHEMA.fields if extra else [])
    raw = F.col(value_col).cast("string")
    parsed = df.select(*keep, raw.alias("raw"), F.try_parse_json(raw).alias("doc"))
    parsed, values, bad = _fields(parsed, "doc", {f.name: f"$.{f.name}" for f in fields}, fields)
    whole = F.schema_of_variant("doc").startswith("OBJECT")
    faults = (F.when(F.col("raw").isNull(), F.array(_fault("absent", F.lit(None), F.lit(None).cast("string"))))
              .when(F.col("doc").isNull(), F.array(_fault("not json", F.lit(None), F.col("raw"))))
              .when(~whole, F.array(_fault("not an object", F.lit(None), F.col("raw"))))
              .otherwise(F.concat(_no_address(values[0]), bad)))
    return parsed.select(*keep, *values, "raw", faults.cast(f"array<{FAULT}>").alias("faults"))


def decode_states(df: DataFrame, doc_col: str = "doc", ingestion_ts: Column | None = None, *, keep: Sequence[str] = ()) -> DataFrame:
    """Snapshot documents -> one row a state vector, as ``decode_tolerant`` gives them, with all fields and ``category``.

    Vectors may have 17 or 18 slots, or stop earlier (what is missing is null). A document that is no JSON object, or has
    no list of states, gives one row with a fault; one without states, or with null for them, gives none.
    """
    stamp = ingestion_ts if ingestion_ts is not None else F.unix_timestamp(F.current_timestamp())
    text = F.col(doc_col).cast("string")
    docs = df.select(*keep, text.alias("text"), F.try_parse_json(text).alias("doc"), stamp.cast("long").alias("t"))
    states = F.try_variant_get("doc", "$.states", "array<variant>")
    unread = (F.when(F.col("text").isNull(), "absent").when(F.col("doc").isNull(), "not json")
              .when(~F.schema_of_variant("doc").startswith("OBJECT") | (states.isNull() & F.try_variant_get("doc", "$.states", "string").isNotNull()),
                    "not an object"))
    one = F.array(F.try_parse_json(F.lit("null")))
    rows = docs.withColumn("unread", unread).select(*keep, "text", "t", "unread", F.explode(F.when(F.col("unread").isNotNull(), one).otherwise(states)).alias("s"))
    fields = [f for f in FLIGHT_SCHEMA.fields + EXTRA_SCHEMA.fields + [CATEGORY] if f.name != "ingestion_ts"]
    slots = {**{name: f"$[{i}]" for name, i in STATE_SLOTS.items()}, "category": f"$[{CATEGORY_SLOT}]"}
    rows, values, bad = _fields(rows, "s", slots, fields)
    raw = F.when(F.col("unread").isNotNull(), F.col("text")).otherwise(F.to_json("s"))
    faults = F.when(F.col("unread").isNotNull(), F.array(F.struct(F.col("unread").alias("reason"), F.lit(None).cast("string").alias("field"), F.col("text").alias("text"))))
    faults = (faults.when(~F.schema_of_variant("s").startswith("ARRAY"), F.array(_fault("not a list", F.lit(None), raw)))
              .otherwise(F.concat(_no_address(values[0]), bad)))
    # the callsign is padded in a snapshot
    values = [F.trim(v).alias("callsign") if f.name == "callsign" else v for f, v in zip(fields, values)]
    return rows.select(*keep, *values, F.when(F.col("unread").isNull(), F.col("t")).alias("ingestion_ts"), raw.alias("raw"),
                       faults.cast(f"array<{FAULT}>").alias("faults"))


def _no_address(icao24: Column) -> Column:
    gone = F.coalesce(icao24, F.lit("")) == ""
    return F.when(gone, F.array(_fault("no address", F.lit("icao24"), F.lit(None).cast("string")))).otherwise(F.array().cast(f"array<{FAULT}>"))


def readable(decoded: DataFrame) -> DataFrame:
    """The reports that have an address, without ``raw`` and ``faults``; their bad fields are null."""
    return decoded.where(F.coalesce("icao24", F.lit("")) != "").drop("raw", "faults")


def quarantine(decoded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row a fault: ``keep``, ``reason``, ``field``, ``text`` (what could not be read) and ``raw``."""
    return decoded.select(*keep, "raw", F.explode("faults").alias("f")).select(*keep, "f.reason", "f.field", "f.text", "raw")


def start_tolerant_archive(decoded: DataFrame, archive: str, set_aside: str, checkpoint: str, trigger: dict | None = None):
    """Write each micro-batch's readable reports and its faults to two append-only tables, from one reading of it.

    A replayed batch replaces what it wrote to either.
    """
    good, bad = append_batch(archive), append_batch(set_aside)

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good(readable(held), batch_id)
            bad(quarantine(held), batch_id)
        finally:
            held.unpersist()
    return (decoded.writeStream.trigger(**(trigger or DEFAULT_TRIGGER)).option("checkpointLocation", checkpoint)
            .foreachBatch(write).start())
