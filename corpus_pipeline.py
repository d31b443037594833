"""Corpus pipeline: toxicity, language ID, near-duplicates, secrets, packing; each stage calls one operator.

Each stage is (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet and reread as the next
one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import langid, packing, secrets, simhash, toxicity
from contrail.llm.common import fresh, read_table, stash
from contrail.session import scratch_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not mark; its model is fitted on all labelled documents."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.scored(F.col("text"), model)["score"] < 0.5)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; ``lang`` becomes the one identified from text, declared language and source.

    Rejected: texts without a letter, and texts that no known language explains better than chance.
    """
    model = langid.fit_text(docs)
    key = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    records = stash(docs.select(key.alias("key"), langid.text_scores(F.col("text"), model).alias("text_ll"),
                                F.lower("lang").alias("declared"), F.lit("").alias("suffix"),
                                F.col("source").alias("host"), F.lit("").alias("domain")), "language-records")
    found = langid.identify(records, model.langs).filter(F.exists("text_ll", lambda x: x != 0))
    if model.langs != [langid.UNKNOWN]:  # else no document says its language, and none can be rejected for it
        found = found.filter(F.col("lang") != langid.UNKNOWN)
    at, lang = fresh(docs, "found_key", "found_lang")
    found = found.groupBy(F.col("key").alias(at)).agg(F.min("lang").alias(lang))
    columns = [F.col(lang).alias("lang") if c == "lang" else F.col(c) for c in docs.columns]
    return docs.join(found, key.eqNullSafe(F.col(at))).select(*columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, linked at 2 or fewer differing fingerprint bits."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in a text replaced by a mark; ``n_chars`` follows the text."""
    ledger = scratch_dir(spark, "pipeline-secret-ledger")
    secrets.scan(docs, ["doc_id"], ledger)
    found = stash(secrets.findings(spark, ledger), "secret-findings")
    blob, spans, clean = fresh(docs, "found_blob", "found_spans", "clean_text")
    held = docs.withColumn(blob, secrets.blob_of(F.col("text"))).join(
        found.select(F.col("blob").alias(blob), F.col("spans").alias(spans)), blob, "left")
    held = held.withColumn(clean, F.when(F.col(spans).isNull(), F.col("text")).otherwise(secrets.redact(F.col("text"), F.col(spans))))
    n = F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length(clean).cast("bigint"))
    return held.select(*[F.col(clean).alias("text") if c == "text" else n.alias("n_chars") if c == "n_chars" else F.col(c)
                         for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language ID", keep_languages),
    ("SimHash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack_sequences),
]

#: The stages learn from data and compute fingerprints, which SQL cannot express; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-').lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)
