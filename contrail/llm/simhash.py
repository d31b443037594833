"""SimHash near-duplicates: 64-bit fingerprints of word shingles, pigeonhole blocks, Hamming check.

Two fingerprints that differ in at most ``k`` bits agree on all but ``k`` of any ``m`` blocks the 64 bits
are cut into, so they share the value of at least one choice of ``m - k`` blocks. Fingerprints are joined
on those values and every pair is verified. With ``m = k + 2`` and k = 2 a join key has 32 bits, so pairs
that meet by chance stay few at any size.

A block value that more than ``bucket_cap`` fingerprints share (a large group of near copies) is not
joined pair by pair: its fingerprints are linked through the points of Hamming space within k/2 bits.
Two fingerprints reach a common point exactly when they differ in at most k bits, so this finds the same
links, in a number of rows proportional to the group and with at most 65 members a point for k = 2.
"""

from __future__ import annotations

from itertools import chain, combinations, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import fresh, stash
from contrail.llm.components import connected_components

SEED = 42
CHUNK = 1 << 15


def simhash64(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a text; 0 without words.

    A-Z are lower-cased and words are split at ASCII white space; fewer words than ``shingle`` make one
    shingle of the whole sequence. A bit is set if more than half of the shingle hashes have it set.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams, n = iter([b" ".join(words)]), 1
    else:
        grams, n = map(b" ".join, zip(*(words[i:] for i in range(shingle)))), len(words) - shingle + 1
    counts = np.zeros(64, dtype=np.int64)
    while block := list(islice(grams, CHUNK)):
        h = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in block), dtype="<u8", count=len(block))
        counts += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a bigint with the same 64 bits (Arrow batches; one text at a time in memory)."""
    @F.pandas_udf("bigint")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash64(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))
    return run(F.coalesce(text, F.lit("")))


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _block_masks(max_bits: int) -> list[int]:
    blocks = max_bits + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    return [_signed(sum(c)) for c in combinations(masks, blocks - max_bits)]


def _ball(radius: int) -> list[int]:
    """The bit patterns with at most ``radius`` bits set."""
    sets = chain.from_iterable(combinations(range(64), r) for r in range(radius + 1))
    return [_signed(sum(1 << i for i in s)) for s in sets]


def near_links(fps: DataFrame, max_bits: int = 2, bucket_cap: int = 64) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within ``max_bits`` bits of each other.

    ``fps`` has one column ``fp`` (bigint) without repeats. Every pair of a block value with at most
    ``bucket_cap`` members is verified by its Hamming distance. Fuller ones are linked through shared
    points: those links join fingerprints of one component, though not each to each.
    """
    if max_bits % 2 or max_bits < 0:
        raise ValueError("max_bits must be even: full blocks are linked through points half as far away")
    blocks = stash(fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("v"))
        for i, m in enumerate(_block_masks(max_bits))])).alias("k")).select("fp", "k.c", "k.v"), "blocks")
    sizes = stash(blocks.groupBy("c", "v").agg(F.count("*").alias("n")).filter("n > 1"), "sizes")
    cold = blocks.join(sizes.filter(F.col("n") <= bucket_cap), ["c", "v"]).select("c", "v", "fp")
    pairs = (cold.withColumnRenamed("fp", "a").join(cold.withColumnRenamed("fp", "b"), ["c", "v"])
             .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
             .select("a", "b"))
    hot = blocks.join(sizes.filter(F.col("n") > bucket_cap), ["c", "v"]).select("fp").distinct()
    stars = (hot.select("fp", F.explode(F.array(*[
        F.col("fp").bitwiseXOR(F.lit(x)) for x in _ball(max_bits // 2)])).alias("point"))
        .groupBy("point").agg(F.collect_list("fp").alias("near"))
        .filter(F.size("near") > 1)
        .select(F.array_min("near").alias("a"), F.explode("near").alias("b")).filter("a <> b"))
    return pairs.unionByName(stars).distinct()


def _grouped(docs: DataFrame, shingle: int, max_bits: int, bucket_cap: int) -> DataFrame:
    """(doc_id, hash, fp, root, component_id) for each row of ``docs``: ``root`` is the same for all rows of a group.

    ``hash`` is of the text: with the doc_id it finds a row again.
    """
    marked = stash(docs.select(F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("hash"), fingerprint(F.col("text"), shingle).alias("fp")), "fp")
    reps = stash(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "reps")
    roots = connected_components(near_links(reps.select("fp"), max_bits, bucket_cap))
    linked = roots.join(reps, roots.node == reps.fp).select("fp", "root", "least")
    moved = (linked.join(stash(linked.groupBy("root").agg(F.min("least").alias("component_id")), "moved"), "root")
             .select("fp", "root", "component_id"))
    # written first: the join below then stands alone, and Spark can split a fingerprint with very many documents
    whole = stash(reps.join(moved, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id")), "whole")
    return marked.join(whole, "fp").select("doc_id", "hash", "fp", "root", "component_id")


def near_components(docs: DataFrame, shingle: int = 3, max_bits: int = 2, bucket_cap: int = 64) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, fp, component_id), one row for each row of ``docs``.

    component_id is the smallest doc_id among all documents reachable over links of at most ``max_bits``
    differing bits, itself included. A null or empty text has fingerprint zero and is linked like any
    other; a null doc_id never is a component_id unless its whole component has none; repeated rows are
    kept and share a component. Only doc_id and text are read, so other columns may have any name.
    """
    return _grouped(docs, shingle, max_bits, bucket_cap).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2, bucket_cap: int = 64) -> DataFrame:
    """The rows of ``docs`` with one row of each near-duplicate group: that with the smallest doc_id.

    A group without any doc_id, or with several texts under that id, keeps the text with the smallest hash; of
    rows that repeat id and text, the smallest in the order of their columns stays. An id or a null that occurs in
    several groups is judged in each by itself.
    """
    found = stash(_grouped(docs, shingle, max_bits, bucket_cap), "components")
    first = (found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("f")).select("f.doc_id", "f.hash"))
    times = found.groupBy("doc_id", "hash").agg(F.count("*").alias("n"))
    at, text, n = fresh(docs, "kept_id", "kept_hash", "kept_n")
    chosen = stash(first.join(times, first.doc_id.eqNullSafe(times.doc_id) & (first.hash == times.hash))
                   .select(first.doc_id.alias(at), first.hash.alias(text), F.col("n").alias(n)), "chosen")
    same = F.col("doc_id").eqNullSafe(F.col(at)) & (F.xxhash64("text") == F.col(text))
    out = docs.join(chosen.filter(F.col(n) == 1), same, "left_semi")
    repeated = chosen.filter(F.col(n) > 1)
    if repeated.isEmpty():
        return out
    again = docs.join(repeated, same).groupBy(at, text).agg(F.min(F.struct(*docs.columns)).alias(n))
    return out.unionByName(again.select(*[F.col(n)[c].alias(c) for c in docs.columns]))
