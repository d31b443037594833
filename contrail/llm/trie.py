"""Prefix trie of conversations, by collapsing whole sequences before looking at their prefixes.

Equal conversations are one weighted sequence with the list of conversations that end there. A sequence
that is a proper prefix of another is found by an anti-join; the others are the leaves. Each sequence then
stands once for each of its prefixes, and grouped sums over those rows give every count of a node:

* A prefix is known by its depth and 128 bits: the exclusive-or of a hash of each (place, turn), a turn
  being known by its SHA-256. So prefix keys are running sums that can be put together from stretches,
  and a conversation of any length is spread over several tasks.
* The smallest conversation of a node owns it. What a sequence owns is one stretch down to its end, so a
  sum over distinct nodes below a node is a sum over sequences, each giving what it owns there.

All conversations pass through each top node, so every grouping is a partial aggregate first, and tables
that are joined on prefix keys are written before, which lets Spark split the hot keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import stash
from contrail.llm.turns import ranked

#: Turns of a conversation in one stretch of a running sum, and ids in one piece of an end list (2 ** bits).
STRETCH = 4096
LIST_BITS = 8
_KEY = ["depth", "k1", "k2"]


@dataclass
class Trie:
    """``nodes``: one row a node; ``ends``: (depth, k1, k2, piece, ids), the sorted conversations that end at a node in pieces.

    Nodes: depth, k1, k2 (the key), conv_id (smallest member), parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, turn_sha (SHA-256 of the last turn, null for the root; ``turn_of`` in this module).
    """

    nodes: DataFrame
    ends: DataFrame


def turn_of(role: Column, text: Column) -> Column:
    """What a turn is known by: SHA-256 (binary) of role and text, null as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def in_order(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, sha, bytes): the turns of every conversation in order of turn, null first.

    Turns with the same number are ordered by role and then by SHA-256. Rows without a conv_id belong to no conversation.
    """
    role, text = F.col("role"), F.col("text")
    rows = (conversations.filter("conv_id is not null")
            .select("conv_id", "turn", F.coalesce(role, F.lit("")).alias("role"), turn_of(role, text).alias("sha"),
                    F.octet_length(F.coalesce(text, F.lit(""))).cast("bigint").alias("bytes")))
    placed = ranked(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha")], "trie-turns")
    return placed.select("conv_id", "pos", "sha", "bytes")


def rebuilt(turns: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that branch off the head of their family: (ids, turns).

    The head of c is c - c % ``family``. c takes the head's first crc32(c) % ``most`` turns (all if it has fewer, none
    if there is no such conversation) in place of as many turns of its own. ``ids`` also has conversations left without turns.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    c = F.col("conv_id")
    plan = sizes.select("conv_id", (c - c % family).alias("head"), (F.crc32(c.cast("string").cast("binary")) % most).alias("h"))
    heads = sizes.select(F.col("conv_id").alias("head"), F.col("n").alias("head_n")).filter(F.col("head") % family == 0)
    plan = stash(plan.join(heads, "head", "left").select("conv_id", "head", "h", F.least("h", F.coalesce("head_n", F.lit(0))).alias("lead")), "trie-plan")
    first = turns.filter((c % family == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "head")
    taken = plan.select("conv_id", "head", "lead").join(first, "head").filter("pos < lead").select("conv_id", "pos", "sha", "bytes")
    own = (turns.join(plan.select("conv_id", "h", "lead"), "conv_id").filter("pos >= h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("lead")).alias("pos"), "sha", "bytes"))
    return plan.select("conv_id"), taken.unionByName(own)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, before, through, sha) of every non-empty prefix of every conversation.

    p1, p2: the key one turn earlier. before, through: the text bytes without and with the last turn.
    """
    mark = [F.xxhash64(F.lit(i), "pos", "sha") for i in (1, 2)]
    rows = turns.select("conv_id", "pos", "sha", "bytes", mark[0].alias("m1"), mark[1].alias("m2"), F.expr(f"pos div {STRETCH}").alias("stretch"))
    run = Window.partitionBy("conv_id", "stretch").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select("*", F.bit_xor("m1").over(run).alias("x1"), F.bit_xor("m2").over(run).alias("x2"), F.sum("bytes").over(run).alias("upto"))
    # conversations of one stretch need nothing added
    sums = (turns.select("conv_id", "bytes", mark[0].alias("m1"), mark[1].alias("m2"), F.expr(f"pos div {STRETCH}").alias("stretch"))
            .groupBy("conv_id", "stretch").agg(F.bit_xor("m1").alias("m1"), F.bit_xor("m2").alias("m2"), F.sum("bytes").alias("bytes")))
    run = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    past = sums.select("conv_id", "stretch", F.bit_xor("m1").over(run).alias("a1"), F.bit_xor("m2").over(run).alias("a2"),
                       F.sum("bytes").over(run).alias("a_bytes")).filter("stretch > 0")
    past = stash(past, "trie-stretches")
    rows = rows.join(past, ["conv_id", "stretch"], "left")

    def added(column: str, past: str) -> Column:
        return F.col(column).bitwiseXOR(F.coalesce(past, F.lit(0)))
    k1, k2, through = added("x1", "a1"), added("x2", "a2"), F.col("upto") + F.coalesce("a_bytes", F.lit(0))
    return rows.select("conv_id", (F.col("pos") + 1).alias("depth"), k1.alias("k1"), k2.alias("k2"), k1.bitwiseXOR(F.col("m1")).alias("p1"),
                       k2.bitwiseXOR(F.col("m2")).alias("p2"), (through - F.col("bytes")).alias("before"), through.alias("through"), "sha")


def build(ids: DataFrame, turns: DataFrame) -> Trie:
    """The trie of the conversations ``ids`` with the ``turns`` (conv_id, pos from 0, sha, bytes); no ids: no nodes."""
    rows = stash(prefixes(turns), "trie-prefixes")
    last = rows.groupBy("conv_id").agg(F.max(F.struct("depth", "k1", "k2", "through")).alias("e")).select("conv_id", "e.*")
    zero = F.lit(0).cast("bigint")
    ended = stash(ids.join(last, "conv_id", "left").select("conv_id", *[F.coalesce(x, zero).alias(x) for x in (*_KEY, "through")]), "trie-ended")

    sequences = stash(ended.groupBy(*_KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"), F.min("through").alias("total"))
                      .withColumnRenamed("depth", "size"), "trie-sequences")
    top = sequences.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), F.lit(None).cast("bigint").alias("p1"),
                           F.lit(None).cast("bigint").alias("p2"), zero.alias("before"), zero.alias("through"), F.lit(None).cast("binary").alias("sha"), "size")
    paths = stash(rows.join(sequences.select("conv_id", "size"), "conv_id").unionByName(top), "trie-paths")

    inner = stash(paths.filter("depth < size").select(F.col("depth").alias("size"), "k1", "k2").distinct(), "trie-inner")
    leaves = sequences.join(inner, ["size", "k1", "k2"], "left_anti").select("conv_id", F.lit(1).cast("bigint").alias("leaf"))
    # the first node down the path that a sequence owns, and the bytes before it
    owned = (paths.groupBy(*_KEY).agg(F.min("conv_id").alias("conv_id"), F.min("before").alias("before"))
             .groupBy("conv_id").agg(F.min(F.struct("depth", "before")).alias("o"))
             .select("conv_id", F.col("o.depth").alias("own"), F.col("o.before").alias("own_before")))
    facts = stash(sequences.select("conv_id", "weight", "total").join(leaves, "conv_id", "left").join(owned, "conv_id", "left")
                  .select("conv_id", "weight", "total", F.coalesce("leaf", zero).alias("leaf"), "own",
                          F.coalesce(F.col("total") - F.col("own_before"), zero).alias("own_bytes")), "trie-facts")

    below = F.col("total") - F.col("before")
    child = (F.col("size") > F.col("depth")) & (F.col("own") <= F.col("depth") + 1)
    nodes = (paths.join(facts, "conv_id").groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("sha").alias("turn_sha"),
        F.sum("weight").alias("n_convs"), F.sum(F.coalesce(child, F.lit(False)).cast("bigint")).alias("n_children"), F.sum("leaf").alias("n_leaves"),
        (F.sum(F.col("weight") * below) - F.sum(F.when(F.col("own") <= F.col("depth"), below).otherwise(F.col("own_bytes")))).alias("saved_tokens")))
    nodes = stash(nodes, "trie-nodes")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(parents, ["depth", "p1", "p2"], "left").drop("p1", "p2")

    piece = F.shiftright("conv_id", LIST_BITS)  # at most 2 ** LIST_BITS ids each, as an id ends at one node only
    ends = ended.groupBy(*_KEY, piece.alias("piece")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    return Trie(nodes, ends)


def ends_sha256(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the end lists: decimal ids, ascending, comma-joined, hashed piece by piece.

    A hash runs over its list from start to end, so a list is read by one task, which holds a batch of pieces at a time.
    """
    pieces = ends.select(*_KEY, "piece", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    pieces = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "piece").drop("piece")
    schema = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for *key, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if key != now:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*done)) or [[]] * 4, schema)], schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*now, state.hexdigest()), schema)], schema=schema)

    return pieces.mapInArrow(digest, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def with_turns(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes with the role and text of their last turn (null for the root)."""
    said = (conversations.select(turn_of(F.col("role"), F.col("text")).alias("turn_sha"), F.coalesce("role", F.lit("")).alias("role"),
                                 F.coalesce("text", F.lit("")).alias("text"))
            .groupBy("turn_sha").agg(F.min(F.struct("role", "text")).alias("t")))
    return nodes.join(stash(said, "trie-said").select("turn_sha", "t.role", "t.text"), "turn_sha", "left")
