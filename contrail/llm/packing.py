"""Best-fit packing of documents into training sequences of several permitted lengths.

Documents longer than the largest length are cut into pieces of that length; every word is packed once.
Pieces are dealt to shards of about ``shard_pieces`` each, as (id, length) rows without texts, and each
shard packs its own in one task:

* longest first, a piece goes to the open bin it leaves least room in (best fit);
* if none has room, a bin is opened; every permitted size that holds the piece is tried against the pieces
  still to come (filled greedily from their lengths), and the size with the least cost for each word wins;
* at the end each bin shrinks to the smallest permitted size that holds its contents.

A shard's only loss against packing everything at once is its few last, partly filled bins.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import stash, words_of

SIZES = (512, 1024, 2048, 4096, 8192)
SHARD_PIECES = 20_000


def sequence_cost(size: int) -> float:
    """Work for one sequence: linear in its length, with a small quadratic part for attention."""
    return size * (1.0 + size / 131_072)


def _greedy_fill(room: int, lengths: list[int], counts: Counter) -> int:
    """Words that the largest remaining lengths put into ``room``, taken longest first."""
    left, hi = room, len(lengths)
    while left and hi:
        hi = bisect_right(lengths, left, 0, hi)
        if hi:
            hi -= 1
            left -= lengths[hi] * min(counts[lengths[hi]], left // lengths[hi])
    return room - left


def best_fit(lengths: list[int], sizes: tuple[int, ...], cost: Callable[[int], float] = sequence_cost) -> tuple[list[int], list[int], list[int]]:
    """Pack pieces of the given lengths: (bin and offset of each piece, final size of each bin).

    No length may exceed the largest size. A piece of length 0 takes no room, but has a bin.
    """
    sizes = tuple(sorted(sizes))
    counts = Counter(n for n in lengths if n)
    distinct = sorted(counts)
    where, offset, used, capacity = [0] * len(lengths), [0] * len(lengths), [], []
    rooms: list[int] = []  # the different amounts of room left, ascending
    by_room: dict[int, list[int]] = {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        if n:
            counts[n] -= 1
            if not counts[n]:
                del distinct[bisect_left(distinct, n)]
        at = bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
        else:
            def per_word(size: int) -> tuple[float, int]:
                fill = max(1, n + _greedy_fill(size - n, distinct, counts))
                return cost(sizes[bisect_left(sizes, fill)]) / fill, size
            size = min((s for s in sizes if s >= n), key=per_word)
            b, room = len(used), size
            used.append(0)
            capacity.append(size)
        where[i], offset[i] = b, used[b]
        used[b] += n
        if left := room - n:
            if left not in by_room:
                insort(rooms, left)
            by_room.setdefault(left, []).append(b)
    return where, offset, [sizes[bisect_left(sizes, u)] for u in used]


def pieces(docs: DataFrame, largest: int) -> DataFrame:
    """(doc_id, piece, start_word, n_words): each document cut at every ``largest`` words.

    A document without words (null, empty or blank text) has one piece of none.
    """
    counted = docs.select(F.col("doc_id").alias("doc_id"), F.size(words_of(F.col("text"))).cast("bigint").alias("n"))
    cut = counted.select("doc_id", "n", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n") / largest) - 1).cast("int"))).alias("piece"))
    start = F.col("piece").cast("bigint") * largest
    return cut.select("doc_id", "piece", start.alias("start_word"), F.least(F.col("n") - start, F.lit(largest)).alias("n_words"))


def pack(docs: DataFrame, sizes: tuple[int, ...] = SIZES, shard_pieces: int = SHARD_PIECES,
         cost: Callable[[int], float] = sequence_cost) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, piece, start_word, n_words, bin_id, bin_offset, bin_size), a row for each piece.

    Words ``start_word`` to ``start_word + n_words`` of the document take the places from ``bin_offset`` of
    sequence ``bin_id``, which is ``bin_size`` long. Repeated rows and null ids are packed like any others;
    an empty table gives no rows. Only doc_id and text are read.
    """
    cut = stash(pieces(docs, max(sizes)), "pieces")
    shards = max(1, -(-cut.count() // shard_pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got)
        where, offset, final = best_fit(table["n_words"].to_pylist(), sizes, cost)
        shard = TaskContext.get().partitionId()
        bins = np.array(where, dtype=np.int64)
        table = (table.append_column("bin_id", pa.array((shard << 32) + bins))
                 .append_column("bin_offset", pa.array(offset, pa.int64()))
                 .append_column("bin_size", pa.array(np.array(final, dtype=np.int64)[bins])))
        yield from table.to_batches(max_chunksize=10_000)

    return cut.repartition(shards).mapInArrow(
        run, "doc_id bigint, piece int, start_word bigint, n_words bigint, bin_id bigint, bin_offset bigint, bin_size bigint")
