"""Byte-level BPE with a rank file: text to token ids and back, as the public encoders do it.

A text is cut into pre-tokens by a pattern. Each is looked up in two tiers: a minimal perfect hash over
the vocabulary resolves pre-tokens that are one token; the others are merged from their bytes, a linked
list of parts with a heap of the pairs that can merge, lowest rank and then leftmost first.

Ids travel as little-endian unsigned 32-bit integers in one binary value. The vocabulary is a broadcast,
bounded by its file, and the hash made from it once for all; each Python worker builds its other tables once and keeps a
bounded memo of pre-tokens. A pre-token may be a whole text (unbroken letters): it is not remembered, and merging it
holds some 75 bytes for each of its own.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Callable
from functools import partial
from heapq import heapify, heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Pre-tokens remembered in each of two generations, and the longest worth remembering: together they bound the bytes.
MEMO = 170_000
MEMO_CHARS = 64
#: Links of the parts next to each other, copied for a pre-token of no more bytes than this has.
LINKS = list(range(-1, 4 * MEMO_CHARS + 1))
#: Pre-tokens from so many bytes on keep their links in arrays, which are slower and smaller than lists.
LONG = 1 << 16
SLICE = 256
#: What looks up the pairs of a token that begins none.
NO_PAIRS = {}.get


def load_ranks(path: str) -> list[bytes]:
    """Tokens in rank order from a file of ``base64 rank`` lines; ranks must be 0, 1, 2, ..."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, filter(None, map(bytes.strip, lines)))}
    return [ranks[i] for i in range(len(ranks))]


class PerfectHash:
    """Minimal perfect hash by hash-and-displace: n keys to the n slots, two hashes a lookup.

    A bucket with several keys stores the seed that sends them all to free slots; one with a single key
    stores minus its slot, less one. A lookup is only right for keys that are in; callers compare.
    """

    def __init__(self, keys: list[bytes]):
        self.n, self.buckets = len(keys), max(1, len(keys) // 3)
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, k in enumerate(keys):
            members[xxhash.xxh3_64_intdigest(k) % self.buckets].append(i)
        self.seeds, self.slots = [0] * self.buckets, [-1] * self.n
        order = sorted((b for b in range(self.buckets) if members[b]), key=lambda b: -len(members[b]))
        free = 0
        for b in order:
            own = members[b]
            if len(own) == 1:
                while self.slots[free] >= 0:
                    free += 1
                self.slots[free], self.seeds[b] = own[0], -free - 1
                continue
            seed = 1
            while True:
                at = [xxhash.xxh3_64_intdigest(keys[i], seed) % self.n for i in own]
                if len(set(at)) == len(at) and all(self.slots[s] < 0 for s in at):
                    break
                seed += 1
            self.seeds[b] = seed
            for s, i in zip(at, own):
                self.slots[s] = i

    def __call__(self, key: bytes) -> int:
        seed = self.seeds[xxhash.xxh3_64_intdigest(key) % self.buckets]
        return self.slots[-seed - 1 if seed < 0 else xxhash.xxh3_64_intdigest(key, seed) % self.n]


class Codec(dict):
    """Encoder and decoder; as a dict, the memo from pre-token to packed ids.

    The memo has two generations of MEMO entries of at most MEMO_CHARS characters: what was used since the
    last turn survives it.
    """

    def __init__(self, tokens: list[bytes], pattern: str, find: PerfectHash | None = None):
        super().__init__()
        self.tokens, self.pieces = tokens, regex.compile(pattern)
        self.find = find or PerfectHash(tokens)
        self.packed = [struct.pack("<I", i) for i in range(len(tokens))]
        rank = {t: i for i, t in enumerate(tokens)}
        self.byte_ids = [rank[bytes([b])] for b in range(256)]
        follow: dict[int, dict[int, int]] = {}
        for r, t in enumerate(tokens):
            for i in range(1, len(t)):
                if t[:i] in rank and t[i:] in rank:
                    follow.setdefault(rank[t[:i]], {})[rank[t[i:]]] = r
        self.pairs = {left: ranks.get for left, ranks in follow.items()}
        self.of_bytes = [[self.pairs.get(a, NO_PAIRS)(b, -1) for b in self.byte_ids] for a in self.byte_ids]
        self.before: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MEMO:
            self.before = dict(self)
            self.clear()
        packed = self.before.get(piece)
        if packed is None:
            packed = b"".join(map(self.packed.__getitem__, self.piece_ids(piece.encode("utf-8", "replace"))))
            if len(piece) > MEMO_CHARS:
                return packed
        self[piece] = packed
        return packed

    def piece_ids(self, piece: bytes) -> list[int]:
        whole = self.find(piece)
        return [whole] if self.tokens[whole] == piece else self.merged(piece)

    def merged(self, piece: bytes) -> list[int]:
        """Merge the bytes of a pre-token that is not a token.

        A heap entry is one number, the rank above as many bits of place as the pre-token needs, so that of a short one it
        is a small number; it is stale unless it is still the entry of its place. The least entry stays until the pair
        that its merge makes with the next part can take its place in one step. Behind the last part stands an id that
        makes no pair.
        """
        follow, first, n = self.pairs.get, self.of_bytes, len(piece)
        bits = n.bit_length()
        mask = (1 << bits) - 1
        ids = [self.byte_ids[b] for b in piece]
        ids.append(-1)
        entries = [first[a][b] << bits | i for i, (a, b) in enumerate(zip(piece, piece[1:]))]
        heap = [e for e in entries if e >= 0]
        entries.append(-1)
        if n + 2 <= len(LINKS):
            after, before = LINKS[2:n + 2], LINKS[:n + 1]
        else:
            hold = list if n < LONG else partial(array, "i")
            after, before = hold(range(1, n + 1)), hold(range(-1, n))
        heapify(heap)
        while heap:
            entry = heap[0]
            i = entry & mask
            if entries[i] != entry:
                heappop(heap)  # one of the two was merged meanwhile
                continue
            j = after[i]
            after[i] = k = after[j]
            before[k] = i
            ids[i] = r = entry >> bits
            entries[j] = -1
            s = follow(r, NO_PAIRS)(ids[k])
            if s is None:
                entries[i] = -1
                heappop(heap)
            else:
                entries[i] = s = s << bits | i
                heapreplace(heap, s)
            h = before[i]
            if h >= 0:
                s = follow(ids[h], NO_PAIRS)(r)
                if s is None:
                    entries[h] = -1
                else:
                    entries[h] = s = s << bits | h
                    heappush(heap, s)
        merged, i = [], 0
        while i < n:
            merged.append(ids[i])
            i = after[i]
        return merged

    def encode(self, text: str) -> bytes:
        if len(text) < 1 << 20:
            return b"".join(map(self.__getitem__, self.pieces.findall(text)))
        return b"".join(self[m.group()] for m in self.pieces.finditer(text))

    def decode(self, packed: bytes) -> bytes:
        return unpack(packed, self.tokens)


class Tokenizer:
    """Encoding and decoding of columns with one vocabulary.

    >>> tokenizer = Tokenizer(spark, load_ranks(path), pattern)
    >>> docs.select(tokenizer.encode(F.col("text")).alias("ids"))

    A null text is an empty one and has no ids; an id outside the vocabulary fails the decoding.
    """

    def __init__(self, spark: SparkSession, tokens: list[bytes], pattern: str):
        self.shared, self.pattern = spark.sparkContext.broadcast((tokens, PerfectHash(tokens))), pattern

    def encode(self, text: Column) -> Column:
        """binary: the ids as little-endian unsigned 32-bit integers."""
        shared, pattern = self.shared, self.pattern

        @F.arrow_udf("binary")
        def run(texts: pa.Array) -> pa.Array:
            return _sliced(_codec(shared, pattern).encode, texts)
        return run(F.coalesce(text, F.lit("")))

    def decode(self, ids: Column) -> Column:
        """binary: the bytes that packed ids stand for."""
        shared = self.shared

        @F.arrow_udf("binary")
        def run(packed: pa.Array) -> pa.Array:
            tokens, _ = shared.value
            return _sliced(lambda ids: unpack(ids, tokens), packed)
        return run(F.coalesce(ids, F.lit(b"")))


def unpack(packed: bytes, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


def _sliced(convert: Callable, values: pa.Array) -> pa.Array:
    """Convert a batch few values at a time, so that only so many are Python objects at once."""
    parts = [pa.array(map(convert, values.slice(i, SLICE).to_pylist()), pa.binary()) for i in range(0, len(values), SLICE)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("bigint")


def _codec(shared: Broadcast, pattern: str) -> Codec:
    """The worker's codec, kept with its copy of the broadcast from task to task."""
    if getattr(shared, "codec", None) is None:
        tokens, find = shared.value
        shared.codec = Codec(tokens, pattern, find)
    return shared.codec
