"""Token files: ids of documents in equal-length sequences, in Arrow stream files that are read at any place.

A file holds an Arrow IPC stream: the schema, then record batches of ``ROWS`` sequences each, with the columns

    ids   fixed_size_list<uint16 or uint32>[width]   the ids of one document after the other
    mask  fixed_size_list<bool>[width]                true for an id, false for the padding that ends a file

Without nulls or compression all batches but the last take the same number of bytes, so batch k starts at
``header + k * size`` and sequence i is found by arithmetic: no footer, no index of batches, and over a
memory map or a buffer its ids are a view of the file (``TokenFile``).

Writing: documents are dealt out by ranges of doc_id and sorted, each task writes files of its own and
returns an index row (doc_id, part, file, at, n_tokens) for each document. The index is a table that Spark
commits; a file left by a lost or repeated task is in no index row. A document lies in one file; a file is
closed after the document that fills it to ``roll`` ids. The place of a document among all ids follows from
the sums of the files before.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from contrail.llm.common import stash

WIDTH, ROWS = 1024, 64
INDEX_SCHEMA = "doc_id bigint, part int, file string, at bigint, n_tokens bigint"
_INDEX = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("file", pa.string()), ("at", pa.int64()), ("n_tokens", pa.int64())])
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
#: Characters of a text that are handled at a time, and of a word that is worth remembering.
SLICE, LONG_WORD = 1 << 20, 64
_GAP = re.compile(r"[ \t-\r]")
_WORD = re.compile(r"[^ \t-\r]+")
#: Characters that str.split takes for white space and the vocabularies do not.
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file; a URI with one slash, as Hadoop writes it, is also taken."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


class _Memory(dict):
    """Results of the function ``work`` by key, for up to ``size`` keys of at most ``LONG_WORD`` characters; a full memory is emptied."""

    def __init__(self, size: int):
        self.size = size

    def __missing__(self, key: str) -> bytes:
        found = self.work(key)
        if len(key) <= LONG_WORD:
            if len(self) >= self.size:
                self.clear()
            self[key] = found
        return found


class Encoder:
    """Ids of a text by a vocabulary file of the tokenizers library that drops white space, without special tokens.

    As white space parts pre-tokens and is dropped, a text's ids are those of its words, one after the other. A worker
    remembers the ids of up to ``remember`` words, from one task to the next. So that there are fewer different ones, a text
    of Latin-1 characters is lower-cased first. A new word of characters below U+0300, which no normal form changes, is
    cut into pre-tokens here, of which those that are new go through the library's model; any other word goes through the
    library whole.
    """

    def __init__(self, path: str, remember: int = 1_000_000):
        self.path, self.remember = path, remember
        self._tokenizer: Tokenizer | None = None

    def __getstate__(self) -> dict:
        return {"path": self.path, "remember": self.remember, "_tokenizer": None}

    def _open(self) -> None:
        self._tokenizer = Tokenizer.from_file(self.path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.dtype = np.dtype("<u2" if self._tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # a worker's tasks each get a copy of this module: what is to outlive them hangs on one that all of them import
        kept = tokenizers.__dict__.setdefault("_remembered_words", {})
        self._words = kept.setdefault((self.path, self.remember), _Memory(self.remember))
        self._words.work = self._word
        parser = _pattern_of(self._tokenizer)
        self._cut = regex.compile(parser).findall if parser else None
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves in a byte-level vocabulary
        hidden = [b for b in range(256) if b not in shown]
        self._shown = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}

    def _part(self, part: str) -> bytes:
        spelled = part.encode().decode("latin-1").translate(self._shown)
        return np.array([t.id for t in self._tokenizer.model.tokenize(spelled)], self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        if self._cut is None or not word.isascii() and max(word) >= "\u0300":
            return np.array(self._tokenizer.encode(word, add_special_tokens=False).ids, self.dtype).tobytes()
        low = word.lower()
        if low.isalpha():
            return self._part(low)
        if low[-1] in ".,;:!?" and low[:-1].isalpha():  # two pre-tokens
            return self._words[low[:-1]] + self._words[low[-1]]
        parts = self._cut(low)
        return self._part(low) if parts == [low] else b"".join(map(self._words.__getitem__, parts))

    def pieces(self, text: str | None) -> Iterator[bytes]:
        """The ids of a text as little-endian bytes of ``dtype``, some at a time; null and empty have none."""
        if self._tokenizer is None:
            self._open()
        at, end = 0, 0
        while text and at < len(text):
            gap = _GAP.search(text, at + SLICE) if len(text) - at > SLICE else None
            end = gap.start() if gap else len(text)
            some = text[at:end] if at or gap else text
            if self._cut is not None and _is_latin(some):
                some = some.lower()
            words = _WORD.findall(some) if any(c in some for c in _SEPARATORS) else some.split()
            yield b"".join(map(self._words.__getitem__, words))
            at = end

    def n_bytes(self) -> int:
        if self._tokenizer is None:
            self._open()
        return self.dtype.itemsize


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _pattern_of(tokenizer: Tokenizer) -> str | None:
    """The pre-token pattern of a vocabulary of words that are normalised by NFC, blanks and lower case; else None."""
    told = json.loads(tokenizer.to_str())
    steps = [x["type"] for x in (told.get("normalizer") or {}).get("normalizers", [])]
    cuts = (told.get("pre_tokenizer") or {}).get("pretokenizers", [])
    plain = (steps == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
             and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"] and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"])
    return cuts[0]["pattern"]["Regex"] if plain else None


def schema_of(width: int, item: int) -> pa.Schema:
    return pa.schema([pa.field("ids", pa.list_(pa.uint16() if item == 2 else pa.uint32(), width), nullable=False),
                      pa.field("mask", pa.list_(pa.bool_(), width), nullable=False)])


class _Writer:
    """One open file: bytes of ids in, whole batches out."""

    def __init__(self, store: fs.FileSystem, path: str, width: int, rows: int, item: int):
        self.schema, self.width, self.item = schema_of(width, item), width, item
        self.out = store.open_output_stream(path, compression=None)
        self.stream = pa.ipc.new_stream(self.out, self.schema)
        self.block = width * rows * item
        self.held = bytearray()
        self.n = 0

    def add(self, ids: bytes) -> None:
        self.held += ids
        self.n += len(ids) // self.item
        while len(self.held) >= self.block:
            self._put(bytes(self.held[:self.block]), self.block // self.item)
            del self.held[:self.block]

    def _put(self, raw: bytes, n: int) -> None:
        size = len(raw) // self.item
        mask = np.packbits(np.arange(size) < n, bitorder="little").tobytes()
        values = pa.Array.from_buffers(self.schema.field(0).type.value_type, size, [None, pa.py_buffer(raw)])
        marks = pa.Array.from_buffers(pa.bool_(), size, [None, pa.py_buffer(mask)])
        self.stream.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(x, self.width) for x in (values, marks)], schema=self.schema))

    def close(self) -> None:
        if self.held:
            n, line = len(self.held) // self.item, self.width * self.item
            self._put(bytes(self.held) + bytes(-len(self.held) % line), n)
        self.stream.close()
        self.out.close()


class TokenFile:
    """A file read at any place; over a memory map nothing is copied.

    ``len`` is the number of sequences, ``file[i]`` the (ids, mask) of the i-th: a numpy view and an Arrow array.
    """

    def __init__(self, source: pa.NativeFile):
        self.source, self.total = source, source.size()
        self.schema = pa.ipc.read_schema(pa.ipc.read_message(source))
        self.width, self.header = self.schema.field("ids").type.list_size, source.tell()
        self.rows = self.size = self.batches = 0
        self._at, self._batch = -1, None
        if self.total - self.header > 8:  # more than the mark at the end
            self.rows = self.batch(0).num_rows
            self.size = source.tell() - self.header
            self.batches = -(-(self.total - self.header - 8) // self.size)

    def batch(self, k: int) -> pa.RecordBatch:
        if k != self._at:
            self.source.seek(self.header + k * self.size)
            self._batch, self._at = pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema), k
        return self._batch

    def __len__(self) -> int:
        return (self.batches - 1) * self.rows + self.batch(self.batches - 1).num_rows if self.batches else 0

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.Array]:
        if not 0 <= i < len(self):
            raise IndexError(i)
        held, row = self.batch(i // self.rows), i % self.rows
        return held.column(0)[row].values.to_numpy(zero_copy_only=True), held.column(1)[row].values

    def ids(self, at: int, n: int) -> Iterator[np.ndarray]:
        """Ids ``at`` to ``at + n`` of the file, a view of each batch that they lie in."""
        while n > 0:
            k, skip = divmod(at, self.rows * self.width)
            some = self.batch(k).column(0).values.to_numpy(zero_copy_only=True)[skip:skip + n]
            yield some
            at, n = at + len(some), n - len(some)


def write(docs: DataFrame, root: str, encoder: Encoder, end_id: int, width: int = WIDTH, rows: int = ROWS, roll: int = 1 << 28) -> DataFrame:
    """Write the ids of (doc_id, text), each document's followed by ``end_id``, in ascending order of doc_id; returns the index.

    ``root`` is a folder that all executors reach. A null or empty text has the end id only. A null doc_id comes first,
    and documents with the same id are ordered by a hash of their text; alike rows in any order. No documents: no rows.
    """
    rows_in = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("read_at"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash"), F.col("read_at")]
    dealt = rows_in.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def append(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _place(root)
        store.create_dir(folder, recursive=True)
        part, item = TaskContext.get().partitionId(), encoder.n_bytes()
        end = end_id.to_bytes(item, "little")
        file, name, at = None, "", 0
        for batch in batches:
            index = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                if file is None:
                    name = f"{part:05d}-{at:012d}-{uuid.uuid4().hex}.arrows"
                    file = _Writer(store, f"{folder}/{name}", width, rows, item)
                    first = 0
                for piece in encoder.pieces(text.as_py()):
                    file.add(piece)
                file.add(end)
                index.append((doc_id, part, name, first, file.n - first))
                at, first = at + file.n - first, file.n
                if file.n >= roll:
                    file.close()
                    file = None
            yield _batch(index, _INDEX)
        if file is not None:
            file.close()

    return stash(dealt.mapInArrow(append, INDEX_SCHEMA), "token-index")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def starts(index: DataFrame) -> DataFrame:
    """The index with ``start``: the number of ids of all documents before, in the order of the files.

    One row a file is summed up in one task and sent to all; a file's name sorts by part and place in it.
    """
    files = index.groupBy("part", "file").agg(F.sum("n_tokens").alias("n"))
    before = files.select(F.col("file").alias("of"), F.coalesce(
        F.sum("n").over(Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return index.join(F.broadcast(before), F.col("file") == F.col("of")).withColumn("start", F.col("before") + F.col("at")).drop("of", "before")


def read(index: DataFrame, root: str, stretch: int = 1 << 22) -> DataFrame:
    """(doc_id, start, ids) of the documents that rows of a whole ``index`` point to; ids: little-endian 32-bit integers.

    Tasks get the documents of ``stretch`` ids of a file at a time, sorted by place, and read each batch of the file once.
    """
    wanted = starts(index).select("doc_id", "start", "file", "at", "n_tokens")
    total = index.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, total // (2 * stretch))
    dealt = (wanted.withColumn("stretch", F.expr(f"at div {stretch}")).repartition(tasks, "file", "stretch").drop("stretch")
             .sortWithinPartitions("file", "at"))

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _place(root)
        name, source, file, found, held = None, None, None, [], 0
        for batch in batches:
            for doc_id, start, of, at, n in zip(*[c.to_pylist() for c in batch.columns]):
                if of != name:
                    if source:
                        source.close()
                    name, source = of, store.open_input_file(f"{folder}/{of}")
                    file = TokenFile(source)
                ids = b"".join([x.astype("<u4").tobytes() for x in file.ids(at, n)])
                found.append((doc_id, start, ids))
                held += len(ids)
                if held > 1 << 24:
                    yield _batch(found, _READ)
                    found, held = [], 0
        if source:
            source.close()
        yield _batch(found, _READ)

    return dealt.mapInArrow(fetch, "doc_id bigint, start bigint, ids binary")
