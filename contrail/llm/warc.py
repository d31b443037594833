"""WARC archives: write with an index, read selected records by coalesced byte ranges.

Writing: each task appends records, every one a gzip member of its own, to archives that it names itself,
and returns an index row (page_id, file, offset, length, url, digest, record_type, refers_to) for each. The
index is a table that Spark commits; an archive left by a lost or repeated task is in no index row.

Reading starts from index rows, any selection of them. They are dealt out by archive and stretch of it,
sorted by offset, and neighbours within ``gap`` bytes are fetched by one read of at most ``most`` bytes.
Payloads are checked against their digest.

Records with the same payload (at least ``MIN_REVISIT`` bytes): the one with the smallest page_id is the
response, the others are revisits, which keep the HTTP header and refer to it.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import stash

MIN_REVISIT = 100
INDEX_SCHEMA = "page_id bigint, file string, offset bigint, length bigint, url string, digest string, record_type string, refers_to bigint"
RECORD_SCHEMA = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file; a URI with one slash, as Hadoop writes it, is also taken."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _page(urn: str | None) -> int | None:
    text = (urn or "<urn:x-page:null>")[len("<urn:x-page:"):-1]
    return None if text == "null" else int(text)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record, uncompressed; a revisit if it refers to another."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", _CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", url)))
    if refers_to is not None:
        head += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    head += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of an uncompressed record; ``payload`` is None for a revisit. Damage raises ValueError."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    field = dict(x.split(": ", 1) for x in lines[1:])
    if lines[0] != "WARC/1.1" or len(rest) != int(field["Content-Length"]) + 4:
        raise ValueError("not a whole WARC/1.1 record")
    http, _, payload = rest[:-4].partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http).group(1))
    digest = field["WARC-Payload-Digest"].removeprefix("sha256:")
    revisit = field["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {field['WARC-Record-ID']} does not match its digest")
    return {"page_id": _page(field["WARC-Record-ID"]), "url": field.get("WARC-Target-URI"), "record_type": field["WARC-Type"],
            "refers_to": _page(field.get("WARC-Refers-To")), "payload_bytes": size, "payload_digest": digest, "payload": None if revisit else payload}


def write(pages: DataFrame, root: str, date: str = "2024-01-01T00:00:00Z", roll: int = 1 << 28, level: int = 3) -> DataFrame:
    """Write (page_id, url, html) under the folder ``root``, which all executors reach; returns the index.

    A null html is an empty payload, a null url has no target field, a null page_id stays null (such a
    record is a response unless another holds its payload under an id). Rows that repeat a response's id
    and payload are responses. An archive is closed once it holds ``roll`` bytes.
    """
    html = F.coalesce("html", F.lit(""))
    # the payloads that occur twice or more; where there are few, Spark sends the small table around
    twice = stash(pages.select("page_id", F.sha2(html, 256).alias("d"), F.octet_length(html).alias("n")).filter(F.col("n") >= MIN_REVISIT)
                  .groupBy("d").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("d", "first"), "warc-twice")
    rows = (pages.select("page_id", "url", html.cast("binary").alias("payload"), F.sha2(html, 256).alias("digest"))
            .join(twice, F.col("digest") == F.col("d"), "left")
            .select("page_id", "url", "payload", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")))

    def append(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _place(root)
        store.create_dir(folder, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            index = []
            for r in batch.to_pylist():
                if out is None:
                    name, at = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{folder}/{name}", compression=None)
                gz = zlib.compressobj(level, zlib.DEFLATED, 31)
                packed = gz.compress(record(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"], date)) + gz.flush()
                out.write(packed)
                index.append((r["page_id"], name, at, len(packed), r["url"], r["digest"], "response" if r["refers_to"] is None else "revisit", r["refers_to"]))
                at += len(packed)
                if at >= roll:
                    out.close()
                    out = None
            yield _batch(index, _INDEX)
        if out is not None:
            out.close()

    return stash(rows.mapInArrow(append, INDEX_SCHEMA), "warc-index")


_INDEX = pa.schema([("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()),
                    ("digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def coalesced(rows: Iterable[tuple[str, int, int]], gap: int, most: int) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """(file, offset, length) sorted by file and offset -> one (file, start, end, members) for each read.

    Neighbours join a read if at most ``gap`` unwanted bytes lie between and it stays within ``most``
    bytes; a longer record is read alone. The same record twice is two members.
    """
    now: tuple[str, int, int, list[tuple[int, int]]] | None = None
    for file, offset, length in rows:
        if now and file == now[0] and offset - now[2] <= gap and offset + length - now[1] <= most:
            now[3].append((offset, length))
            now = (file, now[1], max(now[2], offset + length), now[3])
        else:
            if now:
                yield now
            now = (file, offset, offset + length, [(offset, length)])
    if now:
        yield now


def read(index: DataFrame, root: str, with_payload: bool = True, gap: int = 1 << 16, most: int = 1 << 23, stretch: int = 1 << 24) -> DataFrame:
    """The records that the rows of ``index`` point to: RECORD_SCHEMA, and ``payload`` (null for revisits).

    One record for each index row; nothing selected gives no rows. Tasks get ``stretch`` bytes of an
    archive at a time, so one large archive is read by many.
    """
    wanted = index.select("file", "offset", "length")
    total = wanted.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, total // (2 * stretch))
    dealt = (wanted.withColumn("part", F.floor(F.col("offset") / stretch)).repartition(tasks, "file", "part")
             .sortWithinPartitions("file", "offset"))
    schema = _RECORD.append(pa.field("payload", pa.binary())) if with_payload else _RECORD

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _place(root)
        rows = (r for b in batches for r in zip(b["file"].to_pylist(), b["offset"].to_pylist(), b["length"].to_pylist()))
        name, source = None, None
        for file, start, end, members in coalesced(rows, gap, most):
            if file != name:
                if source:
                    source.close()
                name, source = file, store.open_input_file(f"{folder}/{file}")
            raw = source.read_at(end - start, start)
            found = [parse(zlib.decompress(raw[o - start:o - start + n], 31)) for o, n in members]
            yield _batch([tuple(r[f] for f in schema.names) for r in found], schema)
        if source:
            source.close()

    return dealt.mapInArrow(fetch, RECORD_SCHEMA + (", payload binary" if with_payload else ""))
