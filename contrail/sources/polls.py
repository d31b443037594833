"""Polls of a snapshot feed as a stream: one row a poll, live or replayed, and no poll twice.

A recorder lays the document of each poll down as ``<folder>/<poll number>.json`` (twelve digits). The stream's offset is the
number of polls read, so a restart goes on after the last one committed (a document that comes later is too late); the number of a poll also gives its stamp, which all its
states share and which a retry gives again. Poll by poll, a document that is absent or broken is replaced by the
recorded replay; a poll whose ``states`` are null or missing has none, and without a replay file a failed poll has none
either. Files are reached through Arrow's file systems (``file``, ``hdfs``, ``s3``, ``gs``), also from the executors.

    feed = poll_stream(spark, folder, replay=path)      # poll, ingestion_ts, kind ("live", "replay", "none"), doc
    reports = decode_polls(feed)                        # the 15 message fields
"""

from __future__ import annotations

import json
import re
import sys
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from contrail.fixtures import EPOCH0, POLL_SECONDS
from contrail.session import stream_partitions
from contrail.sources.snapshot import decode_replay, state_vectors

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

SCHEMA = "poll bigint, ingestion_ts bigint, kind string, doc string"
#: Tasks of one batch at most, unless ``poll_stream`` is told otherwise: more polls make longer tasks, not more of them.
TASKS = 200
#: The fewest polls of a task.
POLLS_PER_TASK = 16
#: A task hands its polls on when their documents have this many characters, or at this many polls.
HANDED_ON_CHARS, HANDED_ON_POLLS = 4 << 20, 1000
_NAME = re.compile(r"(\d+)\.json")


def states_of(text: str | None) -> str | None:
    """The list of states of a snapshot document as JSON text; None if the document is absent or broken."""
    try:
        held = json.loads(text)["states"] if text else None
        return None if not text else json.dumps(held or [])
    except KeyError:
        return "[]"
    except (ValueError, TypeError):
        return None


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file; a URI with one slash, as Hadoop writes it, is also taken."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def _text(store: fs.FileSystem, path: str) -> str | None:
    try:
        with store.open_input_file(path) as file:
            return file.read().decode()
    except (FileNotFoundError, UnicodeDecodeError):
        return None


class _Polls(InputPartition):
    def __init__(self, first: int, end: int):
        super().__init__((first, end))
        self.first, self.end = first, end


def _batch(rows: Sequence[tuple]) -> pa.RecordBatch:
    kinds = [("poll", pa.int64()), ("ingestion_ts", pa.int64()), ("kind", pa.string()), ("doc", pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, (_, kind) in zip(zip(*rows), kinds)], schema=pa.schema(kinds))


class PollReader(DataSourceStreamReader):
    """Offsets are poll numbers: ``{"next": n}`` means that polls before n are done."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.replay = options.get("replay")
        self.first, self.start = int(options.get("first", 0)), int(options.get("start", EPOCH0))
        self.seconds = int(options.get("seconds", POLL_SECONDS))
        self.until = int(options["until"]) if "until" in options else None
        self.tasks = max(1, int(options.get("tasks", TASKS)))

    def initialOffset(self) -> dict:
        return {"next": self.first}

    def latestOffset(self) -> dict:
        """One past the newest poll that left a document (or ``until``): the polls before it that left none have failed."""
        if self.until is not None:
            return {"next": max(self.until, self.first)}
        store, folder = _place(self.path)
        # the only listing: names, once a trigger
        names = (_NAME.fullmatch(f.base_name) for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)))
        newest = max([int(m[1]) + 1 for m in names if m], default=self.first)
        return {"next": max(newest, self.first)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        each = max(POLLS_PER_TASK, -(-(end["next"] - start["next"]) // self.tasks))
        return [_Polls(n, min(n + each, end["next"])) for n in range(start["next"], end["next"], each)]

    def commit(self, end: dict) -> None:
        """Nothing to keep: the offset says it all."""

    def read(self, partition: _Polls) -> Iterator[pa.RecordBatch]:
        """The polls in batches that are bounded in characters, so that a task holds few documents however many it reads."""
        held, chars = [], 0
        for row in self._rows(partition):
            held.append(row)
            chars += len(row[3])
            if chars >= HANDED_ON_CHARS or len(held) == HANDED_ON_POLLS:
                yield _batch(held)
                held, chars = [], 0
        if held:
            yield _batch(held)

    def _rows(self, partition: _Polls) -> Iterator[tuple]:
        store, folder = _place(self.path)
        recorded = None
        for n in range(partition.first, partition.end):
            stamp = self.start + n * self.seconds
            states, kind = states_of(_text(store, f"{folder}/{n:012d}.json")), "live"
            if states is None:
                if recorded is None:
                    recorded = self._recorded()
                states, kind = recorded, "replay" if recorded else "none"
            yield n, stamp, kind, states or "[]"

    def _recorded(self) -> str:
        """The replay file's list, read once a task that needs it; empty text without one."""
        if not self.replay:
            return ""
        try:
            held = json.loads(_text(*_place(self.replay)) or "")
            return json.dumps(held) if isinstance(held, list) else ""
        except ValueError:
            return ""


class PollSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "polls"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> PollReader:
        return PollReader(self.options)


def poll_stream(spark: SparkSession, folder: str, *, replay: str | None = None, first: int = 0, until: int | None = None,
                start: int = EPOCH0, seconds: int = POLL_SECONDS) -> DataFrame:
    """A stream of polls (SCHEMA): ``first`` is the first poll's number, ``until`` one past the last if that is known.

    Poll n is stamped ``start + n * seconds``.
    """
    spark.dataSource.register(PollSource)
    reader = spark.readStream.format("polls").option("path", _uri(folder)).option("first", first).option("start", start).option("seconds", seconds)
    reader = reader.option("tasks", stream_partitions(spark))
    if replay is not None:
        reader = reader.option("replay", _uri(replay))
    return (reader if until is None else reader.option("until", until)).load()


def _uri(path: str) -> str:
    return f"file://{path}" if path.startswith("/") else path


def decode_polls(polls: DataFrame, all_fields: bool = False) -> DataFrame:
    """The states of polls as flight rows, each with its poll's stamp."""
    return decode_replay(polls, ingestion_ts=F.col("ingestion_ts"), all_fields=all_fields)


def record_polls(reports: DataFrame, folder: str, start: int = EPOCH0, seconds: int = POLL_SECONDS, *, bare: bool = False,
                 damaged: Column | None = None) -> None:
    """Lay reports down as a recorder would: one document for each poll, by ``ingestion_ts``; ``bare`` writes replay files.

    A document is one file, as a feed answers a poll with one; the tasks write them side by side. Polls whose
    reports are ``damaged`` lose the end of their document.
    """
    number = F.expr(f"(ingestion_ts - {start}) div {seconds}")
    cut = F.lit(False) if damaged is None else damaged
    docs = (state_vectors(reports).groupBy(number.alias("poll"))
            .agg(F.concat_ws(",", F.collect_list("state_json")).alias("s"), F.bool_or(cut).alias("cut")))
    target = _uri(folder)

    def write(rows: Iterator) -> None:
        store, base = _place(target)
        store.create_dir(base, recursive=True)
        for r in rows:
            text = f"[{r.s}]" if bare else '{"time":%d,"states":[%s]}' % (start + r.poll * seconds, r.s)
            part = f"{base}/.{r.poll}-{uuid.uuid4().hex}"  # a file appears under its name as a whole
            with store.open_output_stream(part) as out:
                out.write((text[:-2] if r.cut else text).encode())
            store.move(part, f"{base}/{r.poll:012d}.json")
    docs.foreachPartition(write)
