"""Keyed result tables with idempotent, distributed upserts.

Each micro-batch is written by the executors to a folder of its own, and becomes visible when a small commit
naming the folders it adds and those it replaces is appended to the table's log. Every few commits the whole
list is written beside them, so that a reader needs that list and the commits after it, and what no kept version
needs any more is cleared. A reader is pinned to the version it started from: a replayed batch replaces the
folder of its first attempt at once, and replaced folders stay for ``keep_versions`` commits. The
current row of a key is the one with the largest ``(batch_id, order...)``: a partial-aggregating ``max``, so no
task and not the driver ever holds a key's history. Tables keyed by time are also partitioned by date: reads prune
to their dates, and only dates that are closed are folded.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from contrail.operators.clustered import ClusteredTable
from contrail.operators.rank import latest_by_key
from contrail.session import spread

BATCH_COLUMN = "batch_id"
DATE_COLUMN = "date"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
#: Commits from one whole list of a table's folders to the next.
LIST_EVERY = 16


@dataclass
class KeyedTable:
    """A table of rows by ``keys`` under ``path``; one writer at a time.

    ``date_from``: an epoch-second column that the keys determine; partitions the table by its date.
    ``keep_versions``: how many versions back a reader may have started and still find its files.
    """

    path: str
    keys: Sequence[str]
    order: Sequence[str] = field(default_factory=tuple)
    columns: Sequence[str] | None = None

    compact_every: int | None = None
    # column types, so a table with no batch yet reads as empty instead of failing
    schema: StructType | None = None
    date_from: str | None = None
    keep_versions: int = 5
    open_days: int = 1
    # for tables whose rows add up: aggregates that merge rows of one key, in place of "the latest wins"
    merge: Callable[[], list[Column]] | None = None

    @property
    def _data(self) -> str:
        return f"{self.path.rstrip('/')}/data"

    @property
    def _log(self) -> str:
        return f"{self.path.rstrip('/')}/_log"

    # --- versions: folders [kind, batch_id, date or null, path below data]; a fold is never taken for a batch ---

    def _logged(self, spark: SparkSession) -> tuple[list[int], list[int]]:
        """Versions with a commit and versions with a whole list in the log, ascending."""
        fs, root = file_system(spark, self._log)
        names = [st.getPath().getName() for st in fs.listStatus(root)] if fs.exists(root) else []
        return tuple(sorted(int(n.split(".")[0]) for n in names if n[0] != "." and n.endswith(end)) for end in (".commit", ".list"))

    def _load(self, spark: SparkSession, name: str) -> dict | list:
        fs, path = file_system(spark, f"{self._log}/{name}")
        stream = fs.open(path)
        try:
            return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _store(self, spark: SparkSession, name: str, what: dict | list) -> None:
        fs, staged = file_system(spark, f"{self._log}/.{uuid.uuid4().hex}")
        out = fs.create(staged, False)
        out.write(bytearray(json.dumps(what).encode()))
        out.close()
        if not fs.rename(staged, spark._jvm.org.apache.hadoop.fs.Path(f"{self._log}/{name}")):
            raise RuntimeError(f"could not write {name} of {self.path}")

    def versions(self, spark: SparkSession) -> list[int]:
        """The versions whose files are all kept."""
        return self._logged(spark)[0][-self.keep_versions:]

    def entries(self, spark: SparkSession, version: int | None = None) -> list[list]:
        """The folders of a version (default: the newest; none yet: empty)."""
        commits, lists = self._logged(spark)
        if not commits:
            return []
        version = commits[-1] if version is None else version
        base = max((v for v in lists if v <= version), default=-1)
        now = self._load(spark, f"{base:012d}.list") if base >= 0 else []
        for v in commits:
            if base < v <= version:
                commit = self._load(spark, f"{v:012d}.commit")
                gone = set(commit["remove"])
                now = [e for e in now if e[3] not in gone] + commit["add"]
        return now

    def _commit(self, spark: SparkSession, add: list[list], remove: list[list], tidy: bool = False) -> None:
        """Append one commit; every ``LIST_EVERY`` commits, or to ``tidy``, list the version and clear what no kept one needs."""
        commits, lists = self._logged(spark)
        version = commits[-1] + 1 if commits else 0
        self._store(spark, f"{version:012d}.commit", {"add": add, "remove": [e[3] for e in remove]})
        if tidy or version - (lists[-1] if lists else -1) >= LIST_EVERY:
            self._store(spark, f"{version:012d}.list", self.entries(spark, version))
            self.clear_old(spark)

    def _write(self, df: DataFrame, batch_id: int, known_rows: bool, kind: str = "batch") -> list[list]:
        """Write rows to a new folder; its entries (one for each date of a dated table)."""
        spark = df.sparkSession
        folder = f"{BATCH_COLUMN}={int(batch_id)}/attempt=a-{uuid.uuid4().hex[:12]}"
        partition_by = ()
        if self.date_from:
            df, partition_by = with_date_partition(df, self.date_from), (DATE_COLUMN,)
        if not _write_once(df, f"{self._data}/{folder}", partition_by, known_rows, self.keys):
            return []
        if not self.date_from:
            return [[kind, int(batch_id), None, folder]]
        fs, root = file_system(spark, f"{self._data}/{folder}")
        names = [st.getPath().getName() for st in fs.listStatus(root)]
        return [[kind, int(batch_id), n.split("=", 1)[1], f"{folder}/{n}"] for n in names if n.startswith(f"{DATE_COLUMN}=")]

    # --- writing ---

    def write_batch(self, batch_df: DataFrame, batch_id: int, known_rows: bool = False) -> None:
        """``foreachBatch`` sink. An empty batch writes nothing; ``known_rows`` skips the check for one.

        With ``compact_every=k``, every k-th batch also folds the log up to the
        previous batch. Only committed batches are folded: the batch being
        written may still be replayed after a failure, its predecessor never
        is, so a replay can never replace folded rows.
        """
        spark = batch_df.sparkSession
        out = batch_df.select(*self.columns) if self.columns else batch_df
        new = self._write(out, batch_id, known_rows)
        entries = self.entries(spark)
        first = [e for e in entries if e[:2] == ["batch", int(batch_id)]]
        if self.merge:  # what a fold already holds must not be added again
            folds = {e[2]: e[1] for e in entries if e[0] == "fold"}
            new = [e for e in new if folds.get(e[2], -1) < int(batch_id)]
        if new or first:
            self._commit(spark, new, first)
        if self.compact_every and batch_id > 0 and batch_id % self.compact_every == 0:
            self.compact_in_place(spark, upto=batch_id - 1)

    def batch_ids(self, spark: SparkSession) -> list[int]:
        return sorted({e[1] for e in self.entries(spark)})

    def compact_in_place(self, spark: SparkSession, upto: int | None = None) -> int | None:
        """Fold the batches <= ``upto`` into one folder; returns the newest folded batch.

        By default all but the newest batch, which may still be replayed. The folded rows are the current
        view up to ``upto``, so later batches still win and the view is unchanged. A fold is no batch: a
        replay of a batch in it, should one come, is added to it and takes nothing away. A dated table folds each
        closed date (``open_days`` before its newest date, or older) that has several folders, and leaves the others
        alone, so old dates are folded once. The fold is visible when it is committed; a driver lost before that
        leaves an unused folder. Replaced folders stay for readers that started from a kept version.
        """
        entries = self.entries(spark)
        if upto is None:
            upto = max((e[1] for e in entries), default=0) - 1
        old = [e for e in entries if e[1] <= upto]
        newest = max((e[1] for e in old), default=None)
        if self.date_from:
            dates = [e[2] for e in entries if e[2] != NO_DATE]
            last = str(dt.date.fromisoformat(max(dates)) - dt.timedelta(days=self.open_days)) if dates else ""
            closed = [e for e in old if e[2] == NO_DATE or e[2] <= last]
            count = Counter(e[2] for e in closed)
            old = [e for e in closed if count[e[2]] > 1]
        if len(old) <= 1:
            return newest
        n = max(e[1] for e in old)
        log = self.read(spark, old)
        cols = [c for c in log.columns if c not in (BATCH_COLUMN, DATE_COLUMN)]
        self._commit(spark, self._write(self._reduced(log).select(*cols), n, known_rows=True, kind="fold"), old, tidy=True)
        return n

    def clear_old(self, spark: SparkSession) -> None:
        """Delete the folders and the part of the log that only versions before the last ``keep_versions`` need."""
        commits, lists = self._logged(spark)
        base = max((v for v in lists if v <= commits[max(0, len(commits) - self.keep_versions)]), default=-1)
        jpath = spark._jvm.org.apache.hadoop.fs.Path
        fs, _ = file_system(spark, self.path)
        for v in commits:
            if v <= base:
                for folder in self._load(spark, f"{v:012d}.commit")["remove"]:
                    fs.delete(jpath(f"{self._data}/{folder}"), True)
                if v < base:
                    fs.delete(jpath(f"{self._log}/{v:012d}.commit"), False)
        for v in lists:
            if v < base:
                fs.delete(jpath(f"{self._log}/{v:012d}.list"), False)

    # --- reading ---

    def read(self, spark: SparkSession, entries: Sequence[Sequence]) -> DataFrame:
        """The rows of some folders of a version, with their ``batch_id`` and, in a dated table, ``date``."""
        paths = [f"{self._data}/{e[3]}" for e in entries]
        return spark.read.option("basePath", self._data).parquet(*paths).drop("attempt")

    def log(self, spark: SparkSession, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
        """Every visible row with its ``batch_id`` (no rows yet: empty, if the schema is known).

        ``since`` and ``until`` (inclusive) bound the dates of a dated table.
        """
        entries = [e for e in self.entries(spark) if e[2] is None or (
            (since is None or e[2] != NO_DATE and e[2] >= str(since)) and (until is None or e[2] != NO_DATE and e[2] <= str(until)))]
        if self.schema is not None and not entries:
            fields = [*self.schema.fields, StructField(BATCH_COLUMN, IntegerType(), True)]
            if self.date_from:
                fields.append(StructField(DATE_COLUMN, DateType(), True))
            return spark.createDataFrame([], StructType(fields))
        log = self.read(spark, entries)
        if since is not None and self.date_from:
            log = log.where(F.col(DATE_COLUMN) >= F.lit(since))
        if until is not None and self.date_from:
            log = log.where(F.col(DATE_COLUMN) <= F.lit(until))
        return log

    def current(self, spark: SparkSession, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
        """Current row per key: the latest batch wins, then the largest order tuple (or all rows are merged)."""
        return self._reduced(self.log(spark, since, until))

    def _reduced(self, log: DataFrame) -> DataFrame:
        if self.merge:
            return log.groupBy(*self.keys).agg(*self.merge())
        cols = [c for c in log.columns if c not in (BATCH_COLUMN, DATE_COLUMN)]
        return latest_by_key(log, list(self.keys), [BATCH_COLUMN, *self.order], cols)

    def publish(self, spark: SparkSession, path: str, key: str = "row_key") -> ClusteredTable:
        """The current view as a table clustered by ``key``, for scans of the first rows or of a key prefix."""
        return ClusteredTable(path, key).write(self.current(spark))

    def compact(self, spark: SparkSession, out_path: str) -> "KeyedTable":
        """Write the current view as one new table (batch 0 of a fresh log)."""
        table = KeyedTable(out_path, self.keys, self.order, self.columns, schema=self.schema, date_from=self.date_from)
        table.write_batch(self.current(spark), 0)
        return table


def file_system(spark: SparkSession, path: str):
    """Hadoop file system of ``path`` (works for local, HDFS and object stores)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def append_batch(path: str, date_from: str | None = None):
    """``foreachBatch`` sink for an append-only archive.

    Partitioned by ``batch_id``; with ``date_from`` (an epoch-second column) by
    ``date`` and then ``batch_id``, so a time-range read opens only the folders
    of its dates. Either way a replayed batch overwrites exactly the folders it
    wrote before (dynamic partition overwrite), never another batch's rows.
    """
    root = path.rstrip("/")

    def _write(batch_df: DataFrame, batch_id: int) -> None:
        if date_from is None:
            _write_once(batch_df, f"{root}/{BATCH_COLUMN}={int(batch_id)}")
        else:
            dated = with_date_partition(batch_df, date_from).withColumn(BATCH_COLUMN, F.lit(int(batch_id)))
            _write_once(dated, root, partition_by=("date", BATCH_COLUMN))
    return _write


def _write_once(df: DataFrame, path: str, partition_by: Sequence[str] = (), known_rows: bool = False, cluster: Sequence[str] = ()) -> bool:
    """Write a micro-batch unless it is empty, computing it only once; whether anything was written.

    The emptiness check and the write are two actions; persisting the batch
    keeps the source from being read (and a stateful plan from running) twice.
    The check is a ``count``: one parallel job that fills the cache the write
    then reads (``isEmpty`` would probe partitions in growing serial rounds).
    ``known_rows`` says there are some and skips it. With ``partition_by`` only
    the partitions present in this batch are replaced; with ``cluster`` as well, each of
    them is written by few tasks (see ``together``).
    """
    def write(rows: DataFrame) -> None:
        if partition_by and cluster:
            rows = together(rows, [*partition_by, *cluster])
        writer = rows.write.mode("overwrite")
        if partition_by:
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
        writer.parquet(path)

    if known_rows:
        write(df)
        return True
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if cached.count() == 0:
            return False
        write(cached)
        return True
    finally:
        cached.unpersist()


def together(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows in even ranges of ``by``, so that n tasks and d values of its first column make n + d files at most, not n * d."""
    return spread(df, *dict.fromkeys(by))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).drop(BATCH_COLUMN)


def with_date_partition(df: DataFrame, ts_col: str = "last_contact") -> DataFrame:
    """Date column for a date-partitioned archive (partition pruning on time ranges)."""
    return df.withColumn("date", F.to_date(F.timestamp_seconds(ts_col)))
