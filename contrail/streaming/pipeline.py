"""The streaming application: decode -> event time + watermark -> enrich -> four queries.

Q1 live     latest state per aircraft        -> KeyedTable on icao24
Q2 agg      5-min/1-min sliding window, update mode -> KeyedTable on (country, window_end)
Q3 alerts   rapid descents                    -> KeyedTable on (icao24, ingestion_ts)
Q4 enriched full enriched record per aircraft -> KeyedTable on icao24

Every sink is a distributed ``foreachBatch`` upsert (see ``sinks``); nothing is
collected to the driver. Q1/Q3/Q4 run as one query that reads each micro-batch
once, reduces it to one report per key and joins only those (``fan_out=False``
runs three); Q2 stays separate because it is stateful.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from contrail.functions.scalars import row_key
from contrail.operators.aggregate import country_window_agg
from contrail.operators.enrich import (
    DEFAULT_WATERMARK, descending_fast, enrich, fan_out_by_dimension, fan_out_plan, join_strategy, with_event_time,
)
from contrail.operators.rank import latest_by_key
from contrail.plans.tables import (
    ARRIVAL_ORDER, alert_rows, alerts_then_enrich, latest_then_enrich, live_rows, with_agg_key,
)
from contrail.session import session_conf, stream_partitions
from contrail.schemas import AGG_COLUMNS, ALERT_COLUMNS, ENRICHED_COLUMNS, LIVE_COLUMNS, table_schema
from contrail.sources.messages import decode_messages, to_messages
from contrail.streaming.metrics import BatchMetrics, observe_reports
from contrail.streaming.panes import pane_table, windows as pane_windows, write_panes
from contrail.streaming.sinks import KeyedTable, append_batch, file_system

ALL_QUERIES = ("live", "agg", "alerts", "enriched")
DEFAULT_TRIGGER = {"processingTime": "10 seconds"}
#: Batches from one fold of a result table to the next.
COMPACT_EVERY = 100
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def enriched_stream(source: DataFrame, aircraft: DataFrame, *, value_col: str = "value",
                    keep: Sequence[str] = (), watermark: str | None = DEFAULT_WATERMARK,
                    strategy: str = "auto", unique_dimension: bool = False) -> DataFrame:
    """Source rows with a JSON payload -> enriched, watermarked flight rows."""
    parsed = decode_messages(source, value_col, keep=tuple(keep))
    timed = with_event_time(parsed, watermark)
    return enrich(timed, aircraft, strategy=strategy, unique_dimension=unique_dimension)


def report_stream(source: DataFrame, *, value_col: str = "value", keep: Sequence[str] = (),
                  watermark: str | None = DEFAULT_WATERMARK) -> DataFrame:
    """Source rows with a JSON payload -> watermarked flight rows without metadata, for ``start_pipeline``."""
    return with_event_time(decode_messages(source, value_col, keep=tuple(keep)), watermark)


def counted_stream(source: DataFrame, aircraft: DataFrame, *, value_col: str = "value",
                   watermark: str | None = DEFAULT_WATERMARK, unique_dimension: bool = False) -> DataFrame:
    """Input of the window aggregate: reports repeated per dimension match, no metadata columns.

    With ``unique_dimension=True`` no join is planned at all (join elimination).
    """
    timed = with_event_time(decode_messages(source, value_col), watermark)
    return fan_out_by_dimension(timed, aircraft, unique_dimension=unique_dimension)


@dataclass
class ResultTables:
    live: KeyedTable
    agg: KeyedTable
    alerts: KeyedTable
    enriched: KeyedTable
    panes: KeyedTable

    def windows(self, spark: SparkSession) -> DataFrame:
        """The window aggregate with its keys, from the panes if the pipeline keeps those."""
        found = with_agg_key(pane_windows(spark, self.panes)) if self.panes.versions(spark) else self.agg.current(spark)
        return found.select(*self.agg.columns)

    @classmethod
    def at(cls, root: str, order: Sequence[str] = ARRIVAL_ORDER, compact_every: int | None = COMPACT_EVERY) -> "ResultTables":
        """Tables under ``root``. ``order`` is the arrival order of one aircraft's reports:
        (poll, report time) for files, ``("offset",)`` for Kafka (the message key is the
        address, so one aircraft's reports share a partition and offsets order them)."""
        root = root.rstrip("/")
        order = tuple(order)
        alert_order = tuple(o for o in order if o != "ingestion_ts") or ("last_contact",)

        def cols(base, order_cols):
            return list(base) + [o for o in order_cols if o not in base]
        k = compact_every

        def table(name, keys, order_cols, columns, date_from=None):
            return KeyedTable(f"{root}/{name}", keys, order_cols, columns, k, schema=table_schema(columns), date_from=date_from)
        return cls(
            live=table("flights_live", ["icao24"], order, cols(LIVE_COLUMNS, order)),
            agg=table("flights_agg", ["country", "window_end"], (), AGG_COLUMNS + ["country_key", "row_key"],
                      date_from="window_end"),
            alerts=table("flights_alerts", ["icao24", "ingestion_ts"], alert_order,
                         cols(ALERT_COLUMNS + ["row_key"], alert_order), date_from="ingestion_ts"),
            enriched=table("flights_enriched", ["icao24"], order, cols(ENRICHED_COLUMNS, order)),
            panes=pane_table(f"{root}/flights_panes", k),
        )


def _latest_in_batch(table: KeyedTable):
    """Reduce a micro-batch to one row per key before writing it (fewer bytes written)."""
    def _write(batch_df: DataFrame, batch_id: int) -> None:
        cols = [c for c in table.columns if c not in table.keys]
        table.write_batch(latest_by_key(batch_df, table.keys, list(table.order), cols), batch_id)
    return _write


def _stateless_sink(tables: ResultTables, names: Sequence[str], order: Sequence[str],
                    aircraft: DataFrame | None, strategy: str, panes: bool = False, late_rows=None):
    """``foreachBatch`` sink of the live, alerts and enriched tables (any of them), and with ``panes`` of the panes.

    With ``aircraft`` the batch holds bare reports: they are reduced to one per key first and only those
    are joined. One counting job reads the source into the cache and tells which tables get rows.
    """
    extra = [o for o in order if o not in ARRIVAL_ORDER]
    per_aircraft = [q for q in ("live", "enriched") if q in names]
    counted = fan_out_plan(aircraft) if panes and aircraft is not None else None  # the dimension is static: measured once

    def latest(batch: DataFrame) -> DataFrame:
        t = tables.live
        if aircraft is not None:
            return latest_then_enrich(batch, aircraft, list(t.columns), order, strategy=strategy)
        return latest_by_key(live_rows(batch), t.keys, list(t.order), [c for c in t.columns if c not in t.keys])

    def alerts(batch: DataFrame) -> DataFrame:
        t = tables.alerts
        if aircraft is not None:
            return alerts_then_enrich(batch, aircraft, list(t.order), extra, strategy=strategy)
        rows = alert_rows(batch, extra).withColumn("row_key", row_key(F.col("icao24"), F.col("ingestion_ts")))
        return latest_by_key(rows, t.keys, list(t.order), [c for c in t.columns if c not in t.keys])

    def _write(batch_df: DataFrame, batch_id: int) -> None:
        cached = batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        last = None
        try:
            n, descending = cached.agg(F.count(F.lit(1)), F.count_if(descending_fast())).first()
            if n and per_aircraft:
                # one reduction serves both tables, so both show the same last report
                last = latest(cached)
                if len(per_aircraft) > 1:
                    last = last.persist(StorageLevel.MEMORY_AND_DISK)
                for q in per_aircraft:
                    getattr(tables, q).write_batch(last, batch_id, known_rows=True)
            if descending and "alerts" in names:
                tables.alerts.write_batch(alerts(cached), batch_id, known_rows=True)
            if n and panes:
                write_panes(tables.panes, counted(cached) if counted else cached, batch_id, late_rows=late_rows)
        finally:
            if last is not None:
                last.unpersist()
            cached.unpersist()
    return _write


def start_pipeline(reports: DataFrame, out_root: str, checkpoint_root: str, *,
                   aircraft: DataFrame | None = None, strategy: str = "auto",
                   queries: Sequence[str] = ALL_QUERIES, trigger: dict | None = None,
                   fan_out: bool = True, order: Sequence[str] = ARRIVAL_ORDER,
                   state_store: str | None = None,
                   state_partitions: int | None = None,
                   compact_every: int | None = COMPACT_EVERY,
                   agg_input: DataFrame | None = None,
                   panes: bool = False, metrics: BatchMetrics | None = None) -> dict[str, StreamingQuery]:
    """Start the selected queries; returns them by name.

    ``reports`` with ``aircraft``: bare reports (see ``report_stream``); each micro-batch is reduced before
    it meets the dimension, and the window aggregate joins key multiplicity only. Without ``aircraft``,
    ``reports`` is an enriched stream. ``fan_out`` writes the three stateless tables from one reading of the
    source; otherwise each is a query of its own.

    ``state_store="rocksdb"`` keeps the window state in RocksDB (off-heap, spills
    to local disk, checkpointed incrementally) instead of the default in-memory map;
    it must be chosen before the aggregate query first starts on a checkpoint.
    ``state_partitions`` (see ``session.stream_partitions``) sizes the micro-batch
    shuffles and the window state; a checkpoint keeps the value it first started with.
    ``compact_every=k`` folds each table's batch log in place every k batches (None: never).
    ``agg_input`` (see ``counted_stream``) feeds the window aggregate instead.
    ``panes`` keeps the window aggregate as panes (see ``streaming.panes``; read it by ``ResultTables.windows``):
    the fan-out writes them too, so that all four queries read the source once and none has state.
    ``metrics`` counts every batch (see ``streaming.metrics``).
    """
    tables = ResultTables.at(out_root, order, compact_every)
    if metrics is not None:
        reports = observe_reports(reports)
    trig = trigger or DEFAULT_TRIGGER
    ck = checkpoint_root.rstrip("/")
    started: dict[str, StreamingQuery] = {}
    spark = reports.sparkSession
    conf = {"spark.sql.shuffle.partitions": state_partitions or stream_partitions(spark)}
    if state_store == "rocksdb":
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    if aircraft is not None and strategy == "auto" and set(queries) - {"agg"}:
        strategy = join_strategy(aircraft)  # the dimension is static: measured once
    if strategy == "salted":
        strategy = "shuffle"  # a reduced batch has each key once

    def _start(name: str, df: DataFrame, sink, mode: str = "append") -> None:
        # the stream's session is cloned at start(): the settings are captured here
        with session_conf(spark, **conf):
            started[name] = (df.writeStream.outputMode(mode).trigger(**trig)
                             .option("checkpointLocation", f"{ck}/{name}")
                             .foreachBatch(sink).queryName(f"contrail_{name}_{id(started)}").start())

    if "agg" in queries and not panes:
        if agg_input is None:
            agg_input = reports if aircraft is None else fan_out_by_dimension(reports, aircraft)
        _start("agg", with_agg_key(country_window_agg(agg_input)), tables.agg.write_batch, "update")
    stateless = [q for q in ("live", "alerts", "enriched") if q in queries]
    if panes and "agg" in queries:
        stateless.append("panes")
    groups = {"fanout": stateless} if fan_out and len(stateless) > 1 else {q: [q] for q in stateless}
    for name, members in groups.items():
        if members:
            _start(name, reports, _stateless_sink(tables, members, order, aircraft, strategy, "panes" in members,
                                                   metrics.late(name) if metrics is not None else None))
    return started


def start_archive(df: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None,
                  partitions: int | None = None, date_from: str | None = None) -> StreamingQuery:
    """Append-only archive of every row (e.g. every enriched report).

    ``date_from="last_contact"`` partitions it by report date (then batch) for
    partition pruning on time ranges.
    """
    spark = df.sparkSession
    with session_conf(spark, **{"spark.sql.shuffle.partitions": partitions or stream_partitions(spark)}):
        return (df.writeStream.trigger(**(trigger or DEFAULT_TRIGGER)).option("checkpointLocation", checkpoint)
                .foreachBatch(append_batch(out_path, date_from)).start())


def await_all(queries) -> None:
    for q in (queries.values() if isinstance(queries, dict) else queries):
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()


def run_forever(spark: SparkSession) -> None:
    """Block until any query ends (the service entry point)."""
    spark.streams.awaitAnyTermination()


# --- landing folders for file-driven runs and tests ---------------------------

def time_chunks(df: DataFrame, n: int, col: str = "last_contact", rows_per_chunk: int = 5_000_000) -> list[tuple[int, int]]:
    """Contiguous, non-overlapping ranges of ``col`` covering all rows: ``n``, or more for a large table.

    Three scalars are fetched. A chunk has about ``rows_per_chunk`` rows at most if rows are spread evenly.
    """
    lo, hi, rows = df.agg(F.min(col), F.max(col), F.count(F.lit(1))).first()
    if lo is None:
        return []
    n = max(n, -(-rows // rows_per_chunk))
    step = max(1, -(-(hi - lo + 1) // n))
    return [(lo + i * step, min(hi + 1, lo + (i + 1) * step)) for i in range(n) if lo + i * step <= hi]


def replay_in_batches(spark: SparkSession, flights: DataFrame, landing: str, n_batches: int, run_once, by: str = "last_contact",
                      bounds: list[tuple[int, int]] | None = None) -> None:
    """Land ``flights`` as JSON messages in time-ordered chunks and run the stream after each.

    All chunks are written in one parallel pass, partitioned by chunk number,
    to a staging folder beside ``landing``; before each run the next chunk's
    folder is moved into ``landing`` as a whole (one rename), so the reports are
    read once however many chunks there are. Read ``landing`` with
    ``read_message_files(..., recursive=True)``. ``run_once()`` runs the query with an
    ``availableNow`` trigger from its checkpoint, so chunk k is micro-batch k and
    the watermark advances exactly as a live feed of the same data would.
    ``by``: the column that orders the chunks; ``bounds``: its chunks (see ``time_chunks``), if they are known.
    """
    if bounds is None:
        bounds = time_chunks(flights, n_batches, by)
    if not bounds:
        return
    lo, step = bounds[0][0], bounds[0][1] - bounds[0][0]
    lc = F.col(by)
    # reports without a time ride along with the first chunk
    chunk = F.when(lc.isNull(), F.lit(0)).otherwise(F.floor((lc - F.lit(lo)) / F.lit(step))).cast("int")
    staged = f"{landing.rstrip('/')}-staged"
    (to_messages(flights.withColumn("chunk", chunk), keep=("chunk",)).select("value", "chunk")
     .write.mode("overwrite").partitionBy("chunk").text(staged))
    fs, _ = file_system(spark, staged)
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(jpath(landing))
    for i in range(len(bounds)):
        src = jpath(f"{staged}/chunk={i}")
        if fs.exists(src) and not fs.rename(src, jpath(f"{landing.rstrip('/')}/part-{i}")):
            raise RuntimeError(f"could not land chunk {i}")
        run_once()
