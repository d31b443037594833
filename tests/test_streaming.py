"""Layers 2-3: streaming edges (FIXTURES.md §4) and sink behaviour."""

import json
import os

import pytest
from pyspark.sql import functions as F

from contrail.sources.messages import decode_messages, read_message_files
from contrail.streaming.pipeline import ResultTables, enriched_stream, start_pipeline, await_all
from contrail.streaming.sinks import KeyedTable, append_batch, read_archive
from tests.helpers import aircraft_df, flights_df

FILES = [
    [("a", 1000), ("b", 1010), ("a", 1020)],
    [("a", 2000)],
    [("b", 1005), ("b", 1880), ("b", 1990)],
]
AVAILABLE_NOW = {"availableNow": True}


def _land(folder):
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(FILES):
        p = f"{folder}/batch{i}.json"
        with open(p, "w") as fh:
            for icao, t in rows:
                fh.write(json.dumps({"icao24": icao, "origin_country": "US", "last_contact": t,
                                     "ingestion_ts": t + 5, "baro_altitude": 1000.0, "velocity": 200.0,
                                     "on_ground": False, "vertical_rate": -20.0}) + "\n")
        os.utime(p, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))


def _dim(spark):
    return aircraft_df(spark, [("a", "R", "MFR", "M", "T", "OpA")])


def _run(spark, root, queries=("agg",), fan_out=False):
    landing = f"{root}/landing"
    _land(landing)
    src = read_message_files(spark, landing, max_files_per_trigger=1)
    qs = start_pipeline(enriched_stream(src, _dim(spark)), f"{root}/out", f"{root}/ck",
                        queries=queries, trigger=AVAILABLE_NOW, fan_out=fan_out)
    await_all(qs)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for q in qs.values() for p in q.recentProgress for op in p.get("stateOperators", []))
    return ResultTables.at(f"{root}/out"), dropped


def test_late_row_kept_by_default(spark, scratch):
    tables, dropped = _run(spark, scratch)
    assert dropped == 0
    # the late row is filtered against the previous batch's watermark (900 s) and its
    # windows are still in state, so it joins them: [960, 1260) holds 1000, 1005, 1010, 1020
    cur = {r.window_end: r.flight_count for r in tables.agg.current(spark).collect()}
    assert cur[1260] == 4 and cur[1020] == 3


def test_late_row_dropped_with_single_watermark_semantics(spark, scratch):
    key = "spark.sql.streaming.statefulOperator.allowMultiple"
    spark.conf.set(key, "false")
    try:
        tables, dropped = _run(spark, scratch)
    finally:
        spark.conf.unset(key)
    assert dropped == 5
    cur = {r.window_end: r.flight_count for r in tables.agg.current(spark).collect()}
    assert cur[1260] == 3  # (a,1000), (b,1010), (a,1020): the late 1005 never arrives
    assert cur[1920] == 1  # 1880 sits on the watermark and is kept


def test_stateless_query_keeps_late_rows(spark, scratch):
    tables, _ = _run(spark, scratch, queries=("alerts", "live"))
    alerts = tables.alerts.current(spark)
    assert alerts.where(F.col("icao24") == "b").count() == 4
    live = {r.icao24: (r.last_contact, r.operator) for r in tables.live.current(spark).collect()}
    # last arrival wins: b's last report is 1990; only a is in the dimension
    assert live == {"a": (2000, "OpA"), "b": (1990, None)}


def test_fan_out_equals_separate_queries(spark, tmp_path):
    t1, _ = _run(spark, str(tmp_path / "sep"), queries=("live", "alerts", "enriched"))
    t2, _ = _run(spark, str(tmp_path / "fan"), queries=("live", "alerts", "enriched"), fan_out=True)
    for name in ("live", "alerts", "enriched"):
        a = getattr(t1, name).current(spark)
        b = getattr(t2, name).current(spark)
        assert sorted(a.collect()) == sorted(b.select(*a.columns).collect())


def test_restart_continues_from_checkpoint(spark, scratch):
    landing, ck, out = f"{scratch}/landing", f"{scratch}/ck", f"{scratch}/out"
    _land(landing)

    def once():
        q = (decode_messages(read_message_files(spark, landing)).writeStream.trigger(availableNow=True)
             .option("checkpointLocation", ck).foreachBatch(append_batch(out)).start())
        q.awaitTermination()
    once()
    once()  # nothing new: no batch, nothing rewritten
    assert read_archive(spark, out).count() == 7


def test_replayed_batch_is_idempotent_and_empty_batch_writes_nothing(spark, scratch):
    t = KeyedTable(f"{scratch}/t", ["icao24"], ("last_contact",))
    df = flights_df(spark, [dict(icao24="a", last_contact=1), dict(icao24="b", last_contact=2)])
    t.write_batch(df, 0)
    t.write_batch(df, 0)
    assert t.log(spark).count() == 2
    t.write_batch(df.limit(0), 1)
    assert t.batch_ids(spark) == [0] and not os.path.exists(f"{scratch}/t/data/batch_id=1")
    t.write_batch(flights_df(spark, [dict(icao24="a", last_contact=0)]), 2)
    cur = {r.icao24: r.last_contact for r in t.current(spark).collect()}
    assert cur == {"a": 0, "b": 2}  # later batch wins even with an older time
    compacted = t.compact(spark, f"{scratch}/t2")
    assert sorted(compacted.current(spark).collect()) == sorted(t.current(spark).collect())


class _Recorder:
    """Stands in for a reader or writer: keeps format, options and the last call, starts nothing."""

    def __init__(self):
        self.options_seen, self.kind, self.done = {}, None, None

    def format(self, kind):
        self.kind = kind
        return self

    def option(self, k, v):
        self.options_seen[k] = v
        return self

    def options(self, **kv):
        self.options_seen.update(kv)
        return self

    def load(self, *args):
        self.done = "load"
        return self

    def save(self):
        self.done = "save"

    def start(self):
        self.done = "start"
        return "query"


def test_kafka_source_options():
    from types import SimpleNamespace

    from contrail.sources.messages import read_kafka
    spark = SimpleNamespace(readStream=_Recorder(), read=_Recorder())
    got = read_kafka(spark, "h1:9092,h2:9092", "flights-raw", max_offsets_per_trigger=5000)
    assert got is spark.readStream and (got.kind, got.done) == ("kafka", "load")
    assert got.options_seen == {"kafka.bootstrap.servers": "h1:9092,h2:9092", "subscribe": "flights-raw",
                                "failOnDataLoss": "false", "startingOffsets": "latest", "maxOffsetsPerTrigger": 5000}
    uncapped = read_kafka(SimpleNamespace(readStream=_Recorder()), "h", "t", starting_offsets="earliest", fail_on_data_loss=True)
    assert "maxOffsetsPerTrigger" not in uncapped.options_seen
    assert uncapped.options_seen["startingOffsets"] == "earliest" and uncapped.options_seen["failOnDataLoss"] == "true"
    batch = read_kafka(spark, "h", "t", max_offsets_per_trigger=7, streaming=False)
    assert batch is spark.read and "maxOffsetsPerTrigger" not in batch.options_seen and "startingOffsets" not in batch.options_seen


def test_kafka_sink_options(monkeypatch):
    from types import SimpleNamespace

    import contrail.sources.messages as messages
    monkeypatch.setattr(messages, "to_messages", lambda df: df)
    stream = SimpleNamespace(isStreaming=True, writeStream=_Recorder())
    assert messages.publish_kafka(stream, "h", "t", "s3a://ck") == "query"
    assert stream.writeStream.options_seen == {"kafka.bootstrap.servers": "h", "topic": "t", "kafka.acks": "all",
                                               "kafka.retries": "3", "checkpointLocation": "s3a://ck"}
    batch = SimpleNamespace(isStreaming=False, write=_Recorder())
    assert messages.publish_kafka(batch, "h", "t") is None
    assert (batch.write.kind, batch.write.done, batch.write.options_seen["kafka.acks"]) == ("kafka", "save", "all")


def test_landing_folder_takes_all_files_unless_bounded(spark, scratch):
    _land(f"{scratch}/l/part-0")
    for kw, batches in ((dict(), 1), (dict(max_files_per_trigger=1), 3), (dict(max_bytes_per_trigger="1"), 3)):
        out = f"{scratch}/{batches}{len(str(kw))}"
        q = (read_message_files(spark, f"{scratch}/l", recursive=True, **kw).writeStream.trigger(availableNow=True)
             .option("checkpointLocation", f"{out}/ck").foreachBatch(append_batch(f"{out}/t")).start())
        q.awaitTermination()
        assert sorted(p["batchId"] for p in q.recentProgress if p["numInputRows"]) == list(range(batches))
        assert read_archive(spark, f"{out}/t").count() == 7


def test_run_forever_returns_when_any_query_ends(spark, scratch):
    from contrail.streaming.pipeline import run_forever
    _land(f"{scratch}/landing")
    src = read_message_files(spark, f"{scratch}/landing")
    spark.streams.resetTerminated()
    keeps_on = (src.writeStream.trigger(processingTime="1 hour").option("checkpointLocation", f"{scratch}/a")
                .foreachBatch(append_batch(f"{scratch}/ta")).start())
    ends = (src.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{scratch}/b")
            .foreachBatch(append_batch(f"{scratch}/tb")).start())
    try:
        run_forever(spark)
        assert keeps_on.isActive and not ends.isActive
    finally:
        keeps_on.stop()
        keeps_on.awaitTermination()
        spark.streams.resetTerminated()


def test_bare_reports_give_the_tables_of_the_enriched_stream(spark, tmp_path):
    from contrail.streaming.pipeline import report_stream
    dim = aircraft_df(spark, [("a", "R1", "M", "M1", "T", "OpA"), ("a", "R2", "M", "M1", "T", "OpB")])
    tables = []
    for k, fan in ((0, True), (1, True), (2, False)):
        root = str(tmp_path / str(k))
        _land(f"{root}/landing")
        src = read_message_files(spark, f"{root}/landing", max_files_per_trigger=1)
        bare = {"aircraft": dim} if k else {}
        qs = start_pipeline(report_stream(src) if k else enriched_stream(src, dim), f"{root}/out", f"{root}/ck",
                            trigger=AVAILABLE_NOW, fan_out=fan, **bare)
        await_all(qs)
        t = ResultTables.at(f"{root}/out")
        tables.append([sorted(getattr(t, n).current(spark).select(*getattr(t, n).columns).collect(), key=str)
                       for n in ("live", "agg", "alerts", "enriched")])
    assert tables[0] == tables[1] == tables[2] and all(tables[0])


def test_the_join_sees_one_row_an_aircraft_in_a_batch(spark, scratch, monkeypatch):
    import contrail.plans.tables as tables
    from contrail.streaming.pipeline import _stateless_sink
    seen = []
    real = tables.enrich
    monkeypatch.setattr(tables, "enrich", lambda df, *a, **k: (seen.append(df.count()), real(df, *a, **k))[1])
    rows = [dict(icao24=f"k{i % 5}", last_contact=i, ingestion_ts=10, on_ground=False, vertical_rate=-20.0) for i in range(500)]
    sink = _stateless_sink(ResultTables.at(scratch), ("live", "alerts", "enriched"), ("ingestion_ts", "last_contact"), _dim(spark), "broadcast")
    sink(flights_df(spark, rows), 0)
    sink(flights_df(spark, []), 1)
    assert seen == [5, 5]
    assert ResultTables.at(scratch).live.batch_ids(spark) == ResultTables.at(scratch).alerts.batch_ids(spark) == [0]


def test_four_queries_run_concurrently_with_rocksdb_state(spark, scratch):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    landing = f"{scratch}/landing"
    _land(landing)
    src = read_message_files(spark, landing, max_files_per_trigger=1)
    qs = start_pipeline(enriched_stream(src, _dim(spark)), f"{scratch}/out", f"{scratch}/ck",
                        trigger=AVAILABLE_NOW, state_store="rocksdb", fan_out=False)
    assert sorted(qs) == ["agg", "alerts", "enriched", "live"]
    await_all(qs)
    assert spark.conf.get(key) == before  # the session itself keeps its own setting
    t = ResultTables.at(f"{scratch}/out")
    assert t.live.current(spark).count() == 2 and t.enriched.current(spark).count() == 2
    assert t.alerts.current(spark).count() == 7
    assert t.agg.current(spark).where(F.col("window_end") == 1260).first().flight_count == 4


def test_kafka_style_offset_order(spark, scratch):
    from contrail.plans.tables import alert_rows, live_rows
    from contrail.streaming.pipeline import _latest_in_batch
    rows = [dict(icao24="a", last_contact=900, ingestion_ts=10, callsign="first"),
            dict(icao24="a", last_contact=100, ingestion_ts=10, callsign="second")]
    df = flights_df(spark, rows).withColumn("offset", F.monotonically_increasing_id())
    t = ResultTables.at(scratch, order=("offset",))
    _latest_in_batch(t.live)(live_rows(enrich_rows(spark, df)), 0)
    assert t.live.current(spark).first().callsign == "second"
    assert "offset" in alert_rows(enrich_rows(spark, df), ["offset"]).columns


def enrich_rows(spark, df):
    from contrail.operators.enrich import enrich
    return enrich(df, _dim(spark))


def test_compaction_in_place_keeps_the_view_and_survives_replay(spark, scratch):
    t = KeyedTable(f"{scratch}/t", ["icao24"], ("last_contact",))
    for b in range(6):
        rows = [dict(icao24=k, last_contact=b * 10 + j) for j, k in enumerate(["a", "b", f"k{b}"])]
        t.write_batch(flights_df(spark, rows), b)
    before = sorted(t.current(spark).collect())
    assert t.compact_in_place(spark, upto=3) == 3
    assert t.batch_ids(spark) == [3, 4, 5]
    assert sorted(t.current(spark).collect()) == before
    t.write_batch(flights_df(spark, [dict(icao24="a", last_contact=-1)]), 5)  # replay of the last batch
    cur = {r.icao24: r.last_contact for r in t.current(spark).collect()}
    # the replay rewrote batch 5 only (k5 went with it); folded batches 0-3 are intact
    assert cur["a"] == -1 and cur["k0"] == 2 and cur["b"] == 41 and len(cur) == 7 and "k5" not in cur


def test_periodic_compaction_from_the_sink(spark, scratch):
    t = KeyedTable(f"{scratch}/t", ["icao24"], ("last_contact",), compact_every=2)
    for b in range(5):
        t.write_batch(flights_df(spark, [dict(icao24=f"k{b}", last_contact=b)]), b)
    assert t.batch_ids(spark) == [3, 4]
    assert t.current(spark).count() == 5
    # folders that a fold replaced go once no kept manifest names them
    for b in range(5, 12):
        t.write_batch(flights_df(spark, [dict(icao24=f"k{b}", last_contact=b)]), b)
    held = {d for d in os.listdir(f"{scratch}/t/data") if os.listdir(f"{scratch}/t/data/{d}")}
    assert "batch_id=0" not in held and t.current(spark).count() == 12
    assert len(t.versions(spark)) <= t.keep_versions + 2


def test_pipeline_with_compaction(spark, scratch):
    landing = f"{scratch}/landing"
    _land(landing)
    src = read_message_files(spark, landing, max_files_per_trigger=1)
    qs = start_pipeline(enriched_stream(src, _dim(spark)), f"{scratch}/out", f"{scratch}/ck",
                        queries=("live",), trigger=AVAILABLE_NOW, compact_every=2)
    await_all(qs)
    t = ResultTables.at(f"{scratch}/out")
    assert t.live.batch_ids(spark) == [1, 2]
    assert {r.icao24: r.last_contact for r in t.live.current(spark).collect()} == {"a": 2000, "b": 1990}


def test_agg_without_join_when_keys_unique(spark, scratch):
    from contrail.streaming.pipeline import counted_stream
    landing = f"{scratch}/landing"
    _land(landing)
    src = read_message_files(spark, landing, max_files_per_trigger=1)
    counted = counted_stream(src, _dim(spark), unique_dimension=True)
    qs = start_pipeline(enriched_stream(src, _dim(spark)), f"{scratch}/out", f"{scratch}/ck",
                        queries=("agg",), trigger=AVAILABLE_NOW, agg_input=counted)
    await_all(qs)
    cur = {r.window_end: r.flight_count for r in ResultTables.at(f"{scratch}/out").agg.current(spark).collect()}
    assert cur[1260] == 4


def test_published_json_keeps_nulls_and_round_trips(spark):
    from contrail.sources.messages import to_messages
    f = flights_df(spark, [dict(icao24="a", callsign="X1", baro_altitude=None, velocity=1.5, on_ground=False)])
    msg = to_messages(f).first()
    assert msg.key == "a" and '"baro_altitude":null' in msg.value
    back = decode_messages(spark.createDataFrame([(msg.value,)], "value string")).first()
    assert tuple(back) == tuple(f.first())


def test_date_archive_prunes_by_date_and_replays_idempotently(spark, scratch):
    import contextlib
    import io
    rows = [dict(icao24="a", last_contact=10), dict(icao24="b", last_contact=2 * 86400 + 5),
            dict(icao24="c", last_contact=None)]
    batch = flights_df(spark, rows)
    sink = append_batch(f"{scratch}/arch", date_from="last_contact")
    sink(batch, 0)
    sink(batch.where(F.col("icao24") == "b"), 1)
    sink(batch, 0)  # a replayed batch rewrites its own folders only
    sink(batch.where(F.lit(False)), 2)  # an empty batch writes nothing
    arch = read_archive(spark, f"{scratch}/arch")
    assert sorted(r.icao24 for r in arch.collect()) == ["a", "b", "b", "c"]
    assert not any("batch_id=2" in d for _, dirs, _ in os.walk(f"{scratch}/arch") for d in dirs)
    day = arch.where(F.col("date") == F.lit("1970-01-03").cast("date"))
    assert sorted(r.icao24 for r in day.collect()) == ["b", "b"]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        day.explain()
    assert "PartitionFilters: [isnotnull(date" in buf.getvalue()


def test_fan_out_per_aircraft_tables_show_the_same_report(spark, scratch):
    # two reports of one aircraft with the same arrival order (an exact tie): one
    # reduction picks the live row and the enriched record is its projection
    landing = f"{scratch}/landing"
    os.makedirs(landing)
    with open(f"{landing}/b0.json", "w") as fh:
        for geo, vel in ((1.0, 2.0), (2.0, 1.0)):
            fh.write(json.dumps({"icao24": "a", "origin_country": "US", "last_contact": 1000, "ingestion_ts": 1005,
                                 "geo_altitude": geo, "velocity": vel, "on_ground": False}) + "\n")
    src = read_message_files(spark, landing, max_files_per_trigger=1)
    qs = start_pipeline(enriched_stream(src, _dim(spark)), f"{scratch}/out", f"{scratch}/ck",
                        queries=("live", "enriched"), trigger=AVAILABLE_NOW, fan_out=True)
    await_all(qs)
    t = ResultTables.at(f"{scratch}/out")
    live, enr = t.live.current(spark).collect(), t.enriched.current(spark).collect()
    assert len(live) == len(enr) == 1
    assert (live[0].geo_altitude, live[0].velocity) == (2.0, 1.0) and enr[0].velocity == 1.0


class _CrashingFs:
    """A file system that fails (as a lost driver would stop) at one kind of step."""

    def __init__(self, fs, step):
        self.fs, self.step = fs, step

    def __getattr__(self, name):
        return getattr(self.fs, name)

    def rename(self, src, dst):
        if self.step == "commit":
            raise RuntimeError("lost before the commit")
        return self.fs.rename(src, dst)

    def delete(self, path, recursive):
        if self.step == "clear":
            raise RuntimeError("lost while clearing old folders")
        return self.fs.delete(path, recursive)


@pytest.mark.parametrize("step", ["commit", "clear"])
def test_compaction_interrupted_at_any_step_keeps_the_view(spark, scratch, monkeypatch, step):
    import contrail.streaming.sinks as sinks
    t = KeyedTable(f"{scratch}/t", ["icao24"], ("last_contact",), keep_versions=1)
    for b in range(4):
        rows = [dict(icao24=k, last_contact=b * 10 + j) for j, k in enumerate(["a", "b", f"k{b}"])]
        t.write_batch(flights_df(spark, rows), b)
    before = sorted(t.current(spark).collect())
    real = sinks.file_system
    monkeypatch.setattr(sinks, "file_system", lambda s, p: (_CrashingFs(real(s, p)[0], step), real(s, p)[1]))
    with pytest.raises(RuntimeError):
        t.compact_in_place(spark, upto=2)
    monkeypatch.undo()
    assert sorted(t.current(spark).collect()) == before
    assert t.compact_in_place(spark, upto=2) == 2  # the next compaction completes the job
    assert t.batch_ids(spark) == [2, 3]
    assert sorted(t.current(spark).collect()) == before


def test_a_reader_opened_before_a_compaction_or_replay_still_answers(spark, scratch):
    t = KeyedTable(f"{scratch}/t", ["icao24"], ("last_contact",))
    for b in range(4):
        t.write_batch(flights_df(spark, [dict(icao24="a", last_contact=b), dict(icao24=f"k{b}", last_contact=b)]), b)
    opened = t.current(spark)
    t.compact_in_place(spark)
    t.write_batch(flights_df(spark, [dict(icao24="z", last_contact=9)]), 3)  # a replay with other rows
    assert sorted((r.icao24, r.last_contact) for r in opened.collect()) == [("a", 3), ("k0", 0), ("k1", 1), ("k2", 2), ("k3", 3)]


@pytest.mark.parametrize("upto", [None, 3])
def test_a_replay_of_any_batch_after_a_compaction_keeps_all_keys(spark, scratch, upto):
    t = KeyedTable(f"{scratch}/t", ["icao24"], ("last_contact",))

    def batch(b):
        return flights_df(spark, [dict(icao24="a", last_contact=b), dict(icao24=f"k{b}", last_contact=b)])
    for b in range(4):
        t.write_batch(batch(b), b)
    want = sorted(t.current(spark).collect())
    assert t.compact_in_place(spark, upto) == (2 if upto is None else upto)
    for b in (3, 3, 0, 2):
        t.write_batch(batch(b), b)
        assert sorted(t.current(spark).collect()) == want
    assert t.compact_in_place(spark) == 2
    assert sorted(t.current(spark).collect()) == want


def test_the_log_grows_in_proportion_and_clears_itself(spark, scratch, monkeypatch):
    """Without a compaction the log lists what there is; with one it stays as long as the versions kept."""
    from contrail.streaming import sinks
    t = KeyedTable(f"{scratch}/t", ["icao24"], ("last_contact",))
    fake = {"n": 0}

    def write(df, batch_id, known_rows, kind="batch"):
        fake["n"] += 1
        return [[kind, batch_id, None, f"batch_id={batch_id}/attempt={fake['n']}"]]
    monkeypatch.setattr(t, "_write", write)
    rows, sizes = flights_df(spark, [dict(icao24="a")]), []
    for b in range(160):
        t.write_batch(rows, b)
        if b % 40 == 39:
            sizes.append(sum(os.path.getsize(f"{scratch}/t/_log/{f}") for f in os.listdir(f"{scratch}/t/_log") if not f.startswith(".")))
    assert len(t.entries(spark)) == 160 and sizes[-1] < 5 * sizes[0]
    assert len(os.listdir(f"{scratch}/t/_log")) <= 4 * (sinks.LIST_EVERY + t.keep_versions)  # with the checksum files
    assert [e[1] for e in t.entries(spark, t.versions(spark)[0])] == list(range(156))
    t.write_batch(rows, 159)  # a replay
    assert len(t.entries(spark)) == 160 and t.entries(spark)[-1][3].endswith("attempt=161")


def test_a_batch_is_visible_only_once_committed(spark, scratch, monkeypatch):
    """A write lost half way, at its first attempt or in a replay, shows nothing of itself."""
    t = KeyedTable(f"{scratch}/t", ["icao24"], ("last_contact",))
    t.write_batch(flights_df(spark, [dict(icao24="a", last_contact=1)]), 0)
    monkeypatch.setattr(t, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    for b in (0, 1):
        with pytest.raises(RuntimeError):
            t.write_batch(flights_df(spark, [dict(icao24="b", last_contact=2)]), b)
    monkeypatch.undo()
    assert [(r.icao24, r.last_contact) for r in t.current(spark).collect()] == [("a", 1)]


def test_dated_tables_prune_reads_and_fold_closed_dates_only(spark, scratch):
    import contextlib
    import datetime as dt
    import io
    day = 86400
    t = ResultTables.at(scratch).agg
    shape = spark.createDataFrame([], t.schema)

    def rows(*pairs):
        return spark.createDataFrame([("c", e - 300, e, n, 0.0, 0.0, 0.0, "c", "k") for e, n in pairs], shape.schema)
    for b in range(4):
        t.write_batch(rows((600, b), (day + 600, b), (5 * day + 60 * b, b)), b)
    opened = t.current(spark)
    view = sorted(opened.collect())
    assert t.compact_in_place(spark) == 2  # the newest batch may still be replayed
    folded = {(e[2], e[1]) for e in t.entries(spark)}
    assert folded == {*((d, b) for d in ("1970-01-01", "1970-01-02") for b in (2, 3)), *(("1970-01-06", b) for b in range(4))}
    assert t.compact_in_place(spark, upto=3) == 3
    folded = {(e[2], e[1]) for e in t.entries(spark)}
    assert folded == {("1970-01-01", 3), ("1970-01-02", 3), *(("1970-01-06", b) for b in range(4))}
    assert sorted(t.current(spark).collect()) == sorted(opened.collect()) == view
    before = t.entries(spark)
    t.compact_in_place(spark)
    assert t.entries(spark) == before  # closed dates are folded once
    day2 = t.current(spark, since=dt.date(1970, 1, 2), until=dt.date(1970, 1, 2))
    assert [(r.window_end, r.flight_count) for r in day2.collect()] == [(day + 600, 3)]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        day2.explain()
    assert "PartitionFilters: [isnotnull(date" in buf.getvalue()
    assert t.current(spark, since=dt.date(1980, 1, 1)).count() == 0


def test_dashboard_refresh_equals_panels_over_the_tables(spark, scratch):
    from contrail.plans import panels
    from contrail.plans.dashboard import PANELS, panel_frames, refresh
    t, _ = _run(spark, scratch, queries=("live", "agg", "alerts", "enriched"), fan_out=True)
    direct = panel_frames(t.live.current(spark), t.agg.current(spark), t.alerts.current(spark))
    cached_before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with refresh(spark, t) as p:
        assert sorted(p) == sorted(PANELS)
        for name in PANELS:
            assert sorted(p[name].collect()) == sorted(direct[name].collect()), name
        kpi = p["kpi_summary"].first()
        assert kpi.airborne == p["live_airborne"].count() and kpi.alerts_total == p["alert_log"].count() > 0
    assert panels.top_countries(t.agg.current(spark)).count() == 1
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached_before  # released


def test_refresh_before_any_batch_gives_empty_panels_and_zero_kpis(spark, scratch):
    from contrail.plans.dashboard import refresh
    with refresh(spark, ResultTables.at(f"{scratch}/nothing-yet")) as p:
        kpi = p["kpi_summary"].first()
        assert (kpi.airborne, kpi.countries, kpi.avg_altitude, kpi.avg_velocity, kpi.enriched, kpi.alerts) == \
            (0, 0, 0.0, 0.0, 0, 0)
        assert kpi.alert_status == "all clear"
        assert [r.flights for r in p["altitude_bands"].orderBy("band_order").collect()] == [0] * 7
        for name in ("top_countries", "alert_log", "worst_descent", "velocity_histogram", "trend_top_countries"):
            assert p[name].count() == 0, name


def test_typed_empty_table_matches_written_types(spark, scratch):
    t, _ = _run(spark, scratch, queries=("live", "agg", "alerts", "enriched"), fan_out=True)
    for name in ("live", "agg", "alerts", "enriched"):
        written = {f.name: f.dataType for f in getattr(t, name).current(spark).schema.fields}
        declared = {f.name: f.dataType for f in getattr(t, name).schema.fields}
        assert written == declared, name


def test_refresh_with_picked_countries(spark, scratch):
    from contrail.plans.dashboard import refresh
    t, _ = _run(spark, scratch, queries=("agg",))
    windows = t.agg.current(spark).count()
    with refresh(spark, t, countries=["US"]) as p:
        rows = p["trend_top_countries"].collect()
        assert len(rows) == windows > 0 and {r.country for r in rows} == {"US"}
        assert [r.window_end for r in rows] == sorted(r.window_end for r in rows)
    with refresh(spark, t, countries=["XX"]) as p:
        assert p["trend_top_countries"].count() == 0
