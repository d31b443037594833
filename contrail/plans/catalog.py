"""Registered queries: one lazy DataFrame per operator, over the driver tables.

Every query reads ``events``/``customer`` (through the ``flights``/``aircraft``
views) or data Spark derives from them, so its work grows with the tables.
Streaming queries run ``availableNow`` over a landing folder in the shared
scratch area, then return the batch read of their result table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail import fixtures
from contrail.functions.scalars import (
    aircraft_key, clean_callsign, decode_bool, decode_int, decode_number, encode_bool, encode_number, key_head, rejected,
    reverse_epoch,
)
from contrail.operators.aggregate import country_window_agg
from contrail.operators.clustered import ClusteredTable
from contrail.operators.colocated import ColocatedTables
from contrail.operators.enrich import enrich, fan_out_by_dimension, join_strategy, rapid_descent, with_event_time
from contrail.operators.rollup import RollupTable
from contrail.plans import panels
from contrail.plans.incremental import LiveDashboard
from contrail.plans.tables import alert_pairs, alerts_then_enrich, latest_then_enrich, with_agg_key
from contrail.schemas import DIMENSION_COLUMNS, ENRICHED_COLUMNS, FLIGHT_FIELDS, LIVE_COLUMNS
from contrail.session import ensure_utc, scratch_dir
from contrail.sources.dimension import read_aircraft_csv, write_aircraft_csv
from contrail.sources.messages import decode_messages, read_message_files, to_messages
from contrail.sources.polls import decode_polls, poll_stream, record_polls
from contrail.sources.snapshot import decode_replay, decode_snapshot, snapshot_documents
from contrail.sources.tolerant import decode_states, decode_tolerant, readable, start_tolerant_archive
from contrail.streaming.metrics import BatchMetrics, read_metrics
from contrail.streaming.pipeline import (
    ResultTables, await_all, enriched_stream, replay_in_batches, report_stream, start_archive, start_pipeline,
    time_chunks,
)
from contrail.streaming.sinks import KeyedTable, read_archive
from contrail.streaming.state import read_latest_state, start_latest

STREAM_BATCHES = 5
ENRICHED_FIELDS = FLIGHT_FIELDS + DIMENSION_COLUMNS


# --- shared inputs ---------------------------------------------------------------

def flights(spark, sf):
    return fixtures.flights(spark, sf)


def aircraft(spark, sf):
    return fixtures.aircraft(spark, sf)


def enriched(spark, sf) -> DataFrame:
    return enrich(with_event_time(flights(spark, sf)), aircraft(spark, sf))


def live(spark, sf):
    return latest_then_enrich(flights(spark, sf), aircraft(spark, sf), LIVE_COLUMNS)


def agg(spark, sf):
    # the aggregate reads no metadata column: only each key's multiplicity is joined
    counted = fan_out_by_dimension(flights(spark, sf), aircraft(spark, sf))
    return with_agg_key(country_window_agg(with_event_time(counted)))


def alerts(spark, sf):
    # one report per alert first; the join sees only those
    return alerts_then_enrich(flights(spark, sf), aircraft(spark, sf)).drop("last_contact")


def stored(spark, df, name):
    """Write a derived table once to the shared scratch folder and read it back.

    For panels that read their input more than once (as the dashboard reads a
    stored result table), so the upstream aggregate is not computed per read.
    """
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def airborne(spark, sf):
    return panels.live_airborne(live(spark, sf))


def fleet(spark, sf):
    return panels.enriched_flights(airborne(spark, sf))


# --- sources and decode path --------------------------------------------------------

def q_json_decode(spark, sf):
    msgs = to_messages(flights(spark, sf)).select(F.col("value").cast("binary").alias("value"))
    return decode_messages(msgs)


def q_src_snapshot_decode(spark, sf):
    docs = snapshot_documents(fixtures.reports(spark, sf))
    rows = decode_snapshot(docs, ingestion_ts=F.col("ingestion_ts"), all_fields=True)
    return rows.withColumn("sensors", F.to_json("sensors"))


def q_src_replay(spark, sf):
    docs = snapshot_documents(flights(spark, sf), bare=True)
    return decode_replay(docs, ingestion_ts=F.col("ingestion_ts"))


def q_src_csv_dimension(spark, sf):
    path = scratch_dir(spark, "aircraft_csv")
    write_aircraft_csv(aircraft(spark, sf), path)
    return read_aircraft_csv(spark, path)


def q_dim_row_count(spark, sf):
    return aircraft(spark, sf).agg(F.count(F.lit(1)).alias("aircraft_rows"))


def q_event_time(spark, sf):
    t = with_event_time(flights(spark, sf))
    return t.select("icao24", "last_contact",
                    F.unix_timestamp("event_time").alias("event_epoch"),
                    F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_text"))


def q_messages_per_poll(spark, sf):
    return flights(spark, sf).groupBy("ingestion_ts").agg(F.count(F.lit(1)).alias("sent"))


def q_sink_keyed_json(spark, sf):
    return to_messages(fixtures.reports(spark, sf))


def q_scalar_clean(spark, sf):
    f = flights(spark, sf)
    raw = F.concat(F.lit(" \t"), F.col("callsign"), F.lit("  \n"))
    return f.select(aircraft_key("icao24").alias("key"), raw.alias("callsign_raw"),
                    clean_callsign(raw).alias("callsign_clean"))


def q_reverse_epoch_key(spark, sf):
    a = agg(spark, sf)
    return a.select("country", "window_end", "country_key",
                    reverse_epoch("window_end").alias("reverse_epoch"), "row_key",
                    key_head("row_key").alias("key_head"))


def q_cell_codec(spark, sf):
    """Encode the live rows as cells, damage some, decode all and count what does not decode."""
    nums = ["latitude", "longitude", "baro_altitude", "geo_altitude", "velocity", "true_track", "vertical_rate"]
    t = F.col("last_contact")
    time_cell = (F.when(t % 8 == 0, "12.5").when(t % 8 == 1, "n/a").when(t % 8 == 2, "").when(t % 8 == 3, F.lit(None))
                 .otherwise(encode_number("last_contact")))
    flag_cell = F.when(t % 5 == 0, F.lit(None)).when(t % 5 == 1, "").otherwise(encode_bool("on_ground"))
    cells = {c: encode_number(c) for c in nums} | {"time_cell": time_cell, "on_ground_cell": flag_cell}
    cells["velocity"] = F.when(t % 11 == 0, "fast").otherwise(cells["velocity"])
    stored_cells = live(spark, sf).select("icao24", *[v.alias(k) for k, v in cells.items()])
    bad = rejected("time_cell", "bigint").cast("int")
    for c in nums:
        bad = bad + rejected(c).cast("int")
    return stored_cells.select("icao24", *[decode_number(c).alias(c) for c in nums], F.col("true_track").alias("true_track_cell"),
                               "time_cell", decode_int("time_cell").alias("time"), "on_ground_cell",
                               decode_bool("on_ground_cell").alias("on_ground"), bad.alias("bad_cells"))


# --- enrichment, aggregates, tables -------------------------------------------------

def q_enrich_left_join(spark, sf):
    return enriched(spark, sf).select(*ENRICHED_FIELDS)


def q_country_window_agg(spark, sf):
    return agg(spark, sf).select("country", "window_start", "window_end", "flight_count",
                                 "avg_alt", "max_alt", "avg_velocity")


def q_rapid_descent_alerts(spark, sf):
    return rapid_descent(enriched(spark, sf)).select(*ENRICHED_FIELDS)


def q_live_snapshot(spark, sf):
    return live(spark, sf)


def q_enriched_latest(spark, sf):
    return latest_then_enrich(flights(spark, sf), aircraft(spark, sf), ENRICHED_COLUMNS)


def q_alerts_table(spark, sf):
    return alerts(spark, sf)


def q_scan_live(spark, sf):
    table = KeyedTable(scratch_dir(spark, "flights_live"), ["icao24"], ("ingestion_ts", "last_contact"))
    table.write_batch(live(spark, sf), 0)
    return table.current(spark)


# --- panels ------------------------------------------------------------------------

def q_live_airborne(spark, sf):
    return airborne(spark, sf)


def q_kpi_summary(spark, sf):
    return panels.kpi_summary(airborne(spark, sf), alert_pairs(flights(spark, sf)))


def q_map_points(spark, sf):
    return panels.map_points(airborne(spark, sf))


def q_altitude_bands(spark, sf):
    return panels.altitude_bands(airborne(spark, sf))


def q_velocity_histogram(spark, sf):
    return panels.velocity_histogram(airborne(spark, sf))


def q_latest_country_window(spark, sf):
    return panels.latest_country_window(agg(spark, sf))


def q_top_countries(spark, sf):
    return panels.top_countries(agg(spark, sf))


def q_heatmap_countries(spark, sf):
    return panels.heatmap_countries(agg(spark, sf))


def q_trend_top_countries(spark, sf):
    return panels.trend_top_countries(stored(spark, agg(spark, sf), "flights_agg"))


def q_scan_agg_limit(spark, sf):
    return panels.scan_agg_limit(agg(spark, sf))


def q_enriched_flights(spark, sf):
    return fleet(spark, sf)


def q_top_operators(spark, sf):
    return panels.top_operators(fleet(spark, sf))


def q_top_models(spark, sf):
    return panels.top_models(fleet(spark, sf))


def q_top_manufacturers(spark, sf):
    return panels.top_manufacturers(fleet(spark, sf))


def q_top_typecodes(spark, sf):
    return panels.top_typecodes(fleet(spark, sf))


def q_manufacturer_share(spark, sf):
    return panels.manufacturer_share(fleet(spark, sf))


def q_scatter_top_operators(spark, sf):
    return panels.scatter_top_operators(fleet(spark, sf))


def q_alert_log(spark, sf):
    return panels.alert_log(alerts(spark, sf))


def q_worst_descent(spark, sf):
    return panels.worst_descent(alerts(spark, sf))


def q_descent_histogram(spark, sf):
    return panels.descent_histogram(alerts(spark, sf))


def q_alerts_by_country(spark, sf):
    return panels.alerts_by_country(alerts(spark, sf))


def q_scan_alerts_limit(spark, sf):
    return panels.scan_alerts_limit(alerts(spark, sf))


def q_clustered_first_alerts(spark, sf):
    """The first 200 alerts in key order, read from a clustered table by a bounded scan."""
    table = ClusteredTable(scratch_dir(spark, "alerts-by-key"), "row_key").write(alerts(spark, sf))
    return panels.alert_frame(table.first(spark, panels.MAX_ALERTS))


def q_clustered_country_windows(spark, sf):
    """The newest 100 windows of one country: a prefix of the key, newest first by its construction."""
    table = ClusteredTable(scratch_dir(spark, "windows-by-key"), "row_key").write(agg(spark, sf))
    return table.prefix(spark, "NATION_3|", 100)


def q_colocated_enrich(spark, sf):
    """Every report with its metadata by a join of two tables that are bucketed alike."""
    tables = ColocatedTables(scratch_dir(spark, "colocated"), buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return tables.write(flights(spark, sf), aircraft(spark, sf)).joined(spark).select(*ENRICHED_FIELDS)


def rolled_up(spark, sf) -> RollupTable:
    """Roll-ups by hour, added in two batches that share their hours."""
    table, reports = RollupTable(scratch_dir(spark, "rollup"), "hour"), enriched(spark, sf)
    late = F.col("ingestion_ts") / fixtures.POLL_SECONDS % 2 == 1
    return table.add(reports.where(~late), 0).add(reports.where(late), 1)


def q_rollup_summary(spark, sf):
    """Countries over all hours, put together from the roll-ups of each."""
    return rolled_up(spark, sf).summary(spark)


def q_rollup_quantiles(spark, sf):
    """Median and upper tail of altitude and velocity by country, from bucket counts."""
    return rolled_up(spark, sf).quantiles(spark, (0.5, 0.9, 0.99))


# --- streaming ---------------------------------------------------------------------

def _stream_run(spark, sf, name, build_and_start):
    """Land the flights as ordered JSON files and run a stream once per chunk."""
    root = scratch_dir(spark, f"stream_{name}")
    landing, out, ck = f"{root}/landing", f"{root}/out", f"{root}/checkpoints"
    dim = aircraft(spark, sf)
    # the dimension is static: check its size once, not at every restart
    strategy = join_strategy(dim)

    def run_once():
        source = read_message_files(spark, landing, recursive=True)
        q = build_and_start(source, dim, out, ck, strategy)
        for query in (q.values() if isinstance(q, dict) else [q]):
            query.awaitTermination()
            if query.exception() is not None:
                raise query.exception()

    # the bounds are a short pass over the scan; writing the messages is not, and a scan may have few tasks
    replay_in_batches(spark, fixtures.spread_flights(spark, sf), landing, STREAM_BATCHES, run_once,
                      bounds=time_chunks(flights(spark, sf), STREAM_BATCHES))
    return out


AVAILABLE_NOW = {"availableNow": True}


def q_src_stream_files(spark, sf):
    def start(source, dim, out, ck, strategy):
        return start_archive(decode_messages(source), out, f"{ck}/files", AVAILABLE_NOW)
    out = _stream_run(spark, sf, "files", start)
    return read_archive(spark, out).select(*FLIGHT_FIELDS)


def q_stream_enrich(spark, sf):
    def start(source, dim, out, ck, strategy):
        enriched_df = enriched_stream(source, dim, strategy=strategy).select(*ENRICHED_FIELDS)
        return start_archive(enriched_df, out, f"{ck}/enrich", AVAILABLE_NOW, date_from="last_contact")
    out = _stream_run(spark, sf, "enrich", start)
    return read_archive(spark, out).select(*ENRICHED_FIELDS)


def _pipeline_query(spark, sf, name):
    def start(source, dim, out, ck, strategy):
        return start_pipeline(report_stream(source), out, ck, aircraft=dim, strategy=strategy, queries=(name,),
                              trigger=AVAILABLE_NOW)
    out = _stream_run(spark, sf, name, start)
    return getattr(ResultTables.at(out), name).current(spark)


def q_stream_country_window_agg(spark, sf):
    cur = _pipeline_query(spark, sf, "agg")
    return cur.select("country", "window_start", "window_end", "flight_count", "avg_alt", "max_alt", "avg_velocity")


def q_stream_live_snapshot(spark, sf):
    return _pipeline_query(spark, sf, "live")


def q_stream_pipeline_alerts(spark, sf):
    """All four queries at once (stateless three fanned out of one persisted batch); the alerts table."""
    def start(source, dim, out, ck, strategy):
        return start_pipeline(report_stream(source), out, ck, aircraft=dim, strategy=strategy, trigger=AVAILABLE_NOW)
    out = _stream_run(spark, sf, "pipeline", start)
    cur = ResultTables.at(out).alerts.current(spark)
    return cur.select("icao24", "ingestion_ts", "vrate", "alt", "callsign", "operator", "country", "ts", "row_key")


def q_stream_pane_windows(spark, sf):
    """All four queries from one reading of the source, the window aggregate kept as panes; its windows."""
    def start(source, dim, out, ck, strategy):
        return start_pipeline(report_stream(source), out, ck, aircraft=dim, strategy=strategy, trigger=AVAILABLE_NOW, panes=True)
    out = _stream_run(spark, sf, "panes", start)
    return ResultTables.at(out).windows(spark).drop("country_key", "row_key")


def q_incremental_kpis(spark, sf):
    """The KPIs of a dashboard that was refreshed after each of the stream's batches, reading what each one added."""
    board = []

    def start(source, dim, out, ck, strategy):
        for q in start_pipeline(report_stream(source), out, ck, aircraft=dim, strategy=strategy, trigger=AVAILABLE_NOW, panes=True).values():
            q.awaitTermination()
            if q.exception() is not None:
                raise q.exception()
        if not board:
            board.append(LiveDashboard(spark, ResultTables.at(out)))
        board[0].refresh()
        return {}
    out = _stream_run(spark, sf, "refreshes", start)
    return (board[0] if board else LiveDashboard(spark, ResultTables.at(out))).refresh()["kpi_summary"]


def q_src_poll_feed(spark, sf):
    """A recorded feed of which polls are broken or absent, read poll by poll with the replay in their place."""
    root = scratch_dir(spark, "polls")
    f = fixtures.reports(spark, sf)
    number = F.expr(f"(ingestion_ts - {fixtures.EPOCH0}) div {fixtures.POLL_SECONDS}")
    first, last = f.agg(F.min(number), F.max(number)).first()
    if first is None:
        return flights(spark, sf)
    record_polls(f.where(number % 9 != 6), f"{root}/feed", damaged=number % 9 == 3)
    record_polls(f.where(number == first), f"{root}/replay", bare=True)
    polls = poll_stream(spark, f"{root}/feed", replay=f"{root}/replay/{first:012d}.json", first=first, until=last + 1)
    start_archive(decode_polls(polls), f"{root}/out", f"{root}/ck", AVAILABLE_NOW).awaitTermination()
    return read_archive(spark, f"{root}/out").select(*FLIGHT_FIELDS)


STATE_COLUMNS = [c for c in LIVE_COLUMNS if c not in DIMENSION_COLUMNS]


def q_stream_state_latest(spark, sf):
    """The latest report of each aircraft, read from the state store of a query that was restarted for every batch."""
    checkpoints = []

    def start(source, dim, out, ck, strategy):
        checkpoints[:] = [f"{ck}/state"]
        table = KeyedTable(f"{out}/latest", ["icao24"], ("ingestion_ts", "last_contact"))
        return start_latest(report_stream(source), table, checkpoints[0], STATE_COLUMNS, trigger=AVAILABLE_NOW)
    _stream_run(spark, sf, "state", start)
    if not checkpoints:
        return flights(spark, sf).select(*STATE_COLUMNS)
    return read_latest_state(spark, checkpoints[0], STATE_COLUMNS)


def damaged(messages: DataFrame) -> DataFrame:
    """Messages (``value``) of which six in ten are spoilt, each in its own way, by their time."""
    value = F.col("value")
    way = F.col("__way")  # a column of its own: read from the message once, not at every branch
    timed = messages.withColumn("__way", F.get_json_object(value, "$.time_position").cast("bigint") % 10)
    return timed.withColumn("value", (
        F.when(way == 0, F.regexp_replace(value, '"velocity":[^,}]+', '"velocity":"fast"'))
        .when(way == 1, F.regexp_replace(value, '"last_contact":[^,}]+', '"last_contact":12.5'))
        .when(way == 2, F.substring(value, 1, 40))
        .when(way == 3, F.concat(F.lit("["), value, F.lit("]")))
        .when(way == 4, F.regexp_replace(value, '"baro_altitude":([0-9.E+-]+)', '"baro_altitude":"$1"'))
        .when(way == 5, F.lit(None)).otherwise(value))).drop("__way")


def q_src_tolerant_decode(spark, sf):
    """Spoilt messages field by field: what can be read, and what could not with its reason."""
    told = F.array_join(F.transform("faults", lambda f: F.concat_ws(":", f["reason"], f["field"])), ",")
    return decode_tolerant(damaged(to_messages(fixtures.spread_flights(spark, sf)))).select(*FLIGHT_FIELDS, told.alias("faults"))


def q_src_tolerant_states(spark, sf):
    """Snapshots of which some have longer vectors, vectors that are none, or stop midway; the rows that can be read."""
    poll = F.expr(f"ingestion_ts div {fixtures.POLL_SECONDS}") % 7
    doc = (F.when(poll == 0, F.regexp_replace("doc", r"\](?=,\[|\]\})", ",3]"))
           .when(poll == 1, F.regexp_replace("doc", r'"states":\[', '"states":[{"x":1},["",1],'))
           .when(poll == 2, F.substring("doc", 1, 30)).otherwise(F.col("doc")))
    docs = snapshot_documents(fixtures.reports(spark, sf)).withColumn("doc", doc)
    rows = readable(decode_states(docs, ingestion_ts=F.col("ingestion_ts")))
    return rows.withColumn("sensors", F.to_json("sensors"))


def q_stream_quarantine(spark, sf):
    """Faults by reason and field in the table that a tolerant archive sets aside while it runs."""
    def start(source, dim, out, ck, strategy):
        return start_tolerant_archive(decode_tolerant(damaged(source)), f"{out}/reports", f"{out}/faults", f"{ck}/tolerant", AVAILABLE_NOW)
    out = _stream_run(spark, sf, "tolerant", start)
    return read_archive(spark, f"{out}/faults").groupBy("reason", "field").agg(F.count(F.lit(1)).alias("faults"))


def q_stream_batch_metrics(spark, sf):
    """Rows, rejects and late reports of every micro-batch, counted while the stream runs over damaged messages."""
    root = scratch_dir(spark, "metered")
    f = flights(spark, sf).withColumn("last_contact", F.when(F.col("last_contact") % 10 == 3, F.col("last_contact") - 1200)
                                      .when(F.col("last_contact") % 10 == 4, F.lit(None)).otherwise(F.col("last_contact")))
    metrics = BatchMetrics(spark, f"{root}/metrics")

    def run_once():
        source = read_message_files(spark, f"{root}/landing", recursive=True)
        # one message in ten is cut short
        broken = F.when(F.get_json_object("value", "$.time_position") % 10 == 7, F.substring("value", 1, 40)).otherwise(F.col("value"))
        reports = report_stream(source.withColumn("value", broken))
        await_all(start_pipeline(reports, f"{root}/out", f"{root}/ck", queries=("agg",), panes=True, trigger=AVAILABLE_NOW, metrics=metrics))
    try:
        replay_in_batches(spark, f, f"{root}/landing", STREAM_BATCHES, run_once, by="time_position")
        # the listener is told of a batch after the query has ended
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        metrics.stop()
    return read_metrics(spark, f"{root}/metrics").select("batch_id", "rows", "rejected", "untimed", "late", "partly_late")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "json_decode": q_json_decode,
    "src_snapshot_decode": q_src_snapshot_decode,
    "src_replay": q_src_replay,
    "src_csv_dimension": q_src_csv_dimension,
    "dim_row_count": q_dim_row_count,
    "event_time": q_event_time,
    "messages_per_poll": q_messages_per_poll,
    "sink_keyed_json": q_sink_keyed_json,
    "scalar_clean": q_scalar_clean,
    "reverse_epoch_key": q_reverse_epoch_key,
    "cell_codec": q_cell_codec,
    "enrich_left_join": q_enrich_left_join,
    "country_window_agg": q_country_window_agg,
    "rapid_descent_alerts": q_rapid_descent_alerts,
    "live_snapshot": q_live_snapshot,
    "enriched_latest": q_enriched_latest,
    "alerts_table": q_alerts_table,
    "scan_live": q_scan_live,
    "live_airborne": q_live_airborne,
    "kpi_summary": q_kpi_summary,
    "map_points": q_map_points,
    "altitude_bands": q_altitude_bands,
    "velocity_histogram": q_velocity_histogram,
    "latest_country_window": q_latest_country_window,
    "top_countries": q_top_countries,
    "heatmap_countries": q_heatmap_countries,
    "trend_top_countries": q_trend_top_countries,
    "scan_agg_limit": q_scan_agg_limit,
    "enriched_flights": q_enriched_flights,
    "top_operators": q_top_operators,
    "top_models": q_top_models,
    "top_manufacturers": q_top_manufacturers,
    "top_typecodes": q_top_typecodes,
    "manufacturer_share": q_manufacturer_share,
    "scatter_top_operators": q_scatter_top_operators,
    "alert_log": q_alert_log,
    "worst_descent": q_worst_descent,
    "descent_histogram": q_descent_histogram,
    "alerts_by_country": q_alerts_by_country,
    "scan_alerts_limit": q_scan_alerts_limit,
    "clustered_first_alerts": q_clustered_first_alerts,
    "clustered_country_windows": q_clustered_country_windows,
    "rollup_summary": q_rollup_summary,
    "rollup_quantiles": q_rollup_quantiles,
    "colocated_enrich": q_colocated_enrich,
    "src_poll_feed": q_src_poll_feed,
    "src_tolerant_decode": q_src_tolerant_decode,
    "src_tolerant_states": q_src_tolerant_states,
    "stream_quarantine": q_stream_quarantine,
    "stream_state_latest": q_stream_state_latest,
    "src_stream_files": q_src_stream_files,
    "stream_enrich": q_stream_enrich,
    "stream_country_window_agg": q_stream_country_window_agg,
    "stream_pane_windows": q_stream_pane_windows,
    "stream_batch_metrics": q_stream_batch_metrics,
    "incremental_kpis": q_incremental_kpis,
    "stream_live_snapshot": q_stream_live_snapshot,
    "stream_pipeline_alerts": q_stream_pipeline_alerts,
}


def utc(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: utc(v) for k, v in QUERIES.items()}


