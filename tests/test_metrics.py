"""Counts of each batch against planted bad, untimed, extreme and late messages."""

import json

from contrail.sources.messages import read_message_files
from contrail.streaming.metrics import BatchMetrics, query_name, read_metrics
from contrail.streaming.pipeline import await_all, report_stream, start_pipeline
from tests.helpers import aircraft_df


def land(scratch, n, rows):
    import os
    os.makedirs(f"{scratch}/landing", exist_ok=True)
    with open(f"{scratch}/landing/{n}.json", "w") as out:
        out.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


def report(t, **more):
    return {"icao24": "a", "origin_country": "X", "last_contact": t, "ingestion_ts": t, "on_ground": False, **more}


def test_counts_of_planted_rows_over_restarts(spark, scratch):
    batches = [[report(3000), report(3010), "{", "not json", "{}"],
               [report(3600, baro_altitude=1e12), report(None), report(2000), report(2600), report(2860), "[]"],
               [report(3500), report(3600, velocity=1e300), report(3100)]]
    dim = aircraft_df(spark, [("zz", "R", "", "", "", None)])
    for panes in (True, False):
        metrics = BatchMetrics(spark, f"{scratch}/m{panes}")
        for i, rows in enumerate(batches):
            land(f"{scratch}/{panes}", i, rows)
            source = report_stream(read_message_files(spark, f"{scratch}/{panes}/landing"))
            await_all(start_pipeline(source, f"{scratch}/{panes}/out", f"{scratch}/{panes}/ck", aircraft=dim, trigger={"availableNow": True}, panes=panes, metrics=metrics))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        metrics.stop()
        got = read_metrics(spark, f"{scratch}/m{panes}").where("query = 'fanout'").orderBy("batch_id").collect()
        assert [(r.batch_id, r.input_rows, r.rows, r.rejected, r.untimed, r.out_of_range) for r in got] == \
            [(0, 5, 5, 3, 0, 0), (1, 6, 6, 1, 1, 1), (2, 3, 3, 0, 0, 1)]
        if panes:  # watermark 2890 for the second batch, 3480 for the third
            assert [(r.late, r.partly_late) for r in got] == [(0, 0), (2, 1), (1, 0)]
        else:
            agg = read_metrics(spark, f"{scratch}/m{panes}").where("query = 'agg'").collect()
            assert sum(r.rows for r in agg) == 14 and sum(r.state_dropped for r in agg) > 0 and {r.late for r in agg} == {None}


def test_nothing_yet_and_names(spark, scratch):
    assert read_metrics(spark, f"{scratch}/none").count() == 0
    assert [query_name(n) for n in ("contrail_live_123", "other", "contrail_x")] == ["live", "other", "contrail_x"]
