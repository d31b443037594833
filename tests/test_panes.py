"""The window aggregate kept as panes: equal to the stateful one, late reports included."""

import random

import pytest
from pyspark.sql import functions as F

from contrail.operators.aggregate import country_window_agg, seconds_of
from contrail.operators.enrich import enrich, with_event_time
from contrail.session import session_conf
from contrail.sources.messages import read_message_files, to_messages
from contrail.streaming.panes import pane_table, windows, write_panes
from contrail.streaming.pipeline import ResultTables, await_all, report_stream, start_pipeline
from tests.helpers import aircraft_df, flights_df

DAY = 86400


def reports(r, n, centre, spread):
    return [dict(icao24=f"a{r.randrange(6)}", origin_country=r.choice(["X", "Y", None, ""]), last_contact=r.choice([None] + [centre + r.randrange(-spread, 30)] * 20),
                 baro_altitude=r.choice([None, r.uniform(0, 9e3), float("nan")]), velocity=r.choice([None, r.uniform(0, 300)])) for _ in range(n)]


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_the_stateful_stream_with_late_reports(spark, scratch, seed):
    """Batches reach back further than the watermark, so some windows of a pane are closed and some are not."""
    r = random.Random(seed)
    dim = aircraft_df(spark, [("a0", "R", "m", "M", "T", "O"), ("a0", "R2", "m", "M", "T", "O"), ("a1", "R", "", "", "", None)])
    for i, centre in enumerate((3000, 3100, 3400, 3350, 3900)):
        to_messages(flights_df(spark, reports(r, 120, centre, 900))).select("value").coalesce(1).write.text(f"{scratch}/landing/b{i}")
        for kind in ("state", "panes"):
            source = report_stream(read_message_files(spark, f"{scratch}/landing", recursive=True))
            await_all(start_pipeline(source, f"{scratch}/{kind}", f"{scratch}/{kind}-ck", aircraft=dim, queries=("agg",), trigger={"availableNow": True},
                                     panes=kind == "panes"))
    state, panes = (ResultTables.at(f"{scratch}/{kind}") for kind in ("state", "panes"))
    got = panes.windows(spark)
    assert got.columns == state.windows(spark).columns
    assert rows_of(got) == rows_of(state.windows(spark)) and got.count() > 20
    everything = spark.read.text(f"{scratch}/landing/*")
    from contrail.sources.messages import decode_messages
    whole = country_window_agg(enrich(with_event_time(decode_messages(everything)), dim))
    assert whole.agg(F.sum("flight_count")).first()[0] > got.agg(F.sum("flight_count")).first()[0]  # some reports were late
    held = panes.panes.current(spark)
    assert held.where("closed is not null").count() > 0  # and some late for a part of their windows only


def test_replays_and_folds_neither_lose_nor_add(spark, scratch):
    r = random.Random(4)
    table = pane_table(f"{scratch}/t")
    batches = [with_event_time(flights_df(spark, [x for x in reports(r, 60, 1000 + DAY * (i // 2) + 400 * i, 300) if x["last_contact"]])) for i in range(5)]
    for i, b in enumerate(batches):
        write_panes(table, b, i)
    want = rows_of(windows(spark, table))
    write_panes(table, batches[4], 4)  # the newest batch once more
    assert rows_of(windows(spark, table)) == want
    table.compact_in_place(spark)
    assert any(e[0] == "fold" for e in table.entries(spark)) and rows_of(windows(spark, table)) == want
    for i in (4, 0, 1):  # a batch whose rows a fold holds is not added to it again
        write_panes(table, batches[i], i)
        assert rows_of(windows(spark, table)) == want


def test_windows_of_some_dates(spark, scratch):
    import datetime as dt
    table = pane_table(f"{scratch}/t")
    rows = [dict(icao24="a", origin_country="X", last_contact=t) for t in (DAY - 30, DAY + 30, 2 * DAY + 5)]
    write_panes(table, with_event_time(flights_df(spark, rows)), 0)
    whole = windows(spark, table)
    day = dt.date(1970, 1, 1)
    assert rows_of(windows(spark, table, day, day)) == rows_of(whole.where(F.col("window_start") < DAY))
    assert rows_of(windows(spark, table, since=dt.date(1970, 1, 3))) == rows_of(whole.where(F.col("window_start") >= 2 * DAY))
    assert windows(spark, pane_table(f"{scratch}/none")).count() == 0


def test_windows_of_other_lengths(spark):
    rows = with_event_time(flights_df(spark, [x for x in reports(random.Random(8), 200, 5000, 2000)]))
    for length, slide in (("5 minutes", "1 minute"), ("10 minutes", "5 minutes"), ("90 seconds", "30 seconds"), ("1 minute", "1 minute"), ("5 minutes", "2 minutes")):
        got = {(r.country, r.window_start): r.flight_count for r in country_window_agg(rows, length, slide).collect()}
        plain = rows.where("origin_country is not null").groupBy(F.window("event_time", length, slide).alias("w"), "origin_country").count()
        assert got == {(r.origin_country, r.s): r["count"] for r in plain.withColumn("s", F.unix_timestamp("w.start")).collect()}
    assert seconds_of("5 minutes") == 300
