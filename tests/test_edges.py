"""Layer 4: row edge cases (FIXTURES.md §5, §6), one assertion each."""

import json
import random

import pytest

from pyspark.sql import functions as F

from contrail.functions.scalars import (
    aircraft_key, clean_callsign, country_key, decode_bool, decode_number, encode_bool, encode_number,
)
from contrail.operators.aggregate import country_window_agg
from contrail.operators.enrich import enrich, rapid_descent, with_event_time
from contrail.plans import panels
from contrail.plans.tables import agg_table, alerts_table, live_table
from contrail.sources.dimension import read_aircraft_csv
from contrail.sources.messages import decode_messages
from contrail.sources.snapshot import decode_replay, decode_snapshot, read_replay
from tests.helpers import aircraft_df, flights_df

NO_DIM = [("zzzzzz", "R", "MFR", "M", "T", "OP")]


def _enriched(spark, rows, dim=NO_DIM):
    return enrich(with_event_time(flights_df(spark, rows)), aircraft_df(spark, dim))


def test_bad_json_gives_all_null_row(spark):
    df = spark.createDataFrame([("garbage",), (None,)], "value string")
    rows = decode_messages(df).collect()
    assert len(rows) == 2
    assert all(all(v is None for v in r) for r in rows)


def test_bad_field_nulls_only_that_field(spark):
    df = spark.createDataFrame([('{"icao24":"b","baro_altitude":"x"}',)], "value string")
    r = decode_messages(df).first()
    assert r.icao24 == "b" and r.baro_altitude is None


def test_fractional_integer_is_null(spark):
    df = spark.createDataFrame([('{"icao24":"c","last_contact":1.5}',)], "value string")
    r = decode_messages(df).first()
    assert r.icao24 == "c" and r.last_contact is None


def test_corrupt_record_kept_on_request(spark):
    df = spark.createDataFrame([("garbage",), ('{"icao24":"a"}',)], "value string")
    rows = {r.icao24: r._corrupt_record for r in decode_messages(df, keep_corrupt=True).collect()}
    assert rows == {None: "garbage", "a": None}


def test_null_time_absent_from_windows_present_in_latest_and_alerts(spark):
    rows = [dict(icao24="a", origin_country="US", last_contact=None, on_ground=False, vertical_rate=-20.0,
                 ingestion_ts=10, latitude=1.0, longitude=1.0, baro_altitude=100.0)]
    e = _enriched(spark, rows)
    assert country_window_agg(e).count() == 0
    assert live_table(e).count() == 1
    assert alerts_table(e).count() == 1


def test_null_or_empty_address_keyed_unknown(spark):
    df = spark.createDataFrame([(None,), ("",), ("abc",)], "icao24 string")
    got = sorted(r[0] for r in df.select(aircraft_key("icao24")).collect())
    assert got == ["abc", "unknown", "unknown"]


def test_country_rules(spark):
    rows = [dict(icao24="a", origin_country=c, last_contact=1000, ingestion_ts=1010) for c in (None, "", "a|b")]
    agg = agg_table(_enriched(spark, rows))
    keys = {r.country_key for r in agg.select("country_key").distinct().collect()}
    assert keys == {"UNKNOWN", "a_b"}
    df = spark.createDataFrame([(None,), ("",), ("a|b",)], "c string")
    assert [r[0] for r in df.select(country_key("c")).collect()] == ["UNKNOWN", "UNKNOWN", "a_b"]


def test_descent_thresholds_and_severity(spark):
    rates = [-15.0, -15.01, -30.0, -30.01]
    rows = [dict(icao24=f"a{i}", on_ground=False, vertical_rate=v, ingestion_ts=100 + i, last_contact=100 + i)
            for i, v in enumerate(rates)]
    alerts = alerts_table(_enriched(spark, rows))
    log = {r.vrate_ms: r.severity for r in panels.alert_log(alerts).collect()}
    assert log == {-15.01: "WARNING", -30.0: "WARNING", -30.01: "CRITICAL"}


def test_null_on_ground_not_alert_but_airborne(spark):
    rows = [dict(icao24="a", on_ground=None, vertical_rate=-40.0, latitude=1.0, longitude=1.0,
                 baro_altitude=1000.0, last_contact=5, ingestion_ts=10)]
    e = _enriched(spark, rows)
    assert rapid_descent(e).count() == 0
    assert panels.live_airborne(live_table(e)).count() == 1


def test_position_filter(spark):
    pos = [(0.0, 0.0), (0.0, 5.0), (None, None)]
    rows = [dict(icao24=f"p{i}", latitude=la, longitude=lo, on_ground=False, baro_altitude=100.0,
                 last_contact=1, ingestion_ts=10) for i, (la, lo) in enumerate(pos)]
    got = [r.icao24 for r in panels.live_airborne(live_table(_enriched(spark, rows))).collect()]
    assert got == ["p1"]


def test_altitude_bands(spark):
    alts = [0.0, 3000.0, 3000.01, 12000.0, 14000.0, 14000.01]
    rows = [dict(icao24=f"h{i}", latitude=1.0, longitude=1.0, on_ground=False, baro_altitude=a,
                 last_contact=1, ingestion_ts=10) for i, a in enumerate(alts)]
    out = panels.altitude_bands(panels.live_airborne(live_table(_enriched(spark, rows)))).orderBy("band_order").collect()
    assert [r.label for r in out] == ["<3k", "3-6k", "6-9k", "9-10k", "10-11k", "11-12k", ">12k"]
    assert {r.label: r.flights for r in out} == {"<3k": 1, "3-6k": 1, "6-9k": 0, "9-10k": 0, "10-11k": 0,
                                                 "11-12k": 1, ">12k": 1}
    bands = {r.band: r.flights for r in out}
    assert len(bands) == 7
    assert bands["(0, 3000]"] == 1 and bands["(3000, 6000]"] == 1
    assert bands["(11000, 12000]"] == 1 and bands["(12000, 14000]"] == 1
    assert sum(bands.values()) == 4


def test_duplicate_dimension_key_counts_twice(spark):
    dim = [("a", "R1", "M", "M1", "T", "OpA"), ("a", "R2", "M", "M1", "T", "OpB")]
    rows = [dict(icao24="a", origin_country="US", last_contact=1000, ingestion_ts=1010)]
    agg = country_window_agg(_enriched(spark, rows, dim))
    assert {r.flight_count for r in agg.collect()} == {2}
    uniq = country_window_agg(enrich(with_event_time(flights_df(spark, rows)), aircraft_df(spark, dim),
                                     unique_dimension=True))
    assert {r.flight_count for r in uniq.collect()} == {1}


def test_csv_blanks_read_as_null(spark, scratch):
    path = f"{scratch}/aircraft.csv"
    with open(path, "w") as fh:
        fh.write("icao24,registration,manufacturername,model,typecode,operator,extra\n")
        fh.write('abc,,M,X,T,"",1\n')
    r = read_aircraft_csv(spark, path).first()
    assert r.icao24 == "abc" and r.registration is None and r.operator is None and r.model == "X"


def test_alert_without_time(spark):
    rows = [dict(icao24="a", on_ground=False, vertical_rate=-20.0, last_contact=5, ingestion_ts=None),
            dict(icao24="b", on_ground=False, vertical_rate=-20.0, last_contact=5, ingestion_ts=100)]
    alerts = alerts_table(_enriched(spark, rows))
    keys = {r.icao24: r.row_key for r in alerts.collect()}
    assert keys["a"] == "a|9999999999"
    log = panels.alert_log(alerts).collect()
    assert [r.icao24 for r in log] == ["b", "a"] and log[1].timestamp is None


def test_snapshot_sample(spark):
    doc = ('{"time":1,"states":[["abc123","AAL1 ","United States",100,101,-1.5,2.25,null,false,0.0,0,-16.1,'
           '[1,2],3.0,null,false,0],null]}')
    rows = decode_snapshot(spark.createDataFrame([(doc,)], "doc string"), ingestion_ts=F.lit(1)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.callsign, r.longitude, r.latitude, r.baro_altitude, r.on_ground, r.velocity) == \
        ("AAL1", -1.5, 2.25, None, False, 0.0)
    assert (r.vertical_rate, r.geo_altitude, r.squawk, r.time_position, r.last_contact, r.ingestion_ts) == \
        (-16.1, 3.0, None, 100, 101, 1)


def test_snapshot_null_states_and_missing_address(spark):
    docs = ['{"time":1,"states":null}', '{"time":2,"states":[[null,"x"],[]]}', "not json"]
    assert decode_snapshot(spark.createDataFrame([(d,) for d in docs], "doc string")).count() == 0


def test_replay_files(spark, scratch):
    with open(f"{scratch}/r1.json", "w") as fh:
        json.dump([["a1", "X ", "US", 1, 2, 3.0, 4.0, 5.0, False, 6.0, 7.0, -8.0, None, 9.0, "7700", False, 0]], fh)
    rows = read_replay(spark, scratch, ingestion_ts=F.lit(42)).collect()
    assert [(r.icao24, r.callsign, r.squawk, r.ingestion_ts) for r in rows] == [("a1", "X", "7700", 42)]
    assert read_replay(spark, f"{scratch}/missing").count() == 0
    bad = spark.createDataFrame([("[[",)], "doc string")
    assert decode_replay(bad, ingestion_ts=F.lit(1)).count() == 0


def test_callsign_strip(spark):
    df = spark.createDataFrame([(" \tAB1 \n",), (None,)], "c string")
    assert [r[0] for r in df.select(clean_callsign("c")).collect()] == ["AB1", ""]


def test_cell_codec_round_trip(spark):
    rnd = random.Random(7)
    vals = [None, 0.0] + [rnd.uniform(-1e6, 1e6) for _ in range(50)] + [1e-05, 1e22, -3.5]
    df = spark.createDataFrame([(v, b) for v in vals for b in (None, True, False)][:len(vals)],
                               "x double, b boolean")
    out = df.select("x", "b", encode_number("x").alias("cx"), encode_bool("b").alias("cb")) \
        .select("x", "b", "cb", decode_number("cx").alias("dx"), decode_bool("cb").alias("db")).collect()
    for r in out:
        assert r.dx == (r.x or 0.0)
        assert r.db == bool(r.b)  # a null flag is stored as None and reads as not True
        assert r.cb == {None: "None", True: "True", False: "False"}[r.b]
    bad = spark.createDataFrame([("x1",), ("",), (None,)], "c string").select(decode_number("c")).collect()
    assert [r[0] for r in bad] == [0.0, 0.0, 0.0]


def test_kpi_empty_defaults(spark):
    e = _enriched(spark, [dict(icao24="a", on_ground=True, last_contact=1, ingestion_ts=10)])
    k = panels.kpi_summary(panels.live_airborne(live_table(e)), alerts_table(e)).first()
    assert (k.airborne, k.countries, k.avg_altitude, k.avg_velocity, k.enriched, k.alerts) == (0, 0, 0.0, 0.0, 0, 0)
    assert k.alert_status == "all clear"


def test_alert_cap_in_kpi(spark):
    rows = [dict(icao24=f"{i:06x}", on_ground=False, vertical_rate=-20.0, last_contact=i, ingestion_ts=10 + i)
            for i in range(250)]
    e = _enriched(spark, rows)
    k = panels.kpi_summary(panels.live_airborne(live_table(e)), alerts_table(e)).first()
    assert (k.alerts, k.alerts_total) == (250, 250)
    capped = panels.kpi_summary(panels.live_airborne(live_table(e)), alerts_table(e), alert_cap=200).first()
    assert (capped.alerts, capped.alerts_total) == (200, 250)
    assert panels.scan_alerts_limit(alerts_table(e)).count() == 200


def test_alerts_reduced_before_the_join_equal_those_after(spark):
    from contrail.plans.tables import alert_pairs, alerts_then_enrich
    dim = [("a", "R1", "M", "M1", "T", "OpA"), ("a", "R2", "M", "M1", "T", "OpB"), ("b", "R3", "", "M2", "T", None)]
    rnd = random.Random(5)
    rows = [dict(icao24=rnd.choice(["a", "b", "c", "", None]), on_ground=rnd.choice([False, False, True, None]),
                 vertical_rate=rnd.choice([-20.0, -40.0, -10.0, None]), last_contact=rnd.choice([None, 1, 2]), callsign=rnd.choice(["x", "y"]),
                 ingestion_ts=rnd.choice([None, 10, 20]), origin_country=rnd.choice(["US", None])) for _ in range(200)]
    f, d = flights_df(spark, rows), aircraft_df(spark, dim)
    want = alerts_table(enrich(f, d))
    got = alerts_then_enrich(f, d)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert alert_pairs(f).count() == want.count()


def test_latest_is_last_arrival_not_largest_time(spark):
    rows = [dict(icao24="a", last_contact=500, ingestion_ts=10, callsign="old"),
            dict(icao24="a", last_contact=400, ingestion_ts=20, callsign="new")]
    assert live_table(_enriched(spark, rows)).first().callsign == "new"


def test_latest_then_enrich_equals_join_then_latest(spark):
    from contrail.plans.tables import latest_then_enrich
    from contrail.schemas import ENRICHED_COLUMNS, LIVE_COLUMNS
    dim = [("a", "R1", "M", "M1", "T", "OpA"), ("a", "R2", "M", "M1", "T", "OpB"), ("b", "R3", "", "M2", "T", None)]
    rows = [dict(icao24="a", last_contact=5, ingestion_ts=10, callsign="x"),
            dict(icao24="a", last_contact=5, ingestion_ts=10, callsign="y"),
            dict(icao24="b", last_contact=3, ingestion_ts=10), dict(icao24="", last_contact=1, ingestion_ts=10),
            dict(icao24=None, last_contact=2, ingestion_ts=10), dict(icao24="c", last_contact=9, ingestion_ts=20)]
    f, d = flights_df(spark, rows), aircraft_df(spark, dim)
    for cols in (LIVE_COLUMNS, ENRICHED_COLUMNS):
        want = live_table(enrich(f, d)).select(*cols) if cols is LIVE_COLUMNS else \
            __import__("contrail.plans.tables", fromlist=["x"]).enriched_table(enrich(f, d))
        got = latest_then_enrich(f, d, cols)
        assert sorted(got.collect()) == sorted(want.select(*cols).collect())
        assert got.count() == 4


def test_fan_out_by_dimension_matches_join_on_both_paths(spark):
    from contrail.operators.enrich import fan_out_by_dimension
    dim = [("a", "R1", "M", "M1", "T", "OpA"), ("a", "R2", "M", "M1", "T", "OpB"), ("b", "R3", "", "M2", "T", None),
           ("c", "R4", "", "M2", "T", None), ("c", "R5", "", "M2", "T", None), ("c", "R6", "", "M2", "T", None)]
    rows = [dict(icao24=k, origin_country="US", last_contact=1000 + i, ingestion_ts=1010, velocity=float(i))
            for i, k in enumerate(["a", "a", "b", "c", "d", None, ""])]
    f, d = flights_df(spark, rows), aircraft_df(spark, dim)
    want = sorted(country_window_agg(with_event_time(enrich(f, d))).collect())
    for bound in (10, 0):  # broadcast path, then the repeated-keys path
        got = country_window_agg(with_event_time(fan_out_by_dimension(f, d, max_broadcast_rows=bound)))
        assert sorted(got.collect()) == want


def test_join_strategies_agree(spark):
    dim = [("a", "R1", "M", "M1", "T", "OpA"), ("a", "R2", "M", "M1", "T", "OpB"), ("b", "R3", "", "M2", "T", None)]
    rows = [dict(icao24=k, last_contact=i, ingestion_ts=10, velocity=float(i))
            for i, k in enumerate(["a"] * 40 + ["b", "c", None, ""])]
    f, d = flights_df(spark, rows), aircraft_df(spark, dim)

    def rows_of(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
    want = rows_of(enrich(f, d, strategy="broadcast"))
    assert len(want) == 40 * 2 + 4
    for kw in (dict(strategy="shuffle"), dict(strategy="salted"), dict(strategy="auto", max_broadcast_rows=1)):
        got = enrich(f, d, **kw).select(*f.columns, "registration", "manufacturername", "model", "typecode", "operator")
        assert rows_of(got) == want


def test_fan_out_salted_path(spark):
    from contrail.operators.enrich import fan_out_by_dimension
    dim = [("a", "R1", "M", "M1", "T", "OpA"), ("a", "R2", "M", "M1", "T", "OpB"), ("b", "R3", "", "M2", "T", None)]
    rows = [dict(icao24=k, origin_country="US", last_contact=1000 + i, ingestion_ts=1010)
            for i, k in enumerate(["a"] * 30 + ["b", "z", None])]
    f, d = flights_df(spark, rows), aircraft_df(spark, dim)
    assert fan_out_by_dimension(f, d, max_broadcast_rows=0).count() == 30 * 2 + 3


def test_alert_log_display_headers(spark):
    rows = [dict(icao24="a", on_ground=False, vertical_rate=-20.0, baro_altitude=1000.0, last_contact=5, ingestion_ts=9)]
    log = panels.alert_log(alerts_table(_enriched(spark, rows)), display_headers=True)
    assert {"V-rate (m/s)", "V-rate (fpm)", "Alt (m)", "Alt (ft)"} <= set(log.columns)
    r = log.first()
    assert r["V-rate (fpm)"] == -3937.0 and r["Alt (ft)"] == 3281.0


def test_broadcast_needs_both_row_and_byte_bound(spark):
    import contextlib
    import io

    from contrail.operators.enrich import broadcast_bound_ok, join_strategy, measured_size
    dim = aircraft_df(spark, [("a", "R" * 1000, "M", "M1", "T", "OpA"), ("b", None, "", "M2", "T", None)])
    rows, nbytes = measured_size(dim)
    # 8 + 8 per field for each row, plus the UTF-8 bytes of every string
    assert (rows, nbytes) == (2, 2 * (8 + 8 * 6) + (1 + 1000 + 1 + 2 + 1 + 3) + (1 + 2 + 1))
    assert broadcast_bound_ok(dim, 10, nbytes) and not broadcast_bound_ok(dim, 10, nbytes - 1)
    assert not broadcast_bound_ok(dim, 1, 10 ** 9)
    assert join_strategy(dim) == "broadcast" and join_strategy(dim, max_broadcast_bytes=100) == "salted"
    f = flights_df(spark, [dict(icao24="a", last_contact=1), dict(icao24="c", last_contact=2)])
    big = enrich(f, dim, max_broadcast_bytes=100)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        big.explain()
    # the dimension is shuffled; only the bounded table of hot keys is broadcast
    assert "SortMergeJoin [_key" in buf.getvalue() and "BroadcastHashJoin [_key" not in buf.getvalue()
    key = ["icao24", "last_contact", "registration", "operator"]
    assert sorted(big.select(*key).collect()) == sorted(enrich(f, dim).select(*key).collect())


def test_size_check_shuffles_one_row_a_task_and_skips_hopeless_tables(spark, scratch, monkeypatch):
    import importlib
    E = importlib.import_module("contrail.operators.enrich")
    path = f"{scratch}/dim"
    spark.range(200_000).selectExpr("hex(id) AS icao24", *[f"uuid() AS {c}" for c in
                                    ("registration", "manufacturername", "model", "typecode", "operator")]) \
        .repartition(16).write.parquet(path)
    dim = spark.read.parquet(path)
    assert E.measured_size(dim)[0] == 200_000
    plan = dim.agg(F.count(F.lit(1)), F.sum(E.row_bytes(dim)))._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and plan.count("HashAggregate") == 2  # the exchange is fed by partial aggregates only
    monkeypatch.setattr(E, "measured_size", lambda df: pytest.fail("a hopeless table was read"))
    assert not E.broadcast_bound_ok(dim, max_bytes=100_000)
    monkeypatch.undo()
    assert E.broadcast_bound_ok(dim) and not E.broadcast_bound_ok(dim, max_rows=199_999)


def test_salted_join_splits_measured_hot_keys_and_spreads_null_ones(spark):
    from contrail.operators.enrich import hot_keys, salted_left_join
    rows = [dict(icao24="hot", velocity=1.0)] * 3000 + [dict()] * 1000 + [dict(icao24=f"k{i}") for i in range(500)]
    left = flights_df(spark, rows)
    right = aircraft_df(spark, [("hot", "R", "M", "M1", "T", "OpA")] + [(f"k{i}", "R", "M", "M1", "T", f"Op{i}") for i in range(0, 500, 2)])
    assert [(r.icao24, r._salts) for r in hot_keys(left, "icao24", 32, min_rows=1).collect()] == [("hot", 22)]
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = salted_left_join(left, right, "icao24", min_rows=1).withColumn("p", F.spark_partition_id())
        per = {r["k"]: (r["n"], r["parts"], r["most"]) for r in out.groupBy("icao24", "p").count().groupBy("icao24")
               .agg(F.sum("count").alias("n"), F.count("*").alias("parts"), F.max("count").alias("most"))
               .select(F.coalesce("icao24", F.lit("null")).alias("k"), "n", "parts", "most").collect()}
        assert per["hot"][0] == 3000 and per["hot"][1] >= 10 and per["hot"][2] < 800
        assert per["null"][0] == 1000 and per["null"][1] >= 24  # identical malformed messages part as well
        assert out.count() == 4500 and out.where("operator = 'OpA'").count() == 3000
        assert out.where("icao24 like 'k%' and operator is not null").count() == 250
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_rounding_is_exact_and_has_no_nudge(spark):
    rows = [dict(icao24="a", origin_country=c, last_contact=1000, ingestion_ts=1, baro_altitude=v, velocity=w)
            for c, v, w in [("x", 0.00499995, None), ("y", 0.005, -0.005), ("y", 0.005, -0.015), ("z", -0.001, 1e9), ("z", None, 2e9)]]
    got = {r.country: (r.avg_alt, r.max_alt, r.avg_velocity) for r in agg_table(_enriched(spark, rows)).collect()}
    assert got == {"x": (0.0, 0.0, 0.0), "y": (0.01, 0.01, -0.01), "z": (0.0, 0.0, 1.5e9)}
    assert not any(str(v).startswith("-0.0") and v == 0 for t in got.values() for v in t)


def test_cells_that_do_not_decode(spark):
    from contrail.functions.scalars import decode_int, rejected
    cells = ["12", " -7 ", "12.5", "x", "", None, "99999999999999999999", "1e3"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = df.select(decode_int("c").alias("i"), rejected("c", "bigint").alias("ri"), decode_number("c").alias("d"), rejected("c").alias("rd")).collect()
    assert [r.i for r in got] == [12, -7, 0, 0, 0, 0, 0, 0]
    assert [r.ri for r in got] == [False, False, True, True, False, False, True, True]
    assert [r.rd for r in got] == [False, False, False, True, False, False, False, False]
    flags = spark.createDataFrame([(c,) for c in ("True", "False", "None", "", None, "true")], "c string")
    assert [r[0] for r in flags.select(decode_bool("c")).collect()] == [True, False, False, True, True, False]
    longs = spark.createDataFrame([(0,), (None,), (1704067200,)], "x bigint").select(encode_number("x")).collect()
    assert [r[0] for r in longs] == ["", "", "1704067200"]


def test_all_eighteen_fields_survive_a_snapshot_and_a_message(spark):
    from contrail.schemas import MESSAGE_FIELDS
    from contrail.sources.messages import decode_messages, to_messages
    from contrail.sources.snapshot import snapshot_documents
    f = (flights_df(spark, [dict(icao24="a", callsign="X", ingestion_ts=10), dict(icao24="b", callsign="", ingestion_ts=10)])
         .withColumn("sensors", F.when(F.col("icao24") == "a", F.array(F.lit(3).cast("bigint"), F.lit(9).cast("bigint"))))
         .withColumn("spi", F.col("icao24") == "b").withColumn("position_source", F.lit(2).cast("bigint")))
    back = decode_snapshot(snapshot_documents(f), ingestion_ts=F.col("ingestion_ts"), all_fields=True)
    assert sorted(back.select(*f.columns).collect(), key=str) == sorted(f.collect(), key=str)
    value = to_messages(back.where("icao24 = 'a'")).first().value
    assert list(json.loads(value)) == MESSAGE_FIELDS and json.loads(value)["sensors"] == [3, 9]
    assert len(decode_messages(spark.createDataFrame([(value,)], "value string")).columns) == 15
    now = decode_snapshot(snapshot_documents(f)).select("ingestion_ts").distinct().collect()
    assert len(now) == 1 and now[0][0] > 1_700_000_000


def test_replay_errors_other_than_a_missing_path_are_raised(spark, scratch):
    from pyspark.errors import AnalysisException
    with pytest.raises((AnalysisException, Exception), match="(?i)scheme|filesystem"):
        read_replay(spark, "nosuchscheme://x/y")


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from contrail import session
    monkeypatch.setattr(session, "is_local", lambda s: False)
    monkeypatch.setattr(session, "tempfile", None)

    class NoFolder:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})
        sparkContext = type("S", (), {"getCheckpointDir": staticmethod(lambda: None), "defaultParallelism": 2})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(NoFolder)
    assert session.stream_partitions(NoFolder) == 200  # not the two slots registered so far
    monkeypatch.undo()
    assert session.is_local(spark) and session.stream_partitions(spark) == spark.sparkContext.defaultParallelism


def test_pinned_dimension_is_cached_and_released(spark):
    from contrail.sources.dimension import pin_dimension, release_dimension
    pinned, n = pin_dimension(aircraft_df(spark, [("a", "R", "M", "M1", "T", "OpA"), ("b", None, None, None, None, None)]))
    assert n == 2 and pinned.storageLevel.useMemory
    release_dimension(pinned)
    assert not pinned.storageLevel.useMemory


def test_aggregate_scan_limit_bites(spark):
    rows = [dict(icao24="a", origin_country=f"c{i:05d}", last_contact=1000, ingestion_ts=1) for i in range(1200)]
    agg = agg_table(_enriched(spark, rows))
    assert agg.count() == 6000
    scanned = panels.scan_agg_limit(agg)
    assert scanned.count() == 5000 and scanned.agg(F.max("country")).first()[0] == "c00999"


def test_state_vector_round_trip_of_awkward_values(spark):
    from contrail.sources.snapshot import snapshot_documents
    rnd = random.Random(11)
    texts = ['say "hi"', "back\\slash", " tab\tand\nline ", "ünïcødé", "", None, "x" * 40]
    nums = [0.0, -0.0, 1e-5, 1.5e20, -123.456, 1e7, 2.0 / 3, None]
    longs = [None, 0, 1, 2 ** 40]
    rows = [dict(icao24=f"k{i}", callsign=rnd.choice(texts), origin_country=rnd.choice(texts),
                 time_position=rnd.choice(longs), last_contact=rnd.choice(longs), longitude=rnd.choice(nums),
                 latitude=rnd.choice(nums), baro_altitude=rnd.choice(nums), on_ground=rnd.choice([True, False, None]),
                 velocity=rnd.choice(nums), true_track=rnd.choice(nums), vertical_rate=rnd.choice(nums),
                 geo_altitude=rnd.choice(nums), squawk=rnd.choice(texts), ingestion_ts=rnd.choice([10, 20]))
            for i in range(300)]
    back = {r.icao24: r.asDict() for r in decode_snapshot(
        snapshot_documents(flights_df(spark, rows)), ingestion_ts=F.col("ingestion_ts")).collect()}
    assert len(back) == len(rows)
    for want in rows:
        got = back[want["icao24"]]
        want = dict(want, callsign=(want["callsign"] or "").strip(" \t\n"))
        assert got == want


def _random_reports(seed, n=400):
    rnd = random.Random(seed)
    keys = ["a", "b", "c", "d", "", None]
    rows = []
    for i in range(n):
        rows.append(dict(
            icao24=rnd.choice(keys), callsign=f"C{i}", origin_country=rnd.choice(["US", "FR", "", None]),
            last_contact=rnd.choice([None] + list(range(0, 900, 7))), ingestion_ts=rnd.choice([None, 10, 20, 30]),
            baro_altitude=rnd.choice([None, 0.0, 1500.5, 9000.0, 12500.25]), velocity=rnd.choice([None, 0.0, 180.0, 250.5]),
            vertical_rate=rnd.choice([None, -40.0, -30.0, -15.0, -15.5, 3.0]), on_ground=rnd.choice([True, False, None]),
            latitude=1.0, longitude=2.0))
    dim = [("a", "R1", "M", "M1", "T", "OpA"), ("a", "R2", "M", "M2", "T", "OpB"), ("b", "R3", "", "M3", "T", None),
           ("", "R4", "X", "M4", "T", "OpE")]
    return rows, dim


def _joined(rows, dim):
    """Left join on icao24 (null matches nothing; a repeated key fans out)."""
    out = []
    for r in rows:
        hits = [d for d in dim if r["icao24"] is not None and d[0] == r["icao24"]]
        for d in hits or [(None,) * 6]:
            out.append(dict(r, registration=d[1], manufacturername=d[2], model=d[3], typecode=d[4], operator=d[5]))
    return out


def test_window_aggregate_matches_brute_force(spark):
    rows, dim = _random_reports(3)
    groups = {}
    for r in _joined(rows, dim):
        if r["origin_country"] is None or r["last_contact"] is None:
            continue
        for k in range(5):
            start = r["last_contact"] // 60 * 60 - 60 * k
            groups.setdefault((r["origin_country"], start), []).append(r)

    def mean(xs):
        xs = [x for x in xs if x is not None]
        return sum(xs) / len(xs) if xs else 0.0
    want = {}
    for (c, start), g in groups.items():
        alts = [x["baro_altitude"] for x in g if x["baro_altitude"] is not None]
        want[(c, start)] = (len(g), mean(alts), max(alts) if alts else 0.0, mean([x["velocity"] for x in g]))
    got = {(r.country, r.window_start): (r.flight_count, r.avg_alt, r.max_alt, r.avg_velocity)
           for r in country_window_agg(_enriched(spark, rows, dim)).collect()}
    assert set(got) == set(want)
    for key, (n, avg_alt, max_alt, avg_vel) in want.items():
        g = got[key]
        assert g[0] == n and abs(g[1] - avg_alt) < 0.006 and g[2] == round(max_alt, 2) and abs(g[3] - avg_vel) < 0.006


def test_live_and_alert_tables_match_brute_force(spark):
    from contrail.plans.tables import latest_then_enrich
    from contrail.schemas import LIVE_COLUMNS
    rows, dim = _random_reports(5)
    joined = _joined(rows, dim)

    def order(r):  # arrival: poll, then report time (missing values first)
        return tuple((v is not None, v or 0) for v in (r["ingestion_ts"], r["last_contact"]))
    by_key = {}
    for r in joined:
        by_key.setdefault(r["icao24"] or "unknown", []).append(r)
    f, d = flights_df(spark, rows), aircraft_df(spark, dim)
    live = {r.icao24: r for r in latest_then_enrich(f, d, LIVE_COLUMNS).collect()}
    assert set(live) == set(by_key)
    for k, g in by_key.items():
        # the latest arrival; on an exact tie (or a repeated dimension key) any tied row may win
        top = max(order(r) for r in g)
        tied = [r for r in g if order(r) == top]
        assert (live[k].ingestion_ts, live[k].last_contact) == (tied[0]["ingestion_ts"], tied[0]["last_contact"])
        assert (live[k].callsign, live[k].operator) in {(r["callsign"], r["operator"]) for r in tied}

    alerts = {}
    for r in joined:
        if r["on_ground"] is False and r["vertical_rate"] is not None and r["vertical_rate"] < -15:
            k = (r["icao24"] or "unknown", r["ingestion_ts"] or 0)
            alerts.setdefault(k, []).append(r)
    got = {(r.icao24, r.ingestion_ts): r for r in alerts_table(_enriched(spark, rows, dim)).collect()}
    assert set(got) == set(alerts)
    for k, g in alerts.items():
        latest = max((x["last_contact"] is not None, x["last_contact"] or 0) for x in g)
        assert (got[k].ts, got[k].row_key) == (k[1], f"{k[0]}|{9999999999 - k[1]}")
        assert any((x["last_contact"] is not None, x["last_contact"] or 0) == latest
                   and x["vertical_rate"] == got[k].vrate for x in g)


def test_salted_join_spreads_a_hot_aircraft_over_tasks(spark):
    from contrail.operators.enrich import salted_left_join
    from contrail.session import session_conf
    dim = aircraft_df(spark, [("a", "R1", "M", "M1", "T", "OpA"), ("b", "R2", "M", "M2", "T", "OpB")])
    rows = [dict(icao24="a" if i % 3 else "b", last_contact=i, ingestion_ts=10) for i in range(600)]
    with session_conf(spark, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="16",
                      spark__sql__autoBroadcastJoinThreshold="-1"):
        out = salted_left_join(flights_df(spark, rows), dim.select("icao24", "operator"), "icao24", min_rows=1)
        parts = (out.where(F.col("icao24") == "a").select(F.spark_partition_id().alias("p"))
                 .distinct().count())
        assert out.count() == 600 and out.where(F.col("operator").isNull()).count() == 0
    # the hot key (two thirds of all reports) is read by many reduce tasks, not one
    assert parts >= 8


def test_addresses_beyond_six_digits_stay_distinct_in_both_engines(spark):
    import duckdb
    from contrail import fixtures
    ids = [0, 1, 10, 16**5 - 1, 16**5, 16**5 + 3, 16**6 - 1, 16**6, 16**6 + 1, 16**7 + 5, 2**40 + 3, 3]
    events = spark.createDataFrame([(i, u, "signup", 1.5) for i, u in enumerate(ids)], fixtures.TABLE_COLUMNS["events"])
    customers = spark.createDataFrame([(u, "n", "m") for u in ids], fixtures.TABLE_COLUMNS["customer"])
    own = [sorted(r.icao24 for r in df.select("icao24").collect())
           for df in (fixtures.flights_from_events(events), fixtures.aircraft_from_customer(customers))]
    db = duckdb.connect()
    db.register("events", events.toPandas())
    db.register("customer", customers.toPandas())
    other = [sorted(r[0] for r in db.sql(f"SELECT icao24 FROM ({q})").fetchall()) for q in (fixtures.FLIGHTS_SQL, fixtures.AIRCRAFT_SQL)]
    assert own == other and all(len(set(x)) == len(ids) for x in own)


def test_window_sums_of_extreme_values(spark):
    nan, inf = float("nan"), float("inf")
    values = [8.9e10, -8.9e10, 9.0e10, 1e12, inf, -inf, nan, None, 0.005, -0.005, 1e-9]
    rows = [dict(icao24=f"a{i}", origin_country="X", last_contact=600, baro_altitude=v, velocity=v) for i, v in enumerate(values)]
    rows += [dict(icao24="b", origin_country="Y", last_contact=600, baro_altitude=inf, velocity=nan)]
    got = {r.country: r for r in country_window_agg(with_event_time(flights_df(spark, rows))).where("window_start = 600").collect()}
    # 5 of the 11 have a number of units: they sum to 1e-9, which is none
    assert (got["X"].flight_count, got["X"].avg_alt, got["X"].max_alt, got["X"].avg_velocity) == (11, 0.0, 8.9e10, 0.0)
    assert (got["Y"].flight_count, got["Y"].avg_alt, got["Y"].max_alt, got["Y"].avg_velocity) == (1, 0.0, 0.0, 0.0)
    from contrail.functions.scalars import out_of_units
    assert flights_df(spark, rows).where(out_of_units("baro_altitude")).count() == 6


def test_unit_sums_are_exact_and_signed(spark):
    import random
    from decimal import Decimal
    from contrail.functions.scalars import unit_sums, units_of
    r = random.Random(2)
    xs = [round(r.uniform(-1, 1) * 10 ** r.randrange(-6, 10), 8) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    row = df.agg(*unit_sums("x", "v")).select(units_of("v").alias("u"), "v_n").first()
    import math
    assert (row.u, row.v_n) == (Decimal(sum(math.floor(x * 1e8 + 0.5) for x in xs)), 3000)
