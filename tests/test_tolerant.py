"""Tolerant decoding against a plain reading of the same JSON, and the quarantine beside an archive."""

import json
import math
import random

from pyspark.sql import functions as F

from contrail import fixtures
from contrail.plans import catalog
from contrail.schemas import EXTRA_SCHEMA, FLIGHT_FIELDS, FLIGHT_SCHEMA, MESSAGE_FIELDS
from contrail.sources.messages import decode_messages, read_message_files
from contrail.sources.tolerant import decode_states, decode_tolerant, quarantine, readable, start_tolerant_archive
from contrail.streaming.sinks import read_archive

TYPES = {f.name: f.dataType.simpleString() for f in FLIGHT_SCHEMA.fields}
ODD = ["fast", "12", " 7 ", "", "12.5", "-3", 12, -4, 12.5, 1e3, 0, True, False, "true", "False", None, [1, 2], {"a": 1}, "NaN", "Infinity", 10 ** 19, "é\n"]


def plain(name, value):
    """(value, bad) as the docstring defines them."""
    if value is None:
        return None, False
    text = value if isinstance(value, str) else json.dumps(value, separators=(",", ":"))
    kind = TYPES[name]
    if kind == "string":
        return text, False
    if kind == "boolean":
        return {"true": True, "false": False}.get(text), text not in ("true", "false")
    try:
        if kind == "bigint":
            whole = int(text.strip()) if text.strip().lstrip("+-").isdigit() else None
            return (whole, False) if whole is not None and abs(whole) < 2 ** 63 else (None, True)
        number = float(text)
        return (number, False) if math.isfinite(number) else (None, True)
    except ValueError:
        return None, True


def test_fields_are_read_one_by_one(spark):
    r = random.Random(3)
    docs = [{k: r.choice(ODD) for k in FLIGHT_FIELDS if r.random() < 0.8} for _ in range(400)]
    for d in docs:  # numbers written with an exponent or as whole doubles have several texts; not in text fields
        for k in ("icao24", "callsign", "origin_country", "squawk"):
            if isinstance(d.get(k), float):
                d[k] = "t"
        for k in ("time_position", "last_contact", "ingestion_ts"):
            if d.get(k) == 1e3:
                d[k] = 12.5
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, value string")
    for row in decode_tolerant(df, keep=["i"]).collect():
        doc, bad = docs[row.i], set()
        for name in FLIGHT_FIELDS:
            want, broken = plain(name, doc.get(name))
            assert row[name] == want, (name, doc.get(name))
            if broken:
                bad.add(("bad field", name))
        if doc.get("icao24") in (None, ""):
            bad.add(("no address", "icao24"))
        assert {(f.reason, f.field) for f in row.faults} == bad


def test_clean_messages_read_as_by_the_strict_decoder(spark):
    r = random.Random(9)
    docs = [json.dumps({"icao24": f"{i:06x}", "last_contact": i, "velocity": r.uniform(-1e6, 1e6), "baro_altitude": r.choice([0.1, 1e-9, 12345678.9, 1e17, 0.0]),
                        "on_ground": r.choice([True, False, None]), "squawk": "0007"}) for i in range(300)]
    df = spark.createDataFrame([(d,) for d in docs], "value string")
    got = decode_tolerant(df)
    assert sorted(map(str, got.select(*FLIGHT_FIELDS).collect())) == sorted(map(str, decode_messages(df).select(*FLIGHT_FIELDS).collect()))
    assert got.where(F.size("faults") > 0).count() == 0


def test_whole_messages_that_cannot_be_read(spark):
    cases = {None: "absent", "": "not json", "{": "not json", '{"a":1,"a":2}': "not json", "[1]": "not an object", "5": "not an object", '"x"': "not an object", "null": "not an object"}
    df = spark.createDataFrame([(k,) for k in cases], "value string")
    rows = decode_tolerant(df, extra=True).collect()
    assert {r.raw: r.faults[0].reason for r in rows} == cases
    assert all(len(r.faults) == 1 and all(r[f] is None for f in MESSAGE_FIELDS) for r in rows)
    assert readable(decode_tolerant(df)).count() == 0 and quarantine(decode_tolerant(df)).count() == len(cases)
    assert decode_tolerant(df.limit(0)).count() == 0


def test_state_vectors_of_17_and_18_slots_and_broken_ones(spark):
    whole = ["abc", "CALL  ", "N", 1, 2, 1.5, 2.5, None, False, 4.0, 5, 6, [3, 4], 7, "0001", True, 0]
    docs = [{"time": 1, "states": [whole, whole + [9], whole[:5], {"x": 1}, None, [], ["", 1], ["d", None, "N", "late", 8]]}, {"time": 2, "states": None}, {"time": 3}, {"states": "none"}, [whole]]
    texts = [*map(json.dumps, docs), None, '{"states":[[']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, doc string")
    rows = decode_states(df, ingestion_ts=F.lit(50), keep=["i"]).collect()
    good = [r for r in rows if r.icao24]
    assert [(r.icao24, r.callsign, r.category, r.velocity, r.position_source, r.sensors, r.ingestion_ts) for r in good] == [
        ("abc", "CALL", None, 4.0, 0, [3, 4], 50), ("abc", "CALL", 9, 4.0, 0, [3, 4], 50), ("abc", "CALL", None, None, None, None, 50), ("d", None, None, None, None, None, 50)]
    assert good[3].last_contact == 8 and good[3].time_position is None and [(f.reason, f.field, f.text) for f in good[3].faults] == [("bad field", "time_position", "late")]
    others = sorted((r.i, r.faults[0].reason) for r in rows if not r.icao24)
    assert others == [(0, "no address"), (0, "no address"), (0, "not a list"), (0, "not a list"), (3, "not an object"), (4, "not an object"), (5, "absent"), (6, "not json")]
    assert {f.name for f in EXTRA_SCHEMA.fields} <= set(readable(decode_states(df, ingestion_ts=F.lit(1))).columns)


def test_archive_and_quarantine_together_hold_every_message_once_after_restarts(spark, scratch):
    lines = ['{"icao24":"a","velocity":1}', '{"icao24":"b","velocity":"x"}', "{", '{"velocity":2}']
    for n in range(3):
        with open(f"{scratch}/part{n}.tmp", "w") as f:
            f.write("\n".join(lines))
        __import__("os").makedirs(f"{scratch}/in", exist_ok=True)
        __import__("os").rename(f"{scratch}/part{n}.tmp", f"{scratch}/in/part{n}.json")
        q = start_tolerant_archive(decode_tolerant(read_message_files(spark, f"{scratch}/in")), f"{scratch}/good", f"{scratch}/bad", f"{scratch}/ck", {"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None
    assert sorted((r.icao24, r.velocity) for r in read_archive(spark, f"{scratch}/good").collect()) == sorted([("a", 1.0), ("b", None)] * 3, key=str)
    bad = sorted((r.reason, r.field, r.text, r.raw) for r in read_archive(spark, f"{scratch}/bad").fillna("").collect())
    assert bad == sorted([("bad field", "velocity", "x", lines[1]), ("not json", "", "{", "{"), ("no address", "icao24", "", lines[3])] * 3)


def test_a_table_of_one_row_group_is_decoded_by_many_tasks(spark, scratch):
    events = spark.range(4000).selectExpr("id AS event_id", "id % 7 AS user_id", "'signup' AS event_type", "CAST(id AS DOUBLE) AS value")
    events.coalesce(1).write.parquet(f"{scratch}/events.parquet")
    decoded = catalog.queries()["src_tolerant_decode"](spark, scratch)
    sizes = decoded.rdd.glom().map(len).collect()
    assert sum(sizes) == 4000 and len(sizes) > 1 and max(sizes) < 4000
    ordered = fixtures.spread_flights(spark, scratch).rdd.glom().map(lambda rows: [r.last_contact for r in rows]).collect()
    assert len(ordered) > 1 and all(max(a) < min(b) for a, b in zip(ordered, ordered[1:]))


def test_each_field_is_read_from_the_message_once(spark):
    plan = decode_tolerant(spark.createDataFrame([("{}",)], "value string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("$.velocity") == 1
