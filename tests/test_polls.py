"""The poll source: live or replayed poll by poll, and no poll twice across restarts."""

import json
import os
import random

import pytest

from contrail.sources import polls
from contrail.sources.polls import PollReader, decode_polls, poll_stream, record_polls, states_of
from contrail.streaming.pipeline import start_archive
from contrail.streaming.sinks import read_archive
from tests.helpers import flights_df

START, STEP = 1000, 10


def state(address, when):
    out = [None] * 17
    out[0], out[1], out[2], out[4] = address, " AB1 ", "X", when
    return out


def run(spark, scratch, **options):
    polls = poll_stream(spark, f"{scratch}/feed", start=START, seconds=STEP, **options)
    start_archive(polls, f"{scratch}/polls", f"{scratch}/ck-polls", {"availableNow": True}).awaitTermination()
    return sorted((r.poll, r.ingestion_ts, r.kind, r.doc) for r in read_archive(spark, f"{scratch}/polls").collect())


def test_third_polls_broken_against_brute_force_with_restarts(spark, scratch):
    r = random.Random(1)
    os.makedirs(f"{scratch}/feed")
    recorded = [state("rec1", 5), state(None, 6), state("rec2", 7), []]
    with open(f"{scratch}/replay.json", "w") as out:
        json.dump(recorded, out)
    broken = ["", "{", "[]", "5", "null", '{"states": [', "\udcff".encode("utf-8", "surrogatepass")]
    empty = ['{"states": null}', '{"time": 3}', '{"states": []}']
    want = {}
    for n in range(60):
        if n % 3 == 1:
            text, states, kind = r.choice([*broken, None]), recorded, "replay"
        elif n % 10 == 0:
            text, states, kind = r.choice(empty), [], "live"
        else:
            states, kind = [state(f"a{r.randrange(5)}", n) for _ in range(r.randrange(1, 4))], "live"
            text = json.dumps({"time": n, "states": states})
        if n == 59 or text is not None:
            with open(f"{scratch}/feed/{n:012d}.json", "wb") as out:
                out.write(text if isinstance(text, bytes) else (text or "{").encode())
        want[n] = (n, START + n * STEP, kind, json.dumps(states))
        if n in (4, 5, 40):
            run(spark, scratch, replay=f"{scratch}/replay.json")
    got = run(spark, scratch, replay=f"{scratch}/replay.json")
    assert [g[0] for g in got] == list(range(60))  # none twice, none left out
    assert got == [want[n] for n in range(60)]
    assert run(spark, scratch, replay=f"{scratch}/replay.json") == got  # nothing new
    rows = decode_polls(read_archive(spark, f"{scratch}/polls")).collect()
    states = [(s[0], START + n * STEP) for n in range(60) for s in json.loads(want[n][3]) if s and s[0] is not None]
    assert sorted((x.icao24, x.ingestion_ts) for x in rows) == sorted(states) and {x.callsign for x in rows} == {"AB1"}


@pytest.mark.parametrize("replay", [None, "absent.json", "bad.json"])
def test_without_a_replay_a_failed_poll_has_nothing(spark, scratch, replay):
    os.makedirs(f"{scratch}/feed")
    with open(f"{scratch}/bad.json", "w") as out:
        out.write('{"states": []}')
    with open(f"{scratch}/feed/{1:012d}.json", "w") as out:
        out.write('{"states": [["a"]]}')
    got = run(spark, scratch, replay=replay and f"{scratch}/{replay}", until=3)
    assert [(g[0], g[2], g[3]) for g in got] == [(0, "none", "[]"), (1, "live", '[["a"]]'), (2, "none", "[]")]


def test_no_feed_yet(spark, scratch):
    assert poll_stream(spark, f"{scratch}/feed").isStreaming
    polls = poll_stream(spark, f"{scratch}/feed")
    q = start_archive(polls, f"{scratch}/out", f"{scratch}/ck", {"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None and not os.path.exists(f"{scratch}/out")


def test_documents(spark, scratch):
    assert [states_of(t) for t in (None, "", "{", "[1]", '"x"', "{}", '{"states": null}', '{"states": [[1, null]]}')] == \
        [None, None, None, None, None, "[]", "[]", "[[1, null]]"]
    rows = [dict(icao24=f"a{i}", ingestion_ts=START + STEP * (i % 3), last_contact=i) for i in range(9)]
    record_polls(flights_df(spark, rows), f"{scratch}/feed", START, STEP)
    assert sorted(os.listdir(f"{scratch}/feed")) == [f"{n:012d}.json" for n in range(3)]
    got = run(spark, scratch)
    assert sorted((s[0], p) for p, _, _, doc in got for s in json.loads(doc)) == sorted((f"a{i}", i % 3) for i in range(9))


@pytest.mark.parametrize("tasks", [8, None])
def test_more_polls_make_longer_tasks_not_more(scratch, tasks):
    reader = PollReader({"path": f"file://{scratch}", "until": "3600000", **({"tasks": tasks} if tasks else {})})
    assert reader.latestOffset() == {"next": 3600000}  # without a listing
    parts = reader.partitions({"next": 7}, {"next": 3600000})
    assert len(parts) <= (tasks or 200)
    assert [p.first for p in parts] == [7, *(p.end for p in parts[:-1])] and parts[-1].end == 3600000
    assert len(reader.partitions({"next": 0}, {"next": 40})) == 3  # a few polls are not cut small


def test_a_task_holds_few_documents(scratch, monkeypatch):
    os.makedirs(f"{scratch}/feed")
    for n in range(9):
        with open(f"{scratch}/feed/{n:012d}.json", "w") as out:
            json.dump({"states": [["a" * 400 * (n % 3)]]}, out)
    monkeypatch.setattr(polls, "HANDED_ON_CHARS", 500)
    reader = PollReader({"path": f"file://{scratch}/feed"})
    batches = list(reader.read(reader.partitions({"next": 0}, {"next": 9})[0]))
    assert [b["poll"].to_pylist() for b in batches] == [[0, 1, 2], [3, 4, 5], [6, 7, 8]]
