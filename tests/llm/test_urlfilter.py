"""Temporal URL lists against a day-by-day replay, and against DuckDB."""

import datetime as dt
import random

import duckdb
import pytest

from contrail.llm import queries, urlfilter

DAY = dt.date(2024, 1, 1)
DOMAINS = ["example.org", "a.example.org", "b.a.example.org", "other.net", "x.other.net", "org", "notexample.org"]


def replay(entries, host, day):
    """(entries in force, deciding one) for a host on a day, by replaying the list."""
    state = {}
    for d, category, action, at in sorted(entries, key=lambda e: (e[3], e[2] != "remove")):  # an addition has the last word
        if at <= day:
            if action == "add":
                state[(d, category)] = at
            elif state.get((d, category)) != at:
                state.pop((d, category), None)
    met = [(-len(d), -at.toordinal(), c or "", d, c, at) for (d, c), at in state.items() if host == d or host.endswith("." + d)]
    return len(met), min(met)[3:] if met else (None, None, None)


def test_as_of_join_replays_the_list(spark):
    r = random.Random(4)
    entries = [(r.choice(DOMAINS), r.choice(["x", "y", None]), r.choice(["add", "add", "remove"]), DAY + dt.timedelta(r.randrange(60))) for _ in range(150)]
    odd = [(None, "x", "add", DAY), ("example.org", "z", "add", None), ("example.org", "z", "noise", DAY), ("EXAMPLE.org", "x", "add", DAY)]
    listed = urlfilter.intervals(spark.createDataFrame(entries + entries[:5] + odd, "domain string, category string, action string, day date"))
    hosts = [*DOMAINS, "deep.b.a.example.org", "nothing.at.all"]
    captures = [(i, f"https://u@{r.choice(hosts).upper()}:8080/p?q", DAY + dt.timedelta(r.randrange(70))) for i in range(400)]
    captures += [captures[0], (None, captures[1][1], captures[1][2]), (900, None, DAY), (901, "relative/path", DAY), (902, "http://example.org/", None)]
    df = spark.createDataFrame([(*c, "clash") for c in captures], "id bigint, url string, fetched date, domain string")
    got = sorted((str(x.id), x.host, x.n_active, x.blocked, x.domain, x.category, x.valid_from) for x in urlfilter.evaluate(df, listed, ["id"]).collect())
    clean = entries + [("example.org", "x", "add", DAY)]
    want = []
    for i, url, day in captures:
        host = url.split("@")[1].split(":")[0].lower() if url and "@" in url else "example.org" if i == 902 else ""
        n, best = replay(clean, host, day) if day else (0, (None, None, None))
        want.append((str(i), host, n, n > 0, *best))
    assert got == sorted(want, key=lambda x: x[:1]) or sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    for name in ("op6_url_filters", "op5_warc"):
        res = con.execute(queries.ORACLE_SQL[name])
        columns = [d[0] for d in res.description]
        df = queries.QUERIES[name](spark, sf)
        assert sorted(df.columns) == sorted(columns)
        assert sorted(map(str, (tuple(r) for r in df.select(columns).collect()))) == sorted(map(str, res.fetchall()))


def test_empty_tables(spark):
    listed = urlfilter.intervals(spark.createDataFrame([], "domain string, category string, action string, day date"))
    captures = spark.createDataFrame([(1, "http://a.b/", DAY)], "id int, url string, fetched date")
    assert [x.blocked for x in urlfilter.evaluate(captures, listed, ["id"]).collect()] == [False]
    assert urlfilter.evaluate(captures.limit(0), listed, ["id"]).count() == 0
