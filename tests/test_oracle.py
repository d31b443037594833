"""Layer 1: every registered query against its DuckDB oracle (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from contrail.plans import catalog
from tests.conftest import SF_SMALL

NAMES = sorted(catalog.queries())
SQL = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(NAMES) - set(SQL) == set()


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(rows) > 0
        return
    res = duck.execute(SQL[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(rows, df.columns) == _canon(res.fetchall(), ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["country", "window_start", "window_end", "flight_count", "avg_alt", "max_alt", "avg_velocity"]


def test_scratch_lives_under_the_session_checkpoint_dir(spark):
    from contrail.session import checkpoint_root, scratch_dir
    conf = spark.conf.get("spark.checkpoint.dir", None)
    root = checkpoint_root(spark)
    if conf:
        assert root == conf  # the cluster's shared folder wins
    else:
        assert root == spark.sparkContext.getCheckpointDir()
    assert scratch_dir(spark, "x").startswith(root.rstrip("/") + "/")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
