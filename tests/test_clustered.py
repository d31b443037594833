"""Ordered scans over a clustered table: equal to a full sort, and reading little of the table."""

import random

import pytest
from pyspark.sql import functions as F

from contrail.operators.clustered import ClusteredTable, _after
from contrail.session import session_conf
from contrail.streaming.pipeline import ResultTables


def read_by(df):
    """(rows out of the scans, files opened) of a collected DataFrame without exchanges."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves, rows, files = plan.collectLeaves(), 0, 0
    for i in range(leaves.length()):
        metrics = leaves.apply(i).metrics()
        if metrics.contains("numFiles"):
            rows, files = rows + metrics.apply("numOutputRows").value(), files + metrics.apply("numFiles").value()
    return rows, files


@pytest.fixture(scope="module")
def big(spark, tmp_path_factory):
    df = spark.range(0, 200_000).select(F.concat(F.lit("K"), F.col("id") % 40, F.lit("|"), F.lpad(F.xxhash64("id").cast("string"), 22, "0")).alias("row_key"),
                                        F.col("id"), F.repeat(F.lit("x"), 50).alias("load"))
    with session_conf(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}):
        return df, ClusteredTable(str(tmp_path_factory.mktemp("c")), "row_key").write(df, zone_rows=1000)


@pytest.mark.parametrize("n", [1, 200, 5000, 30_000])
def test_first_rows_equal_the_full_sort_and_read_few(spark, big, n):
    df, table = big
    got = table.first(spark, n)
    assert [r.row_key for r in got.collect()] == [r.row_key for r in df.orderBy("row_key").limit(n).collect()]
    rows, files = read_by(got)
    assert rows <= n + 25_000 and files <= 2 + n // 10_000


def test_prefix_reads_the_files_of_its_range(spark, big):
    df, table = big
    for prefix in ("K7|", "K3", "K39|-9"):
        got = table.prefix(spark, prefix)
        assert [r.id for r in got.collect()] == [r.id for r in df.where(F.col("row_key").startswith(prefix)).orderBy("row_key").collect()]
    few = table.prefix(spark, "K7|", 20)
    assert few.count() == 20 and read_by(few)[1] <= 2
    assert table.prefix(spark, "none").count() == 0 and table.prefix(spark, "", 5).count() == 5


def test_random_keys_with_nulls_ties_and_odd_characters(spark, scratch):
    r = random.Random(5)
    keys = [r.choice([None, "", "a", "a|", "ab", "\U0010ffff", "\U0010ffffz", "\ud7ff!", "é", "zz"]) for _ in range(500)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "row_key string, i int")
    table = ClusteredTable(f"{scratch}/t", "row_key").write(df, zone_rows=7)
    order = sorted(keys, key=lambda k: (k is not None, (k or "").encode()))
    for n in (1, 60, 499, 500, 600):
        assert [x.row_key for x in table.first(spark, n).collect()] == order[:n]
    for prefix in ("a", "a|", "\U0010ffff", "\ud7ff", ""):
        assert [x.row_key for x in table.prefix(spark, prefix).collect()] == [k for k in order if k is not None and k.startswith(prefix)]
    assert _after("\ud7ff") == "\ue000" and _after("a\U0010ffff") == "b" and _after("\U0010ffff") is None


def test_empty_table_and_published_view(spark, scratch):
    tables = ResultTables.at(f"{scratch}/out")
    empty = tables.alerts.publish(spark, f"{scratch}/none")
    assert empty.first(spark, 5).count() == 0 and empty.prefix(spark, "a").count() == 0
    rows = spark.createDataFrame([("c", e - 300, e, e // 60, 0.0, 0.0, 0.0, "c", f"c|{9999999999 - e}") for e in range(300, 6000, 60)], tables.agg.schema)
    for b in range(2):
        tables.agg.write_batch(rows.where(F.col("window_end") % 120 == 60 * b), b)
    newest = tables.agg.publish(spark, f"{scratch}/windows").prefix(spark, "c|", 3)
    assert [r.window_end for r in newest.collect()] == [5940, 5880, 5820]
