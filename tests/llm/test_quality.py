"""Quality statistics against brute force, and the decision list on data whose rule is known."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from contrail.llm import quality, queries
from tests.llm.helpers import documents, scribble, write_table


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    repeated = {k for i, x in enumerate(windows) if often[x] > 1 for k in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated))


TEXTS = [None, "", " \n\t", "one", "a b", "a b c", "a a a a", "x y z x y z", "a b c\na b c\n\n \n a b c\na b c", "é😀 ## $x |<> é😀",
         "a\xa0b c d\x0be", "w x y " * 3000, " ".join(f"u{i // 2}" for i in range(3000)) + " " + " ".join(f"u{i // 2}" for i in range(2500)),
         *[scribble(i, 200, "ab  c\n") for i in range(80)], *[scribble(i, 3000, ["the ", "of ", "and ", "x ", "yy ", "\n", "zé "]) for i in range(20)]]


def test_query_statistics(spark, tmp_path):
    write_table(documents(spark, TEXTS + [(5, TEXTS[5]), (None, "n")], n_words=9, rule=8, __w=7).repartition(4), tmp_path, "documents")
    write_table(spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, None)], "doc_id bigint, quality int, toxic int"), tmp_path, "labels")
    rows = queries.op2_quality_rules(spark, str(tmp_path)).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        want = brute("n" if r.doc_id is None else TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed)  # nothing could be learned


@pytest.fixture(scope="module")
def learned(spark):
    """Bad: more than 0.3 symbols a word, or long lines full of capitals; 1 % of labels wrong."""
    r = random.Random(8)
    texts, labels = [], []
    for i in range(1500):
        kind = i % 5
        words = [scribble(r.random(), r.randrange(2, 9), "abcdefgh") for _ in range(120)]
        if kind == 0:
            words = [w + ("#" if r.random() < 0.6 else "") for w in words]
        elif kind == 1:
            words = [w.upper() for w in words]
        elif kind == 2:
            words = [w + ("#" if r.random() < 0.03 else "") for w in words]
        bad = kind in (0, 1)
        texts.append(" ".join(words))
        labels.append((i, int(bad == (r.random() < 0.01)), 0))
    docs = documents(spark, texts)
    rules = quality.fit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    return docs, rules


def test_list_finds_the_rules(learned):
    docs, rules = learned
    assert {c.feature for rule in rules for c in rule} & {"symbols_per_word"} and any(c.feature == "upper_share" for rule in rules for c in rule)
    got = quality.statistics(docs, ["doc_id"]).select("doc_id", quality.deciding_rule(rules).alias("rule")).collect()
    wrong = [r.doc_id for r in got if (r.rule > 0) != (r.doc_id % 5 in (0, 1))]
    assert len(wrong) <= 15
    assert all(str(c).split()[1] in (">", "<=") for rule in rules for c in rule)


def test_first_rule_decides_and_empty_list_keeps(spark, learned):
    docs, rules = learned
    counted = quality.statistics(docs.limit(10), ["doc_id"])
    assert {r.x for r in counted.select(quality.deciding_rule([]).alias("x")).collect()} == {0}
    always = (quality.Condition("words", True, -1.0, 0),)
    assert {r.x for r in counted.select(quality.deciding_rule([always, *rules]).alias("x")).collect()} == {1}


def test_no_python_in_the_plan(spark, learned):
    docs, rules = learned
    plan = quality.statistics(docs, ["doc_id"]).select(quality.deciding_rule(rules))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_held_out_verdicts_on_the_given_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rules = quality.fit(docs, labels.filter("doc_id % 3 <> 0"))
    got = (quality.statistics(docs.join(labels.filter("doc_id % 3 = 0"), "doc_id"), ["doc_id", "quality"])
           .select("quality", (~quality.base_failed() & (quality.deciding_rule(rules) == 0)).alias("kept"), quality.base_failed().alias("b")).collect())
    good = [r.kept for r in got if r.quality == 1 and not r.b]
    bad = [r.kept for r in got if r.quality == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.1


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.fit(documents(spark, []), labels) == []
    assert quality.statistics(documents(spark, []), ["doc_id"]).count() == 0
