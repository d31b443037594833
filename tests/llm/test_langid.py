"""Language ID: the fusion against Bayes' rule by hand, and held-out accuracy of texts and pages."""

import math
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import langid, queries, urlfilter
from tests.llm.helpers import documents, write_table

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return langid.fit_text(docs.filter("doc_id % 4 <> 0"), max_labelled=2000)


def test_texts_not_trained_on(model):
    rows = duckdb.sql(f"select text, lang from '{SF}/documents.parquet' where doc_id % 4 = 0 and length(text) > 60").fetchall()[:600]
    right = sum(model.langs[int(np.argmax(model.log_likelihood(t)))] == lang for t, lang in rows)
    assert model.langs == ["de", "en", "es", "fr", "und"] and right / len(rows) > 0.97


def test_evidence_is_bounded_and_empty_texts_say_nothing(model):
    for t in ("", " ", "123 ### 456", None and ""):
        assert not model.log_likelihood(t or "").any()
    long, short = model.log_likelihood("the and of " * 50_000), model.log_likelihood("the and of " * 50)
    assert np.abs(long - short).max() < 2


def test_fusion_is_bayes_rule(spark):
    r = np.random.default_rng(1)
    langs = ["a", "b", "und"]
    rows = [(i, [float(x) for x in r.normal(0, 2, 3)], ["a", "b", None][i % 3], ".x", f"h{i % 4}", "d1" if i % 4 < 2 else None) for i in range(40)]
    rows.append(rows[0])
    df = spark.createDataFrame(rows, "id int, text_ll array<double>, declared string, suffix string, host string, domain string")
    got = sorted((x.id, tuple(x.posterior), x.lang) for x in langid.identify(df, langs).collect())

    def softmax(v):
        e = np.exp(np.array(v) - max(v))
        return e / e.sum()
    p = [softmax(x[1]) for x in rows]
    total = sum(p)
    base = (total + 1) / (total.sum() + 3)
    sums = {n: defaultdict(lambda: np.zeros(3)) for n in ("declared", "suffix", "host", "domain")}
    for x, q in zip(rows, p):
        for n, v in (("declared", x[2]), ("suffix", x[3]), ("host", (x[5], x[4])), ("domain", x[5])):
            sums[n][v] += q
    want = []
    for x in rows:
        domain = (sums["domain"][x[5]] + 10 * base) / (sums["domain"][x[5]].sum() + 10)
        host = sums["host"][(x[5], x[4])]
        score = np.array(x[1]) + np.log((host + 10 * domain) / (host.sum() + 10))
        for n, v in (("declared", x[2]), ("suffix", x[3])):
            score += np.log((sums[n][v] + 1) / (total + len(sums[n])))
        post = softmax(score)
        want.append((x[0], tuple(post), langs[int(post.argmax())]))
    for a, b in zip(got, sorted(want)):
        assert a[0] == b[0] and a[2] == b[2] and all(math.isclose(x, y, rel_tol=1e-9) for x, y in zip(a[1], b[1]))


def test_pages(spark):
    got = queries.op9_language_id(spark, SF).collect()
    urls = dict(duckdb.sql(f"select page_id, url from '{SF}/pages.parquet'").fetchall())
    assert len(got) == len(urls)
    assert sum(f"/{r.lang}/" in urls[r.page_id] for r in got) / len(got) > 0.98


def test_evidence_of_odd_pages(spark):
    html = ["<HTML class='x' LANG='pt-BR'><script>var a='<p>'</script>Ol&aacute;<!-- x --></p>", None, "", "<p lang=en>", "<html lang=de>"]
    urls = ["https://u:p@Example.ORG:80/fr-ca/x?y", None, "", "nonsense", "http://a.example.de"]
    df = spark.createDataFrame(list(zip(html, urls)), "html string, url string")
    got = df.select(langid.declared_of(F.col("html")).alias("d"), langid.suffix_of(F.col("url")).alias("s"), urlfilter.host_of(F.col("url")).alias("h")).collect()
    assert [tuple(r) for r in got] == [("pt", "/fr", "example.org"), ("", ".", ""), ("", ".", ""), ("", ".", ""), ("de", ".de", "a.example.de")]
    assert langid.visible_text(html[0]).split() == ["Olá"] and langid.visible_text(None) == ""


def test_empty_and_unlabelled_tables(spark, tmp_path):
    empty = documents(spark, [])
    assert langid.fit_text(empty).langs == ["und"]
    write_table(empty, tmp_path, "documents")
    write_table(spark.createDataFrame([(1, None, None), (1, None, None), (None, "http://a/en/", "<p>x")], "page_id bigint, url string, html string"), tmp_path, "pages")
    assert [r.lang for r in queries.op9_language_id(spark, str(tmp_path)).collect()] == ["und"] * 3
    records = spark.createDataFrame([], "id int, text_ll array<double>, declared string, suffix string, host string, domain string")
    assert langid.identify(records, ["a", "und"]).count() == 0


def test_markup_is_cut_as_by_one_pattern_and_in_linear_time():
    import html as entities
    import random
    import re
    import time
    pattern = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
    r = random.Random(2)
    bits = ["<", ">", "<!--", "-->", "-", "<script>", "</script >", "<STYLE a", "</style>", "<scripted>", "a", "é&amp;", "\n", "<b>", "</script"]
    for _ in range(3000):
        page = "".join(r.choice(bits) for _ in range(r.randrange(14)))
        assert langid.visible_text(page) == entities.unescape(pattern.sub(" ", page)), page
    for bit in ("<!--", "<", "<script>", "<style>a", "<script></style>", "</script"):
        began = time.time()
        langid.visible_text(bit * (1_000_000 // len(bit)))
        assert time.time() - began < 2, bit


def test_sample_and_languages_are_bounded(spark):
    rows = [(i, "the same text in every row", "en", "s", 1) for i in range(3000)] + [(i, f"words {i} here", f"l{i % 40:02d}", "s", 1) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert langid.fit_text(docs, max_langs=3).langs == ["en", "l00", "l01", "und"]
    from contrail.llm.common import sample_by_hash
    assert sample_by_hash(docs.withColumn("key", F.xxhash64("doc_id", "text")), "key", 300).count() < 420
