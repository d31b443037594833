"""Weighted-sampling fingerprints: edited texts, equality, and likeness against the generalised Jaccard."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from contrail.llm import cws, queries
from tests.llm.helpers import documents, write_table


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{int(r.paretovariate(0.8)) % vocabulary}é" for _ in range(n))


TEXTS = [None, "", " \n", "one", "a b a\tb", "😀" * 9 + " é", *[prose(i, 50 * (i + 1)) for i in range(12)], prose(3, 200), prose(7, 9000)]


def edit(text, following):
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def jaccard(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("cws"))
    ids = [7 * i - 20 for i in range(len(TEXTS))]
    df = documents(spark, list(zip(ids, TEXTS)), fingerprint="clash", next_id=1, head="h", n=3)
    write_table(df.repartition(4), folder, "documents")
    got = {r.doc_id: r for r in queries.op7_document_fingerprints(spark, folder).collect()}
    assert len(got) == len(TEXTS)
    return [got[i] for i in ids]


def test_edited_texts(rows):
    for i, r in enumerate(rows):
        text, following = TEXTS[i] or "", TEXTS[(i + 1) % len(TEXTS)] or ""
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edit(text, following).encode()).hexdigest()


def test_likeness_is_the_generalised_jaccard(rows):
    off_edited, off_next = [], []
    for i, r in enumerate(rows):
        text, following = TEXTS[i] or "", TEXTS[(i + 1) % len(TEXTS)] or ""
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 4 * cws.SLOTS
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if len(text.split()) >= 200:
            off_edited.append(r.near_edited - jaccard(text, edit(text, following)))
            off_next.append(r.near_next - jaccard(text, following))
    for off in (off_edited, off_next):
        assert abs(sum(off) / len(off)) < 0.05 and max(map(abs, off)) < 0.2


def test_equal_texts_and_empty_ones(rows):
    assert rows[0].fingerprint == rows[1].fingerprint == rows[2].fingerprint == cws.EMPTY * cws.SLOTS
    assert rows[0].near_edited == rows[0].near_next == 1.0 and rows[2].near_next == 0.0
    same = [i for i, t in enumerate(TEXTS) if t == TEXTS[9]]
    assert len(same) == 2 and len({rows[i].fingerprint for i in same}) == 1


def test_slots_equal_brute_force(spark):
    """Each slot against the definition, computed from the same hashes in Python."""
    text = prose(5, 300)
    pieces = [(w, p, 1) for w, n in Counter(text.split()).items() for p in range(n)]
    df = spark.createDataFrame(pieces, "w string, p int, n int").select("p", "n", F.xxhash64("w").alias("x"))
    best = {}
    for r in df.select("n", *[F.xxhash64(F.lit(i), "x", "p").alias(f"h{i}") for i in (1, 2, 3)]).collect():
        def u(h, shift):
            return (((h & (2**64 - 1)) >> shift & 0xFFFFFFFF) + 0.5) / 2**32
        rr, c, b = -math.log(u(r.h1, 0) * u(r.h1, 32)), -math.log(u(r.h2, 0) * u(r.h2, 32)), u(r.h3, 0)
        t = math.floor(math.log(r.n) / rr + b)
        slot = (r.h3 & (2**64 - 1)) >> 57
        best[slot] = min(math.log(c) - rr * (t + 1 - b), best.get(slot, math.inf))
    got = cws.with_fingerprints(spark.createDataFrame([(text,)], "t string"), {"f": "t"}).first().f
    slots = [got[i:i + 4] for i in range(0, len(got), 4)]
    for i, slot in enumerate(slots):
        want = f"{int((best[i] + 512) * 2**32) & 0xFFFF:04x}" if i in best else cws.EMPTY
        assert slot == want or i in best and abs(int(slot, 16) - int(want, 16)) <= 1


@pytest.mark.parametrize("words", [2, 5, 10, 40, 200])
def test_collision_rate_is_the_similarity_at_every_length(spark, words):
    """Mean error over 2,000 pairs of texts with repeated words, the second an edit of the first."""
    r, pairs = random.Random(words), []
    for i in range(2000):
        a = [f"x{i}w{int(r.paretovariate(0.7)) % (2 * words)}" for _ in range(words)]
        b = [w if r.random() < 0.7 else f"x{i}w{r.randrange(2 * words)}" for w in a][:r.randrange(max(1, words // 2), words + 1)]
        pairs.append((" ".join(a), " ".join(b)))
    df = cws.with_fingerprints(spark.createDataFrame(pairs, "a string, b string").repartition(8), {"f": "a", "g": "b"})
    off = [x.s - jaccard(x.a, x.b) for x in df.select("a", "b", cws.likeness(F.col("f"), F.col("g")).alias("s")).collect()]
    assert len(off) == 2000 and abs(sum(off) / len(off)) < 0.02


def test_few_words_with_repeats_are_exact_but_for_shared_bins(spark):
    rows = [("w w v", "w w", 2 / 3), ("w w w", "w", 1 / 3), ("a", "b", 0.0), ("a a a a", "a a a a", 1.0)]
    df = cws.with_fingerprints(spark.createDataFrame(rows, "a string, b string, want double"), {"f": "a", "g": "b"})
    for x in df.select("want", cws.likeness(F.col("f"), F.col("g")).alias("s")).collect():
        assert abs(x.s - x.want) < 0.2


@pytest.mark.parametrize("per_range", [3, 1000])
def test_successors(spark, per_range):
    ids = [5, None, -3, 40, 12, 7, 100]
    got = {r.doc_id: r.next_id for r in cws.successors(spark.createDataFrame([(i,) for i in ids], "doc_id bigint"), per_range).collect()}
    order = [None, -3, 5, 7, 12, 40, 100]
    assert got == dict(zip(order, order[1:] + order[:1]))


def test_repeated_and_null_ids_and_empty_table(spark, tmp_path):
    df = documents(spark, [(1, "a b c d"), (1, "a b c d"), (1, "x"), (None, "n"), (2, "other words")])
    got = cws.compare_edited(df).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 1), (1, 1), (1, 7), (1, 7), (2, 11)]
    assert cws.compare_edited(documents(spark, [])).count() == 0
    (only,) = cws.compare_edited(documents(spark, ["alone in here"])).collect()
    assert only.near_next == 1.0
