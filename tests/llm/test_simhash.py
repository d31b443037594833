"""SimHash fingerprints, links and components against brute force."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from contrail.llm import queries, simhash
from contrail.llm.components import connected_components
from tests.llm.helpers import documents, scribble, write_table


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for gap in "\t\n\x0b\x0c\r":
        words = words.replace(gap, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words)] if len(words) < 3 else [" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs, max_bits):
    """[(id, fingerprint)] -> {fingerprint: smallest id reachable}, all pairs compared."""
    root = {f: f for _, f in pairs}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    different = list(root)
    for i, a in enumerate(different):
        for b in different[:i]:
            if (a ^ b).bit_count() <= max_bits:
                root[find(a)] = find(b)
    least = {}
    for i, f in pairs:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return {f: least.get(find(f)) for f in root}


BASE = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf in the dark wood " * 4
TEXTS = [None, "", " \n\t", "Ab", "aB", "one two", "A b\x0bC", BASE, BASE.upper(), BASE + "x", "É é ß x y z", "a a a a a a", "very long " * 30_000,
         *[BASE.replace("fox", scribble(i, 3, "abcxyz"), 1) for i in range(40)], *[scribble(i, 80, "ab  cd\n") for i in range(60)]]


def test_fingerprints():
    for t in TEXTS:
        assert simhash.simhash64(t) == brute_fingerprint(t)
    assert simhash.simhash64("") == 0


def test_query_matches_brute_force(spark, tmp_path):
    df = documents(spark, TEXTS + [(500, TEXTS[7]), (500, TEXTS[7]), (None, "Ab")], fp=1, component_id=2, root=3, a=4)
    write_table(df.repartition(4), tmp_path, "documents")
    got = queries.op3_simhash_near_dedup(spark, str(tmp_path)).collect()
    ids = [(i, brute_fingerprint(t)) for i, t in enumerate(TEXTS)] + [(500, brute_fingerprint(TEXTS[7]))] * 2 + [(None, brute_fingerprint("Ab"))]
    want = brute_components(ids, 2)
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == sorted((str(i), f"{f:016x}", want[f]) for i, f in ids)


@pytest.mark.parametrize("cap", [2, 64])
@pytest.mark.parametrize("bits", [0, 2])
def test_full_blocks_lose_no_link(spark, cap, bits):
    """Clusters of close fingerprints, chains, and strangers: the same components whatever the cap."""
    r = random.Random(bits)
    fps = [0, 2**64 - 1]
    for _ in range(6):
        f = r.getrandbits(64)
        for _ in range(25):
            fps.append(f)
            f ^= 1 << r.randrange(64)
            if r.random() < 0.5:
                f ^= 1 << r.randrange(64)
            if r.random() < 0.1:
                f ^= 0b111 << r.randrange(60)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp bigint")
    links = simhash.near_links(df, bits, bucket_cap=cap)
    roots = {x.node: x.root for x in connected_components(links).collect()}
    got = {}
    for f in fps:
        got.setdefault(roots.get(simhash._signed(f), simhash._signed(f)), set()).add(f)
    want = {}
    for f, least in brute_components([(f, f) for f in fps], bits).items():
        want.setdefault(least, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (None, 3)]
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in got} == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}
    assert len(got) == 501


def test_keep_one(spark):
    df = documents(spark, [(4, BASE), (2, BASE), (9, "lone"), (9, "lone"), (None, "nameless"), (None, BASE), (7, None), (6, "")], __x=1)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("2", BASE), ("6", ""), ("9", "lone"), ("None", "nameless")]
    assert simhash.keep_one(df.limit(0)).count() == 0
    assert simhash.near_components(df.filter(F.lit(False))).count() == 0


def test_keep_one_against_brute_force(spark):
    """Random rows with null and repeated ids, null and repeated texts, near texts, and clashing column names."""
    import random
    r = random.Random(11)
    base = [f"the quick brown fox number {k} jumps over the lazy dog and runs away " * 12 for k in range(4)]
    texts = [None, "", "x", "y z", *base, *[b + "again" for b in base], *[b.replace("lazy", "idle", 1) for b in base]]
    rows = [(r.choice([None, None, *range(12)]), r.choice(texts)) for _ in range(90)]
    df = documents(spark, rows, root=1, kept_id=2, _kept_id="x", kept_hash=None, kept_n=0, fp=3, hash="h").repartition(3)
    got = [(x.doc_id, x.text) for x in simhash.keep_one(df.withColumn("kept_hash", F.lit(5))).collect()]
    prints = {t: simhash.simhash64(t) for t in texts}
    groups = []
    for f in set(prints[t] for _, t in rows):
        near = [g for g in groups if any((f ^ o).bit_count() <= 2 for o in g)]
        groups = [g for g in groups if g not in near] + [set().union({f}, *near)]
    assert len(got) == len(groups)
    for g in groups:
        own = [(i, t) for i, t in rows if prints[t] in g]
        (kept,) = [x for x in got if prints[x[1]] in g]
        ids = [i for i, _ in own if i is not None]
        assert kept in own and kept[0] == (min(ids) if ids else None)


def test_keep_one_of_nameless_rows(spark):
    df = documents(spark, [(2, BASE), (None, BASE), (None, "other words here"), (None, BASE + " more"), (None, BASE + " more")])
    assert sorted(str(x.doc_id) for x in simhash.keep_one(df).collect()) == sorted(["2", "None"] + (["None"] if (simhash.simhash64(BASE) ^ simhash.simhash64(BASE + " more")).bit_count() > 2 else []))
