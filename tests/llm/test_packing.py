"""Packing: every word once, bins within their size, and cost against single-size packing and a bound."""

import random
from collections import defaultdict

import pytest

from contrail.llm import packing, queries
from tests.llm.helpers import documents, write_table


def check(lengths, sizes):
    where, offset, final = packing.best_fit(lengths, sizes)
    members = defaultdict(list)
    for n, b, o in zip(lengths, where, offset):
        members[b].append((o, n))
    assert sorted(members) == list(range(len(final)))
    for b, inside in members.items():
        at = 0
        for o, n in sorted(inside):
            assert o == at
            at += n
        assert final[b] == min(s for s in sizes if s >= at)
    return final


def test_bins_hold_each_piece_once_and_are_downsized():
    r = random.Random(3)
    for _ in range(60):
        sizes = tuple(sorted(r.sample(range(4, 60), 3)))
        check([r.randrange(0, sizes[-1] + 1) for _ in range(r.randrange(0, 120))], sizes)


def test_joint_sizes_cost_less_than_any_single_size_and_stay_near_the_bound():
    r = random.Random(5)
    lengths = [min(8192, int(r.lognormvariate(5.5, 1.2))) for _ in range(4000)]
    cost = lambda sizes: sum(map(packing.sequence_cost, check(lengths, sizes)))
    joint = cost(packing.SIZES)
    assert joint < cost((8192,))
    assert joint < 1.02 * sum(lengths) * packing.sequence_cost(512) / 512 + sum(packing.sequence_cost(n) for n in lengths if n > 512) * 0.1


def test_known_small_cases():
    assert packing.best_fit([], (4, 8))[2] == []
    assert packing.best_fit([0, 0], (4, 8)) == ([0, 0], [0, 0], [4])
    assert sorted(packing.best_fit([3, 5, 4, 4], (4, 8))[2]) in ([4, 4, 8], [8, 8])
    with pytest.raises(ValueError):
        packing.best_fit([9], (4, 8))


TEXTS = [None, "", " \n ", "one", "w " * 8192, "w " * 8193, "w " * 30_000, *["x " * (37 * i % 900) for i in range(300)]]


def test_query_packs_every_word_once(spark, tmp_path):
    write_table(documents(spark, TEXTS + [(3, "one"), (None, "two words")], bin_id=1, piece=2).repartition(3), tmp_path, "documents")
    rows = queries.op8_best_fit_packing(spark, str(tmp_path)).collect()
    words = defaultdict(list)
    for r in rows:
        words[r.doc_id].append((r.start_word, r.n_words))
    for i, t in enumerate(TEXTS):
        if i != 3:
            at = 0
            for start, n in sorted(words[i]):
                assert start == at
                at += n
            assert at == len((t or "").split())
    assert words[3] == [(0, 1), (0, 1)] and words[None] == [(0, 2)]
    bins = defaultdict(list)
    for r in rows:
        bins[(r.bin_id, r.bin_size)].append((r.bin_offset, r.n_words))
    assert len(bins) == len({b for b, _ in bins})
    for (_, size), inside in bins.items():
        assert size in packing.SIZES and sum(n for _, n in inside) <= size
        ends = sorted((o, o + n) for o, n in inside)
        assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_shards_and_empty_table(spark):
    df = documents(spark, ["w " * (i % 50) for i in range(500)])
    rows = packing.pack(df, sizes=(16, 64), shard_pieces=100).collect()
    assert sum(r.n_words for r in rows) == sum(i % 50 for i in range(500))
    assert len({r.bin_id >> 32 for r in rows}) == 5
    assert packing.pack(documents(spark, [])).count() == 0
