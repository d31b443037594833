"""Byte-level BPE against the tiktoken library, on awkward texts, and the round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import bpe, queries
from tests.llm.helpers import documents, write_table

TOKENS = bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(TOKENS, P.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={})


def awkward(seed):
    r = random.Random(seed)
    kinds = [lambda: r.randrange(32, 127), lambda: r.randrange(0x80, 0x3000), lambda: r.randrange(0x4E00, 0x9FFF),
             lambda: r.randrange(0x1F300, 0x1F700), lambda: r.choice([9, 10, 13, 0x1C, 0x1F, 0x85, 0xA0, 0x2028])]
    return "".join(chr(r.choice(kinds)()) for _ in range(300))


TEXTS = [None, "", " ", "\n\n  x", "a" * 5000, " " * 1000, "don't 'll I'VE 12345 <|endoftext|>", "x\x1f\x1cy ٣٤ ⅷ", "abab" * 40_000,
         *[awkward(i) for i in range(30)]]


def test_perfect_hash_finds_every_token(codec):
    assert all(codec.find(t) == i for i, t in enumerate(TOKENS))
    assert sorted(codec.find.slots) == list(range(len(TOKENS)))


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=120))
def test_ids_equal_the_library(codec, library, text):
    packed = codec.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text)
    assert codec.decode(packed) == text.encode()


def test_memo_stays_bounded_and_right(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 5)
    codec.clear()
    text = "one two three one fourish five sixth seven two one eighth ninety tenfold one"
    assert np.frombuffer(codec.encode(text) + codec.encode(text), "<u4").tolist() == library.encode_ordinary(text) * 2
    assert len(codec) <= 5 and len(codec.before) <= 5


def test_query(spark, library, tmp_path):
    write_table(documents(spark, TEXTS + [(3, TEXTS[3]), (None, "x")], ids="clash", decoded=1), tmp_path, "documents")
    got = queries.op4_byte_bpe(spark, str(tmp_path)).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = "x" if r.doc_id is None else TEXTS[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark, tmp_path):
    write_table(documents(spark, []), tmp_path, "documents")
    assert queries.op4_byte_bpe(spark, str(tmp_path)).count() == 0


def test_long_pre_tokens_are_merged_whole_and_not_remembered(codec, library):
    """Unbroken letters are one pre-token however long they are."""
    r = random.Random(8)
    for text in ("ab" * 150_000, "".join(r.choice("etaoinshr") for _ in range(200_000)), "漢字" * 50_000, "z" * 65):
        before = len(codec) + len(codec.before)
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode_ordinary(text)
        assert len(codec) + len(codec.before) == before


def test_merging_looks_up_only_the_pairs_that_merges_make(codec, library, monkeypatch):
    """Pairs of bytes come from a table, and a merge that makes a pair with the next part moves the heap once."""
    class Counted(dict):
        gets = 0

        def get(self, *a):
            self.gets += 1
            return super().get(*a)
    pairs, steps = Counted(codec.pairs), []
    monkeypatch.setattr(codec, "pairs", pairs)
    for name in ("heappop", "heappush", "heapreplace"):
        f = getattr(bpe, name)
        monkeypatch.setattr(bpe, name, lambda *a, f=f: (steps.append(1), f(*a))[1])
    pieces = [b" andonlythere", b"thesbleorand", "漢字かな".encode(), b"\xff\xfe\x00" * 5, b"q", b"etaoinshr" * 40]
    for piece in pieces:
        pairs.gets, before = 0, len(steps)
        ids = codec.merged(piece)
        merges = len(piece) - len(ids)
        assert b"".join(TOKENS[i] for i in ids) == piece
        assert pairs.gets <= 2 * merges and len(steps) - before <= len(piece) - 1 + 2 * merges
    assert codec.merged(b" andonlythere") == library.encode_ordinary(" andonlythere")


def test_heap_entries_of_a_short_pre_token_are_small_numbers(codec, library, monkeypatch):
    entries = []
    for name in ("heappush", "heapreplace"):
        f = getattr(bpe, name)
        monkeypatch.setattr(bpe, name, lambda heap, e, f=f: (entries.append(e), f(heap, e))[1])
    for text in (" andonlythere", "漢字かな", "etaoinshr" * 40):
        entries.clear()
        assert codec.merged(text.encode()) == library.encode_ordinary(text)
        assert entries and max(entries) < len(TOKENS) << len(text.encode()).bit_length()


def test_links_of_every_length(codec, library):
    """Up to a length the links are copies, beyond it they are made."""
    for n in (1, 2, len(bpe.LINKS) - 3, len(bpe.LINKS) - 2, len(bpe.LINKS) - 1, len(bpe.LINKS)):
        text = ("thesbleorand" * n)[:n]
        assert codec.merged(text.encode()) == library.encode_ordinary(text)
    assert bpe.LINKS == list(range(-1, 4 * bpe.MEMO_CHARS + 1))


def test_workers_get_the_hash_made(spark, monkeypatch):
    made, init = [], bpe.PerfectHash.__init__
    monkeypatch.setattr(bpe.PerfectHash, "__init__", lambda self, keys: (made.append(1), init(self, keys))[1])
    shared = bpe.Tokenizer(spark, TOKENS[:300], P.PATTERN).shared
    codec = bpe._codec(shared, P.PATTERN)
    assert len(made) == 1 and bpe._codec(shared, P.PATTERN) is codec
    assert [codec.find(t) for t in TOKENS[:300]] == list(range(300))
    shared.destroy()
