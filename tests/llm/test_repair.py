"""Conversation repair against a plain search over all edits of each conversation."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from contrail.llm import queries, repair
from tests.llm.helpers import write_table

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
GAP = " \t\n\x0b\x0c\r"


def damage(rows):
    out = defaultdict(list)
    for c, turn, role, text in rows:
        out[c]
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        key = (turn is not None, turn or 0, role, hashlib.sha256(text.encode()).digest())
        now = ("user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        out[c] += [(key, turn, now)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: [(turn, *now) for _, turn, now in sorted(x, key=lambda y: y[0])] for c, x in out.items()}


def faults(turns):
    seen, out = set(), []
    for _, role, text in turns:
        shown = text.strip(GAP)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(turns, found):
    """(cost, audit, repaired) by a shortest path over (row, grammar state) that keeps whole audits."""
    best = {}
    allowed = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    name = {"u": "user", "a": "assistant"}

    def go(i, state, inserted):
        if (i, state, inserted) in best:
            return best[i, state, inserted]
        ways = [(0, "", ())] if i == len(turns) and state in ("", "a") else []
        if inserted < 3:
            ways += [(3 + c, "I" + a, ((name[x], ""), *r)) for x in allowed[state] if x in name
                     for c, a, r in [go(i, allowed[state][x], inserted + 1)] if c is not None]
        if i < len(turns):
            _, role, text = turns[i]
            more = 3 if found[i] == "truncated" else 0
            c, a, r = go(i + 1, state, 0)
            ways += [(4 + c, "D" + a, r)] if c is not None else []
            if found[i] not in ("blank", "duplicate"):
                for x, to in allowed[state].items():
                    c, a, r = go(i + 1, to, 0)
                    if c is not None and role[:1] == x:
                        ways.append((c + more, "K" + a, ((role, text), *r)))
                    if c is not None and x in name:
                        ways.append((3 + more + c, "R" + a, ((name[x], text), *r)))
        best[i, state, inserted] = min(ways, key=lambda w: w[:2]) if ways else (None, None, None)
        return best[i, state, inserted]

    for i in range(len(turns), 0, -1):  # from the end, so that long conversations need no deep recursion
        for state in allowed:
            go(i, state, 0)
    return go(0, "", 0)


def plain(rows):
    out = []
    for c, turns in damage(rows).items():
        found = faults(turns)
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        cost, audit, fixed = cheapest(turns, found)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out.append((c, gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def run(spark, rows, folder):
    write_table(spark.createDataFrame(rows, SCHEMA).withColumns({"cost": F.lit("x"), "kind": F.lit(3), "pos": F.lit(1), "copy": F.lit(0)}), folder, "conversations")
    return sorted([tuple(r) for r in queries.op13_conversation_repair(spark, folder).select(*COLUMNS).collect()], key=str)


def random_rows(seed, n, length=9):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-50, 9 * n), n):
        for i in range(r.randrange(1, length)):
            rows.append((c, None if r.random() < 0.05 else i + r.choice([0, 0, 0, 1]), r.choice(["user", "assistant", "system", "user", "assistant", "tool", None, "", "Übel"]),
                         r.choice(["Yes.", "No!\n", "open", "?\x0b", " \t", "", None, "ü?", "a. b"])))
    return rows + [(None, 1, "user", "Lost."), (None, None, None, None)] + r.sample(rows, 5)


def test_against_plain_search(spark, tmp_path):
    for seed in range(3):
        rows = random_rows(seed, 80)
        assert run(spark, rows, str(tmp_path / str(seed))) == plain(rows)


def test_automaton_finds_least_audit_of_every_short_signature():
    letters = [chr(65 + 4 * i + f) for i in range(4) for f in (0, 1, 3)]
    walk = repair.Automaton()
    for signature in sorted(map("".join, itertools.chain.from_iterable(itertools.product(letters, repeat=n) for n in range(4))), key=lambda s: s[::-1]):
        turns = [(i, {"s": "system", "u": "user", "a": "assistant", "?": "x"}[repair._kept(x)[0]], "t") for i, x in enumerate(signature)]
        found = [f.replace("none", "") for f in (repair._kept(x)[1] for x in signature)]
        assert walk.solve(signature)[1:] == cheapest(turns, found)[:2], signature


def test_empty_dropped_and_long(spark, tmp_path, monkeypatch):
    assert run(spark, [], str(tmp_path / "none")) == []
    dropped = [c for c in range(2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    rows = [(c, 0, "user", "Gone.") for c in dropped]
    assert run(spark, rows, str(tmp_path / "gone")) == [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in sorted(dropped, key=str)]
    monkeypatch.setattr(repair, "_STRETCH", 16)
    rows = [(1, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(400)] + [(2, 0, "user", "x" * 300_000), (2, 1, "assistant", "Done.")]
    rows += [(10 + c, t, "user", "Same.") for c in range(50) for t in range(3)]
    assert run(spark, rows, str(tmp_path / "long")) == plain(rows)


def test_repaired_turns_are_legal_and_hash_alike(spark, tmp_path):
    rows = spark.createDataFrame(random_rows(9, 40), SCHEMA)
    ids, bad = rows.select("conv_id").distinct(), repair.damaged(rows)
    fixed = defaultdict(list)
    for r in repair.repaired_turns(ids, bad).orderBy("conv_id", "place").collect():
        fixed[r["conv_id"]].append(r)
    for r in repair.repair(ids, bad).collect():
        turns = fixed.get(r["conv_id"], [])
        assert [t["place"] for t in turns] == list(range(len(turns)))
        assert re.fullmatch("(s?(ua)+)?", "".join(t["role"][0] for t in turns))
        assert hashlib.sha256("\n".join(f"{t['role']}:{t['text']}" for t in turns).encode()).hexdigest() == r["repaired_sha256"]
        assert "".join(t["edit"] for t in turns) == r["audit"].replace("D", "")
