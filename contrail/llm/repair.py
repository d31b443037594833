"""Structure repair of conversations by the cheapest edits, worked out once for each shared ending.

Each row of a conversation is one letter: its role's initial and its first fault. The letters of a
conversation are its signature; equal signatures are repaired alike, so they are collapsed first. Distinct
signatures are sorted from their ends and dealt out by ranges: signatures that end alike are neighbours, and a
task walks them as an automaton built from the ends, in which a shared ending is one node. For each node and
each state of the role grammar it keeps the cost to go and the edits with which the best audit goes on,
worked out when the node is new; nodes whose costs differ by a constant and whose audits rank alike share
those tables. (Only the nodes on the seam of two ranges, one signature's length at most, are built by both tasks.)

The grammar of role initials, ``(s?(ua)+)?``, has four states: nothing yet, after s, after u, after a. In
each at most one of user and assistant may come next, so an audit stands for one repair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import stash
from contrail.llm.turns import ranked

#: A letter is "A" plus 4 times the place of the role's initial here (the last for any other) plus that of the fault.
INITIALS, FAULTS = "sua?", ("none", "blank", "duplicate", "truncated")
_GAP_CHARS = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}
#: State (0 nothing yet, 1 after s, 2 after u, 3 after a) to the state after an initial; the rest is not allowed.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_OTHER = (2, 2, 3, 2)  # the state after the one of user and assistant that may come next
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
_STRETCH = 4096
_COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, tie...) after a fixed damage, null role or text being one space.

    crc32 of ``conv_id:turn`` (null: one space) modulo 20: 0 drops the row, 1 empties its text, 2 removes its
    full stops, question and exclamation marks, 3 repeats it, 4 makes it the user's.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = (F.crc32(key.cast("binary")) % 20).cast("int")
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.col("role").alias("tie_role"), F.unhex(F.sha2("text", 256)).alias("tie_text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def _order() -> list[Column]:
    """Rows of a conversation by turn, null first; rows of one turn by role and SHA-256 of the text before the damage."""
    return [F.col("turn").asc_nulls_first(), F.col("tie_role"), F.col("tie_text"), F.col("copy")]


def signatures(rows: DataFrame) -> DataFrame:
    """(conv_id, signature) of the conversations that have rows: one letter a row, in order.

    Faults: blank (no character but white space), duplicate (role and text stood earlier in the conversation),
    truncated (the last such character ends no sentence); the first that holds counts. Rows of a conversation are put
    together by stretches, so that only the letters themselves, which the audit needs too, meet in one row.
    """
    shown = F.rtrim(F.col("text"), F.lit(_GAP_CHARS))
    initial = F.substring("role", 1, 1)
    place = F.when(initial.isin(*INITIALS[:3]), F.instr(F.lit(INITIALS), initial) - 1).otherwise(F.lit(3))
    light = rows.select("conv_id", "turn", "tie_role", "tie_text", "copy", place.alias("place"), (shown == "").alias("blank"),
                        (~F.right(shown, F.lit(1)).isin(".", "!", "?")).alias("open"),
                        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)).alias("said"))
    light = ranked(light, "conv_id", _order(), "repair-rows").select("conv_id", "pos", "place", "blank", "open", "said")
    again = (light.filter("not blank").groupBy(F.col("conv_id").alias("c"), F.col("said").alias("s"))
             .agg(F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1").select("c", "s", "first"))
    again = stash(again, "repair-again")
    light = light.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("said") == F.col("s")), "left")
    fault = F.when(F.col("blank"), 1).when(F.col("pos") > F.col("first"), 2).when(F.col("open"), 3).otherwise(0)
    letters = light.select("conv_id", "pos", F.expr(f"pos div {_STRETCH}").alias("stretch"), F.char(F.lit(65) + 4 * F.col("place") + fault).alias("letter"))

    def joined(at: str, what: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, what))), lambda x: x[what]), "")
    parts = letters.groupBy("conv_id", "stretch").agg(joined("pos", "letter").alias("letters"))
    return parts.groupBy("conv_id").agg(joined("stretch", "letters").alias("signature"))


def _kept(letter: str) -> tuple[str, str]:
    place, fault = divmod(ord(letter) - 65, 4)
    return INITIALS[place], FAULTS[fault]


#: What is left at the end, for each state: cost, edits, and the rank of the edits among the four.
_END = ((0, 6, 3, 0), (("", -1), ("II", -1), ("I", -1), ("", -1)), (0, 2, 1, 0))


@lru_cache(maxsize=1 << 16)
def _node(letter: str, costs: tuple[int, ...], ranks: tuple[int, ...]) -> tuple[int, tuple]:
    """The node that reads ``letter`` before one with these costs to go and ranks of best audits, by state.

    Returns the least cost and (costs beyond it, (edits, next state), ranks), each by state.
    """
    initial, fault = _kept(letter)
    best: list[tuple[int, str, str, int]] = []  # cost, key that sorts as the audit does, edits, state after the row
    for state in range(4):
        ways = [(DELETE + costs[state], "D", state)]
        if fault in ("none", "truncated"):
            more = TRUNCATED if fault == "truncated" else 0
            ways.append((REROLE + more + costs[_OTHER[state]], "R", _OTHER[state]))
            if initial in _NEXT[state]:
                after = _NEXT[state][initial]
                ways.append((KEEP + more + costs[after], "K", after))
        best.append(min((cost, edit + chr(ranks[after]), edit, after) for cost, edit, after in ways))
    for _ in range(3):  # insertions before the row; each costs, so none goes round
        best = [min(best[s], (INSERT + best[_OTHER[s]][0], "I" + best[_OTHER[s]][1], "I" + best[_OTHER[s]][2], best[_OTHER[s]][3])) for s in range(4)]
    least = min(b[0] for b in best)
    order = {key: i for i, key in enumerate(sorted({b[1] for b in best}))}
    return least, (tuple(b[0] - least for b in best), tuple((b[2], b[3]) for b in best), tuple(order[b[1]] for b in best))


class Automaton:
    """The path of the signature at hand through the automaton, from the end; kept as far as the next one ends alike."""

    def __init__(self) -> None:
        self.letters = ""  # of the path, last row first
        self.path: list[tuple[int, int, tuple]] = [(0, 0, _END)]  # cost so far, illegal neighbours, tables

    def solve(self, signature: str) -> tuple[int, int, str]:
        """(illegal neighbours, cost, audit) of a signature."""
        ends = signature[::-1]
        same = _alike(ends, self.letters)
        del self.path[same + 1:]
        for i in range(same, len(ends)):
            cost, illegal, tables = self.path[-1]
            more, made = _node(ends[i], tables[0], tables[2])
            pair = _kept(ends[i])[0] + _kept(ends[i - 1])[0] if i else "ua"
            self.path.append((cost + more, illegal + (pair not in _LEGAL), made))
        self.letters = ends
        state, audit = 0, []
        for _, _, tables in reversed(self.path):
            edits, after = tables[1][state]
            audit.append(edits)
            state = after
        cost, illegal, tables = self.path[-1]
        return illegal, cost + tables[0][0], "".join(audit)


def _alike(a: str, b: str) -> int:
    """Length of the common start."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_SOLVED = pa.schema([("signature", pa.string()), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string())])


def solved(found: DataFrame) -> DataFrame:
    """(signature, blank, duplicate, truncated, illegal, cost, audit) of each distinct signature."""
    distinct = found.groupBy("signature").count().select("signature", F.reverse("signature").alias("ends"))
    dealt = distinct.repartitionByRange("ends").sortWithinPartitions("ends").select("signature")
    letters = {f: [chr(65 + 4 * i + FAULTS.index(f)) for i in range(4)] for f in FAULTS}

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Automaton()
        for batch in batches:
            done = []
            for s in batch["signature"].to_pylist():
                illegal, cost, audit = walk.solve(s)
                done.append((s, *[sum(map(s.count, letters[f])) for f in FAULTS[1:]], illegal, cost, audit))
            yield _batch(done, _SOLVED)

    return dealt.mapInArrow(solve, "signature string, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", audit string")


def plans(ids: DataFrame, rows: DataFrame) -> DataFrame:
    """(conv_id, blank, duplicate, truncated, illegal, cost, audit) of each of ``ids``; without rows zeros and an empty audit."""
    found = stash(signatures(rows), "repair-signatures")
    done = stash(solved(found), "repair-solved")
    with_audit = stash(found.join(done, "signature").drop("signature").withColumnRenamed("conv_id", "c"), "repair-audits")
    zero = F.lit(0).cast("bigint")
    return (ids.join(with_audit, F.col("conv_id").eqNullSafe(F.col("c")), "left")
            .select("conv_id", *[F.coalesce(c, zero).alias(c) for c in _COUNTS], F.coalesce("audit", F.lit("")).alias("audit")))


def _streamed(plan: DataFrame, rows: DataFrame) -> DataFrame:
    """Plans and rows dealt out by conversation: first the plan of a conversation, then its rows in order."""
    both = plan.withColumn("is_row", F.lit(False)).unionByName(rows.withColumn("is_row", F.lit(True)), allowMissingColumns=True)
    columns = ["conv_id", "is_row", *_COUNTS, "audit", "turn", "role", "text"]
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", *_order()).select(*columns)


def _walk(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, event, a, b): "plan" (counts and audit), "turn" (number, null), "D" or an edit "K", "R", "I" (role, text), "end"."""
    now, audit, at, state, open_ = None, "", 0, 0, False

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while audit[at:at + 1] == "I":
            at, state = at + 1, _OTHER[state]
            yield now, "I", "user" if state == 2 else "assistant", ""

    for batch in batches:
        for conv_id, is_row, *plan, turn, role, text in zip(*[c.to_pylist() for c in batch.columns]):
            if not is_row:
                if open_:
                    yield from inserted()
                    yield now, "end", at, len(audit)
                now, audit, at, state, open_ = conv_id, plan[-1], 0, 0, True
                yield now, "plan", plan, None
                continue
            yield now, "turn", turn, None
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "R":
                state = _OTHER[state]
                role = "user" if state == 2 else "assistant"
            elif edit == "K":
                state = _NEXT[state][role[0]]
            yield now, edit, role, text
    if open_:
        yield from inserted()
        yield now, "end", at, len(audit)


_REPAIR = pa.schema([("conv_id", pa.int64()), ("gaps", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])
_TURNS = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def repair(ids: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each of ``ids``: gaps, fault counts, cost, audit, and the SHA-256 of the repaired ``role:text`` lines.

    ``rows``: (conv_id, turn, role, text) without null roles or texts, and (tie_role, tie_text, copy), which order the rows
    of one turn, as ``damaged`` returns them. Null conv_ids are a conversation. A role counts by its first character; an empty
    one is kept nowhere. gaps: missing numbers between the least and largest turn. A hash runs from start to end, so a
    conversation's texts pass through one task, a batch at a time.
    """
    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for conv_id, event, a, b in _walk(batches):
            if event == "plan":
                told, state, first, low, last, distinct = a, hashlib.sha256(), True, None, None, 0
            elif event == "turn":
                if a is not None and a != last:
                    low, last, distinct = a if low is None else low, a, distinct + 1
            elif event == "end":
                if a != b:
                    raise ValueError(f"audit of conversation {conv_id} does not fit its rows")
                gaps = 0 if low is None else last - low + 1 - distinct
                done.append((conv_id, gaps, *told, state.hexdigest()))
                if len(done) >= 10_000:
                    yield _batch(done, _REPAIR)
                    done = []
            elif event != "D":
                state.update(f"{'' if first else chr(10)}{a}:{b}".encode())
                first = False
        yield _batch(done, _REPAIR)

    schema = "conv_id bigint, gaps bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", audit string, repaired_sha256 string"
    return _streamed(stash(plans(ids, rows), "repair-plans"), rows).mapInArrow(digest, schema)


def repaired_turns(ids: DataFrame, rows: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns of the repaired conversations, place counting from 0, edit K, R or I."""
    def turns(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, place, size = [], 0, 0
        for conv_id, event, a, b in _walk(batches):
            if event == "plan":
                place = 0
            elif event in ("K", "R", "I"):
                done.append((conv_id, place, event, a, b))
                place, size = place + 1, size + len(b)
                if size > 1 << 22 or len(done) >= 10_000:
                    yield _batch(done, _TURNS)
                    done, size = [], 0
        yield _batch(done, _TURNS)

    return _streamed(stash(plans(ids, rows), "repair-plans"), rows).mapInArrow(turns, "conv_id bigint, place bigint, edit string, role string, text string")
