"""Document fingerprints by consistent weighted sampling over word counts.

Every term x of a text has a weight w, how often it occurs. It draws r, c ~ Gamma(2, 1) and b ~ U(0, 1) from
hashes of x alone, and with t = floor(ln w / r + b) gets the value

    ln a = ln c - r (t + 1 - b).

Over a set of terms the one with the least a, with its t, is a consistent weighted sample: two texts draw
the same one with the probability of their generalised Jaccard similarity, sum(min w) / sum(max w).

Terms are dealt into SLOTS bins by hash and each bin keeps its sample, so one draw a term yields all
slots. Every bin has one vote, so terms must weigh alike for the votes to: a term of weight w is first cut into the
pieces (x, 0), (x, 1), ... (x, w - 1) of weight 1 (for which t is 0), each a term of its own. Pieces fill in order, so
the sums of minima and maxima, and with them the similarity, stay the same. Of the pieces that either text has in a
bin each is as likely to be the sample, so a bin in use is equal with the probability of the similarity, however few
terms there are. The share of equal slots, among those where either text has a term, estimates it; its variance
is at most s (1 - s) / n, n being the slots in use.

A fingerprint is SLOTS groups of four hex digits, the low bits of ln a of the sample; ``----`` is an empty
bin. All of it is array functions on one row; nothing is exploded and no text is sampled or cut.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import let, stash, words_of

SLOTS = 128  # a bin is the top seven bits of a hash
EMPTY = "----"
_ONE = float(1 << 32)


def _low(h: Column) -> Column:
    """The lower 32 bits of a hash, and a half: over 2**32, a number in (0, 1)."""
    return h.bitwiseAND(F.lit(0xFFFFFFFF)) + 0.5


def _gamma(h: Column) -> Column:
    """Gamma(2, 1) from one hash: minus the logarithm of the product of two uniforms."""
    return 64 * math.log(2) - F.ln(_low(h) * (F.shiftrightunsigned(h, 32) + 0.5))


def _packed(x: Column, piece: Column) -> Column:
    """Bin and ln a of a piece in one bigint that sorts by both."""
    r, c, h = (F.xxhash64(F.lit(n), x, piece) for n in (1, 2, 3))
    b = _low(h) / _ONE
    ln_a = F.ln(_gamma(c)) - _gamma(r) * (1 - b)
    return F.shiftleft(F.shiftrightunsigned(h, 57), 42).bitwiseOR(((ln_a + 512) * _ONE).cast("bigint"))


def with_fingerprints(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds the fingerprint of each text column: ``columns`` maps new names to text columns.

    A null, empty or blank text has no terms and only empty slots; equal texts have equal fingerprints.
    The steps are separate projections, so that arrays that lambdas refer to are computed once a row.
    """
    names = rows.columns

    def step(df: DataFrame, make, drop: bool = False) -> DataFrame:
        kept = names if drop else df.columns
        return df.select(*[F.col(c) for c in kept], *make)

    def per(make) -> list[Column]:
        return [make(i, n, t) for i, (n, t) in enumerate(columns.items())]

    # term hashes in order; then where each run of equal ones begins
    df = step(rows, per(lambda i, n, t: F.sort_array(F.transform(words_of(F.col(t)), lambda w: F.xxhash64(w))).alias(f"__s{i}")))

    def starts(i: int, *_: str) -> Column:
        s = F.col(f"__s{i}")
        return F.when(F.size(s) == 0, F.array().cast("array<int>")).otherwise(F.filter(
            F.sequence(F.lit(0), F.size(s) - 1), lambda k: (k == 0) | (F.get(s, k) != F.get(s, k - 1)))).alias(f"__b{i}")
    df = step(df, per(starts))

    def draws(i: int, *_: str) -> Column:
        s, b = F.col(f"__s{i}"), F.col(f"__b{i}")

        def term(k: Column, j: Column) -> Column:
            return F.struct(F.get(s, k).alias("x"), (F.coalesce(F.get(b, j + 1), F.size(s)) - k).alias("w"))

        def pieces(t: Column) -> Column:
            x, w = t["x"], t["w"]
            cut = F.transform(F.sequence(F.lit(0), w - 1), lambda p: _packed(x, p))
            return F.when(w == 1, F.array(_packed(x, F.lit(0)))).otherwise(cut)
        return F.sort_array(F.flatten(F.transform(F.transform(b, term), pieces))).alias(f"__p{i}")
    df = step(df, per(draws))

    def least(i: int, *_: str) -> Column:
        p = F.col(f"__p{i}")
        return F.filter(p, lambda x, k: (k == 0) | (F.shiftright(x, 42) != F.shiftright(F.get(p, k - 1), 42))).alias(f"__m{i}")
    df = step(df, per(least))

    def written(i: int, name: str, _: str) -> Column:
        m = F.col(f"__m{i}")

        def bin_at(k: Column) -> Column:
            return F.coalesce(F.shiftright(F.get(m, k), 42), F.lit(-1)).cast("int")
        slots = F.transform(m, lambda x, k: F.concat(F.repeat(F.lit(EMPTY), bin_at(k) - bin_at(k - 1) - 1), F.lower(F.right(F.hex(x), F.lit(4)))))
        return F.concat(F.array_join(slots, ""), F.repeat(F.lit(EMPTY), SLOTS - 1 - bin_at(F.size(m) - 1))).alias(name)
    return step(df, per(written), drop=True)


def likeness(a: Column, b: Column) -> Column:
    """Estimated generalised Jaccard similarity of two fingerprints, 0 to 1; two without any term are alike."""
    def slot(f: Column, k: Column) -> Column:
        return F.substring(f, k, F.lit(4))  # of bytes: no counting of characters from the start

    def verdict(k: Column, x: Column, y: Column) -> Column:
        return F.when(slot(x, k) != slot(y, k), 2).when(slot(x, k) == F.lit(EMPTY.encode()), 0).otherwise(1)

    def share(v: Column) -> Column:
        same, used = F.size(F.filter(v, lambda i: i == 1)), F.size(F.filter(v, lambda i: i > 0))
        return F.when(used == 0, 1.0).otherwise(same / used)
    x, y = a.cast("binary"), b.cast("binary")
    return let(F.transform(F.sequence(F.lit(1), F.lit(4 * SLOTS - 3), F.lit(4)), lambda k: verdict(k, x, y)), share)


def successors(ids: DataFrame, per_range: int = 1_000_000) -> DataFrame:
    """(doc_id) without repeats -> (doc_id, next_id): the next in ascending order, after the last the first.

    Ids are dealt into ranges of about ``per_range``; each range is ordered by itself, and the ends meet
    through one row a range. A null id comes first.
    """
    ranges = max(1, -(-ids.count() // per_range))
    dealt = stash(ids.repartitionByRange(ranges, F.col("doc_id").asc_nulls_first()).select("doc_id", F.spark_partition_id().alias("range")), "id-ranges")
    own = Window.partitionBy("range").orderBy(F.col("doc_id").asc_nulls_first())
    inner = dealt.select("doc_id", "range", F.lead(F.struct("doc_id")).over(own).alias("after"))
    ends = dealt.groupBy("range").agg(F.min_by(F.struct("doc_id"), F.coalesce("doc_id", F.lit(-2**63))).alias("first"),
                                      F.max(F.col("doc_id").isNull().cast("int")).alias("null"))
    ends = ends.select("range", F.when(F.col("null") == 1, F.struct(F.lit(None).cast("bigint").alias("doc_id"))).otherwise(F.col("first")).alias("first"))
    order = Window.orderBy("range")
    ring = ends.select("range", F.coalesce(F.lead("first").over(order), F.first("first").over(order.rowsBetween(Window.unboundedPreceding, 0))).alias("beyond"))
    return inner.join(ring, "range").select("doc_id", F.coalesce("after", "beyond")["doc_id"].alias("next_id"))


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprint documents (doc_id, text) and their edited texts, and compare.

    The edited text has its last quarter (rounded down, in code points) replaced by as much of the start
    of the next document, or all of it. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next (likeness to the edited text's and the next document's).
    A null text is empty. Rows may repeat an id: each has its row, and as a next document such an id stands
    for its text with the smallest SHA-256. A single document is its own next.
    """
    base = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = stash(base.groupBy("doc_id").agg(F.max(F.length("text")).alias("n"), F.count("*").alias("rows")), "ids")
    repeated = (ids.agg(F.max("rows")).first()[0] or 0) > 1
    nexts = stash(successors(ids.select("doc_id")), "next-ids")
    one = base.groupBy("doc_id").agg(F.min_by("text", F.sha2("text", 256)).alias("text")) if repeated else base
    wanted = (nexts.join(ids, nexts.doc_id.eqNullSafe(ids.doc_id)).select(
        nexts.doc_id.alias("for_id"), "next_id", F.floor(F.col("n") / 4).cast("int").alias("k")))
    heads = (wanted.join(one, F.col("next_id").eqNullSafe(F.col("doc_id")))
             .select("for_id", "next_id", F.substring("text", F.lit(1), F.col("k")).alias("head")))
    rows = base.join(heads, F.col("doc_id").eqNullSafe(F.col("for_id"))).select(
        "doc_id", "next_id", "text", F.length("text").alias("n"), "head", F.floor(F.length("text") / 4).cast("int").alias("k"))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n") - F.col("k")), F.substring("head", F.lit(1), F.col("k")))
    rows = rows.select("doc_id", "next_id", "text", "n", edited.alias("edited"))
    marked = with_fingerprints(rows, {"fingerprint": "text", "edited_fingerprint": "edited"})
    marked = stash(marked.select("doc_id", "next_id", F.col("n").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                                 *([F.sha2("text", 256).alias("sha")] if repeated else []), "fingerprint", "edited_fingerprint"), "fingerprints")
    if repeated:
        after = marked.groupBy(F.col("doc_id").alias("id")).agg(F.min_by("fingerprint", "sha").alias("next_fingerprint"))
    else:
        after = marked.select(F.col("doc_id").alias("id"), F.col("fingerprint").alias("next_fingerprint"))
    joined = marked.join(after, F.col("next_id").eqNullSafe(F.col("id")))
    return joined.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                         likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                         likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
