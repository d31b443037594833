"""Quality rules: text statistics, fixed base rules, and a decision list learned by sequential covering.

The list is a sequence of conjunctions of thresholds on the statistics ("rejected if symbols per word > a
and words per line <= b"), the first that holds decides, and a document that none holds for is kept. It is
grown and pruned on labelled documents: on the growing part, conditions are added while they gain the most
information; on the pruning part, the conjunction is cut back to the prefix that covers the most bad documents
less good ones, of those precise enough; if none is, the list ends. Documents a rule covers leave before the next.

Every step is one grouped count over binned statistics, so at most features x bins rows reach the driver,
however many documents are labelled. The result is an ordered Spark conditional expression. Only
DataFrame functions are used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import let, one_label, sample_by_hash, stash, words_of

MAX_LABELLED = 20_000
BINS = 64
FEATURES = ("words", "word_length", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share",
            "marks_per_word", "words_per_line", "digit_share")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_digits",
          "n_lines", "n_chars")
_SMALL = 32  # so many repeated windows are looked up one by one; more are found by sorting; same result


def _repeated(h: Column) -> Column:
    """Positions whose value occurs twice or more in an array<bigint>, ascending."""
    def differ(a: Column, b: Column) -> Column:
        return F.coalesce(a != b, F.lit(True))  # beyond either end there is nothing to equal

    def few(twice: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: F.array_contains(twice, F.get(h, i)))

    def many(pairs: Column) -> Column:
        return F.sort_array(F.transform(F.filter(pairs, lambda p, j: ~(
            differ(F.get(pairs, j - 1)["x"], p["x"]) & differ(F.get(pairs, j + 1)["x"], p["x"]))), lambda p: p["i"]))

    def found(twice: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return F.when(F.size(twice) <= _SMALL, few(twice)).otherwise(let(pairs, many))

    twice = let(F.sort_array(h), lambda o: F.array_distinct(F.filter(o, lambda x, i: (i > 0) & (x == F.get(o, i - 1)))))
    return F.when(F.size(F.array_distinct(h)) == F.size(h), F.array().cast("array<int>")).otherwise(let(twice, found))


def statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Counts (bigint, named as in ``COUNTS``) for each row of documents with a ``text``, beside columns ``keep``.

    n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words are as the base rules define them; the
    others feed the learned rules. A null text has no words and no lines. A window of three words is
    compared by its 64-bit hash within its own text. ``keep`` must not name a count. Write the result
    before filtering on it: a filter pushed below would compute the counts anew.
    """
    names = [F.col(c) for c in keep]
    text = F.coalesce("text", F.lit("")).alias("__t")
    split = docs.select(*names, text, words_of(F.col("text")).alias("__w"),
                        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__l"))
    w, t = F.col("__w"), F.col("__t")
    hashed = split.select("*", F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))).alias("__h"))
    hits = hashed.withColumn("__r", _repeated(F.col("__h")))
    covered = F.aggregate("__r", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), lambda a, i: F.struct(
        (i + 3).alias("end"), (a["n"] + i + 3 - F.greatest(a["end"], i)).alias("n")))["n"]
    counts = (F.size("__w"), F.length(F.array_join("__w", "")), F.regexp_count(t, F.lit(r"[#*$%&|<>]")),
              F.size("__l") - F.size(F.array_distinct("__l")), covered, F.regexp_count(t, F.lit("[A-Z]")),
              F.regexp_count(t, F.lit("[!?]")), F.regexp_count(t, F.lit("[0-9]")), F.size("__l"), F.length(t))
    return hits.select(*names, *[c.cast("bigint").alias(n) for n, c in zip(COUNTS, counts)])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features() -> dict[str, Column]:
    """The statistics as ratios, each a double and 0 where there is nothing to divide by."""
    def per(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return dict(zip(FEATURES, (F.col("n_words").cast("double"), per("word_chars", "n_words"), per("n_symbols", "n_words"),
                               per("n_dup_lines", "n_lines"), per("n_repeat_words", "n_words"), per("n_upper", "n_chars"),
                               per("n_marks", "n_words"), per("n_words", "n_lines"), per("n_digits", "n_chars"))))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float
    bin: int

    def holds(self) -> Column:
        x = features()[self.feature]
        return x > self.threshold if self.above else x <= self.threshold

    def holds_binned(self) -> Column:
        x = F.get("bins", FEATURES.index(self.feature))
        return x > self.bin if self.above else x <= self.bin

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _all(conditions: Rule) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.holds_binned()
    return out


def _grow(rows: DataFrame, cuts: list[list[float]], max_conditions: int) -> Rule:
    rule: Rule = ()
    while len(rule) < max_conditions:
        table = (rows.filter(_all(rule)).select("bad", F.posexplode("bins").alias("f", "bin")).groupBy("f", "bin")
                 .agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect())  # features x bins at most
        total_p = sum(r.p for r in table if r.f == 0)
        total_n = sum(r.n for r in table if r.f == 0)
        if not total_p or not total_n:
            break
        best = (0.0, None)
        for f, name in enumerate(FEATURES):
            p = n = 0
            for r in sorted((r for r in table if r.f == f), key=lambda r: r.bin)[:-1]:
                p, n = p + r.p, n + r.n
                for above, a, b in ((False, p, n), (True, total_p - p, total_n - n)):
                    if a:
                        gain = a * (math.log2(a / (a + b)) - math.log2(total_p / (total_p + total_n)))
                        best = max(best, (gain, Condition(name, above, cuts[f][r.bin], r.bin)), key=lambda x: x[0])
        if best[1] is None:
            break
        rule = (*rule, best[1])
    return rule


def _widened(rule: Rule, counted: DataFrame) -> Rule:
    """Thresholds halfway between the value they were learned at and the next larger one seen."""
    above = counted.agg(*[F.min(F.when(F.col(c.feature) > c.threshold, F.col(c.feature))) for c in rule]).first()
    return tuple(replace(c, threshold=c.threshold if x is None else (c.threshold + x) / 2) for c, x in zip(rule, above))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_rules: int = 8, max_conditions: int = 4,
        min_precision: float = 0.95, min_covered: int = 5) -> list[Rule]:
    """Learn the list from (doc_id, text) and labels (doc_id, quality: 1 good, 0 bad).

    At most about ``max_labelled`` labelled documents are used, chosen by hash; those that the base rules
    reject anyway, and null ids, labels and texts, are left out. A rule joins the list if at least
    ``min_precision`` of the pruning documents it covers are bad and it covers ``min_covered`` or more.
    Without labelled documents of both kinds the list is empty and keeps everything.
    """
    chosen = sample_by_hash(one_label(labels, "quality"), "doc_id", max_labelled)
    text = docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("text")).filter("text is not null")
    sample = text.join(F.broadcast(chosen), F.col("__id") == F.col("doc_id")).select("__id", "text", "y")  # bounded by max_labelled
    sample = sample.repartition(docs.sparkSession.sparkContext.defaultParallelism)
    counted = stash(statistics(sample, ["__id", "y"]), "quality-counts").filter(~base_failed())
    marked = counted.select((F.col("y") <= 0).cast("int").alias("bad"), F.pmod(F.xxhash64("__id"), F.lit(3)).alias("part"),
                            *[c.alias(n) for n, c in features().items()])
    shares = [i / BINS for i in range(1, BINS)]
    found = marked.agg(*[F.percentile_approx(n, shares, 10_000).alias(n) for n in FEATURES]).first()
    cuts = [sorted(set(found[n] or [])) for n in FEATURES]

    def bin_of(name: str, cut: list[float]) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cut)), lambda t: F.col(name) > t)) if cut else F.lit(0)

    bins = F.array(*map(bin_of, FEATURES, cuts))
    rows = stash(marked.select("bad", "part", bins.alias("bins")).coalesce(8), "quality-bins")
    rules: list[Rule] = []
    while len(rules) < max_rules:
        rule = _grow(rows.filter("part <> 0"), cuts, max_conditions)
        if not rule:
            break
        sums = [x for i in range(1, len(rule) + 1) for x in (
            F.coalesce(F.sum(F.when(_all(rule[:i]), F.col("bad"))), F.lit(0)), F.count(F.when(_all(rule[:i]), 1)))]
        got = rows.filter("part = 0").agg(*sums).first()
        bad, covered = list(got[0::2]), list(got[1::2])
        good_enough = [i for i in range(len(rule)) if covered[i] >= min_covered and bad[i] >= min_precision * covered[i]]
        if not good_enough:
            break
        keep = max(good_enough, key=lambda i: (2 * bad[i] - covered[i], -i))  # bad less good ones covered
        rules.append(_widened(rule[:keep + 1], marked))
        rows = rows.filter(~_all(rule[:keep + 1]))
    return rules


def deciding_rule(rules: list[Rule]) -> Column:
    """Over the counts: number, from 1, of the first rule that holds; 0 if none does and the document is kept."""
    out = F.lit(0)
    for i, rule in reversed(list(enumerate(rules, 1))):
        holds = F.lit(True)
        for c in rule:
            holds = holds & c.holds()
        out = F.when(holds, F.lit(i)).otherwise(out)
    return out
