"""Secret scans over every historical version of a text, with an incremental blob ledger.

A version's blob is the SHA-256 of its text. The ledger is a Parquet table of (blob, rule versions
scanned, spans found). A scan looks up which (blob, rule version) pairs the ledger lacks, reads one text
for each such blob, applies only the missing rules, appends to the ledger, and joins the findings back to
every path that holds the blob. Raising a rule's version rescans every blob for that rule alone.

Spans are in code points, end exclusive. Everything is built-in SQL functions: the texts between matches
(split) and the matches (regexp_extract_all) give the lengths whose running sum is the positions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import let, stash

LEDGER_SCHEMA = "blob string, scanned array<string>, spans array<struct<start:int,rank:int,end:int,rule:string>>"
_BLOCK = 256


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; those whose ``group`` is shorter than ``least`` go.

    ``needle``: a literal that every match holds, for a cheap test first.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1
    needle: str | None = None

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base rules, in the order that ties at one start are listed in.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18, needle="AKIA"),
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)
#: Formats that announce themselves, beside the base rules.
VENDOR_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", least=40, needle="gh"),
    # starts where a run of its characters does, and takes runs whole: a long text is read once
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", needle="eyJ", version=2),
    # the matcher goes one call deeper for each repetition of a group, so their number is bounded
    Rule("pem", r"-----BEGIN (?:[A-Z0-9]{1,16} ){0,4}PRIVATE KEY-----", needle="PRIVATE KEY", version=2),
)
RULES = BASE_RULES + VENDOR_RULES


def blob_of(text: Column) -> Column:
    """Content address: SHA-256 of the UTF-8 text in hex; a null text is an empty one."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _found(text: Column, rule: Rule, rank: int) -> Column:
    pattern = F.lit(rule.pattern)
    hits, values = F.regexp_extract_all(text, pattern, F.lit(0)), F.regexp_extract_all(text, pattern, F.lit(rule.group))
    none_yet = F.array().cast("array<struct<start:int,rank:int,end:int,ok:boolean>>")

    def lengths(h: Column) -> Column:
        gaps = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(h))
        return F.transform(F.arrays_zip(h.alias("h"), values.alias("v"), gaps.alias("g")), lambda x: F.struct(
            F.length(x["g"]).alias("g"), F.length(x["h"]).alias("h"), F.length(x["v"]).alias("v")))

    def step(acc: Column, x: Column) -> Column:
        start, end = acc["at"] + x["g"], acc["at"] + x["g"] + x["h"]
        one = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), (x["v"] >= rule.least).alias("ok"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    # running sums in blocks, so that a text with very many matches is not copied once for each
    def blocks(all_hits: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(all_hits) - 1) / _BLOCK).cast("int")),
                           lambda b: F.slice(all_hits, b * _BLOCK + 1, F.lit(_BLOCK)))

    def spans(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda n, x: n + x["g"] + x["h"]))
        begin = F.aggregate(sums, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), F.slice(begin, F.lit(1), F.size(blocks)).alias("s")),
                                     lambda z: F.aggregate(z["b"], F.struct(z["s"].alias("at"), none_yet.alias("out")), step)["out"]))

    hit = let(hits, lengths)
    kept = F.transform(F.filter(let(let(hit, blocks), spans), lambda s: s["ok"]),
                       lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), F.lit(rule.id).alias("rule")))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,rule:string>>")
    seen = text.rlike(rule.pattern)
    return F.when(seen if rule.needle is None else text.contains(rule.needle) & seen, kept).otherwise(none)


def spans_of(text: Column, rules: tuple[Rule, ...] = RULES, only: Column | None = None) -> Column:
    """All spans of a text that is not null, by rule; ``only``: array of the rule ids to apply."""
    none = F.array().cast("array<struct<start:int,rank:int,end:int,rule:string>>")
    each = [_found(text, r, i) for i, r in enumerate(rules)]
    if only is not None:
        each = [F.when(F.array_contains(only, r.id), e).otherwise(none) for r, e in zip(rules, each)]
    return F.concat(*each)


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger table at ``path``; created empty if there is none."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    spark.createDataFrame([], LEDGER_SCHEMA).write.parquet(path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def scan(versions: DataFrame, keys: list[str], ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger lacks and append it; returns the path index (keys..., blob) of ``versions``.

    ``versions``: one row for each historical version, ``keys`` naming its path and version, and ``text``
    (null: empty). Rows may repeat and keys may be null. With nothing unseen no text is scanned.
    """
    spark = versions.sparkSession
    v = versions.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.coalesce("text", F.lit("")).alias("t"))
    v = v.withColumn("blob", blob_of(F.col("t")))
    names = [f"k{i}" for i in range(len(keys))]
    index = stash(v.select(*names, "blob"), "paths")
    done = (open_ledger(spark, ledger).groupBy("blob")
            .agg(F.array_distinct(F.flatten(F.collect_set("scanned"))).alias("scanned")))  # as many as rule versions
    wanted = F.array(*[F.lit(r.id) for r in rules])
    todo = (index.groupBy("blob").agg(F.min(F.struct(*names)).alias("at")).join(done, "blob", "left")
            .select(F.col("blob").alias("b"), *[F.col(f"at.{n}").alias(f"r{n}") for n in names],
                    F.array_except(wanted, F.coalesce("scanned", F.array().cast("array<string>"))).alias("missing"))
            .filter(F.size("missing") > 0))
    same = F.col("blob") == F.col("b")
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"r{n}"))
    (v.join(todo, same).select("blob", F.col("missing").alias("scanned"), spans_of(F.col("t"), rules, F.col("missing")).alias("spans"))
     .write.mode("append").parquet(ledger))
    return index.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], "blob")


def findings(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans) of the blobs where the current versions of ``rules`` found something, by start and rule."""
    current = [r.id for r in rules]
    own = F.filter("spans", lambda s: s["rule"].isin(*current))
    rank = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, current)), s["rule"]).cast("int").alias("rank"),
        s["end"].alias("end"), s["rule"].alias("rule")))
    return (open_ledger(spark, ledger).select("blob", own.alias("spans")).filter(F.size("spans") > 0)
            .groupBy("blob").agg(F.flatten(F.collect_set("spans")).alias("spans"))  # a row for each scan of the blob
            .select("blob", rank.alias("spans")).select("blob", F.array_sort(F.array_distinct("spans")).alias("spans")))


def by_path(index: DataFrame, found: DataFrame) -> DataFrame:
    """The path index with ``spans`` joined back to all paths of a blob; empty where nothing was found.

    The findings are written first: the join then stands alone, and Spark can split a blob with very many paths.
    """
    found = stash(found, "findings")
    none = F.array().cast("array<struct<start:int,rank:int,end:int,rule:string>>")
    return index.join(found, "blob", "left").withColumn("spans", F.coalesce("spans", none))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.substring_index(s["rule"], "@", 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every stretch that sorted ``spans`` cover, overlapping or not, replaced by one mask."""
    def step(acc: Column, s: Column) -> Column:
        before = F.when(s["start"] >= acc["at"], F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))).otherwise("")
        return F.when(s["end"] <= acc["at"], acc).otherwise(
            F.struct(s["end"].alias("at"), F.concat(acc["out"], before).alias("out")))
    walked = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    return let(walked, lambda w: F.concat(w["out"], F.substring(text, w["at"] + 1, F.length(text))))
