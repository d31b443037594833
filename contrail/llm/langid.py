"""Language identification by Bayesian fusion of text, declared language, address and host.

For a record with evidence t (text), d (declared markup language), a (address suffix) and h (host):

    P(l | t, d, a, h)  is proportional to  P(l | h) P(t | l) P(d | l) P(a | l)

* P(t | l): naive Bayes over hashed byte trigrams, fitted on a bounded sample of documents whose language
  is known (``max_labelled``). Neighbouring trigrams repeat each other's evidence, so the log likelihood
  is tempered to at most ``MAX_EVIDENCE`` trigrams' worth.
* P(d | l), P(a | l): from the whole table, counts of each declared value weighted by the text posterior.
* P(l | h): shares of the host, smoothed towards its domain, smoothed towards the whole table; grouped
  sums of the text posteriors. Every record counts, and one hot host is summed map-side first.

Only scoring of texts runs in Python, over Arrow batches; the fusion is joins and grouped sums.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import sample_by_hash, stash
from contrail.llm.urlfilter import host_of

BUCKETS = 1 << 16
MAX_LABELLED = 8_000
MAX_EVIDENCE = 40.0
UNKNOWN = "und"
_CHUNK = 1 << 20
_HIDDEN = re.compile(r"<(script|style)\b", re.I)
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style")}
#: Languages that a text model knows at most: those with the most rows of the sample.
MAX_LANGS = 256


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Hashed byte trigrams of the lower-cased text with its runs of non-letters made one space."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)
    for i in range(0, len(raw), _CHUNK):
        b = raw[i:i + _CHUNK + 2]
        letter = (b >= 128) | ((b >= 97) & (b <= 122))
        b = np.where(letter, b, 32).astype(np.uint32)
        b = np.concatenate([[32], b[(b != 32) | np.roll(letter, 1)], [32]]).astype(np.uint32)
        if len(b) > 3:
            yield ((b[:-2] * 0x1F35 + b[1:-1] * 0x2F0B + b[2:] * 0x0115) * np.uint32(2654435761)) >> np.uint32(16)


def visible_text(html: str | None) -> str:
    """Text of a page: scripts, styles, comments and tags cut out, entities resolved.

    One pass: what opens without an end is looked for once, and from then on taken as a tag, or as text without a ``>``.
    """
    html, at, out, endless = html or "", 0, [], set()
    while (i := html.find("<", at)) >= 0:
        end = -1
        hidden = _HIDDEN.match(html, i)
        kind = hidden[1].lower() if hidden else "<!--" if html.startswith("<!--", i) else None
        if kind and kind not in endless:
            if hidden:
                close = _CLOSE[kind].search(html, hidden.end())
                end = close.end() if close else -1
            else:
                end = html.find("-->", i + 4) + 3 if html.find("-->", i + 4) >= 0 else -1
            if end < 0:
                endless.add(kind)
        if end < 0:
            end = html.find(">", i) + 1
        if end <= 0:
            break
        out += (html[at:i], " ")
        at = end
    out.append(html[at:])
    return html_lib.unescape("".join(out))


@dataclass
class TextModel:
    """log P(trigram | language); the last language is ``und``, for which all trigrams are alike."""

    langs: list[str]
    table: np.ndarray  # BUCKETS x languages, float32

    def log_likelihood(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.langs)), 0
        for g in trigrams(text):
            total += self.table[g].sum(axis=0, dtype=np.float64)
            n += len(g)
        return total * (min(n, MAX_EVIDENCE) / n if n else 0.0)


def fit_text(docs: DataFrame, max_labelled: int = MAX_LABELLED, max_langs: int = MAX_LANGS) -> TextModel:
    """Trigram counts by language of at most about ``max_labelled`` rows (doc_id, text, lang), chosen by a hash of id and text.

    Rows without a text or language are left out, as are languages beyond the ``max_langs`` with the most
    rows of the sample (ties by name). Counts are summed in each partition, then by Spark; at most BUCKETS x ``max_langs``
    numbers reach the driver. Without any row only ``und`` is known.
    """
    key = F.xxhash64("doc_id", "text") if "doc_id" in docs.columns else F.xxhash64("text")
    known = docs.select(key.alias("key"), F.col("text").alias("text"), F.lower("lang").alias("lang")).filter("text <> '' and lang <> ''")
    rows = sample_by_hash(known, "key", max_labelled).select("text", "lang")
    common = [r.lang for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).collect()]
    rows = rows.filter(F.col("lang").isin(common)).repartition(docs.sparkSession.sparkContext.defaultParallelism)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                n, held = np.zeros(BUCKETS, dtype=np.int64), []
                for g in (g for t in texts for g in trigrams(t)):
                    held.append(g)
                    if len(held) >= 500 or len(g) >= _CHUNK:
                        n += np.bincount(np.concatenate(held), minlength=BUCKETS)
                        held = []
                if held:
                    n += np.bincount(np.concatenate(held), minlength=BUCKETS)
                at = np.flatnonzero(n)
                yield pd.DataFrame({"lang": lang, "gram": at, "n": n[at]})

    sums = rows.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(sums["lang"].unique()) if len(sums) else []
    table = np.full((BUCKETS, len(langs) + 1), 0.5)
    for i, lang in enumerate(langs):
        own = sums[sums["lang"] == lang]
        table[own["gram"], i] += own["n"]
    table[:, -1] = 1.0
    return TextModel([*langs, UNKNOWN], np.log(table / table.sum(axis=0)).astype(np.float32))


def text_scores(text: Column, model: TextModel, markup: bool = False) -> Column:
    """array<double> of tempered log likelihoods in the order of ``model.langs``; zeros without letters."""
    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([model.log_likelihood(visible_text(t) if markup else t) for t in texts])
    return run(F.coalesce(text, F.lit("")))


def domain_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def suffix_of(url: Column) -> Column:
    """Language hint of an address: a first path segment such as /fr/ or /pt-br/, else the last host label."""
    first = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:]+://[^/?#]+/([A-Za-z]{2})(?:-[A-Za-z]{2})?(?:[/?#]|$)", 1))
    return F.when(first != "", F.concat(F.lit("/"), first)).otherwise(F.concat(F.lit("."), F.substring_index(host_of(url), ".", -1)))


def declared_of(html: Column) -> Column:
    """The language that a page's html element declares, without its region; empty if none."""
    return F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})""", 1))


def _softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    e = F.transform(scores, lambda x: F.exp(x - top))
    total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return F.transform(e, lambda x: x / total)


def _sums(p: str, k: int) -> list[Column]:
    return [F.sum(F.get(p, i)).alias(f"s{i}") for i in range(k)]


def _array(k: int) -> Column:
    return F.array(*[F.col(f"s{i}") for i in range(k)])


def fuse(records: DataFrame, langs: list[str], host_weight: float = 10.0, domain_weight: float = 10.0,
         smoothing: float = 1.0) -> DataFrame:
    """Posterior for records (id, text_ll array<double>, declared, suffix, host, domain) -> adds ``posterior``.

    A null or empty declared, suffix, host or domain is a value of its own and carries what its counts
    say. ``host_weight`` and ``domain_weight`` are how many records' worth of trust the level above gets.
    Records may repeat; an empty table stays empty. ``records`` is read several times: pass a written table.
    """
    k = len(langs)
    for c in ("declared", "suffix", "host", "domain"):
        records = records.withColumn(c, F.coalesce(c, F.lit("")))
    own = records.withColumn("p", _softmax(F.col("text_ll")))
    mass = [x or 0.0 for x in own.agg(*_sums("p", k)).first()]  # of each language, over the whole table
    prior = F.array(*[F.lit((x + 1.0) / (sum(mass) + k)) for x in mass])

    def smoothed(counts: Column, above: Column, weight: float) -> Column:
        n = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(counts, above, lambda c, q: (c + weight * q) / (n + weight))

    # both written first: the join then stands alone, and Spark can split a domain with very many hosts
    hosts = stash(own.groupBy("domain", "host").agg(*_sums("p", k)).select("domain", "host", _array(k).alias("hc")), "host-sums")
    domains = stash(hosts.groupBy("domain").agg(*_sums("hc", k))
                    .select("domain", smoothed(_array(k), prior, domain_weight).alias("dp")), "domain-sums")
    hosts = stash(hosts.join(domains, "domain").select("domain", "host", smoothed(F.col("hc"), F.col("dp"), host_weight).alias("hp")), "host-priors")

    def channel(name: str) -> DataFrame:
        """log P(value | language): weighted counts, so many as the column has values."""
        counts = own.groupBy(name).agg(*_sums("p", k)).select(name, _array(k).alias("c"))
        values = counts.count()
        base = F.array(*[F.lit(m + smoothing * values) for m in mass])
        return stash(counts.select(name, F.zip_with("c", base, lambda c, m: F.log((c + smoothing) / m)).alias(f"{name}_ll")), f"{name}-likelihood")

    out = records
    for name in ("declared", "suffix"):
        out = out.join(channel(name), name)
    out = out.join(hosts, ["domain", "host"])
    logs = [F.col("text_ll"), F.col("declared_ll"), F.col("suffix_ll"), F.transform("hp", lambda x: F.log(x))]
    joint = logs[0]
    for more in logs[1:]:
        joint = F.zip_with(joint, more, lambda a, b: a + b)
    return out.withColumn("posterior", _softmax(joint)).drop("declared_ll", "suffix_ll", "hp")


def identify(records: DataFrame, langs: list[str], **weights: float) -> DataFrame:
    """fuse(), plus ``lang`` (the likeliest; the first in order on ties) and its ``confidence``."""
    names = F.array(*map(F.lit, langs))
    best = F.array_max("posterior")
    return (fuse(records, langs, **weights)
            .withColumn("lang", F.get(names, (F.array_position("posterior", best) - 1).cast("int")))
            .withColumn("confidence", best))
