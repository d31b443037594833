"""Toxicity by multiple-instance learning: documents carry the labels, sentences the scores.

A sentence scores s = sigmoid(bias + the sum of the weights of its features); a document scores
1 - prod(1 - s) over its sentences (noisy-or), so one bad sentence is enough and the sentence that is to
blame is known. Features are lower-cased words and the first four to six letters of longer words, so
that an inflected form nobody labelled is still caught by its stem.

Fitting: on a bounded sample of labelled documents (``max_labelled``). Document frequencies by label are
grouped counts; features far more frequent in toxic documents are candidates; their weights and the bias
maximise the likelihood of the document labels under the noisy-or. What reaches the driver is counts and
the candidates' positions in the sample's sentences, bounded by the sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import one_label, sample_by_hash, stash

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+")
STEMS = (4, 5, 6)
MAX_LABELLED = 20_000


def features_of(word: str) -> list[str]:
    """The word itself and, marked by a trailing star, its longer beginnings."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


def document_features(text: str | None) -> set[str]:
    return {f for w in set(WORD.findall((text or "").lower())) for f in features_of(w)}


@dataclass
class Model:
    bias: float = -20.0
    weights: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.whole = {f for f in self.weights if not f.endswith("*")}
        self.roots = {f[:STEMS[0]] for f in self.weights if f.endswith("*")}

    def suspects(self, words: set[str]) -> set[str]:
        """The words that can have a feature with a weight."""
        out = words & self.whole
        if not self.roots.isdisjoint(beginnings := {w[:STEMS[0]] for w in words}):
            near = self.roots & beginnings
            out |= {w for w in words if w[:STEMS[0]] in near}
        return out

    def weigh(self, words: set[str]) -> float:
        return sum(self.weights.get(f, 0.0) for w in self.suspects(words) for f in features_of(w))

    def score(self, text: str | None, threshold: float = 0.5) -> tuple[float, list[tuple[int, int, float]]]:
        """(document score, offending sentences as (start, end, score), in code points, end exclusive)."""
        text = text or ""
        if not self.suspects(set(WORD.findall(text.lower()))):
            n = sum(not s.isspace() for s in SENTENCE.findall(text))
            return float(-np.expm1(-n * np.logaddexp(0.0, self.bias))), []
        clear, found = 0.0, []
        for m in SENTENCE.finditer(text):
            if m.group().isspace():
                continue
            z = self.bias + self.weigh(set(WORD.findall(m.group().lower())))
            clear += np.logaddexp(0.0, z)
            p = float(1.0 / (1.0 + np.exp(-z)))
            if p >= threshold:
                found.append((m.start(), m.end(), p))
        return float(-np.expm1(-clear)), found


def _noisy_or_fit(bags: pd.DataFrame, vocab: list[str], start: np.ndarray, rounds: int = 400, rate: float = 0.1,
                  decay: float = 1e-3, top_bias: float = -10.0) -> Model:
    """Adam on the document likelihood. ``bags``: y, n (sentences), hits (per hit sentence, feature ids)."""
    y = bags["y"].to_numpy(dtype=float)
    n = bags["n"].to_numpy(dtype=float)
    doc, sent, feat, k = [], [], [], 0
    for d, hits in enumerate(bags["hits"]):
        for h in hits:
            doc.append(d)
            sent.extend([k] * len(h))
            feat.extend(h)
            k += 1
    doc, sent, feat = np.array(doc, dtype=int), np.array(sent, dtype=int), np.array(feat, dtype=int)
    plain = n - np.bincount(doc, minlength=len(y))
    w, b = start.copy(), top_bias
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, rounds + 1):
        z = b + np.bincount(sent, weights=w[feat], minlength=k)
        clear = plain * np.logaddexp(0.0, b) + np.bincount(doc, weights=np.logaddexp(0.0, z), minlength=len(y))
        odds = np.clip(np.exp(-clear) / np.maximum(-np.expm1(-clear), 1e-9), 0, 1e4)  # (1 - P) / P
        slope = np.where(y > 0, odds, -1.0)  # of the log likelihood by ``clear``
        s = 1.0 / (1.0 + np.exp(-z))
        by_sentence = slope[doc] * s
        g_w = np.bincount(feat, weights=by_sentence[sent], minlength=len(w)) - decay * len(y) * 1e-2 * w
        g_b = by_sentence.sum() + (slope * plain).sum() / (1.0 + np.exp(-b))
        g = np.append(g_w, g_b) / max(1.0, y.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w + move[:-1], min(b + move[-1], top_bias)
    return Model(float(b), {f: float(x) for f, x in zip(vocab, w) if abs(x) > 1e-3})


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, min_toxic: int = 3,
        min_lift: float = 8.0) -> Model:
    """Fit on at most about ``max_labelled`` documents of (doc_id, text) with a label (doc_id, toxic).

    A feature is a candidate if ``min_toxic`` toxic documents have it and its smoothed share of the toxic
    documents is ``min_lift`` times its share of the others. Null ids, labels and texts are left out;
    an empty sample, or one without toxic documents, gives a model that scores everything near zero.
    """
    chosen = sample_by_hash(one_label(labels, "toxic"), "doc_id", max_labelled)
    text = docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text")).filter("__text is not null")
    bags = stash(text.join(F.broadcast(chosen), F.col("__id") == F.col("doc_id"))  # bounded by max_labelled
                 .select(F.col("__text").alias("text"), (F.col("y") > 0).cast("int").alias("y"))
                 .repartition(docs.sparkSession.sparkContext.defaultParallelism), "toxic-sample")
    n_all, n_toxic = bags.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not n_toxic:
        return Model()

    def toxic_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"f": [f for t in batch["text"] for f in document_features(t)]}, dtype=object)

    common = (bags.filter("y = 1").mapInPandas(toxic_features, "f string").groupBy("f")
              .agg(F.count("*").alias("n")).filter(F.col("n") >= min_toxic))
    in_toxic = {r.f: r.n for r in common.toLocalIterator()}

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"f": [f for t in batch["text"] for f in document_features(t) if f in in_toxic]}, dtype=object)

    in_rest = {r.f: r.n for r in bags.filter("y = 0").mapInPandas(counts, "f string").groupBy("f")
               .agg(F.count("*").alias("n")).toLocalIterator()}

    def lift(f: str) -> float:
        return (in_toxic[f] / n_toxic) / ((in_rest.get(f, 0) + 0.5) / (n_all - n_toxic + 1))

    vocab = sorted(f for f in in_toxic if lift(f) >= min_lift)
    number = {f: i for i, f in enumerate(vocab)}

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t, y in zip(batch["text"], batch["y"]):
                sentences = [s for s in SENTENCE.findall(t) if not s.isspace()]
                marked = [[number[f] for f in document_features(s) if f in number] for s in sentences]
                rows.append((y, len(sentences), [h for h in marked if h]))
            yield pd.DataFrame(rows, columns=["y", "n", "hits"])

    seen = bags.mapInPandas(hits, "y int, n long, hits array<array<int>>").toPandas()
    return _noisy_or_fit(seen, vocab, np.array([np.log(lift(f)) for f in vocab]))


def scored(text: Column, model: Model, threshold: float = 0.5) -> Column:
    """struct(score double, offending array<struct<start int, end int, score double>>) of a text.

    The score is in [0, 1]; a null, empty or blank text has no sentence and scores 0.
    """
    @F.pandas_udf("score double, offending array<struct<start:int,end:int,score:double>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.score(t, threshold) for t in texts], columns=["score", "offending"])
    return run(F.coalesce(text, F.lit("")))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a document is kept from training: crc32 of its id as text is divisible by ``folds``."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))
