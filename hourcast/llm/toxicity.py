"""Toxicity by non-negative positive-unlabelled learning (numpy).

A linear classifier over hashed words and word beginnings is trained from
confirmed toxic documents and unlabelled text.  Its risk is estimated with the
class prior: ``prior * E_toxic[l(g, +)] + max(0, E_unlabelled[l(g, -)] - prior *
E_toxic[l(g, -)])`` with the sigmoid loss, which is bounded; where the bracket is
negative only its own gradient is stepped back, so the risk never goes below zero.

Training reads a bounded, seeded sample (``MAX_TOXIC`` and ``MAX_UNLABELLED``
documents, by the order of a hash); scoring reads every whole text.

Defined results: a null or empty text has no features and gets the bias's
score.  Without toxic rows to learn from, every score is the prior's or 0.
Labels with a null ``toxic`` count as unlabelled; repeated label rows count once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytehash import chunks, lower_table, words_and_prefixes
from .common import materialise

MAX_TOXIC = 3000
MAX_UNLABELLED = 9000
BUCKETS = 1 << 22
PREFIXES = (4, 5, 6)
MIN_TOXIC_DOCS = 4
MIN_PURITY = 0.6
RATE = 1.0
BIAS_RANGE = 2.0
STEPS = 400
SEED = 31


def letters_only() -> np.ndarray:
    """Separator table: all but ASCII letters and the bytes of other characters."""
    t = np.ones(256, bool)
    t[65:91] = t[97:123] = False
    t[128:] = False
    return t


def features(texts: list) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the text, distinct feature buckets) per chunk: (first, buckets, bounds)."""
    sep, fold = letters_only(), lower_table()
    for first, part in chunks(texts):
        hashes, owners = words_and_prefixes(part, sep, fold, PREFIXES)
        yield first, (hashes % np.uint64(BUCKETS)).astype(np.int64), owners


def fold_of(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4))


@dataclass
class Model:
    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: list) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        if len(self.buckets):
            for first, b, owner in features(texts):
                at = np.searchsorted(self.buckets, b)
                hit = np.flatnonzero(self.buckets[np.minimum(at, len(self.buckets) - 1)] == b)
                pair = np.unique(owner[hit] * np.int64(len(self.buckets)) + at[hit])
                np.add.at(out, first + pair // len(self.buckets), self.weights[pair % len(self.buckets)])
        return 1 / (1 + np.exp(-np.clip(out, -50, 50)))


def risk(xp: tuple, xu: tuple, w: np.ndarray, c: float, prior: float) -> tuple[float, np.ndarray]:
    """The non-negative PU risk under the sigmoid loss of weights ``w`` and bias ``c``, and what a
    step goes against: its gradient in (w, c), or, where the bracket is below zero, the
    gradient of the bracket taken away.  Texts are (features, texts that have them, number)."""
    def margin(x):
        return c + np.bincount(x[1], weights=w[x[0]], minlength=x[2])

    def back(x, g):
        return np.append(np.bincount(x[0], weights=g[x[1]], minlength=len(w)), g.sum())

    sp, su = (1 / (1 + np.exp(-np.clip(margin(x), -50, 50))) for x in (xp, xu))
    slope_p, slope_u = back(xp, prior * sp * (1 - sp) / len(sp)), back(xu, su * (1 - su) / len(su))
    negative = su.mean() - prior * sp.mean()
    value = prior * (1 - sp).mean() + max(negative, 0.0)
    # The loss of toxic text falls by slope_p; the bracket grows by slope_u - slope_p.
    return float(value), slope_p - slope_u if negative < 0 else slope_u - 2 * slope_p


def fit_pu(toxic: list, unlabelled: list, prior: float, steps: int = STEPS, seed: int = SEED) -> Model:
    """A linear model of least non-negative PU risk on the features that are found in at
    least ``MIN_TOXIC_DOCS`` toxic texts, and in unlabelled ones no oftener than if
    ``MIN_PURITY`` of the texts with it were toxic."""
    def distinct(texts):
        pairs = [np.unique((first + owner) * np.int64(BUCKETS) + b) for first, b, owner in features(texts)]
        pairs = np.concatenate(pairs) if pairs else np.zeros(0, np.int64)
        return pairs // BUCKETS, pairs % BUCKETS

    prior = min(max(prior, 1e-6), 1 - 1e-6)
    bias = float(np.log(prior / (1 - prior)))
    none = Model(np.zeros(0, np.int64), np.zeros(0), bias if toxic else -50.0)
    if not toxic or not unlabelled:
        return none
    (ip, bp), (iu, bu) = distinct(toxic), distinct(unlabelled)
    keys, cp = np.unique(bp, return_counts=True)
    ku, cu = np.unique(bu, return_counts=True)
    at = np.minimum(np.searchsorted(ku, keys), max(len(ku) - 1, 0))
    seen = np.where(ku[at] == keys, cu[at], 0) if len(ku) else np.zeros(len(keys))
    ratio = (cp / len(toxic)) / ((seen + 0.5) / len(unlabelled))
    keys = keys[(cp >= min(MIN_TOXIC_DOCS, len(toxic))) & (ratio >= MIN_PURITY / prior)]
    if not len(keys):
        return none

    def rows(i, b, n):
        where = np.searchsorted(keys, b)
        hit = keys[np.minimum(where, len(keys) - 1)] == b
        i, where = i[hit], where[hit]
        order = np.argsort(i, kind="stable")
        i, where = i[order], where[order]
        return where, i, n

    xp, xu = rows(ip, bp, len(toxic)), rows(iu, bu, len(unlabelled))

    w, c = np.zeros(len(keys) + 1), bias
    speed = np.zeros(len(w))
    for _ in range(steps):
        _, grad = risk(xp, xu, w[:-1], c, prior)
        # Plain steps: what many texts share learns faster than what few have.
        speed = 0.9 * speed - RATE / prior * grad
        w += speed
        w[:-1] = np.maximum(w[:-1], 0)  # a toxic word is never evidence against
        w[-1] = np.clip(w[-1], -BIAS_RANGE, BIAS_RANGE)  # a few toxic words outweigh any bias
        c = bias + w[-1]
    keep = np.abs(w[:-1]) > 1e-3
    return Model(keys[keep], w[:-1][keep], float(c))


def learn(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """A model from the rows outside fold 2; ``prior`` is the toxic share of the
    labelled rows.  The samples are the first ids by a hash, found on distinct ids
    alone; the texts read are theirs, each text of an id once, and no more of them
    than the bounds."""
    order = F.xxhash64(F.lit(SEED), "doc_id")
    lab = labels.filter(F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id")) != 2)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = lab.filter("toxic is not null").agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id")) != 2)).distinct()
    some = ids.orderBy(order, "doc_id").limit(max_unlabelled).select("doc_id", F.lit(0).alias("toxic"))
    sure = lab.filter("toxic = 1").select("doc_id").orderBy(order, "doc_id").limit(max_toxic).select("doc_id", F.lit(1).alias("toxic"))
    want = F.broadcast(some.union(sure))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_h")).join(want, "doc_id").dropDuplicates(["doc_id", "_h", "toxic"])
    rows = materialise(rows, "toxicity-sample")
    texts = rows.select("doc_id", "_h", "toxic").orderBy(order, "doc_id", "_h")
    taken = texts.filter("toxic = 0").limit(max_unlabelled).union(texts.filter("toxic = 1").limit(max_toxic))
    rows = rows.join(F.broadcast(taken.withColumnRenamed("_h", "_t")), ["doc_id", "toxic"]).filter(F.col("_h").eqNullSafe(F.col("_t")))
    rows = rows.select("doc_id", "text", "toxic", "_h").toPandas().sort_values(["doc_id", "toxic", "_h"])
    return fit_pu(rows.text[rows.toxic == 1].tolist(), rows.text[rows.toxic == 0].tolist(), float(share or 0.0))


def score(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and score of every document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "score": model.scores(b["text"].tolist())})

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return d.mapInPandas(run, "doc_id long, score double")
