"""Quality classifier from positive and unlabelled documents (nnPU).

Trusted documents are the positives, web text as it comes is unlabelled: it
holds good and bad documents in unknown shares. The share of good ones is
estimated first, from a classifier of trusted against unlabelled (the share of
unlabelled text above a score, over that of trusted text, at the score where
this is smallest with its error bound). Then a small network minimises the
unbiased risk pi R_p(+) + max(0, R_u(-) - pi R_p(-)): where the negative part
falls below zero, the step goes the other way.

Features look at form, not at words: which kinds of characters follow each
other, and how words and lines repeat. They are computed by Spark; training sees
a sample of a size that is a parameter.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from corpusforge.llm.common import below_rate, parts, require

CLASSES = 12
WINDOW = 100
FEATURES = CLASSES * CLASSES + 12


@cache
def _classes() -> np.ndarray:
    by_category = {"Ll": 0, "Lu": 1, "Lt": 1, "N": 3, "Z": 4, "P": 9, "S": 10, "C": 11}
    table = np.full(0x110000, 2, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        table[c] = by_category.get(kind, by_category.get(kind[0], 2))
    for signs, kind in (("\n\r\x85  ", 5), (".", 6), (",;:", 7), ("!?", 8), ("$%&*#|+=<>@^~_\\/", 10)):
        for c in signs:
            table[ord(c)] = kind
    return table


def features(text: str | None) -> np.ndarray:
    """Features of a whole text; zeros for NULL and empty ones."""
    out = np.zeros(FEATURES, np.float32)
    if not text:
        return out
    kinds = _classes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
    follow = np.bincount(kinds[:-1] * CLASSES + kinds[1:], minlength=CLASSES * CLASSES)
    out[:CLASSES * CLASSES] = np.sqrt(follow / max(1, kinds.size - 1))
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n = max(1, len(words))
    shares = [len(set(words[at:at + WINDOW])) / len(words[at:at + WINDOW]) for at in range(0, len(words), WINDOW)] or [0]
    count = Counter(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    edges = np.fromiter((not (w[0].isalnum() and w[-1].isalnum()) for w in words), np.int64, len(words))
    most = max(count.values(), default=0)
    out[CLASSES * CLASSES:] = (
        np.log1p(len(text)) / 10, np.log1p(len(words)) / 10, sizes.mean() / 10 if words else 0,
        sizes.std() / 10 if words else 0, len(count) / n, sum(shares) / len(shares), min(shares), most / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        1 - len(set(lines)) / max(1, len(lines)), edges.mean() if words else 0, len(lines) / n)
    return out


@dataclass
class Network:
    """One hidden layer of rectified units over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]

    def logit(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.maximum(((x - self.mean) / self.scale).clip(-8, 8) @ a + b, 0) @ c + d

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(x).clip(-30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, correct: bool = True, hidden: int = 32,
        epochs: int = 40, rate: float = 3e-3, seed: int = 0) -> Network:
    """Minimise the non-negative risk (logistic loss) with Adam.

    With `correct` off, this is a plain classifier of positives against
    unlabelled rows, both sides weighted alike.
    """
    random = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled])
    width = both.shape[1]
    net = Network(both.mean(axis=0), both.std(axis=0) + 1e-3, [
        random.normal(0, width ** -0.5, (width, hidden)), np.zeros(hidden),
        random.normal(0, hidden ** -0.5, hidden), np.zeros(1)])
    first, second = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights]
    p_all, u_all = (((x - net.mean) / net.scale).clip(-8, 8) for x in (positive, unlabelled))
    steps = max(1, -(-len(u_all) // 512))
    sigmoid = lambda z: 1 / (1 + np.exp(-z.clip(-30, 30)))
    t = 0
    for _ in range(epochs):
        u_order, p_order = random.permutation(len(u_all)), random.permutation(len(p_all))
        for u_rows, p_rows in zip(np.array_split(u_order, steps), np.array_split(p_order, steps), strict=True):
            if not len(u_rows) or not len(p_rows):
                continue
            x, n_p = np.concatenate([p_all[p_rows], u_all[u_rows]]), len(p_rows)
            a, b, c, d = net.weights
            inner = x @ a + b
            h = np.maximum(inner, 0)
            z = h @ c + d
            up, down = sigmoid(z) - 1, sigmoid(z)  # slopes of the losses for label 1 and 0
            slope = np.zeros_like(z)
            if not correct:
                slope[:n_p], slope[n_p:] = up[:n_p] / n_p, down[n_p:] / len(u_rows)
            else:
                loss0 = np.logaddexp(0, z)
                negative = loss0[n_p:].mean() - prior * loss0[:n_p].mean()
                slope[:n_p], slope[n_p:] = -prior * down[:n_p] / n_p, down[n_p:] / len(u_rows)
                if negative < 0:
                    slope = -slope
                else:
                    slope[:n_p] += prior * up[:n_p] / n_p
            back = np.outer(slope, c) * (inner > 0)
            grads = [x.T @ back + 1e-4 * a, back.sum(axis=0), h.T @ slope + 1e-4 * c, slope.sum(keepdims=True)]
            t += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net.weights[k] = net.weights[k] - rate * (first[k] / (1 - 0.9 ** t)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
    return net


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 0) -> float:
    """Share of positives among the unlabelled rows, by the best bin of a
    classifier that is fitted on one half and applied to the other."""
    half_p, half_u = len(positive) // 2, len(unlabelled) // 2
    net = fit(positive[:half_p], unlabelled[:half_u], 0.5, correct=False, epochs=15, seed=seed)
    p, u = np.sort(net.logit(positive[half_p:])), np.sort(net.logit(unlabelled[half_u:]))
    above_p = 1 - np.arange(len(p)) / len(p)
    above_u = 1 - np.searchsorted(u, p) / len(u)
    error = np.sqrt(np.log(40) / 2 / len(u)) + np.sqrt(np.log(40) / 2 / len(p))
    best = np.argmin((above_u + 1.01 * error) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def learn(docs: DataFrame, positives: DataFrame, id_column: str = "doc_id", text: str = "text",
          max_positives: int = 10_000, max_unlabelled: int = 20_000) -> tuple[Network | None, float]:
    """The network and the estimated prior.

    `docs` is the unlabelled web text, `positives` has the ids of trusted
    documents in it. At most about `max_positives` and `max_unlabelled` are used,
    chosen by hash of the id. NULL ids and texts teach nothing. Without at least
    two rows of both kinds there is no network (None), and prior 0.5.
    """
    require(docs, [id_column, text])
    require(positives, [id_column])
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).dropna()
    trusted = positives.select(F.col(id_column).alias("id")).dropna().distinct()
    n_p, n_u = trusted.count(), rows.count()
    some = trusted.filter(below_rate(F.col("id"), min(1.0, max_positives / max(1, n_p)))).withColumn("p", F.lit(True))
    unit = below_rate(F.col("id") + 1, min(1.0, max_unlabelled / max(1, n_u)))
    # `some` has at most about max_positives ids.
    sample = rows.join(F.broadcast(some), "id", "left").select("id", "text", F.coalesce("p", F.lit(False)).alias("p"), unit.alias("u"))
    found = sample.filter("p OR u").select("id", "p", "u", _features(F.col("text")).alias("x")).orderBy("id").collect()
    vector = lambda name: [np.frombuffer(r["x"], np.float32) for r in found if r[name]]
    p, u = vector("p"), vector("u")
    if len(p) < 2 or len(u) < 2:
        return None, 0.5
    random = np.random.default_rng(0)
    p, u = (np.array(x, np.float64)[random.permutation(len(x))] for x in (p, u))
    prior = estimate_prior(p, u)
    return fit(p, u, prior), prior


def _features(text: Column) -> Column:
    @pandas_udf("binary")
    def computed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in parts(texts):
            yield pd.Series([features(t).tobytes() for t in batch], dtype=object)

    return computed(text)


def quality(docs: DataFrame, network: Network | None, prior: float, text: str = "text") -> Column:
    """Column: probability (double) that a text is of quality. Without a network
    it is the prior everywhere."""
    require(docs, [text])
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net = shared.value
        for batch in parts(texts):
            x = np.array([features(t) for t in batch])
            yield pd.Series(net.probability(x) if net else np.full(len(batch), prior))

    return score(F.col(text))
