"""Toxicity by the nearest labelled examples under TF-IDF cosine.

Terms are words and their beginnings and ends, so that a stem counts in forms
never seen. The vocabulary is every term that toxic examples hold significantly
more often than others do, however many these are. An example is its TF-IDF vector over
the vocabulary; equal vectors are one entry of the index, with their label
counts.

The index is cut into blocks, and each term knows the highest weight it has in
each block. A text's terms give every block an upper bound; blocks are searched
from the highest bound on and the search ends, exactly, when no bound reaches
the k-th best cosine. Where many bounds do, the terms' postings give what is
left at once. Votes are weighted by distance and brought to
probabilities on examples that the index does not hold. A text without a known
term has the rate of the examples without one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from corpusforge.llm.common import below_rate, parts, require, written

WORD = re.compile(r"[^\W\d_]+")
#: Letters of beginnings; ends are as long, but for the shortest.
EDGES = (3, 4, 5, 6)
#: Tokens whose terms a worker keeps; then it starts anew.
KEPT = 500_000
NEIGHBOURS = 16
BLOCK = 256
#: Blocks that are searched one by one, before the postings are.
SINGLY = 4
#: Vectors whose score a worker keeps: texts with one or two terms are often alike.
SCORED = 50_000
#: Terms that a worker counts before it hands the counts on.
COUNTED = 200_000


def word_terms(word: str) -> list[str]:
    """The word, its beginnings ("abcd*") and its ends ("*efgh")."""
    return [word, *[f"{word[:k]}*" for k in EDGES if k < len(word)], *[f"*{word[-k:]}" for k in EDGES[1:] if k < len(word)]]


def words_of(text: str | None) -> Counter:
    return Counter(WORD.findall(text.lower())) if text else Counter()


class Tokens(dict):
    """Places of the vocabulary's terms in a token (a run without white space),
    worked out when a token is first met."""

    def __init__(self, place: dict[str, int]):
        super().__init__()
        self.place = place
        #: How a word starts or ends that may have a term at all.
        self.heads = {t[:EDGES[0]] for t in place if t[0] != "*"} | {t[:-1] for t in place if t[0] != "*" and t[-1] == "*"}
        self.tails = {t[-EDGES[1]:] for t in place if t[0] == "*"}

    def __missing__(self, token: str) -> tuple:
        if len(self) >= KEPT:
            self.clear()
        words = (token,) if token.isalpha() else WORD.findall(token)
        found = self[token] = tuple(self.place[t] for w in words if w[:EDGES[0]] in self.heads or w[-EDGES[1]:] in self.tails
                                    for t in word_terms(w) if t in self.place)
        return found


@dataclass
class Vocabulary:
    """Terms and their inverse document frequencies."""

    place: dict[str, int]
    idf: np.ndarray

    def __post_init__(self):
        self.tokens = Tokens(self.place)

    def __reduce__(self):
        return Vocabulary, (self.place, self.idf)

    def counts(self, text: str | None) -> Counter:
        """How often each term of the vocabulary occurs in a whole text."""
        tokens = text.lower().split() if text else []
        return Counter(p for found in map(self.tokens.__getitem__, tokens) if found for p in found)

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Places, ascending, and weights of a text's vector, of length one."""
        counts = sorted(self.counts(text).items())
        places = np.array([p for p, _ in counts], np.int64)
        weights = (1 + np.log([n for _, n in counts])) * self.idf[places] if counts else np.empty(0)
        return places, weights / np.linalg.norm(weights) if counts else weights


@dataclass
class Index:
    """Distinct vectors with label counts and block-wise maxima of term weights."""

    starts: np.ndarray
    places: np.ndarray
    weights: np.ndarray
    total: np.ndarray
    toxic: np.ndarray
    ids: np.ndarray
    best: np.ndarray
    size: int

    def __post_init__(self):
        #: Entries and weights of each term, term by term.
        order = np.argsort(self.places, kind="stable")
        self.entries = np.repeat(np.arange(self.total.size), np.diff(self.starts)).astype(np.int32)[order]
        self.parts, self.heads = self.weights[order], np.searchsorted(self.places[order], np.arange(self.size + 1))

    def __reduce__(self):
        return Index, (self.starts, self.places, self.weights, self.total, self.toxic, self.ids, self.best, self.size)

    @staticmethod
    def build(vectors: list[tuple[np.ndarray, np.ndarray]], labels: Iterable[int], ids: Iterable[int], size: int) -> Index:
        groups: dict[tuple, list] = {}
        for (places, weights), label, i in zip(vectors, labels, ids, strict=True):
            if places.size:
                group = groups.setdefault((places.tobytes(), weights.tobytes()), [places, weights, 0, 0, i])
                group[2] += 1
                group[3] += label
                group[4] = min(group[4], i)
        # Vectors with the same terms stand together, so that blocks differ in their maxima.
        rows = sorted(groups.values(), key=lambda g: (g[0].astype(">i8").tobytes(), g[1].astype(">f8").tobytes()))
        lengths = np.array([g[0].size for g in rows], np.int64)
        blocks = max(1, -(-len(rows) // BLOCK))
        best = np.zeros((size, blocks))
        for k, g in enumerate(rows):
            best[g[0], k // BLOCK] = np.maximum(best[g[0], k // BLOCK], g[1])
        join = lambda at, kind: np.concatenate([np.empty(0, kind), *[g[at] for g in rows]]).astype(kind)
        column = lambda at: np.array([g[at] for g in rows], np.int64)
        return Index(np.append(0, np.cumsum(lengths)), join(0, np.int64), join(1, np.float64), column(2), column(3),
                     column(4), best, size)

    def nearest(self, places: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Entries of the k highest cosines above zero, ties to the first entry, and the cosines."""
        none = np.empty(0, np.int64), np.empty(0)
        if not places.size or not self.total.size:
            return none
        bound = weights @ self.best[places]
        query = np.zeros(self.size)
        query[places] = weights
        entries, scores, least = *none, 0.0
        for n, block in enumerate(np.argsort(-bound, kind="stable")):
            if bound[block] * (1 + 1e-9) < least or bound[block] <= 0:
                break
            if n == SINGLY:
                return self._by_postings(places, weights, k)
            first, last = block * BLOCK, min(block * BLOCK + BLOCK, self.total.size)
            lo, hi = self.starts[first], self.starts[last]
            found = np.add.reduceat(query[self.places[lo:hi]] * self.weights[lo:hi], self.starts[first:last] - lo).round(12)
            hits = np.flatnonzero((found > 0) & (found >= least))
            entries, scores = np.append(entries, hits + first), np.append(scores, found[hits])
            order = np.lexsort((entries, -scores))[:k]
            entries, scores = entries[order], scores[order]
            least = scores[-1] if scores.size == k else 0.0
        return entries, scores

    def _by_postings(self, places: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        spans = [slice(self.heads[p], self.heads[p + 1]) for p in places]
        shares = np.concatenate([self.parts[span] * w for span, w in zip(spans, weights, strict=True)])
        found = np.bincount(np.concatenate([self.entries[span] for span in spans]), shares, self.total.size).round(12)
        entries = np.flatnonzero(found > 0)
        if entries.size > k:  # all that reach the k-th best, then ties to the first
            entries = entries[found[entries] >= np.partition(found[entries], -k)[-k]]
        entries = entries[np.lexsort((entries, -found[entries]))[:k]]
        return entries, found[entries]


@dataclass
class Model:
    vocabulary: Vocabulary
    index: Index
    rate: float
    rate_without: float
    steps: np.ndarray
    values: np.ndarray

    def vote(self, places: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Share of toxic votes, the neighbours and their cosines."""
        entries, cosines = self.index.nearest(places, weights)
        if not entries.size:
            return self.rate_without, entries, cosines
        votes = self.index.total[entries] / (0.02 + np.maximum(0, 1 - cosines))
        toxic = votes @ (self.index.toxic[entries] / self.index.total[entries])
        return float((toxic + self.rate) / (votes.sum() + 1)), entries, cosines

    def score(self, text: str | None) -> tuple[float, list[int], list[float], list[str]]:
        """Probability, evidence (ids of the nearest examples, cosines), terms."""
        places, weights = self.vocabulary.vector(text)
        kept, key = self.__dict__.setdefault("_scored", {}), (places.tobytes(), weights.tobytes())
        if key not in kept:
            if len(kept) >= SCORED:
                kept.clear()
            share, entries, cosines = self.vote(places, weights)
            at = min(int(np.searchsorted(self.steps, share)), self.values.size - 1)
            kept[key] = float(self.values[at]), self.index.ids[entries].tolist(), cosines.tolist(), places.tolist()
        return kept[key]


def calibrate(shares: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps (upper ends) and values of the monotone fit of labels on shares."""
    if not shares.size:
        return np.array([1.0]), np.array([0.5])
    values, where = np.unique(shares, return_inverse=True)
    pools: list[list[float]] = []  # upper end, rows, toxic rows
    for upper, n, y in zip(values, np.bincount(where), np.bincount(where, labels), strict=True):
        pools.append([upper, float(n), float(y)])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            upper, n, y = pools.pop()
            pools[-1] = [upper, pools[-1][1] + n, pools[-1][2] + y]
    return np.array([p[0] for p in pools]), np.array([(p[2] + 0.5) / (p[1] + 1) for p in pools])


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic",
          max_examples: int = 24_000, min_share: float = 0.005, min_gain: float = 0.05) -> Model:
    """The model from labelled documents.

    At most about `max_examples` labelled documents are examples, chosen by hash
    of the id; a fifth of them calibrates. Terms stand in a share of `min_share`
    of the toxic examples or more (in four at least; six are enough), with a
    log-likelihood ratio of `min_gain` a toxic example or more (ten at least; 25 is
    enough, which chance reaches once in some million terms). A beginning or end
    has to reach that without the word that it is found in most. Every such term is
    kept, and examples of both labels are counted for every term. Copies count once for that. The terms' document frequencies are counted over all
    of `docs`. NULL ids and labels teach nothing; of repeated ids the smallest
    label counts.
    """
    require(docs, [id_column, text])
    require(labels, [id_column, label])
    known = (labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("y")).dropna()
             .groupBy("id").agg(F.min("y").alias("y")))
    rate = min(1.0, max_examples / max(1, known.count()))
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    # At most about max_examples ids.
    sample = written(rows.join(F.broadcast(known.filter(below_rate(F.col("id"), rate))), "id"), "examples")
    fit = sample.filter(~below_rate(F.col("id") + 1, 0.2)).dropDuplicates(["text", "y"])
    sizes = {r["y"]: r["n"] for r in fit.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)

    counts = written(_label_counts(fit), "terms")
    # Terms of the examples, of which the bound above limits the number.
    found = counts.filter(_telling("toxic", "clean", n1, n0, min_share, min_gain))
    own = _without_first_word(found.filter(_piece()), counts).filter(_telling("toxic", "clean", n1, n0, min_share, min_gain))
    terms = sorted(r["term"] for r in found.filter(~_piece()).select("term").unionAll(own.select("term")).collect())
    n_docs = docs.count()
    frequency = {r["term"]: r["n"] for r in _term_counts(rows, set(terms)).collect()} if terms else {}
    idf = np.log((n_docs + 1) / (np.array([frequency.get(t, 0) for t in terms], np.float64) + 1)) + 1e-3
    vocabulary = Vocabulary({t: k for k, t in enumerate(terms)}, idf)

    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @pandas_udf("places binary, weights binary")
    def vectors(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in parts(texts):
            found = [shared.value.vector(t) for t in batch]
            yield pd.DataFrame({"places": [p.tobytes() for p, _ in found], "weights": [w.tobytes() for _, w in found]})

    apart = below_rate(F.col("id") + 1, 0.2)
    own = sample.filter(~apart).select("id", "y", vectors("text").alias("v")).select("id", "y", "v.*").orderBy("id", "places").collect()
    index = Index.build([(np.frombuffer(r["places"], np.int64), np.frombuffer(r["weights"], np.float64)) for r in own],
                        [r["y"] for r in own], [r["id"] for r in own], len(terms))
    without = [r["y"] for r in own if not r["places"]]
    model = Model(vocabulary, index, (sum(r["y"] for r in own) + 0.5) / (len(own) + 1),
                  (sum(without) + 0.5) / (len(without) + 1), np.array([1.0]), np.array([0.5]))
    voter = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("double")
    def voted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([voter.value.vote(*voter.value.vocabulary.vector(t))[0] for t in batch], dtype=float)

    aside = sample.filter(apart).select("y", voted("text").alias("share")).collect()
    model.steps, model.values = calibrate(np.array([r["share"] for r in aside]), np.array([r["y"] for r in aside], np.float64))
    return model


def _piece() -> Column:
    return F.col("term").contains("*")


def _telling(toxic: str, clean: str, n1: int, n0: int, min_share: float, min_gain: float) -> Column:
    """Whether texts of these numbers of either label speak for toxicity."""
    a, b = F.col(toxic), F.col(clean)
    expected = (a + b) * n1 / max(1, n0 + n1)
    gain = 2 * (a * F.log(F.try_divide(a, expected)) + F.when(b > 0, b * F.log(b / (a + b - expected))).otherwise(0.0))
    return (a >= min(6, max(4, min_share * n1))) & (a > expected) & (gain >= min(25.0, max(10.0, min_gain * n1)))


def _without_first_word(pieces: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts of pieces less those of the word that brings each into most toxic
    texts: a beginning of one toxic word only says nothing of other words."""
    words = counts.filter(~_piece() & (F.col("toxic") > 0))
    size = F.length("term")
    parts_of = F.concat(*[F.when(size > k, F.array(F.concat(F.left("term", F.lit(k)), F.lit("*")))).otherwise(F.array().cast("array<string>")) for k in EDGES],
                        *[F.when(size > k, F.array(F.concat(F.lit("*"), F.right("term", F.lit(k))))).otherwise(F.array().cast("array<string>")) for k in EDGES[1:]])
    of_word = words.select(F.explode(parts_of).alias("term"), F.struct("toxic", "clean").alias("of"))
    first = of_word.groupBy("term").agg(F.max("of").alias("first"))
    return pieces.join(first, "term").select("term", (F.col("toxic") - F.col("first.toxic")).alias("toxic"),
                                             F.greatest(F.col("clean") - F.col("first.clean"), F.lit(0)).alias("clean"))


def _label_counts(rows: DataFrame) -> DataFrame:
    """(term, toxic, clean): the number of texts of either label that hold each term."""

    def frame(counts: dict[str, list[int]]) -> pd.DataFrame:
        return pd.DataFrame({"term": pd.Series(list(counts), dtype=object), "toxic": np.array([n[1] for n in counts.values()], np.int64),
                             "clean": np.array([n[0] for n in counts.values()], np.int64)})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, y in zip(batch["text"], batch["y"], strict=True):
                for t in {t for w in words_of(text) for t in word_terms(w)}:
                    counts.setdefault(t, [0, 0])[y] += 1
                if len(counts) >= COUNTED:
                    yield frame(counts)
                    counts = {}
        yield frame(counts)

    return (rows.filter("y IN (0, 1)").select("text", "y").mapInPandas(count, "term string, toxic long, clean long")
            .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def _term_counts(rows: DataFrame, only: set[str]) -> DataFrame:
    """(term, n): the number of texts that hold each term of `only`."""
    shared = rows.sparkSession.sparkContext.broadcast(only)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, counts = sorted(shared.value), Counter()
        known = Vocabulary({t: k for k, t in enumerate(names)}, np.empty(0))
        for batch in batches:
            for text in batch["text"]:
                counts.update(known.counts(text).keys())
        yield pd.DataFrame({"term": pd.Series([names[p] for p in counts], dtype=object),
                            "n": np.fromiter(counts.values(), np.int64, len(counts))})

    return (rows.select("text").mapInPandas(count, "term string, n long")
            .groupBy("term").agg(F.sum("n").alias("n")))


def toxicity(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Column of struct(score, neighbours, cosines, terms) for a text column.

    `score` is the probability that the text is toxic; the others are evidence:
    ids of the nearest examples, their cosines, the text's terms. NULL counts as
    an empty text, which has the rate of texts without known terms.
    """
    require(docs, [text])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("score double, neighbours array<long>, cosines array<double>, terms array<string>")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        names = list(own.vocabulary.place)
        for batch in parts(texts):
            rows = [own.score(t) for t in batch]
            yield pd.DataFrame([(s, i, c, [names[p] for p in t]) for s, i, c, t in rows],
                               columns=["score", "neighbours", "cosines", "terms"])

    return score(F.col(text))
