"""Language identification by rank-order profiles of character n-grams.

A language's profile lists its most frequent n-grams (one to three letters,
words edged by a space) by rank. A document is ranked in the same way, and goes
to the language whose profile has the smallest out-of-place distance: the sum
over the document's n-grams of the difference in rank, or the profile's length
for an n-gram the profile lacks.

n-grams are exact 63-bit integers (21 bits a code point), so a document is one
sort of an integer array and no string is built per n-gram.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf

from corpusforge.llm.common import below_rate, parts, require

UNDETERMINED = "und"
#: Letters that are counted at once; a longer text is counted piece by piece.
CHUNK = 1 << 18


@cache
def _classes() -> np.ndarray:
    """2 for letters, 1 for marks (they belong to words), 0 for all else."""
    kind = {"L": 2, "M": 1}
    return np.array([kind.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8)


def _grams(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, ascending, with their counts."""
    one = letters.astype(np.int64)
    two = one[:-1] | one[1:] << 21
    three = two[:-1] | one[2:] << 42
    space = ord(" ")
    codes = np.sort(np.concatenate([one[one != space], two, three]))
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.diff(np.append(first, codes.size))


def count_grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of a whole text and their counts; empty where it has no letter."""
    nothing = np.empty(0, np.int64), np.empty(0, np.int64)
    if not text:
        return nothing
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _classes()[points]
    if not (kinds == 2).any():
        return nothing
    space = np.uint32(ord(" "))
    letters = np.concatenate([[space], np.where(kinds > 0, points, space), [space]])
    letters = letters[np.append(True, (letters[1:] != space) | (letters[:-1] != space))]
    if letters.size <= CHUNK:
        return _grams(letters)
    codes, counts = nothing
    for at in range(0, letters.size - 2, CHUNK):
        part = letters[at:at + CHUNK + 2]
        more, n = _grams(part)
        if at + CHUNK < letters.size - 2:  # the two letters that the next part starts with
            tail, tail_n = _grams(part[-2:])
            n = n.copy()
            n[np.searchsorted(more, tail)] -= tail_n
        joined, where = np.unique(np.concatenate([codes, more]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([counts, n]), joined.size).astype(np.int64)
        codes = joined
    return codes[counts > 0], counts[counts > 0]


def ranked(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Indices of the `size` most frequent n-grams; ties go to the smaller code."""
    order = counts * codes.size - np.arange(codes.size)  # unique, codes ascend
    if codes.size > size:
        top = np.argpartition(-order, size - 1)[:size]
        return top[np.argsort(-order[top])]
    return np.argsort(-order)


@dataclass(frozen=True)
class Profiles:
    """languages; sorted n-grams; rank of each n-gram in each language (or -1)."""

    languages: tuple[str, ...]
    codes: np.ndarray
    ranks: np.ndarray
    size: int

    def predict(self, text: str | None) -> tuple[str, float]:
        codes, counts = count_grams(text)
        if not codes.size or not self.languages:
            return UNDETERMINED, 0.0
        top = codes[ranked(codes, counts, self.size)]
        at = np.minimum(np.searchsorted(self.codes, top), self.codes.size - 1)
        found = self.codes[at] == top
        ranks = np.where(found[:, None], self.ranks[at], -1)
        places = np.abs(ranks - np.arange(top.size)[:, None])
        distance = np.where(ranks >= 0, places, self.size).sum(axis=0)
        best = int(np.argmin(distance))  # ties: the first language by name
        most = self.size * top.size
        rest = np.delete(distance, best)
        other = int(rest.min()) if rest.size else most
        return self.languages[best], float((other - distance[best]) / other) if other else 0.0


def learn_profiles(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang",
                   size: int = 300, max_documents: int = 5000) -> Profiles:
    """Profiles from labelled documents.

    A language is learned from at most about `max_documents` documents, chosen by
    hash of the id at a rate of its own, so that a rare language keeps all of its
    documents. The n-grams are counted and ranked by Spark; the driver gets
    `size` n-grams a language. Rows with NULL id, text or language teach nothing.
    """
    require(docs, [id_column, text, lang])
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    rate = rows.groupBy("lang").agg((max_documents / F.count("*")).alias("rate"))
    # One row a language: of a size that the number of languages bounds.
    sample = rows.join(F.broadcast(rate), "lang").filter(below_rate(F.col("id"), F.col("rate"))).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in parts(batches):
            for name, texts in batch.groupby("lang")["text"]:
                found = [count_grams(t) for t in texts]
                codes = np.concatenate([f[0] for f in found])
                codes, where = np.unique(codes, return_inverse=True)
                n = np.bincount(where, np.concatenate([f[1] for f in found]), codes.size)
                yield pd.DataFrame({"lang": name, "code": codes, "n": n.astype(np.int64)})

    total = (sample.mapInPandas(count, "lang string, code long, n long")
             .groupBy("lang", "code").agg(F.sum("n").alias("n")))
    # Spark limits each task's rows to `size` a language before it shuffles them.
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    tops = (total.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= size)
            .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "code")))["code"].alias("codes"))
            .orderBy("lang").collect())
    languages = tuple(r["lang"] for r in tops)
    codes = np.unique(np.array([c for r in tops for c in r["codes"]], np.int64))
    ranks = np.full((codes.size, len(languages)), -1, np.int32)
    for k, r in enumerate(tops):
        ranks[np.searchsorted(codes, np.array(r["codes"], np.int64)), k] = np.arange(len(r["codes"]))
    return Profiles(languages, codes, ranks, size)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> Column:
    """Column of struct(lang_pred string, score double) for a text column.

    `score` is how much nearer the language is than the next one, as a share of
    that one's distance. A NULL text, or one without a letter: `und`, score 0.
    """
    require(docs, [text])
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    @pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in parts(texts):
            yield pd.DataFrame([model.predict(t) for t in batch], columns=["lang_pred", "score"])

    return predict(F.col(text))
