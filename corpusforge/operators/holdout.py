"""Hold-out: training rows that contain a benchmark's items, in any script.

A text is a row of units: characters where the script has no spaces (Chinese,
kana, Thai and the like), words elsewhere. A gram is the shortest run of units
from a place on that is as long as 8 words, or 13 characters, or a mixture: a
character counts for 1/13 of a gram, a word for 1/8. A text shorter than a gram
is one gram, which only an equal text has.

The grams of a row are windows of one rolling hash. Those that a Bloom filter of
the benchmark's grams does not know are gone before anything is shuffled, so what
moves is as large as what matches, whatever the size of the training table.
"""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from corpusforge.session import shared_folder

#: Scripts written without spaces, as ranges of a character class.
UNSPACED = "฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿"
WORDS, CHARACTERS = 8, 13
#: Bits a gram in the filter, and the filter's largest size: 2^27 bits are 16 MB.
#: With more grams than these are for, it lets more pass, and nothing is lost.
BITS_A_GRAM, SMALLEST, LARGEST = 16, 10, 27
#: Odd multipliers: of the rolling hash, and of the filter's places.
BASE = 0x9E3779B97F4A7C15
#: Kinds of characters; one of a script without spaces may be a letter or a mark.
SPACE, LETTER, CHARACTER = 1, 2, 4
#: Items of one text that are joined together.
TOGETHER = 4096
PLACES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)


def normal_text(c: Column) -> Column:
    """Lower case, white space as one space."""
    return F.btrim(F.regexp_replace(F.lower(c), r"\s+", " "))


def units(c: Column) -> Column:
    """The units of a text. Punctuation that touches a character unit is dropped."""
    clean = normal_text(c)
    apart = F.regexp_replace(clean, rf"([{UNSPACED}])[^\p{{L}}\p{{N}} ]+", "$1 ")
    apart = F.regexp_replace(apart, rf"[^\p{{L}}\p{{N}} ]+([{UNSPACED}])", " $1")
    apart = F.btrim(F.regexp_replace(F.regexp_replace(apart, f"([{UNSPACED}])", " $1 "), " +", " "))
    return F.split(F.when(clean.rlike(f"[{UNSPACED}]"), apart).otherwise(clean), " ")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _kinds() -> np.ndarray:
    """What each character is: a space, a letter or digit, of a script without spaces."""
    kinds = np.zeros(0x110000, np.uint8)
    kinds[[c for c in range(0x110000) if unicodedata.category(chr(c))[0] in "LN"]] = LETTER
    for first, last in re.findall("(.)-(.)", UNSPACED):
        kinds[ord(first):ord(last) + 1] |= CHARACTER
    kinds[[ord(c) for c in " \t\n\x0b\f\r"]] = SPACE
    return kinds


def _marked(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The characters of a lower-cased text, which of them belong to a unit, which
    begin one, and which are one alone: the same units as `units` has."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _kinds()[chars]
    alone, kept = kinds & CHARACTER != 0, kinds != SPACE
    if alone.any():
        other = kinds & (LETTER | SPACE) == 0
        edges = np.flatnonzero(np.diff(other, prepend=False, append=False))
        start, end = edges[::2], edges[1::2]
        if start.size:
            beside = np.concatenate([[False], kinds == LETTER | CHARACTER, [False]])
            # Of a run beside no character unit, a mark that is one itself stays alone.
            places = np.arange(chars.size)
            mark = np.minimum.reduceat(np.where(other & alone, places, chars.size), start)
            mark = np.where(mark < end, mark, chars.size)
            gone = beside[start] | (beside[end + 1] & (mark >= end - 1))
            run = np.repeat(np.arange(start.size), end - start)
            kept[other] = ~gone[run] & ((mark[run] == chars.size) | (places[other] == mark[run]))
    before = np.append(False, (kept & ~alone)[:-1])
    return chars, kept, kept & (alone | ~before), alone


def unit_codes(text: str) -> np.ndarray:
    """A hash of each unit of a lower-cased text; the lowest bit marks characters
    of scripts without spaces."""
    chars, kept, begins, alone = _marked(text)
    start = np.flatnonzero(begins)
    with np.errstate(over="ignore"):  # all modulo 2^64
        power, back = _powers(chars.size)
        sums = np.append(np.uint64(0), np.cumsum(np.where(kept, _mixed(chars + np.uint64(BASE)), np.uint64(0)) * power[:-1]))
        codes = _mixed((np.diff(sums[np.append(start, chars.size)])) * back[start])
    return (codes & ~np.uint64(1) | alone[start]).view(np.int64)


def told(text: str) -> bytes | None:
    """The same for texts of the same units, and no others; None for blank texts."""
    chars, kept, begins, _ = _marked(text)
    if not kept.any():
        return None
    apart = np.full(kept.sum() + begins.sum(), ord(" "), np.uint32)
    apart[np.cumsum(kept + begins.astype(np.int64))[kept] - 1] = chars[kept]
    return hashlib.sha256(apart.tobytes()).digest()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse, to the powers from 0 to n."""
    return tuple(p[:n + 1] for p in _powers_upto(max(1 << 14, 1 << n.bit_length())))


@functools.lru_cache(maxsize=2)
def _powers_upto(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return tuple(np.append(np.uint64(1), np.cumprod(np.full(n, b, np.uint64))) for b in (BASE, pow(BASE, -1, 1 << 64)))


def window_hashes(codes: np.ndarray, words: int = WORDS, characters: int = CHARACTERS) -> np.ndarray:
    """Distinct hashes of a text's grams, ascending."""
    if not codes.size:
        return codes
    upto = np.append(0, np.cumsum(np.where(codes & 1, words, characters)))
    start = np.arange(codes.size)
    end = np.searchsorted(upto, upto[:-1] + words * characters)
    if upto[-1] < words * characters:
        start, end = start[:1], np.array([codes.size])
    start, end = start[end <= codes.size], end[end <= codes.size]
    with np.errstate(over="ignore"):  # all modulo 2^64
        power, back = _powers(codes.size)
        sums = np.append(np.uint64(0), np.cumsum(codes.view(np.uint64) * power[:-1]))
        return np.unique(((sums[end] - sums[start]) * back[start]).view(np.int64))


def _places(grams: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.stack([(grams.view(np.uint64) ^ (grams.view(np.uint64) >> np.uint64(29))) * np.uint64(p) >> np.uint64(64 - bits) for p in PLACES])


def bloom_filter(grams: DataFrame, column: str = "gram") -> tuple[np.ndarray, int]:
    """Words of 64 bits, and the number of bits as a power of two.

    Spark makes the words; the driver gets at most 2^21 of them."""
    n = max(1, grams.count())
    bits = min(LARGEST, max(SMALLEST, (BITS_A_GRAM * n - 1).bit_length()))

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = np.zeros(1 << bits - 6, np.uint64)
        for batch in batches:
            at = _places(batch[column].to_numpy(np.int64), bits).ravel()
            np.bitwise_or.at(own, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        there = np.flatnonzero(own)
        yield pd.DataFrame({"at": there, "word": own[there].view(np.int64)})

    made = grams.select(column).mapInPandas(words, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toPandas()
    table = np.zeros(1 << bits - 6, np.uint64)
    table[made["at"].to_numpy(np.int64)] = made["word"].to_numpy(np.int64).view(np.uint64)
    return table, bits


def _grams(df: DataFrame, key: str, text: str, words: int, characters: int, known=None) -> DataFrame:
    """(key, grams) of the rows that have any; with `known`, a broadcast filter,
    only grams that it may hold."""

    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = []
            for lowered in batch:
                grams = window_hashes(unit_codes(lowered or ""), words, characters)
                if known is not None:
                    table, bits = known.value
                    at = _places(grams, bits)
                    there = table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)
                    grams = grams[there.all(axis=0)]
                rows.append(grams)
            yield pd.Series(rows, dtype=object)

    grams = F.pandas_udf(found, T.ArrayType(T.LongType()))
    return df.select(F.col(key).alias("k"), grams(F.lower(F.col(text))).alias("grams")).filter(F.size("grams") > 0)


def holdout_pairs(train: DataFrame, bench: DataFrame, train_id: str, item_id: str, text: str = "text", words: int = WORDS,
                  share: float = 0.8, characters: int = CHARACTERS) -> DataFrame:
    """(train_id, item_id, share): training rows that contain `share` of a
    benchmark item's grams; of rows that share an id, the fullest counts.

    Grams are told apart by 64 bits. The benchmark is read while the DataFrame is
    built. NULL and blank texts have no gram.
    """
    each = ["k", F.xxhash64("grams").alias("row")]
    items = _grams(bench, item_id, text, words, characters).dropDuplicates(["k", "grams"])
    asked = items.select(F.col("k").alias("item"), F.xxhash64("grams").alias("asked"), F.size("grams").alias("needed"), F.explode("grams").alias("gram"))
    known = train.sparkSession.sparkContext.broadcast(bloom_filter(asked))
    # Rows of one id with the same candidates are as full as each other.
    candidates = _grams(train, train_id, text, words, characters, known).dropDuplicates(["k", "grams"])
    shared = (candidates.select(*each, F.explode("grams").alias("gram")).join(asked, "gram")
              .groupBy("k", "row", "item", "asked", "needed").agg(F.count("*").alias("shared"))
              .filter(F.col("shared") >= F.lit(share) * F.col("needed")))
    return (shared.groupBy("k", "item").agg(F.max(F.col("shared") / F.col("needed")).alias("share"))
            .select(F.col("k").alias(train_id), F.col("item").alias(item_id), "share"))


@F.pandas_udf(T.BinaryType())
def _told(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(told, na_action="ignore")


def equal_pairs(train: DataFrame, bench: DataFrame, train_id: str, item_id: str, text: str = "text") -> DataFrame:
    """(train_id, item_id): training rows whose whole text is a benchmark item's,
    up to case, white space and punctuation between characters without spaces.

    As many pairs as there are: of n equal texts on both sides, n * n. Those of a
    text with many items are made by several tasks. Texts are read while the
    DataFrame is built, once where both sides are the same table and id, and only
    ids and digests are kept.
    """
    def texts(df: DataFrame, key: str) -> DataFrame:
        rows = df.select(F.col(key).alias("k"), _told(F.lower(F.col(text))).alias("told"))
        rows, folder = rows.filter("told IS NOT NULL").distinct(), shared_folder(df.sparkSession, "texts")
        rows.write.parquet(folder)
        return df.sparkSession.read.schema(rows.schema).parquet(folder)

    rows = texts(train, train_id)
    items = (rows if train is bench and train_id == item_id else texts(bench, item_id)).withColumnRenamed("k", "item")
    many = items.groupBy("told").agg(F.ceil(F.count("*") / TOGETHER).alias("parts")).filter("parts > 1")
    parts = lambda df: df.join(many, "told", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = parts(items).select("told", "item", F.pmod(F.xxhash64("item"), "parts").alias("part"))
    # Only ids that come with several texts can give a pair twice.
    several = rows.groupBy(F.col("k").alias("id")).agg(F.count("*").alias("texts")).filter("texts > 1")
    asked = parts(rows.join(several, F.col("k").eqNullSafe(F.col("id")), "left"))
    asked = asked.select("k", "texts", "told", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    pair = [F.col("k").alias(train_id), F.col("item").alias(item_id)]
    once, again = (asked.filter(c).join(dealt, ["told", "part"]).select(*pair) for c in ("texts IS NULL", "texts > 1"))
    return once.unionAll(again.distinct())


def holdout(train: DataFrame, pairs: DataFrame, train_id: str) -> DataFrame:
    """The training rows without those in `pairs`; a NULL id is an id."""
    held = pairs.select(F.col(train_id).alias("_held")).distinct()
    return train.join(held, train[train_id].eqNullSafe(held["_held"]), "left_anti")
