"""Hierarchical packing of token sequences into windows of several sizes.

A document's tokens are cut into whole windows and a rest. A rest goes to the
tier of the smallest window that holds it. Tiers are packed one by one, the
largest first, each from its longest piece on; what a window leaves free is
filled from the same and all shorter tiers, longest fitting piece first. A
window of a smaller tier has to be full; the pieces of those that are not are
packed into windows of the largest, which alone are padded. Windows of one tier
are dealt to steps so that every step has about the same attention cost.

Only rests need company, and a shard of some tens of thousands of them packs as
tightly as all of them. Shards are hashed, so equal or hot keys do not meet.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from corpusforge.llm.common import parts, require, written

#: Words whose ids a worker keeps in each of two generations.
KEPT = 300_000


class WordTokens:
    """Ids of a byte-level BPE vocabulary, kept word by word.

    The vocabulary's pattern never joins a single space with what stands before
    it, so " word" has the same ids wherever it stands. Texts with any other
    white space in front of a space, and those that hold a special token's
    string, are given to the tokenizers library whole.
    """

    def __init__(self, path: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as file:
            merges = {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}
        self.words = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        if len(self.young) >= KEPT:
            self.old, self.young = self.young, {}
        ids = self.old.get(word)
        if ids is None:
            ids = array("I", self.words.encode_ordinary(" " + word)).tobytes()
        self.young[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as unsigned 32-bit integers."""
        if any(s in text for s in self.special):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        first, *rest = text.split(" ")
        joined = " " in text and ("" in rest or any(s in text for s in ("\n ", "\t ", "\r "))
                                  or (first[-1:] or "x").isspace() or any(w[-1:].isspace() for w in rest[:-1]))
        if joined:
            return array("I", self.words.encode_ordinary(text)).tobytes()
        get, word = self.young.get, self._word
        lead = array("I", self.words.encode_ordinary(first)).tobytes()
        return lead + b"".join([get(w) or word(w) for w in rest])


@cache
def word_tokens(path: str, ranks: str, pattern: str) -> WordTokens:
    return WordTokens(path, ranks, pattern)


def cut(docs: DataFrame, path: str, ranks: str, pattern: str, text: str = "text", window: int = 2048,
        end_id: int = 1) -> Column:
    """Column of struct(doc_tokens, ids of each piece) for a text column.

    A text's ids and the end id are cut into whole windows and a rest; ids are
    little-endian unsigned 32-bit integers. A NULL text counts as empty.
    """
    require(docs, [text])
    end = array("I", [end_id]).tobytes()

    @pandas_udf("doc_tokens long, ids array<binary>")
    def pieces(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own, step = word_tokens(path, ranks, pattern), 4 * window
        for batch in parts(texts):
            rows = []
            for value in batch:
                ids = own.encode(value or "") + end
                rows.append((len(ids) // 4, [ids[at:at + step] for at in range(0, len(ids), step)]))
            yield pd.DataFrame(rows, columns=["doc_tokens", "ids"])

    return pieces(F.col(text))


def pack_lengths(lengths: np.ndarray, tiers: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window number, offset and tier of each piece; every piece fits the largest tier.

    The largest tier first: the longest piece of a tier opens a window, which the
    longest pieces fill that still fit, of this tier or a shorter one. A window of
    a smaller tier that does not get full is given up; at the end its pieces are
    packed in the same way into windows of the largest. A window whose total is a
    tier's size is of that tier, any other is padded to the largest. Pieces are
    kept by length, with a bit for each length that occurs: a piece costs a step.
    """
    largest = tiers[-1]
    number, offset, tier = np.zeros(lengths.size, np.int64), np.zeros(lengths.size, np.int64), np.zeros(lengths.size, np.int64)
    by_length: list[list[int]] = [[] for _ in range(largest + 1)]
    for k in range(lengths.size - 1, -1, -1):
        by_length[lengths[k]].append(k)
    there = sum(1 << n for n, pieces in enumerate(by_length) if pieces)
    windows, given_up = 0, []

    def longest(most: int) -> int:
        return (there & ((2 << most) - 1)).bit_length() - 1

    for size, above in [*zip(reversed(tiers), [*reversed(tiers[:-1]), 0], strict=True), (largest, 0)]:
        if above == 0 and size == largest and given_up:
            for k in reversed(given_up):
                by_length[lengths[k]].append(k)
                there |= 1 << int(lengths[k])
            given_up = []
        while longest(size) > above:
            room, pieces = size, []
            while (n := longest(room)) > 0:
                pieces.append(by_length[n].pop())
                if not by_length[n]:
                    there &= ~(1 << n)
                room -= n
            if room and size < largest:
                given_up += pieces
                continue
            used = 0
            for k in pieces:
                number[k], offset[k] = windows, used
                used += int(lengths[k])
            tier[pieces] = used if used in tiers else largest
            windows += 1
    return number, offset, tier


def balanced_steps(cost: np.ndarray, per_step: int) -> np.ndarray:
    """Step of each window: dearest first, back and forth over all steps."""
    steps = max(1, -(-cost.size // per_step))
    lap, place = np.divmod(np.arange(cost.size), steps)
    step = np.empty(cost.size, np.int64)
    step[np.argsort(-cost, kind="stable")] = np.where(lap % 2 == 0, place, steps - 1 - place)
    return step


def tier_steps(cost: np.ndarray, tier: np.ndarray, per_step: int) -> np.ndarray:
    """Step of each window: of one tier each, with as many tokens as `per_step` largest windows."""
    step, steps = np.zeros(cost.size, np.int64), 0
    for size in np.unique(tier):
        own = np.flatnonzero(tier == size)
        step[own] = steps + balanced_steps(cost[own], int(per_step * tier.max() // size))
        steps = int(step[own].max()) + 1
    return step


def pack(docs: DataFrame, path: str, ranks: str, pattern: str, id_column: str = "doc_id", text: str = "text",
         tiers: Sequence[int] = (256, 512, 1024, 2048), end_id: int = 1, per_shard: int = 30_000,
         per_step: int = 64) -> DataFrame:
    """One row per piece: where it comes from, which window it lies in and where.

    Columns: id, start, length, ids (little-endian unsigned 32-bit integers) and
    their ids_crc32, doc_tokens, sequence_id, offset, and tier (the window's size
    after padding) and step, whose windows are of one tier. Repeated rows are documents
    of their own; a NULL id stays NULL; an empty table gives no rows. A shard has
    about `per_shard` rests (a group of bounded size, whatever the table's).
    """
    require(docs, [id_column, text])
    tiers, window = sorted(tiers), max(tiers)
    done = docs.select(F.col(id_column).alias("doc_id"),
                       cut(docs, path, ranks, pattern, text, window, end_id).alias("cut"))
    at = F.col("at").cast("long") * window
    # A number of its own for each piece, the same whenever the table is read.
    pieces = written(
        done.select("doc_id", "cut.doc_tokens", F.posexplode("cut.ids").alias("at", "ids"))
        .select("doc_id", at.alias("start"), F.least(F.col("doc_tokens") - at, F.lit(window)).alias("length"),
                "ids", "doc_tokens", F.monotonically_increasing_id().alias("piece")), "pieces", compression="zstd")
    shards = max(1, round(pieces.count() / per_shard))
    shard = F.pmod(F.xxhash64("doc_id", "start", "piece"), F.lit(shards))

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        lengths = group["length"].to_numpy()
        number, offset, tier = pack_lengths(lengths, tiers)
        cost, of_window = np.bincount(number, lengths.astype(float) ** 2), np.zeros(number.max() + 1, np.int64)
        of_window[number] = tier
        base = int(group["shard"].iloc[0]) << 32
        return pd.DataFrame({"piece": group["piece"], "sequence_id": base + number, "offset": offset, "tier": tier,
                             "step": base + tier_steps(cost, of_window, per_step)[number]})

    # Only lengths are dealt to shards; the ids join their places.
    places = pieces.select("piece", "length", shard.alias("shard")).groupBy("shard").applyInPandas(
        packed, "piece long, sequence_id long, offset long, tier long, step long")
    return pieces.join(places, "piece").select(
        "doc_id", "start", "length", "ids", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step")


def sequences(packed: DataFrame, pad_id: int = 0) -> DataFrame:
    """One row per window of `pack`: sequence_id, tier, step, tokens, ids, padded to the tier with `pad_id`."""
    pad = F.lit(np.array([pad_id], "<u4").tobytes().hex())
    own = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: F.hex(x["ids"])), "")
    rows = packed.groupBy("sequence_id", "tier", "step").agg(F.sum("length").alias("tokens"), own.alias("own"))
    return rows.select("sequence_id", "tier", "step", "tokens",
                       F.unhex(F.concat("own", F.repeat(pad, (F.col("tier") - F.col("tokens")).cast("int")))).alias("ids"))
