"""How far sources of one language differ in what words they use.

Each (language, source) group has a count for each of the language's kept terms,
and with it a price: one plus a share of 10^9 after smoothing, in whole numbers.
Two groups differ by the sum over all kept terms of the difference of prices.

That price depends on the group and the count only, so the sum needs no terms,
but the joint table of two groups: how many terms have count i in the one and j
in the other. Indicator columns for (group, count level), one row a term, give
all joint tables at once: the product of the transposed columns with the columns.
Terms are cut into blocks, groups into panels; each task multiplies the indicator
blocks of a block of terms and two panels, prices the tables it gets and hands on
one sum for a pair of groups. Products are counts of at most a block's terms, and
sums are integers: all is exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusforge.llm.common import require, written

#: Of the bytes of a text in UTF-8: A to Z in lower case, all else below 0x80
#: that is no letter as a space. Terms are letters and all beyond ASCII.
BYTES = bytes(c + 32 if chr(c) in ascii_uppercase else c if c > 127 or chr(c) in ascii_lowercase else 32 for c in range(256))
SCALE, SMOOTH = 1_000_000_000, 5
#: Terms of a block, groups of a panel, indicator columns multiplied at once.
TERMS, GROUPS, COLUMNS = 512, 64, 2048
#: Terms that a task counts before it hands the counts on, and rows handed on at once.
COUNTED, HANDED = 250_000, 50_000


def price(count: int, total: int, terms: int) -> int:
    """1 + floor(10^9 * (count + 5) / (total + 5 * terms)) in whole numbers of any size."""
    return 1 + SCALE * (count + SMOOTH) // (total + SMOOTH * terms)


def priced(count: Column, total: Column, terms: Column) -> Column:
    """`price` as an expression."""
    share = (count + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (total + SMOOTH * terms).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", share, below)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(BYTES).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, docs) of (lang, source, text), a row each."""

    def batches_of(counts: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (number, documents) in counts.items():
            terms = list(number)
            for at in range(0, len(terms), HANDED):
                own = terms[at:at + HANDED]
                columns = [pa.repeat(lang, len(own)), pa.repeat(source, len(own)), pa.array(own, pa.binary()).cast(pa.string()),
                           pa.array([number[t] for t in own], pa.int64()), pa.array([documents[t] for t in own], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "count", "docs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"], strict=True):
                number, documents = counts.setdefault((lang, source), (Counter(), Counter()))
                terms = terms_of(text.as_buffer().to_pybytes())
                before = len(number)
                number.update(terms)
                documents.update(set(terms))
                held += len(number) - before
                if held >= COUNTED:
                    yield from batches_of(counts)
                    counts, held = {}, 0
        yield from batches_of(counts)

    found = docs.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(
        count, "lang string, source string, term string, count long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def _blocks(rows: DataFrame) -> DataFrame:
    """(lang, block, panel, terms, at, place, count): the counts of up to TERMS
    terms of a language and one panel of its groups, as a sparse matrix."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lang, panels, held, block = None, 0, [], 0

        def made() -> pd.DataFrame:
            at = np.repeat(np.arange(len(held)), [len(g) for g, _ in held])
            group = np.concatenate([g for g, _ in held]).astype(np.int64)
            number = np.concatenate([n for _, n in held]).astype(np.int64)
            rows = []
            for panel in range(panels):
                own = group // GROUPS == panel
                rows.append((lang, block, panel, len(held), at[own].tobytes(), (group[own] % GROUPS).tobytes(), number[own].tobytes()))
            return pd.DataFrame(rows, columns=["lang", "part", "panel", "terms", "at", "place", "count"])

        for batch in batches:
            for row in batch.itertuples():
                if held and (row.lang != lang or len(held) == TERMS):
                    yield made()
                    held, block = [], block + 1
                lang, panels = row.lang, row.panels
                held.append((row.groups, row.counts))
        if held:
            yield made()

    # Terms of like counts stand together: a block has few levels then.
    near = rows.repartitionByRange("lang", "total", "term").sortWithinPartitions("lang", "total", "term")
    cut_up = near.select("lang", "panels", "groups", "counts").mapInPandas(
        cut, "lang string, part long, panel long, terms long, at binary, place binary, count binary")
    return cut_up.withColumn("block", F.shiftleft(F.spark_partition_id().cast("long"), 32) + F.col("part")).drop("part")


class Indicator:
    """One-hot columns (group of a panel, count level) over the terms of a block."""

    def __init__(self, terms: int, at: bytes, place: bytes, count: bytes, totals, kept: int):
        groups = len(totals)
        dense = np.zeros((groups, terms), np.int64)
        dense[np.frombuffer(place, np.int64), np.frombuffer(at, np.int64)] = np.frombuffer(count, np.int64)
        column, group, cost = np.zeros((groups, terms), np.int64), [], []
        for g in range(groups):
            levels, where = np.unique(dense[g], return_inverse=True)
            column[g] = where + len(group)
            group += [g] * len(levels)
            cost += [price(int(c), int(totals[g]), kept) for c in levels]
        self.groups, self.group, self.price = groups, np.array(group, np.int64), np.array(cost, np.int64)
        self.matrix = np.zeros((terms, len(group)), np.float32)
        self.matrix[np.arange(terms), column] = 1

    def joint(self, other: Indicator) -> Iterator[tuple[slice, slice, np.ndarray]]:
        """Parts of matrix transposed times the other's: joint tables of levels."""
        for a in range(0, self.group.size, COLUMNS):
            left = slice(a, a + COLUMNS)
            for b in range(0, other.group.size, COLUMNS):
                right = slice(b, b + COLUMNS)
                yield left, right, self.matrix[:, left].T @ other.matrix[:, right]

    def differences(self, other: Indicator) -> np.ndarray:
        """Sum over the block's terms of the difference of prices, for each pair of groups."""
        total = np.zeros(self.groups * other.groups, np.int64)
        for left, right, table in self.joint(other):
            i, j = np.nonzero(table)
            share = table[i, j].astype(np.int64) * np.abs(self.price[left][i] - other.price[right][j])
            np.add.at(total, self.group[left][i] * other.groups + other.group[right][j], share)
        return total.reshape(self.groups, other.groups)


def _pair_sums(blocks: DataFrame, panels: DataFrame) -> DataFrame:
    """(lang, a, b, value) of pairs of group numbers, a before b."""
    sided = written(blocks.join(panels, ["lang", "panel"]), "blocks")
    names = [c for c in sided.columns if c not in ("lang", "block", "kept", "terms")]
    left = sided.select("lang", "block", "kept", "terms", *[F.col(c).alias(f"l_{c}") for c in names])
    right = sided.select("lang", "block", *[F.col(c).alias(f"r_{c}") for c in names])
    both = left.join(right, ["lang", "block"]).filter("l_panel <= r_panel")

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for r in batch.itertuples():
                one = Indicator(r.terms, r.l_at, r.l_place, r.l_count, r.l_totals, r.kept)
                two = one if r.l_panel == r.r_panel else Indicator(r.terms, r.r_at, r.r_place, r.r_count, r.r_totals, r.kept)
                key = (r.lang, r.l_panel, r.r_panel)
                sums[key] = sums.get(key, 0) + one.differences(two)
                if len(sums) > 64:
                    yield from map(frame, sums.items())
                    sums = {}
        yield from map(frame, sums.items())

    def frame(item) -> pd.DataFrame:
        (lang, i, j), table = item
        a, b = np.divmod(np.arange(table.size), table.shape[1])
        own = pd.DataFrame({"lang": lang, "a": i * GROUPS + a, "b": j * GROUPS + b, "value": table.ravel()})
        return own[own.a < own.b]

    return both.mapInPandas(multiply, "lang string, a long, b long, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 30,
          top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank) for every group of the table.

    Part `pair`: each other source of the language, by falling difference from it,
    whole. Part `term`: the `top` terms that are dearer in the group than in its
    whole language, by falling excess. Ties go to the smaller item in UTF-8.

    A language keeps the terms that stand in `min_docs` of its documents or more;
    every row is a document, repeated ones too. NULL text, lang or source count
    as ''. A group without a kept term takes part with count 0 throughout, and in
    a language without one all pairs differ by 0. Other columns are ignored; an
    empty table gives no rows. Texts of any length are counted whole.
    """
    require(docs, [text, lang, source])
    spark = docs.sparkSession
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    counts = written(term_counts(rows), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("total")).filter(F.col("docs") >= min_docs)
    entries = written(counts.drop("docs").join(kept.drop("docs"), ["lang", "term"]), "entries")

    # A row a group: its number within the language, its tokens; V and N of the language.
    by_lang = Window.partitionBy("lang")
    own = entries.groupBy("lang", "source").agg(F.sum("count").alias("tokens"))
    vocabulary = entries.groupBy("lang", "term").agg(F.first("total").alias("total")).groupBy("lang").agg(F.count("*").alias("kept"))
    groups = (rows.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(vocabulary, "lang", "left")
              .na.fill(0, ["tokens", "kept"])
              .withColumns({"g": (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long"), "n_lang": F.sum("tokens").over(by_lang),
                            "panels": F.floor((F.count("*").over(by_lang) + (GROUPS - 1)) / GROUPS)}))
    groups = written(groups, "groups")

    matrix = (entries.join(groups.select("lang", "source", "g", "panels"), ["lang", "source"])
              .groupBy("lang", "term").agg(F.first("total").alias("total"), F.first("panels").alias("panels"),
                                           F.collect_list(F.struct("g", "count")).alias("own"))  # at most one entry a group
              .select("lang", "term", "total", "panels", F.col("own.g").alias("groups"), F.col("own.count").alias("counts")))
    panels = (groups.groupBy("lang", "kept", F.floor(F.col("g") / GROUPS).alias("panel"))
              .agg(F.transform(F.array_sort(F.collect_list(F.struct("g", "tokens"))), lambda x: x["tokens"]).alias("totals")))
    sums = written(_pair_sums(_blocks(matrix), panels), "sums")

    # Both directions; pairs of a language without kept terms differ by 0.
    one = groups.select("lang", F.col("g").alias("a"), "source")
    two = groups.select("lang", F.col("g").alias("b"), F.col("source").alias("item"))
    directed = sums.select("lang", "a", "b", "value").unionAll(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    pairs = one.join(two, "lang").filter("a <> b").join(directed, ["lang", "a", "b"], "left").na.fill(0, ["value"])
    pair = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    p = priced(F.col("count"), F.col("tokens"), F.col("kept"))
    q = priced(F.col("total"), F.col("n_lang"), F.col("kept"))
    dearer = (entries.join(groups, ["lang", "source"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (p - q).alias("value"))
              .filter("value > 0"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    term = dearer.withColumn("rank", rank).filter(F.col("rank") <= top)
    done = pair.withColumn("rank", rank).unionAll(term)
    return done.select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")
