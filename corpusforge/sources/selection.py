"""The n rows with the smallest keys, found without sorting the table.

The n-th key is closed in on: a few thousand keys, drawn by hash, give pivots
near the place wanted; one count of the rows up to each pivot tells between which
two the key lies, and the next round reads only those rows. What is left in the
end is small and is put in order exactly. No row moves for it, and a key that a
third of the rows share costs a count like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

#: Keys drawn in a round, about, and rows that are ordered exactly.
DRAWN, EXACT = 4096, 65536
#: Distances of pivots, in drawn keys, from where the key is expected; and as many even ones.
NEAR, EVEN = (0, 3, 12, 48), 8


@dataclass(frozen=True)
class Nth:
    """The n-th smallest key, rows before its first and with it."""

    key: Row
    before: int
    same: int


class Keys:
    """Comparisons with a key of some columns; NULL is smallest, as in sorting."""

    def __init__(self, df: DataFrame, columns: Sequence[str]):
        self.columns, self.types = columns, {c: df.schema[c].dataType for c in columns}
        self.this = F.struct(*[F.col(f"`{c}`") for c in columns])

    def _value(self, key: Row, c: str) -> Column:
        return F.lit(key[c]).cast(self.types[c])

    def _up_to(self, key: Row, c: str) -> Column:
        """Not behind the key by its column c; a form that scans can use."""
        column = F.col(f"`{c}`")
        return column.isNull() if key[c] is None else column.isNull() | (column <= self._value(key, c))

    def before(self, key: Row) -> Column:
        if len(self.columns) == 1:
            c, = self.columns
            return F.lit(False) if key[c] is None else F.col(f"`{c}`").isNull() | (F.col(f"`{c}`") < self._value(key, c))
        return self._up_to(key, self.columns[0]) & (self.this < self._struct(key))

    def up_to(self, key: Row) -> Column:
        if len(self.columns) == 1:
            return self._up_to(key, self.columns[0])
        return self._up_to(key, self.columns[0]) & (self.this <= self._struct(key))

    def equal(self, key: Row) -> Column:
        return reduce(and_, [F.col(f"`{c}`").isNull() if key[c] is None else F.col(f"`{c}`") == self._value(key, c) for c in self.columns])

    def behind(self, key: Row) -> Column:
        if len(self.columns) == 1:
            c, = self.columns
            return F.col(f"`{c}`").isNotNull() if key[c] is None else F.col(f"`{c}`") > self._value(key, c)
        return self.this > self._struct(key)

    def _struct(self, key: Row) -> Column:
        return F.struct(*[self._value(key, c).alias(c) for c in self.columns])


def nth_key(df: DataFrame, key: Sequence[str], n: int) -> Nth | None:
    """The n-th smallest key; None if the table has no more than n rows."""
    keys, rows = Keys(df, key), df.select(*[F.col(f"`{c}`") for c in key])
    inside, left = rows.count(), n
    if inside <= n:
        return None
    low = high = None
    more = 1
    while inside > EXACT:
        rate = min(1.0, more * DRAWN / inside)
        part = _between(rows, keys, low, high)
        unit = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in key]), F.lit(1 << 40))
        drawn = part.filter(unit < int(rate * (1 << 40))).distinct().orderBy(*[F.col(f"`{c}`") for c in key]).collect()
        middle = int(left / inside * len(drawn))
        wanted = {middle + s * d for d in NEAR for s in (-1, 1)} | {i * len(drawn) // EVEN for i in range(EVEN)}
        pivots = [drawn[i] for i in sorted(wanted) if 0 <= i < len(drawn)]
        counts = part.agg(*[F.count_if(keys.up_to(p)).alias(f"n{i}") for i, p in enumerate(pivots)],
                          F.min(keys.this).alias("least"), F.max(keys.this).alias("most")).first()
        if counts["least"] == counts["most"]:
            return Nth(counts["least"], n - left, inside)
        upto = [counts[f"n{i}"] for i in range(len(pivots))]
        under = [i for i, c in enumerate(upto) if c < left]
        over = [i for i, c in enumerate(upto) if c >= left]
        first = upto[under[-1]] if under else 0
        narrowed = (upto[over[0]] if over else inside) - first
        if under:
            low = pivots[under[-1]]
        if over:
            high = pivots[over[0]]
        # Many rows of few keys may give no pivot, or the same one again: draw more of them.
        more = more * 64 if narrowed == inside else 1
        inside, left = narrowed, left - first
    counts = _between(rows, keys, low, high).groupBy(*[F.col(f"`{c}`") for c in key]).agg(F.count("*").alias("_n"))
    # At most EXACT rows, or few keys.
    upto = F.sum("_n").over(Window.orderBy(*[F.col(f"`{c}`") for c in key]).rowsBetween(Window.unboundedPreceding, 0))
    found = counts.withColumn("_upto", upto).filter(F.col("_upto") >= left).orderBy("_upto").first()
    return Nth(Row(**{c: found[c] for c in key}), n - left + found["_upto"] - found["_n"], found["_n"])


def _between(rows: DataFrame, keys: Keys, low: Row | None, high: Row | None) -> DataFrame:
    if low is not None:
        rows = rows.filter(keys.behind(low))
    return rows if high is None else rows.filter(keys.up_to(high))


def first_by_key(df: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """The n rows with the smallest key, the same rows at every reading.

    The n-th key becomes a filter that scans can use. Rows that share it count in
    the order of their contents' digests, found in the same way; of equal rows it
    does not matter which. NULL is the smallest value. Some short jobs run while
    the DataFrame is built.
    """
    nth = nth_key(df, key, n)
    if nth is None:
        return df
    keys = Keys(df, key)
    if nth.before + nth.same == n:
        return df.filter(keys.up_to(nth.key))
    taken = {c.lower() for c in df.columns}
    digest = next(c for c in ("_digest" + "_" * i for i in range(len(taken) + 1)) if c not in taken)
    ties = df.filter(keys.equal(nth.key)).withColumn(digest, F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
    left = n - nth.before
    of_ties = nth_key(ties, [digest], left)
    some = Keys(ties, [digest])
    chosen = ties.filter(some.before(of_ties.key))
    if of_ties.before + of_ties.same == left:
        chosen = ties.filter(some.up_to(of_ties.key))
    else:
        chosen = chosen.unionByName(ties.filter(some.equal(of_ties.key)).limit(left - of_ties.before))
    return df.filter(keys.before(nth.key)).unionByName(chosen.drop(digest))
