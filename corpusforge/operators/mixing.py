"""Mix sources by weight and shuffle them, reproducibly.

All choices hang on md5 of (seed, source, row key), never on partitioning or
arrival order, so a rerun or a lost executor gives the same table. `row_key`
identifies a row within its source.
"""

from __future__ import annotations

from collections.abc import Mapping
from fractions import Fraction
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusforge.operators.conform import check_aligned, require

DIGEST_DIGITS = 32
DIGITS_PER_PASS = 4          # 65,536 buckets per source and pass
COPIES_PER_TASK_ROW = 1024   # beyond this, copies of one row are spread over tasks


def concat(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All rows of all sources, with a `source` column."""
    check_aligned(tables)
    tagged = [df.withColumn("source", F.lit(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, tagged)


def target_rows(sizes: Mapping[str, int], weights: Mapping[str, float]) -> dict[str, int]:
    """Rows per source in the shortest mix that shows every source in full.

    Exact arithmetic: with floats a product like 129.0000000001 would add a row.
    """
    if empty := [s for s, n in sizes.items() if n == 0]:
        raise ValueError(f"sources without rows cannot be mixed: {empty}")
    exact = {s: Fraction(str(weights[s])) for s in sizes}
    if bad := [s for s, w in exact.items() if w <= 0]:
        raise ValueError(f"weights must be positive: {bad}")
    whole = sum(exact.values())
    length = max(ceil(n * whole / exact[s]) for s, n in sizes.items())
    return {s: ceil(length * exact[s] / whole) for s in sizes}


def mix(tables: Mapping[str, DataFrame], weights: Mapping[str, float], seed: int = 42) -> DataFrame:
    """Concatenate equally weighted sources, interleave the others."""
    union = concat(tables)
    values = [float(weights[s]) for s in tables]
    if all(abs(w - values[0]) < 1e-9 for w in values):
        return union.withColumn("copy", F.lit(1).cast("long"))
    return weighted_interleave(union, weights, seed)


def weighted_interleave(df: DataFrame, weights: Mapping[str, float], seed: int = 42) -> DataFrame:
    """Repeat rows so that source sizes stand in proportion to the weights.

    Every row appears at least once; `copy` numbers its repetitions. The rows
    that get one copy more than the others are those with the smallest digest.
    """
    require(df, ["source", "row_key"], "weighted_interleave")
    sizes = {r["source"]: r["n"] for r in df.groupBy("source").agg(F.count("*").alias("n")).collect()}
    sizes |= {s: 0 for s in weights if s not in sizes}
    targets = target_rows(sizes, weights)
    base = {s: targets[s] // n for s, n in sizes.items()}
    extra = {s: targets[s] % n for s, n in sizes.items() if targets[s] % n}

    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), "source", F.col("row_key").cast("string")))
    df = df.withColumn("_digest", digest)
    cuts, ties = _cut_offs(df, extra)
    gets_extra = _any([_upto(s, cut) for s, cut in cuts.items()]
                      + [_below(s, digest) for s, (digest, _) in ties.items()])
    out = _repeat(df.withColumn("_copies", _lookup(base) + gets_extra.cast("int")), base)
    for source, (digest, wanted) in ties.items():
        tied = _tied_rows(df, source, digest, wanted)
        out = out.unionByName(tied.withColumn("copy", F.lit(base[source] + 1).cast("long")))
    return out.drop("_digest")


def shuffle(df: DataFrame, seed: int = 42) -> DataFrame:
    """A seeded permutation by `shuffle_key`; equal however df is partitioned.

    The position only tells rows with one and the same key apart, so that a
    repeated key cannot fill a whole task.
    """
    require(df, ["row_key"], "shuffle")
    parts = [F.lit(str(seed)), *[F.col(c).cast("string") for c in ("source", "row_key", "copy")
                                 if c in df.columns]]
    keyed = df.withColumns({"shuffle_key": F.md5(F.concat_ws("|", *parts)),
                            "_position": F.monotonically_increasing_id()})
    return keyed.orderBy("shuffle_key", "_position").drop("_position")


# --- helpers ----------------------------------------------------------------

def _any(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _upto(source: str, cut: str) -> Column:
    return (F.col("source") == source) & (F.left("_digest", F.lit(len(cut))) <= cut)


def _below(source: str, digest: str) -> Column:
    return (F.col("source") == source) & (F.col("_digest") < digest)


def _lookup(numbers: Mapping[str, int]) -> Column:
    cases = [F.when(F.col("source") == s, F.lit(n).cast("long")) for s, n in numbers.items()]
    return F.coalesce(*cases)


def _cut_offs(df: DataFrame, ranks: Mapping[str, int]):
    """Digest prefix up to which exactly ranks[source] rows lie.

    Each pass counts rows per bucket of the next digits, inside the bucket that
    holds the cut-off so far: a map-side combined aggregation over the key
    columns, never a sort of the rows. Returns the prefixes, and for sources
    whose cut-off falls into rows with one and the same digest, that digest and
    how many of those rows are still wanted.
    """
    prefix, wanted = {s: "" for s in ranks}, dict(ranks)
    cuts, ties = {}, {}
    for digits in range(DIGITS_PER_PASS, DIGEST_DIGITS + 1, DIGITS_PER_PASS):
        if not wanted:
            break
        inside = _any((F.col("source") == s) & F.col("_digest").startswith(prefix[s]) for s in wanted)
        buckets = (df.filter(inside).groupBy("source", F.left("_digest", F.lit(digits)).alias("bucket"))
                   .agg(F.count("*").alias("n")))
        upto = F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))
        at = (buckets.withColumn("upto", upto)
              .filter((F.col("upto") >= _lookup(wanted)) & (F.col("upto") - F.col("n") < _lookup(wanted))))
        for row in at.collect():          # one row per source
            source = row["source"]
            prefix[source] = row["bucket"]
            if row["upto"] == wanted[source]:
                cuts[source] = row["bucket"]
                del wanted[source]
            else:
                wanted[source] -= row["upto"] - row["n"]
    for source, n in wanted.items():
        ties[source] = (prefix[source], n)
    return cuts, ties


def _tied_rows(df: DataFrame, source: str, digest: str, wanted: int) -> DataFrame:
    """`wanted` of the rows sharing one digest, which happens when a row key is
    not unique. Their content decides; equal rows stand for one another."""
    content = [F.col(c) for c in df.columns if c != "_digest"]
    tied = (df.filter((F.col("source") == source) & (F.col("_digest") == digest))
            .withColumn("_digest", F.md5(F.to_json(F.struct(*content)))))
    cuts, same = _cut_offs(tied, {source: wanted})
    if cuts:
        return tied.filter(_upto(source, cuts[source]))
    content_digest, copies = same[source]
    one = tied.filter(F.col("_digest") == content_digest).limit(1)
    repeated = (df.sparkSession.range(copies).select(F.lit(content_digest).alias("_digest"))
                .join(F.broadcast(one), "_digest"))     # a single row
    return tied.filter(_below(source, content_digest)).unionByName(repeated)


def _repeat(df: DataFrame, base: Mapping[str, int]) -> DataFrame:
    """Emit every row `_copies` times, numbered by `copy`.

    A source repeated thousands of times would have a few rows write it all, so
    its copies are cut into ranges and spread over the cluster first.
    """
    def explode(frame: DataFrame, first: Column, last: Column) -> DataFrame:
        return frame.withColumn("copy", F.explode(F.sequence(first, last))).drop("_copies", "_first")

    one = F.lit(1).cast("long")
    heavy = [s for s, n in base.items() if n > COPIES_PER_TASK_ROW]
    if not heavy:
        return explode(df, one, F.col("_copies"))
    step = F.lit(COPIES_PER_TASK_ROW).cast("long")
    # A fixed number of partitions: by their size, adaptive execution would put
    # these few rows back into one task.
    wanted = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    tasks = int(wanted) if wanted.isdecimal() else df.sparkSession.sparkContext.defaultParallelism
    ranges = (df.filter(F.col("source").isin(heavy))
              .withColumn("_first", F.explode(F.sequence(one, F.col("_copies"), step)))
              .repartition(tasks, "_digest", "_first"))
    last = F.least(F.col("_first") + step - 1, F.col("_copies"))
    light = df.filter(~F.col("source").isin(heavy))
    return explode(ranges, F.col("_first"), last).unionByName(explode(light, one, F.col("_copies")))
