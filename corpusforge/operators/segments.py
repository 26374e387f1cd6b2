"""Documents joined end to end and cut into packs of one length.

The order is by hash of the key, so a document's position is the sum of all
lengths before it. The sum is taken in two levels: within blocks, which are equal
ranges of the hash, and over the blocks' sums. No sorted run is longer than a
block, and rows that share key and length are one entry with a count, however
many they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows of a block, about.
ROWS_PER_BLOCK = 100_000
#: Equal rows that are written out together.
TOGETHER = 4096


def pack_segments(df: DataFrame, key: str, tokens: Column, max_length: int, shards: int = 1, seed: int = 42,
                  blocks: int | None = None) -> DataFrame:
    """(shard, pack, key, start, end): a document that crosses a cut has several
    segments; positions count from the document's first token.

    Every pack but the last of a shard is full, so one shard, the default, wastes
    least; more of them give files that can be written apart. `blocks` only says
    how the work is cut: the segments do not depend on it. Rows are counted while
    the DataFrame is built, unless it is given. A row with NULL or no tokens is
    left out; a NULL key is a key like any other.
    """
    if blocks is None:
        blocks = df.count() // ROWS_PER_BLOCK + 1
    order = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    place = F.conv(F.substring("o", 1, 8), 16, 10).cast("long")
    rows = df.select(F.col(key).alias("k"), tokens.cast("long").alias("n"), order.alias("o"))
    # A filter on n itself would move below the projection and count tokens twice.
    rows = rows.groupBy("o", "k", "n").agg(F.count("*").alias("copies"), F.max("n").alias("most")).filter("most > 0")
    rows = rows.select("*", F.pmod(place, F.lit(shards)).alias("shard"), F.floor(place * blocks / (1 << 32)).alias("block"))

    whole = F.col("n") * F.col("copies")
    sums = rows.groupBy("shard", "block").agg(F.sum(whole).alias("tokens"))
    over_blocks = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    offsets = sums.select("shard", "block", (F.sum("tokens").over(over_blocks) - F.col("tokens")).alias("offset"))
    in_block = Window.partitionBy("shard", "block").orderBy("o", "k", "n").rowsBetween(Window.unboundedPreceding, 0)
    placed = (rows.withColumn("before", F.sum(whole).over(in_block) - whole).join(offsets, ["shard", "block"])
              .select("shard", "k", "n", "copies", (F.col("before") + F.col("offset")).alias("first")))

    cut = placed.filter(F.col("copies") <= TOGETHER).unionAll(_apart(placed.filter(F.col("copies") > TOGETHER)))
    cut = cut.select("shard", "k", "n", F.explode(F.transform(F.sequence(F.lit(0), F.col("copies") - 1), lambda i: F.col("first") + i * F.col("n"))).alias("first"))
    packs = F.sequence(F.floor(F.col("first") / max_length), F.floor((F.col("first") + F.col("n") - 1) / max_length))
    cut = cut.withColumn("pack", F.explode(packs))
    start = F.greatest(F.col("pack") * max_length - F.col("first"), F.lit(0))
    end = F.least((F.col("pack") + 1) * max_length - F.col("first"), F.col("n"))
    return cut.select("shard", "pack", F.col("k").alias(key), start.alias("start"), end.alias("end"))


def _apart(many: DataFrame) -> DataFrame:
    """Entries of many copies as entries of TOGETHER, dealt out over tasks."""
    at = F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(TOGETHER)))
    some = many.withColumn("at", at).repartition("k", "n", "at")
    return some.select("shard", "k", "n", F.least(F.col("copies") - F.col("at"), F.lit(TOGETHER)).alias("copies"),
                       (F.col("first") + F.col("at") * F.col("n")).alias("first"))
