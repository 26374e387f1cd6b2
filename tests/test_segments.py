"""Packing by prefix sums in two levels."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from corpusforge.operators import segments as G


def brute(rows, length, seed=42):
    order = lambda k: hashlib.md5(f"{seed}|{'' if k is None else k}".encode()).hexdigest()
    out, first = [], 0
    for k, n in sorted(((k, n) for k, n in rows if n and n > 0), key=lambda r: (order(r[0]), r[1])):
        for pack in range(first // length, (first + n - 1) // length + 1):
            out.append((0, pack, k, max(pack * length - first, 0), min((pack + 1) * length - first, n)))
        first += n
    return sorted(out, key=str)


ROWS = [(i, i % 37) for i in range(300)] + [(5, 900), (5, 900), (6, 1), (None, 4), (8, None), (9, -3)]


@pytest.mark.parametrize("blocks", [1, 7, 64, None])
def test_segments_do_not_depend_on_blocks(spark, blocks):
    df = spark.createDataFrame(ROWS, "k int, n int").withColumn("shard", F.lit("own"))
    got = [tuple(r) for r in G.pack_segments(df, "k", F.col("n"), 50, blocks=blocks).collect()]
    assert sorted(got, key=str) == brute(ROWS, 50)


def test_a_third_of_the_rows_share_a_key(spark, monkeypatch):
    monkeypatch.setattr(G, "TOGETHER", 10)
    rows = [(1, 3)] * 1005 + [(1, 4)] * 95 + [(i, 2) for i in range(2, 50)]
    df = spark.createDataFrame(rows, "k int, n int")
    got = [tuple(r) for r in G.pack_segments(df, "k", F.col("n"), 16, blocks=4).collect()]
    assert sorted(got, key=str) == brute(rows, 16)


def test_no_rows(spark):
    assert G.pack_segments(spark.createDataFrame([], "k int, n int"), "k", F.col("n"), 16).collect() == []


def test_no_window_holds_a_whole_shard(spark):
    df = spark.range(1000).withColumn("n", F.col("id") % 9)
    plan = G.pack_segments(df, "id", F.col("n"), 16, blocks=8)._jdf.queryExecution().executedPlan().toString()
    specs = [line.split("windowspecdefinition(")[1].split(" ASC")[0] for line in plan.split("\n") if " Window [" in line]
    # Rows stand in windows of one block; the window over a shard has a row a block.
    assert specs and all(re.fullmatch(r"shard#\w+, block#\w+(, o#\w+)?", s) for s in specs) and any("o#" in s for s in specs)
    assert "SinglePartition" not in plan


def test_tokens_are_counted_once_a_row(spark, tmp_path):
    """Not again for the filter that leaves out empty rows."""
    spark.createDataFrame([(1, "a b"), (2, "")], "k int, t string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = G.pack_segments(df, "k", F.length(F.reverse("t")), 2, blocks=2)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not any("reverse(" in line for line in plan.splitlines() if "Filter" in line)
    assert {r["k"] for r in got.collect()} == {1}
