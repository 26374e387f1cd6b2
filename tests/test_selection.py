"""The n smallest keys without sorting the table."""

import random

import pytest
from pyspark.sql import functions as F

from corpusforge.sources import selection as S


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(S, "DRAWN", 32)
    monkeypatch.setattr(S, "EXACT", 50)


def order(x):
    return (x is not None, x if x is not None else 0)


def test_every_place_of_unique_keys(spark, small):
    values = random.Random(1).sample(range(100_000), 3000)
    df = spark.createDataFrame([(v, f"t{v}") for v in values], "k long, t string").repartition(4)
    ranked = sorted(values)
    for n in (1, 1500, 2999):
        nth = S.nth_key(df, ["k"], n)
        assert (nth.key["k"], nth.before, nth.same) == (ranked[n - 1], n - 1, 1)
    assert S.nth_key(df, ["k"], 3000) is None and S.nth_key(df, ["k"], 9999) is None


@pytest.mark.parametrize("kind", ["string", "double", "date"])
def test_few_keys_hot_keys_and_nulls(spark, small, kind):
    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 2, 2, 2, 2, 3, 700]), i) for i in range(2000)] + [(900 + i, i) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, i int")
    if kind == "date":
        df = df.withColumn("k", F.date_add(F.lit("2020-01-01").cast("date"), F.col("k")))
    else:
        df = df.withColumn("k", F.lpad(F.col("k").cast("string"), 4, "0").cast(kind))
    keys = sorted((order(k) for k, _ in rows))
    for n in (1, 600, 2050):
        nth = S.nth_key(df, ["k"], n)
        assert nth.before == sum(k < keys[n - 1] for k in keys) and nth.same == keys.count(keys[n - 1])
        first = S.first_by_key(df, ["k"], n)
        assert first.count() == n and first.columns == df.columns


def test_two_columns(spark, small):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([*range(30), None]), i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a string, b int, _digest int")
    keys = sorted((order(a) if a is None else (True, a), order(b)) for a, b, _ in rows)
    for n in (1, 700):
        nth = S.nth_key(df, ["a", "b"], n)
        got = (order(nth.key["a"]) if nth.key["a"] is None else (True, nth.key["a"]), order(nth.key["b"]))
        assert got == keys[n - 1] and nth.before == sum(k < got for k in keys)
        took = [S.first_by_key(df.repartition(p), ["a", "b"], n).orderBy("_digest").collect() for p in (1, 5)]
        assert took[0] == took[1] and len(took[0]) == n


def test_equal_rows(spark, small):
    df = spark.createDataFrame([(1, "x")] * 300 + [(0, "y")] * 5, "k int, t string")
    got = S.first_by_key(df, ["k"], 100).collect()
    assert len(got) == 100 and sum(r["k"] == 0 for r in got) == 5
    assert S.first_by_key(df.limit(0), ["k"], 3).collect() == []


def test_no_sort_and_a_filter_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("t")).write.parquet(path)
    df = S.first_by_key(spark.read.parquet(path), ["k"], 100)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan and "LessThanOrEqual(k,99)" in plan.replace(" ", "")
    assert df.count() == 100
