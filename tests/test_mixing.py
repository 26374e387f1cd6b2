import hashlib
from collections import Counter
from fractions import Fraction
from math import ceil

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpusforge.operators import mixing as M


def source(spark, n, prefix="k"):
    return spark.range(n).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("row_key"),
                                 (F.col("id") * 2).alias("v"))


def brute_force(sizes, weights, seed, prefix="k"):
    """Rows and copies by sorting all digests."""
    targets = M.target_rows(sizes, weights)
    out = Counter()
    for name, n in sizes.items():
        keys = [f"{prefix}{i}" for i in range(n)]
        keys.sort(key=lambda k: hashlib.md5(f"{seed}|{name}|{k}".encode()).hexdigest())
        for rank, key in enumerate(keys):
            out[name, key] = targets[name] // n + (rank < targets[name] % n)
    return out


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 300), st.sampled_from([0.1, 0.3, 1, 2, 6, 7.5])), min_size=2, max_size=4),
       st.integers(0, 99))
def test_interleave_equals_brute_force(spark, spec, seed):
    sizes = {f"s{i}": n for i, (n, _) in enumerate(spec)}
    weights = {f"s{i}": w for i, (_, w) in enumerate(spec)}
    union = M.concat({s: source(spark, n) for s, n in sizes.items()})
    rows = M.weighted_interleave(union, weights, seed).collect()
    assert Counter((r["source"], r["row_key"]) for r in rows) == brute_force(sizes, weights, seed)
    assert len({(r["source"], r["row_key"], r["copy"]) for r in rows}) == len(rows)


@given(st.dictionaries(st.sampled_from("abcd"), st.tuples(st.integers(1, 10**6), st.integers(1, 50)), min_size=1))
def test_targets_show_every_source_in_full(spec):
    sizes = {s: n for s, (n, _) in spec.items()}
    weights = {s: w for s, (_, w) in spec.items()}
    targets = M.target_rows(sizes, weights)
    whole = sum(weights.values())
    length = max(ceil(Fraction(n * whole, weights[s])) for s, n in sizes.items())
    for s in sizes:
        assert targets[s] >= sizes[s]
        assert 0 <= targets[s] - Fraction(length * weights[s], whole) < 1


def test_targets_use_exact_arithmetic():
    assert M.target_rows({"a": 43, "b": 10}, {"a": 0.1, "b": 0.3}) == {"a": 43, "b": 129}
    for bad, match in (({"a": 0, "b": 1}, "without rows"), ({"a": 1, "b": 1}, "positive")):
        with pytest.raises(ValueError, match=match):
            M.target_rows(bad, {"a": 0, "b": 1})


def test_equal_weights_and_single_source_concatenate(spark):
    tables = {"a": source(spark, 5), "b": source(spark, 50)}
    assert M.mix(tables, {"a": 3.0, "b": 3.0 + 1e-12}).groupBy("copy").count().collect() == [(1, 55)]
    assert M.mix({"a": tables["a"]}, {"a": 9}).count() == 5
    with pytest.raises(ValueError, match="without rows"):
        M.mix({"a": tables["a"], "b": tables["b"].limit(0)}, {"a": 1, "b": 2})
    with pytest.raises(ValueError, match="differ in columns"):
        M.mix({"a": tables["a"], "b": tables["b"].drop("v")}, {"a": 1, "b": 1})


def test_mix_does_not_depend_on_partitioning(spark):
    def run(n):
        tables = {"a": source(spark, 40).repartition(n), "b": source(spark, 300).repartition(n)}
        mixed = M.shuffle(M.mix(tables, {"a": 3, "b": 1}, 7), 7)
        return [tuple(r) for r in mixed.select("source", "row_key", "copy", "shuffle_key").collect()]

    one = run(1)
    assert one == run(8)
    assert [r[3] for r in one] == sorted(r[3] for r in one) and len({r[3] for r in one}) == len(one)
    assert [r[:3] for r in one] != sorted(r[:3] for r in one)


def test_keys_that_are_not_unique(spark):
    """A third of a source shares one key; most of those rows are equal."""
    rows = [(f"k{i}", i) for i in range(200)] + [("hot", i // 60) for i in range(100)]
    tables = {"a": spark.createDataFrame(rows, "row_key string, v int"), "b": source(spark, 7).withColumn("v", F.col("v").cast("int"))}
    for weight in (2, 3, 11):
        mixed = M.mix(tables, {"a": weight, "b": 1}, seed=3)
        assert dict(mixed.groupBy("source").count().collect()) == M.target_rows({"a": 300, "b": 7}, {"a": weight, "b": 1})
    small = {"a": spark.createDataFrame([("hot", i // 60) for i in range(100)], "row_key string, v int"),
             "b": tables["b"].limit(7)}
    weights = {"a": 100, "b": 4}         # 175 rows wanted of the 100 hot ones
    mixed = M.mix(small, weights, seed=1)
    assert dict(mixed.groupBy("source").count().collect()) == M.target_rows({"a": 100, "b": 7}, weights)
    assert mixed.filter("source = 'a'").count() == 175
    per_value = {r["v"]: r["n"] for r in mixed.filter("source = 'a'").groupBy("v").agg(F.count("*").alias("n")).collect()}
    assert per_value[0] >= 60 and per_value[1] >= 40


def test_many_copies_are_spread_over_tasks(spark):
    tables = {"a": source(spark, 2), "b": source(spark, 4000)}
    mixed = M.mix(tables, {"a": 1.5, "b": 1}, 5)
    counts = mixed.groupBy("source", "row_key").agg(F.count("*").alias("n"), F.count_distinct("copy").alias("d"))
    a = [(r["n"], r["d"]) for r in counts.filter("source = 'a'").collect()]
    assert a == [(3000, 3000)] * 2
    assert mixed.filter("source = 'b'").count() == 4000
    tasks = mixed.filter("source = 'a'").select(F.spark_partition_id()).distinct().count()
    assert tasks > 1


def test_a_repeated_key_does_not_fill_one_task(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("row_key"))
    # Adaptive execution may merge partitions, so look at the sort's own ranges.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["n"] for r in M.shuffle(df.repartition(4)).groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 0.3 * 30000
    with pytest.raises(ValueError, match="row_key"):
        M.shuffle(spark.range(3))
