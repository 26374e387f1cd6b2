"""Near duplicates, components and inner products against brute force."""

import random
import re
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.llm import inner_products as I
from corpusforge.llm import lsh_forest as N
from corpusforge.llm.components import components


def sets(text):
    words = re.findall(r"\w+", (text or "").lower())
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows, threshold=0.8):
    entries = {}
    for i, text in rows:
        entries.setdefault(sets(text), []).append(i)
    keys = [k for k in entries if k]
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links = dict.fromkeys(keys, 0)
    for a in range(len(keys)):
        for b in range(a):
            x, y = keys[a], keys[b]
            if len(x & y) >= threshold * len(x | y):
                links[x] += 1
                links[y] += 1
                parent[root(x)] = root(y)
    smallest = {}
    for k in keys:
        r = root(k)
        smallest[r] = min(smallest.get(r, 1 << 60), min(entries[k]))
    out = [(i, i, 0, 1) for i in entries.get(frozenset(), [])]
    return sorted(out + [(i, smallest[root(k)], links[k], len(entries[k])) for k in keys for i in entries[k]])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    out = []
    for base in range(6):
        words = [word() for _ in range(rng.randrange(60, 200))]
        for _ in range(40 if base == 0 else 5):  # one large group of near copies
            copy = list(words)
            for _ in range(rng.randrange(0, 9)):
                copy[rng.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    shared = " ".join(word() for _ in range(50))
    out += [f"{' '.join(word() for _ in range(90))} {shared}" for _ in range(15)]
    out += [out[0]] * 20 + [out[0].upper().replace(" ", ", "), "one two", "One, two!", "a b c d e", "a b c d f", "", None, "!?", None]
    return list(enumerate(out))


@pytest.mark.parametrize("members", [512, 7])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, rows, members):
    monkeypatch.setattr(N, "MEMBERS", members)
    df = spark.createDataFrame([(i, t, i, "x") for i, t in rows], "doc_id long, text string, links long, entry string").repartition(5)
    got = N.near_duplicates(df).select("doc_id", "class_id", "links", "copies").collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_one_per_class(spark, rows):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows] + [(3, rows[3][1], 1)], "doc_id long, text string, key int")
    kept = N.one_per_class(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c, _, _ in brute(rows)})
    assert N.one_per_class(df.limit(0)).count() == 0


def test_ids_may_be_missing_or_shared(spark, rows):
    text = rows[0][1]
    df = spark.createDataFrame([(None, text), (None, text), (1, "x y z"), (1, "p q r s"), (None, None)], "doc_id long, text string")
    got = N.near_duplicates(df).select("class_id", "copies").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 2), (None, 2), (1, 1), (1, 1), (None, 1)], key=str)
    assert N.one_per_class(df).count() == 3


def test_depth():
    depth = N.depth_for(0.8, 32, 12, 0.9999)
    assert 1 - (1 - 0.8 ** depth) ** 32 >= 0.9999 > 1 - (1 - 0.8 ** (depth + 1)) ** 32
    with pytest.raises(ValueError):
        N.depth_for(0.1, 2, 4, 0.99)


def test_overlaps():
    rng = np.random.default_rng(0)
    found = [np.unique(rng.integers(0, 40, rng.integers(1, 30))).astype(np.uint64) for _ in range(25)]
    left, right = np.arange(12), np.arange(9, 25)
    want = [[np.intersect1d(found[a], found[b]).size if a != b else None for b in right] for a in left]
    got = N.overlaps(found, left, right)
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            assert a == b or got[i, j] == want[i][j]


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 90)] + [(200, i) for i in range(201, 260)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    label = {v: v for e in edges for v in e}
    for _ in range(len(label)):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {v: m for v, m in label.items() if any(v in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block, chunk", [(2048, 512), (32, 8)])
def test_top_k_equals_brute_force(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(I, "BLOCK", block)
    monkeypatch.setattr(I, "CHUNK", chunk)
    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 1, (300, 8)) * rng.gamma(2, 1, (300, 1))
    vectors[50:90] = vectors[50]  # ties
    rows = [(int(i), v.tolist(), 0, 1.5) for i, v in enumerate(vectors)]
    rows += [(400, None, 0, 0.0), (420, [float("nan")] * 8, 0, 0.0), (440, [None] * 8, 0, 0.0), (460, [float("inf")] * 8, 0, 0.0),
             (None, [1.0] * 8, 0, 0.0), (480, [0.5, -0.25], 0, 0.0), (500, [], 0, 0.0), (300, vectors[20].tolist(), 0, 0.0), (300, vectors[20].tolist(), 0, 0.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int, score double")
    got = I.top_k(df, F.col("vec_id") % 20 == 0, k=7).collect()
    sound = [(r[0], r[1]) for r in df.collect() if r[0] is not None and r[1] is not None
             and all(x is not None and np.isfinite(x) for x in r[1])]
    whole = [(i, np.pad(np.floor(64 * np.array(v, np.float64)), (0, 8 - len(v)))) for i, v in sound]
    want = []
    for k, (i, v) in enumerate(whole):
        if i % 20 == 0:
            scores = sorted((-int(v @ w), j) for m, (j, w) in enumerate(whole) if m != k)[:7]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_of_little(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in I.top_k(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 64 * 64 * 3)]
    assert I.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("size", [1, 1e3])
def test_top_k_of_many_blocks_parts_and_copies(spark, monkeypatch, size):
    for name, value in (("BLOCK", 32), ("CHUNK", 16), ("PACK", 16)):
        monkeypatch.setattr(I, name, value)
    rng = np.random.default_rng(7)
    vectors = rng.normal(0, 1, (2300, 6)) * rng.gamma(2, 1, (2300, 1)) * size
    vectors[100:900] = vectors[100]  # more copies than k in each chunk, their queries too
    vectors = vectors.astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    whole, ids = np.floor(64 * vectors), np.arange(len(vectors))
    want = []
    for i in ids[ids % 10 == 0]:
        score = whole @ whole[i]
        best = [j for j in np.lexsort((ids, -score)) if j != i][:5]
        want += [(i, n + 1, j, int(score[j])) for n, j in enumerate(best)]
    assert sorted(map(tuple, I.top_k(df, F.col("vec_id") % 10 == 0, k=5).collect())) == want


def test_numbers_take_few_bytes():
    for most, kind in ((127, np.int8), (128, np.int16), (-40_000, np.int32), (2.0**40, np.float64)):
        data = np.array([[0.0, 1.0, -1.0], [most, 5.0, 0.0]])
        short = I._shortest(data)
        assert short.dtype == kind and (I._numbers(short.tobytes(), 2, 3) == data).all()


def test_driver_gets_the_blocks_it_needs_only():
    # Each task sends the driver its first rows in order: two blocks of 32 KB from each of 90 tasks are over 4 MB.
    code = """
import numpy as np
from pyspark.sql import SparkSession, functions as F
from corpusforge.llm import inner_products as I
conf = {"spark.driver.maxResultSize": "4m", "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "64k",
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
spark = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
I.BLOCK = 64
vectors = np.random.default_rng(1).normal(0, 1, (5800, 64))
spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").createOrReplaceTempView("v")
print("rows", I.top_k(spark.table("v"), F.col("vec_id") % 20 == 0, k=3).count())
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(I.__file__).parents[2], capture_output=True, text=True)
    assert "rows 870" in done.stdout, done.stderr[-2000:]
