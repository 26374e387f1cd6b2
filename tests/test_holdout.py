"""Hold-out of benchmark items in any script."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.operators import holdout as H

HAN = "臺灣最高的山是哪一座請從下列選項中選出正確的答案"


def pairs(spark, docs, items, how=H.holdout_pairs, **more):
    train = spark.createDataFrame(docs, "doc_id int, text string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    return train, how(train, bench, "doc_id", "item_id", **more)


def test_units(spark):
    texts = ["Das  ist\tgut.", "山是，哪（一）座 ABC-1 x", "「山」", "...", "ราคา 5 บาท", "カタカナ語"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(H.units(F.col("t"))).collect()]
    assert got == [["das", "ist", "gut."], ["山", "是", "哪", "一", "座", "abc-1", "x"], ["山"], ["..."], [*"ราคา", "5", *"บาท"], [*"カタカナ語"]]


def test_windows_equal_brute_force():
    rng = random.Random(1)
    for n in (0, 1, 3, 7, 8, 12, 13, 14, 60):
        for _ in range(20):
            codes = np.array([rng.randrange(1 << 40) for _ in range(n)], np.int64)
            grams = {tuple(codes)} if n else set()
            weight = lambda c: 8 if c & 1 else 13
            if sum(map(weight, codes)) >= 104:
                grams = set()
                for i in range(n):
                    k = next((k for k in range(i, n + 1) if sum(map(weight, codes[i:k])) >= 104), None)
                    grams |= {tuple(codes[i:k])} if k else set()
            assert H.window_hashes(codes).size == len(grams)
    same = np.array([2, 4, 6, 8, 10, 12, 14, 16], np.int64)
    longer = np.concatenate([[100, 102], same, [104]])
    assert np.isin(H.window_hashes(same), H.window_hashes(longer)).all()


def test_chinese_inside_a_document_is_found(spark):
    docs = [(1, f"前言。{HAN[:12]}，{HAN[12:]}？後面還有很多別的文字和 English words"), (2, HAN[:13] + "完全不同的後半段文字沒有關係"), (3, f"a b {HAN}"),
            (4, None), (5, ""), (6, "臺灣最高的山")]
    train, found = pairs(spark, docs, [(7, HAN + "？"), (8, "臺灣最高的山"), (9, None), (7, HAN + "？")])
    got = sorted(map(tuple, found.collect()))
    assert got == [(1, 7, 1.0), (3, 7, 1.0), (6, 8, 1.0)]
    assert sorted(r[0] for r in H.holdout(train, found, "doc_id").select("doc_id").collect()) == [2, 4, 5]


def test_repeated_ids_do_not_add_up(spark):
    half, rest = HAN[:18], HAN[-18:]
    _, found = pairs(spark, [(1, half), (1, rest), (2, half), (2, half), (2, half)], [(7, HAN)], share=0.9)
    assert found.collect() == []
    _, found = pairs(spark, [(1, half), (1, rest), (2, HAN), (2, HAN)], [(7, HAN)], share=0.1)
    assert {(r["doc_id"], r["share"]) for r in found.collect()} == {(1, 0.5), (2, 1.0)}


def test_share_counts_mixed_grams(spark):
    item = "the quick brown fox jumps over the lazy dog 山是哪一座請從下列選項中"
    _, found = pairs(spark, [(1, "x " + item + " y"), (2, "THE QUICK brown fox jumps over the lazy dog only"), (3, "unrelated " * 30)], [(7, item)], share=0.05)
    got = {r["doc_id"]: r["share"] for r in found.collect()}
    assert got[1] == 1.0 and 0 < got[2] < 0.3 and 3 not in got


def test_equal_texts(spark):
    docs = [(1, "山是 哪一座？"), (2, "山是哪一座"), (3, "山是哪一座 嗎"), (4, None), (5, " ")]
    _, found = pairs(spark, docs, [(7, "山是哪一座!"), (8, " "), (9, None)], H.equal_pairs)
    assert sorted(map(tuple, found.collect())) == [(1, 7), (2, 7)]


def test_null_ids_are_held_out_too(spark):
    train, found = pairs(spark, [(None, HAN), (None, HAN), (1, "other")], [(7, HAN)])
    assert [r["doc_id"] for r in H.holdout(train, found, "doc_id").collect()] == [1]


@pytest.mark.parametrize("docs, items", [([], [(1, HAN)]), ([(1, HAN)], [])])
def test_empty_tables(spark, docs, items):
    for how in (H.holdout_pairs, H.equal_pairs):
        assert pairs(spark, docs, items, how)[1].collect() == []


def test_filter_knows_every_gram_and_few_others(spark):
    rng = np.random.default_rng(0)
    grams = rng.integers(-(1 << 62), 1 << 62, 20_000)
    table, bits = H.bloom_filter(spark.createDataFrame([(int(g),) for g in grams], "gram long").repartition(3))
    def known(values):
        at = H._places(values, bits)
        return (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).all(axis=0)
    assert known(grams).all()
    assert known(rng.integers(-(1 << 62), 1 << 62, 50_000)).mean() < 0.01


def test_grams_are_filtered_before_they_move(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, "some text of a document " * 9) for i in range(50)], "doc_id int, text string").write.parquet(path)
    bench = spark.createDataFrame([(1, HAN)], "item_id int, text string")
    plan = H.holdout_pairs(spark.read.parquet(path), bench, "doc_id", "item_id")._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("FileScan")
    moved = plan[plan.rindex("Exchange", 0, scan):scan]
    # What moves first has been through the function that filters, and the rows without a gram are gone.
    assert "ArrowEvalPython" in moved and "size(" in moved and "Generate" not in moved


def test_units_by_codes_are_those_of_the_column(spark):
    """Also marks that are characters of their own, punctuation beside them, and white space."""
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab é1_.,!-  \n\tกั฿ิ中国，。ー①²𝒜😀") for _ in range(rng.randrange(14))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    same, codes = {}, {}
    for r in df.select(H.units(F.col("t")).alias("units"), F.lower("t").alias("t")).collect():
        units = tuple(u for u in r["units"] if u)
        assert same.setdefault(H.told(r["t"]), units or ()) == units
        assert len(H.unit_codes(r["t"])) == len(units)
        assert all(codes.setdefault(int(c), u) == u for c, u in zip(H.unit_codes(r["t"]), units, strict=True))
    assert len(set(codes.values())) == len(codes) and len(set(same.values())) == len(same)


def test_equal_pairs_of_a_large_group_are_dealt_out(spark, monkeypatch):
    """Of one table with itself, over many parts; ids that come twice or are NULL give a pair once."""
    monkeypatch.setattr(H, "TOGETHER", 3)
    df = spark.createDataFrame([(i, "山，高") for i in range(20)] + [(20, "B b"), (20, "山高"), (1, "b  B"), (None, "山 高"), (9, " "), (8, None)], "k int, t string")
    found = [tuple(r) for r in H.equal_pairs(df, df, "k", "k", "t").collect()]
    first, second = [*range(21), None], [20, 1]
    want = {(a, b) for group in (first, second) for a in group for b in group}
    assert len(found) == len(want) and set(found) == want


def test_the_texts_of_equal_pairs_are_worked_out_once(spark, tmp_path):
    """One table with itself is read once, and no text is in the plan that makes the pairs."""
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "山"), (2, "山")], "k int, text string").write.parquet(path)
    df = spark.read.parquet(path)
    plan = H.equal_pairs(df, df, "k", "k")._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "text" not in plan.replace("texts", "")
