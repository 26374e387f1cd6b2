import pytest
from pyspark.sql import functions as F

from corpusforge.operators import audits as A
from corpusforge.operators import evaluation as E
from corpusforge.streaming.monitor import metric_windows


def letters(spark, texts, *args):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(E.predicted_letter(F.col("t"), *args)).collect()]


def test_predictions(spark):
    texts = ["so \\boxed{b}", "\\boxed{A} no, \\boxed{(C)}", "最終答案：D", "答案是(A)", "The answer is B.", " (C) ", "because", "", None, "\\boxed{12}", "答案Also"]
    assert letters(spark, texts, "box") == ["B", "C", None, None, None, None, None, None, None, None, None]
    assert letters(spark, texts, "pattern") == ["B", "C", "D", "A", "B", "C", None, None, None, None, None]
    assert letters(spark, ["x=7", "y"], "regex", "x=(\\d)") == ["7", None]
    for bad in ("regex", "guess"):
        with pytest.raises(ValueError):
            E.predicted_letter(F.col("t"), bad)


def test_accuracy_counts_missing_predictions(spark):
    key = spark.createDataFrame([(1, "A"), (2, " b "), (3, None)], "item int, answer string")
    read = spark.createDataFrame([(1, "A"), (3, "C"), (9, "A")], "item int, prediction string")
    row = E.accuracy(read, key, ["item"], []).first()
    assert (row["items"], row["correct"], row["unparsed"], row["alarm"]) == (3, 1, 1, True)
    assert row["accuracy"] == pytest.approx(1 / 3)
    assert E.accuracy(read, key.limit(0), ["item"], ["item"]).count() == 0


def test_repeats_and_comparison(spark):
    stats = lambda rows: E.repeat_stats(spark.createDataFrame(rows, "b string, accuracy double"), ["b"])
    got = {r["b"]: r["verdict"] for r in E.compare(
        stats([("x", 0.4), ("x", 0.6), ("y", 0.5), ("z", 0.1), ("w", 0.9)]), stats([("x", 0.6), ("y", 0.7), ("w", 0.1), ("n", 1.0)]), ["b"]).collect()}
    assert got == {"x": "within deviation", "y": "better", "z": "only before", "w": "worse", "n": "only after"}
    assert stats([("x", 0.4)]).first()["deviation"] is None


def test_options_follow_their_answer(spark):
    rows = [(i, f"a{i}", f"b{i}", None if i % 3 else f"c{i}", f"d{i}", "ABDX"[i % 4]) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, A string, B string, C string, D string, answer string")
    got = {r["k"]: r for r in E.shuffle_options(df, ["k"]).collect()}
    for k, a, b, c, d, answer in rows:
        r = got[k]
        assert sorted(x or "" for x in (r["A"], r["B"], r["C"], r["D"])) == sorted(x or "" for x in (a, b, c, d))
        assert r["answer"] is None if answer == "X" else r[r["answer"]] == dict(zip("ABCD", (a, b, c, d), strict=True))[answer]
        assert c is not None or r["D"] is None
    again = {r["k"]: r for r in E.shuffle_options(df.repartition(5), ["k"]).collect()}
    assert got == again and any(got[k]["A"] != f"a{k}" for k in got)


def test_position_bias(spark):
    df = spark.createDataFrame([("A", "A"), ("A", "B"), (None, "c ")], "prediction string, answer string")
    got = {r["letter"]: (r["predicted"], r["keyed"], r["predicted_share"]) for r in E.position_bias(df).collect()}
    assert got == {"A": (2, 1, 1.0), "B": (0, 1, 0.0), "C": (0, 1, 0.0)}


def test_groups_and_caps(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.0), (2, 0.0), (2, 1.0), (2, None), (3, None)], "g int, reward double")
    got = {r["g"]: (r["no_signal"], r["too_small"]) for r in A.zero_signal_groups(df, "g", smallest=3).collect()}
    assert got == {1: (True, True), 2: (False, False), 3: (True, True)}
    sizes = spark.createDataFrame([(i,) for i in range(1, 101)], "n int")
    caps = {r["cap"]: (r["cut"], r["advised"]) for r in A.cap_advice(sizes, F.col("n"), [50, 99, 100, 400]).collect()}
    assert caps == {50: (50, False), 99: (1, False), 100: (0, True), 400: (0, False)}
    ratio = A.clipped_ratio(sizes, F.col("n"), 61, []).first()
    assert ratio["ratio"] == pytest.approx(0.4) and ratio["warn"]


def test_shares_and_bands(spark):
    df = spark.createDataFrame([("a", 30, 1), ("a", 30, 2), ("b", 40, 1)], "source string, n int, copy int")
    shares = A.mix_shares(df, F.col("n"), {"a": 1, "b": 3}, copies="copy")
    got = {r["source"]: (r["tokens"], r["epochs"], r["share"], r["wanted_share"], r["verdict"])
           for r in A.replay_check(shares, {"a": (0.1, 0.5)}).collect()}
    assert got == {"a": (60, 2, 0.6, 0.25, "above"), "b": (40, 1, 0.4, 0.75, "no band")}


def test_holdout(spark):
    item = "what is the largest river of the northern plain by far"
    docs = [(1, f"Intro. What is  the largest\nriver of the NORTHERN plain by far and more"), (2, "what is the largest river here"), (3, None), (4, ""),
            (5, "short one")]
    train = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id int, text string, g string")
    bench = spark.createDataFrame([(7, item), (8, "short one"), (9, None)], "item_id int, text string")
    pairs = A.holdout_pairs(train, bench, "doc_id", "item_id")
    assert sorted(map(tuple, pairs.collect())) == [(1, 7, 1.0), (5, 8, 1.0)]
    assert sorted(r["doc_id"] for r in A.holdout(train, pairs, "doc_id").collect()) == [2, 3, 4]


def test_segments_fill_packs(spark):
    df = spark.createDataFrame([(i, i % 37) for i in range(200)], "k int, n int")
    rows = A.pack_segments(df, "k", F.col("n"), 50, shards=3).collect()
    per_key, per_pack = {}, {}
    for r in rows:
        per_key.setdefault(r["k"], []).append((r["start"], r["end"]))
        per_pack[r["shard"], r["pack"]] = per_pack.get((r["shard"], r["pack"]), 0) + r["end"] - r["start"]
    for k, spans in per_key.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] == k % 37 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    last = {s: max(p for t, p in per_pack if t == s) for s, _ in per_pack}
    assert all(n == 50 for (s, p), n in per_pack.items() if p < last[s]) and max(per_pack.values()) <= 50
    assert len(per_key) == sum(i % 37 > 0 for i in range(200))


def test_metric_windows(spark):
    rows = [("r", f"2024-01-01 0{h}:{m}0:00", v) for h, m, v in ((0, 1, 0.4), (0, 2, 0.9), (1, 0, 0.0), (2, 0, 0.1), (2, 1, 0.1), (2, 2, 0.1), (2, 3, 9.0), (3, 0, None))]
    df = spark.createDataFrame(rows, "run_id string, ts string, value double").withColumn("ts", F.to_timestamp_ntz("ts"))
    got = [r["symptom"] for r in metric_windows(df).orderBy("start").collect()]
    assert got == ["persistently high", "flat at zero", "spike"]


def test_preference_profile(spark):
    df = spark.createDataFrame([("a b", "c d e f", None), (None, "x", "y " * 40)], "prompt string, chosen string, rejected string")
    got = {r["part"]: r["max"] for r in A.preference_profile(df).collect()}
    assert got["prompt and longer answer"] == got["rejected"] and got["prompt"] > 0
