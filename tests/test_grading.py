"""Grading by own options and by value, totals, and accounts of filters and weights."""

import pytest
from pyspark.sql import functions as F

from corpusforge.functions import text as X
from corpusforge.operators import audits as A
from corpusforge.operators import grading as G
from corpusforge.operators import scoring as S


def read(spark, rows, method="pattern"):
    df = spark.createDataFrame([(i, t, list(o)) for i, (t, o) in enumerate(rows)], "i int, t string, o array<string>")
    return [tuple(r[0]) for r in df.orderBy("i").select(G.read_option(F.col("t"), F.col("o"), method)).collect()]


def test_letters_are_the_items_own(spark):
    assert read(spark, [("答案是 I 但 答案是 B", "ABCD"), ("The answer is I. The answer is C.", "ABC"), ("\\boxed{D}", "ABC"), ("\\boxed{D} 答案：A", "ABC"),
                        ("\\boxed{e}", "ABCDE"), ("", "AB"), (None, "AB"), ("no idea", "AB"), ("\\boxed{ {{A", "AB"), ("(B)", "AB"), ("X", "XY")]) == [
        ("B", None), ("C", None), (None, G.FOREIGN), ("A", None), ("E", None), (None, G.BLANK), (None, G.BLANK), (None, G.NOTHING), (None, G.UNMATCHED),
        ("B", None), ("X", None)]
    assert read(spark, [("答案：A", "ABC"), ("\\boxed{a}", "ABC")], "box") == [(None, G.NOTHING), ("A", None)]


def test_math_compares_values(spark):
    spellings = ["\\boxed{1/2}", "\\boxed{0.50}", "so \\boxed{\\frac{2}{4}}", "\\boxed{1,000}", "\\boxed{x}", "0.5", "\\boxed{}", None]
    done = spark.createDataFrame([(i, t) for i, t in enumerate(spellings)], "item int, completion string")
    key = spark.createDataFrame([(i, a) for i, a in enumerate(["0.5", "1/2", ".5", "1000", "X.", "0.5", "1", "1"])], "item int, answer string")
    got = {r["item"]: (r["correct"], r["unread"]) for r in G.grade(done, key, ["item"], "math").collect()}
    assert [got[i][0] for i in range(8)] == [True] * 5 + [False] * 3
    assert [got[i][1] for i in (5, 6, 7)] == [G.NOTHING, G.NOTHING, G.BLANK]
    with pytest.raises(ValueError):
        G.grade(done, key, ["item"], "logit")


def test_unmatched_boxes(spark):
    texts = ["\\boxed{a}", "\\boxed{a", "\\boxed{{{a}}} \\boxed{b}", "", None, "\\boxed{\\boxed{a}}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(G.unmatched_boxes(F.col("t"))).collect()]
    assert got[:4] == [0, 1, 1, 0] and got[5] == 1


def test_totals_in_one_pass(spark):
    done = spark.createDataFrame([(1, "\\boxed{A}"), (2, "\\boxed{B}"), (3, "\\boxed{"), (5, "答案：C")], "item int, completion string")
    key = spark.createDataFrame([(1, "x", "p", "A"), (2, "x", "q", "A"), (3, "y", "p", "A"), (4, "y", "p", "B"), (5, None, "p", "c ")], "item int, benchmark string, config string, answer string")
    key = key.withColumn("options", F.array(*map(F.lit, "ABC")))
    sums = G.totals(G.grade(done, key, ["item"]), ["benchmark", "config"])
    got = {(r["benchmark"], r["config"], r["level"]): (r["items"], r["correct"], r["unparsed"], r["unmatched"], r["alarm"]) for r in sums.collect()}
    assert got == {("x", "p", 0): (1, 1, 0, 0, False), ("x", "q", 0): (1, 0, 0, 0, False), ("y", "p", 0): (2, 0, 2, 1, True), (None, "p", 0): (1, 1, 0, 0, False),
                   ("x", None, 1): (2, 1, 0, 0, False), ("y", None, 1): (2, 0, 2, 1, True), (None, None, 1): (1, 1, 0, 0, False), (None, None, 2): (5, 2, 2, 1, True)}
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and "Union" not in plan
    assert G.totals(G.grade(done.limit(0), key.limit(0), ["item"]), ["benchmark"]).filter("items > 0").collect() == []


def test_the_filter_counts_in_its_own_pass(spark):
    rows = [("臺灣国国", "a"), ("臺灣", "a"), ("words", "b"), ("国", None), ("国", "c"), (None, "b")]
    df = spark.createDataFrame(rows, "t string, source string")
    kept, seen = A.filter_script_counted(df, "t", "source", ["a", "b"])
    assert sorted((r["t"] or "", r["source"]) for r in kept.collect()) == [("", "b"), ("words", "b"), ("臺灣", "a")]
    assert seen.get == {"kept": {"a": 1, "b": 2, "": 0}, "dropped": {"a": 1, "b": 0, "": 2}}


def test_weights_and_what_the_total_follows(spark):
    rows = [(i, float(i % 2), float(i % 5 == 0), 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "i int, accuracy_exact double, format_boxed double, format_think double")

    def judged(*weights):
        spec = [{"name": n, "weight": w} for n, w in zip(("accuracy_exact", "format_boxed", "format_think"), weights, strict=True)]
        total = sum(F.col(s["name"]) * s["weight"] for s in spec)
        return {r["reward"]: r for r in A.weight_balance(df.withColumn("reward", total), spec).collect()}

    good = judged(3.0, 0.5, 0.5)
    assert good["accuracy_exact"]["verdict"] == "dominates" and good["accuracy_exact"]["correlation"] > 0.9
    assert good["format_boxed"]["verdict"] == "shaping" and good["format_think"]["correlation"] is None
    bad = judged(0.3, 3.0, 0.5)
    assert bad["accuracy_exact"]["verdict"] == "outweighed" and bad["format_boxed"]["verdict"] == "stronger than correctness"


def test_cut_off_completions_are_masked(spark):
    df = spark.createDataFrame([(1, 10, 1.0), (1, 99, 0.0), (1, 20, None), (2, 99, 1.0)], "step int, n int, r double")
    got = {r["step"]: (r["completions"], r["rewarded"], r["mean_reward"], r["warn"]) for r in A.clipped_ratio(df, F.col("n"), 50, ["step"], reward="r").collect()}
    assert got == {1: (3, 1, 1.0, True), 2: (1, 0, None, True)}


def test_general_rows_for_each_tool_row(spark):
    df = spark.createDataFrame([(i,) for i in range(12)], "i int")
    verdict = lambda n: A.tool_balance(df, F.col("i") < n).first()["verdict"]
    assert [verdict(n) for n in (0, 1, 3, 4, 6)] == ["no tool rows", "too few tool rows", "inside", "inside", "too few general rows"]


def test_common_characters_are_stable():
    ranges = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff\u3001-\u3002\u4e00-\u9fa5"
    chars = [chr(c) for c in range(128)] + [chr(c) for a, b in zip(ranges[::3], ranges[2::3], strict=True) for c in range(ord(a), ord(b) + 1)]
    plain = set(X._stable_ranges())
    assert plain and all(len(c.lower()) == 1 for c in chars)
    assert all(X.normalized("a" + c + "a") == "a" + c.lower() + "a" for c in chars)


def test_own_spec_scores(spark):
    from corpusforge.workloads.rewards import SPEC
    df = spark.createDataFrame([("\\boxed{1}", "1")], "completion string, target string")
    assert S.score(df, SPEC, target="target").first()["rewards_applied"] >= 3


def test_stage_advice(spark):
    rows = [("law", 1, 10), ("law", 1, 20), ("wiki", 1, 40), ("wiki", 2, 40), ("news", 1, 5), (None, 1, 1)]
    df = spark.createDataFrame(rows, "source string, copy int, n int")
    got = {r["source"]: (r["own_tokens"], r["epochs"], r["advice"]) for r in A.stage_advice(df, F.col("n"), ["law"], least=31).collect()}
    assert got == {"law": (30, 1.0, "too little text for this stage"), "wiki": (40, 2.0, "memorizes"), "news": (5, 1.0, "fits"), None: (1, 1.0, "fits")}
    assert {r["advice"] for r in A.stage_advice(df, F.col("n"), ["law"], least=30).collect()} == {"fits", "memorizes"}


def test_gram_hashes_count_as_grams_do(spark):
    texts = ["", None, "a b c", "a b c d", "a  b\tc d a b c d", "中文字元中文字元", "中文字", "x中y文z字w元q中", " a b c d ", "a " * 50]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select(X.fourgrams("t").alias("g"), X.fourgram_hashes("t").alias("h")).collect():
        assert (len(r["g"] or []), len(set(r["g"] or []))) == (len(r["h"] or []), len(set(r["h"] or [])))
