"""Rewards: the four built-in samples, every branch, composition."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusforge.functions import rewards as R
from corpusforge.operators import scoring as S

SAMPLES = [
    "<think>先算 420*600=252000</think>答案是 \\boxed{11 \\frac{2}{3}}",
    "<think>这个问题需要计算</think>答案是 \\boxed{11}",
    "The answer is definitely forty two because reasons apply here.",
    "好的好的好的好的好的好的好的好的好的好的好的好的好的好的好的好的",
]
TARGET = "11 \\frac{2}{3}"


def gauss(n, t=600):
    return math.exp(-((n - t) ** 2) / (2 * (t * 0.6) ** 2))


EXPECTED = {
    "zhtw_purity": [1.0, 0.0, None, 1.0],
    "no_english_drift": [0.95, 1.0, 0.0, 1.0],
    "format_think": [0.3, 0.3, 0.0, 0.0],
    "format_boxed": [1.0, 1.0, 0.0, 0.0],
    "accuracy_exact": [1.0, 0.0, 0.0, 0.0],
    "accuracy_math": [1.0, 0.0, 0.0, 0.0],
    "accuracy_mcq": [1.0, 1.0, 0.0, 0.0],
    "no_repetition": [None, None, None, 2 / 29],
    "length_target": [gauss(len(s)) for s in SAMPLES],
}


def table(spark, rows, columns="i int, completion string, prompt string, target string"):
    return spark.createDataFrame(rows, columns)


def scores(df, spec, **kw):
    return [tuple(r)[1:] for r in S.score(df, spec, **kw).orderBy("i").drop(
        "completion", "prompt", "target", "reward", "rewards_applied").collect()]


@pytest.mark.parametrize("name", EXPECTED)
def test_built_in_samples(spark, name):
    df = table(spark, [(i, s, None, TARGET) for i, s in enumerate(SAMPLES)])
    got = [r[0] for r in scores(df, [name], target="target")]
    assert got == [None if e is None else pytest.approx(e, abs=1e-12) for e in EXPECTED[name]]


def test_score_matrix_is_the_samples_table(spark):
    df = table(spark, [(i, s, None, TARGET) for i, s in enumerate(SAMPLES)])
    long = S.score_matrix(df, ["i"], target="target")
    got = {(r["reward"], r["i"]): r["score"] for r in long.collect()}
    assert len(got) == 36
    for name, values in EXPECTED.items():
        for i, value in enumerate(values):
            assert got[name, i] == (None if value is None else pytest.approx(value, abs=1e-12))


BRANCHES = [
    ("zhtw_purity", "這" * 99 + "这", {}, 0.8),
    ("zhtw_purity", "abc", {}, None),
    ("zhtw_purity", "", {}, None),
    ("no_english_drift", "好 one two six ten", {"prompt": "請計算這題"}, 0.95),
    ("no_english_drift", "好", {"prompt": "請答"}, None),
    ("no_english_drift", "`one` $two$ 12", {"prompt": "請計算這題"}, None),
    ("no_english_drift", "good", {"prompt": "請計算這題"}, 0.0),
    ("no_english_drift", "好" + " word" * 40, {"prompt": "請計算這題"}, 0.0),
    ("format_think", "<think>" + "x" * 20 + "</think>a", {}, 1.0),
    ("format_think", "<think>" + "x" * 20 + "</think> \n", {}, 0.3),
    ("format_think", "<think> " + "x" * 19 + " </think>a", {}, 0.3),
    ("format_think", "<think>a</think><think>b</think>c", {}, 0.0),
    ("format_boxed", "\\boxed{ }", {}, 0.0),
    ("format_boxed", "\\boxed{1}\\boxed{}", {}, 0.2),
    ("format_boxed", "\\boxed{a{b{c}}}", {}, 0.0),
    ("accuracy_mcq", "答案：(c)", {"target": " C. because"}, 1.0),
    ("accuracy_mcq", "\\boxed{B}", {"target": "C"}, 0.0),
    ("accuracy_mcq", "\\boxed{}\nC", {"target": "C"}, 0.0),
    ("accuracy_mcq", "\\boxed{N}", {"target": None}, 0.0),
    ("accuracy_mcq", "\\boxed{ßx}", {"target": "ß"}, 1.0),
    ("accuracy_exact", "Ｐaris。", {"target": "paris"}, 1.0),
    ("accuracy_exact", "", {"target": ""}, 0.0),
    ("accuracy_exact", "x", {"target": None}, 0.0),
    ("accuracy_math", "\\boxed{1,000}", {"target": "1000.0"}, 1.0),
    ("accuracy_math", "\\boxed{\\frac{6}{4}}", {"target": "1.5"}, 1.0),
    ("accuracy_math", "\\boxed{1\\dfrac{1}{2}}", {"target": "3/2"}, 1.0),
    ("accuracy_math", "\\boxed{-\\frac{1}{2}}", {"target": "-0.50"}, 1.0),
    ("accuracy_math", "\\boxed{-\\frac{1}{2}}", {"target": "0.5"}, 0.0),
    ("accuracy_math", "\\boxed{$7$}", {"target": "7"}, 1.0),
    ("accuracy_math", "\\boxed{1/0}", {"target": "2/0"}, 0.0),
    ("accuracy_math", "\\boxed{0.333333333}", {"target": "1/3"}, 0.0),
    ("accuracy_math", "\\boxed{999999999999999999.5}", {"target": "1999999999999999999/2"}, 1.0),
    ("accuracy_math", "\\boxed{999999999999999999.5}", {"target": "999999999999999999.50"}, 1.0),
    ("accuracy_math", "\\boxed{-}", {"target": "+"}, 0.0),
    ("accuracy_math", "\\boxed{x+1}", {"target": "X+1."}, 1.0),
    ("no_repetition", " ".join("abcdefghijklmnopqrst"), {}, 1.0),
    ("no_repetition", " ".join("abcdefghijklmnopqrs"), {}, None),
    ("no_repetition", "a " * 20, {}, 1 / 17),
    ("length_target", "x" * 600, {}, 1.0),
]


@pytest.mark.parametrize("name", sorted(R.REWARDS))
def test_branches(spark, name):
    for with_prompt in (False, True):
        cases = [(c, e, want) for n, c, e, want in BRANCHES if n == name and ("prompt" in e) == with_prompt]
        if cases:
            df = table(spark, [(i, c, e.get("prompt"), e.get("target")) for i, (c, e, _) in enumerate(cases)])
            got = scores(df, [name], target="target", prompt="prompt" if with_prompt else None)
            for (completion, extra, want), (score,) in zip(cases, got):
                assert score == (None if want is None else pytest.approx(want, abs=1e-12)), (completion, extra)


def test_accuracy_needs_a_target_column(spark):
    df = table(spark, [(0, "\\boxed{A}", None, "A")])
    names = ["accuracy_mcq", "accuracy_exact", "accuracy_math"]
    assert scores(df, names) == [(None, None, None)]


def test_compose_weights_skips_and_options(spark):
    df = table(spark, [(0, "abc", None, None), (1, "中" * 30, None, None)])
    out = S.score(df, [{"name": "zhtw_purity", "weight": 2}, {"name": "length_target", "target_length": 3},
                       {"name": "length_target", "weight": 0.5}]).orderBy("i").collect()
    assert out[0]["zhtw_purity"] is None and out[0]["rewards_applied"] == 2
    assert out[0]["length_target"] == 1.0 and out[0]["length_target_2"] == pytest.approx(gauss(3))
    assert out[0]["reward"] == pytest.approx(1.0 + 0.5 * gauss(3))
    assert out[1]["reward"] == pytest.approx(2.0 + gauss(30, 3) + 0.5 * gauss(30))
    nothing = S.score(df, ["zhtw_purity"]).orderBy("i").collect()
    assert [r["reward"] for r in nothing] == [None, 1.0]
    assert S.score(df, []).columns[-3:] == ["format_boxed", "reward", "rewards_applied"]
    with pytest.raises(ValueError, match=r"already has columns \['reward'\]"):
        S.score(df.withColumn("reward", F.lit(1)), ["zhtw_purity"])
    with pytest.raises(ValueError, match="unknown reward 'nope'; available: accuracy_exact"):
        S.score(df, ["nope"])


def test_custom_reward_reads_any_column(spark):
    @R.reward("is_first", "the row is the first")
    def is_first(s):
        return F.when(s.column("i") == 0, 1.0)

    try:
        assert ("is_first", "the row is the first") in R.list_rewards()
        assert scores(table(spark, [(0, "a", None, None), (1, "b", None, None)]), ["is_first"]) == [(1.0,), (None,)]
    finally:
        del R.REWARDS["is_first"]


def test_custom_reward_may_be_a_pandas_udf(spark):
    @F.pandas_udf("double")
    def share_of_a(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t.count("a") / len(t) if t else None).astype("float64")

    spec = [R.Reward("share_of_a", "opaque logic", lambda s: share_of_a(s.measure("text")))]
    df = table(spark, [(0, "ab", None, None), (1, "", None, None)])
    assert scores(df, spec) == [(0.5,), (None,)]


def test_message_completions_and_prompts(spark):
    df = spark.createDataFrame(
        [(0, [("assistant", "好"), ("assistant", "\\boxed{A}")], [("system", "請用中文回答問題"), ("user", "hi")], "A")],
        "i int, completion array<struct<role:string,content:string>>, prompt array<struct<role:string,content:string>>, target string")
    assert scores(df, ["format_boxed", "accuracy_mcq", "no_english_drift"], prompt="prompt", target="target") == [(1.0, 1.0, 1.0)]
    assert scores(df, ["no_english_drift"], prompt="prompt", user_turn_only=True) == [(None,)]


def test_simplified_set_is_a_parameter(spark):
    df = table(spark, [(0, "中文", None, None)])
    assert scores(df, ["zhtw_purity"], simplified="中") == [(0.0,)]


def test_scores_do_not_depend_on_partitioning(spark):
    df = table(spark, [(i, s, "請計算這題", TARGET) for i, s in enumerate(SAMPLES * 5)])
    names = sorted(R.REWARDS)
    kw = {"prompt": "prompt", "target": "target"}
    assert scores(df.repartition(1), names, **kw) == scores(df.repartition(8), names, **kw)


@pytest.mark.parametrize("answer, target, equal", [
    ("3.14159265350", "3.1415926535", True), ("3.14159265350", "3.1415926536", False),
    ("\\frac{10000000000}{2}", "5000000000", True), ("\\frac{30000000000}{10000000000}", "3", True),
    ("1,234,567,890,123,456,789,012", "1234567890123456789012.0", True), ("9" * 40 + "/3", "3" * 40, True),
    ("9" * 40, "9" * 39 + "8", False), ("1/" + "0" * 12, "0", False)])
def test_long_numbers_are_exact(spark, answer, target, equal):
    df = spark.createDataFrame([(f"so \\boxed{{{answer}}}", target)], "completion string, target string")
    scored = S.score(df, [{"name": "accuracy_math", "weight": 1.0}], target="target")
    assert scored.first()["reward"] == (1.0 if equal else 0.0)
