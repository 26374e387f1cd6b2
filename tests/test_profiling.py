import json

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpusforge.operators import profiling as P
from corpusforge.plans.inspection import inspect


def test_shapes():
    def names(columns):
        return [s for s, _, _ in P.detect_shapes(columns)]

    assert names(["question", "A", "B", "C", "D", "answer"]) == ["multiple-choice benchmark", "QA pair"]
    assert names(["prompt", "chosen", "rejected"]) == [
        "preference (explicit prompt)", "preference (implicit prompt)", "prompt-only"]
    assert names(["prompt", "completion", "label"]) == ["unpaired preference", "prompt-completion", "prompt-only"]
    assert names(["instruction", "output", "text"]) == ["Alpaca-style", "language modeling"]
    assert names(["x"]) == ["unknown"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(1, 3000), min_size=1, max_size=200))
def test_percentiles_are_sorted_indexes(spark, lengths):
    df = spark.createDataFrame([(n,) for n in lengths] + [(None,)], "n int")
    points = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p99": 0.99, "p100": 1.0}
    row = P.percentiles(P.histogram(df, F.col("n")), points).first().asDict()
    ordered, n = sorted(lengths), len(lengths)
    assert row.pop("n") == n and row.pop("min") == ordered[0] and row.pop("max") == ordered[-1]
    assert row == {name: ordered[min(n - 1, int(n * p))] for name, p in points.items()}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=60))
def test_token_profile(spark, counts):
    df = spark.createDataFrame([(str(n), ) for n in counts] + [("",), (None,)], "text string")
    row = P.token_profile(df, counter=lambda c: c.cast("int")).first()
    ordered, n = sorted(counts), len(counts)
    p99 = ordered[min(n - 1, int(n * 0.99))]
    suggested = 1 << max(9, (max(p99, 1) - 1).bit_length())
    assert (row["n"], row["p99"], row["max"], row["suggested"]) == (n, p99, ordered[-1], suggested)
    assert row["truncated_share"] == sum(c > suggested for c in counts) / n


def test_suggested_length_at_powers_of_two(spark):
    for tokens, expected in ((0, 512), (512, 512), (513, 1024), (1697, 2048), (2048, 2048), (2049, 4096)):
        df = spark.createDataFrame([(str(tokens),)], "text string")
        assert P.token_profile(df, counter=lambda c: c.cast("int")).first()["suggested"] == expected


def test_groups_without_text_are_left_out(spark):
    df = spark.createDataFrame([("a", "xx"), ("b", ""), ("c", None)], "source string, text string")
    assert [tuple(r) for r in P.length_profile(df, by=("source",)).collect()] == [("a", 1, 2, 2, 2, 2)]
    assert [r["source"] for r in P.token_profile(df, by=("source",)).collect()] == ["a"]
    assert P.length_profile(df.filter("source = 'b'")).collect() == []


def test_rendered_rows(spark):
    share = spark.createDataFrame([([("human", "a"), ("gpt", None), None, ("x", "b")],)],
                                  "conversations array<struct<from:string,value:string>>")
    assert share.select(P.rendered_row(share)).first()[0] == "a\n\nb"
    text = spark.createDataFrame([('[{"role":"u","content":""},{"value":"v"}]',), ("[",)], "messages string")
    assert [r[0] for r in text.select(P.rendered_row(text)).collect()] == ["\nv", None]
    cols = spark.createDataFrame([("a", None, "z")], "output string, text string, other string")
    assert cols.select(P.rendered_row(cols)).first()[0] == "\na"
    other = spark.createDataFrame([(7, "z")], "first int, other string")
    assert other.select(P.rendered_row(other)).first()[0] == "7"


def test_json_columns_keys_roles_turns(spark):
    good = json.dumps([{"role": "user", "content": "a", "z": 1}, {"role": "assistant"}])
    df = spark.createDataFrame(
        [(good, [("human", "a")], "{}"), ("[", None, None), (None, [], "{}")],
        "messages string, conversations array<struct<from:string,value:string>>, tools string")
    kinds = {r["column"]: (r["kind"], r["present"], r["json"], r["malformed"]) for r in P.json_string_columns(df).collect()}
    assert kinds == {"messages": ("mixed", 2, 1, 1), "conversations": ("native", 2, 0, 0), "tools": ("json", 2, 2, 0)}
    assert {tuple(r) for r in P.element_keys(df, "messages").collect()} == {("content", 1), ("role", 1), ("z", 1)}
    assert {tuple(r) for r in P.element_keys(df, "conversations").collect()} == {("from", 1), ("value", 1)}
    assert {tuple(r) for r in P.role_histogram(df).collect()} == {("user", 1), ("assistant", 1)}
    assert tuple(P.turn_stats(df).first()) == (1, 2, 2, 2)


def test_preview(spark):
    df = spark.createDataFrame([("a\nb", [1, 2], None, "x" * 401)], "s string, l array<int>, n int, w string")
    assert tuple(P.preview(df).first()) == ("a\\nb", "[1,2]", "None", "x" * 400 + "... <+1 chars>")


def test_inspect(spark):
    df = spark.createDataFrame([([("user", "hello there")],)], "messages array<struct<role:string,content:string>>")
    report = inspect(df)
    assert report.shapes[0][0] == "conversational language modeling"
    assert report.json_columns.first()["kind"] == "native"
    assert report.lengths.first()["max"] == 11 and report.tokens.first()["max"] == 2
    assert inspect(spark.range(3)).roles is None
