"""Text functions on hand-made rows; expected values worked out by hand."""

import unicodedata

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.functions import json_columns as J
from corpusforge.functions import text as X
from corpusforge.functions import values as V


def evaluate(spark, values, build):
    """build(column) for every value, in order."""
    rows = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    return [r["x"] for r in rows.select("i", build(F.col("s")).alias("x")).orderBy("i").collect()]


CASES = {
    "strip": (X.strip, [("　 \n a b\x1c\x85", "a b"), ("", ""), ("\u2003", ""), (None, None)]),
    "strip_code": (X.strip_code, [
        ("a ```x\ny``` b", "a   b"), ("`q` z", "  z"), ("$a$ b \\[c\nd\\] \\(e\\)", "  b    "),
        ("``` open", " ` open"), ("plain", "plain"), ("a ` b", "a ` b"), ("$1 only", "$1 only"), (None, None)]),
    "cjk_text": (X.cjk_text, [("a中b文𠀀ｶ。", "中文"), ("abc", ""), ("一鿿㐀", "一鿿")]),
    "simplified_count": (X.simplified_count, [("这个问题", 4), ("這個問題", 0), ("发里后台", 0), ("国國", 1)]),
    "latin_words": (X.latin_words, [
        ("one two of a", 2), ("中abc", 0), ("abc1 abc_ 1abc", 0), ("it's ABC-def", 2), ("éabc abc", 1),
        ("", 0), ("abc", 1), ("ab", 0)]),
    "think_blocks": (X.think_blocks, [
        ("<think>a\nb</think>c<think></think>", ["a\nb", ""]), ("<think>open", []), ("none", []),
        ("<think>a<think>b</think>", ["a<think>b"])]),
    "drop_think": (X.drop_think, [("a<think>x</think>b", "ab"), ("<think>x", "<think>x"), ("ab", "ab")]),
    "boxed": (X.boxed, [
        ("\\boxed{1} \\boxed{\\frac{1}{2}}", ["1", "\\frac{1}{2}"]), ("\\boxed{a{b{c}}}", []),
        ("\\boxed{}", [""]), ("\\boxed{x", []), ("boxed{1}", [])]),
    "extract_answer": (X.extract_answer, [
        ("x \\boxed{ 7 }", "7"), ("\\boxed{1}\\boxed{ }\nlast", ""), ("<think>a</think>b\n c ", "c"),
        ("<think>a</think>", None), ("  ", None), ("a\x0bb\u2028c", "c"), ("a\r\nb", "b"), ("a\x85b\x1cc", "c")]),
    "norm_answer": (X.norm_answer, [
        ("  ABC. ", "abc"), ("１２，", "12"), ("Ａ。 、", "a"), ("a.b", "a.b"), ("½", "1⁄2"), ("ﬁ,", "fi"),
        ("e\u0301.", "é"), ("É.", "é"), ("", ""), ("\x1cQ\x1f,", "q"), ("ｶﾞ", "ガ"), (None, None)]),
    "mcq_letter": (X.mcq_letter, [
        ("the answer is b", "B"), ("答案：C。", "C"), ("(d)", "D"), ("Z", "Z"), ("I think so", "I"), ("AB", "A"),
        ("A1 C", "C"), (" 11", "1"), ("中B", "中"), ("", "")]),
    "fourgrams": (X.fourgrams, [
        ("甲乙x丙丁戊", ["甲乙丙丁", "乙丙丁戊"]), ("a  b\nc d\u3000e", ["a b c d", "b c d e"]), ("a b c", []), ("", [])]),
    "token_estimate": (X.token_estimate, [
        ("中文 abc, d_1!", 6), ("", 0), ("   \n", 0), ("a中b", 3), ("...", 3), ("l'été\u3000", 3)]),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(spark, name):
    build, rows = CASES[name]
    assert evaluate(spark, [v for v, _ in rows], build) == [w for _, w in rows]


def test_norm_answer_matches_its_definition_on_all_characters(spark):
    """The native path and the UDF agree with one plain Python definition."""
    values = [chr(c) + "Aß" + chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]

    def expected(s):
        s = unicodedata.normalize("NFKC", s).strip().lower()
        while s and (s[-1].isspace() or s[-1] in V.ANSWER_TAIL):
            s = s[:-1]
        return s

    got = evaluate(spark, values, X.norm_answer)
    wrong = [v for v, g in zip(values, got) if g != expected(v)]
    assert not wrong


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab 中文这\n\u3000.\x1c", max_size=60), min_size=1, max_size=30))
def test_functions_match_python_definitions(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    got = rows.select("i", X.strip("s"), X.cjk_count("s"), F.size(X.fourgrams("s")),
                      F.size(F.array_distinct(X.fourgrams("s")))).orderBy("i").collect()
    for text, row in zip(texts, got):
        units = [c for c in text if "一" <= c <= "鿿"] or text.split()
        grams = [tuple(units[i:i + 4]) for i in range(len(units) - 3)]
        assert list(row)[1:] == [text.strip(), sum("一" <= c <= "鿿" for c in text), len(grams), len(set(grams))]


def test_long_texts_do_not_recurse(spark):
    many_braces = "\\boxed{" + "{a}" * 30000 + "}"
    assert evaluate(spark, [many_braces, "中" * 100000], lambda c: F.size(X.boxed(c))) == [1, 0]
    assert evaluate(spark, ["中" * 100000], lambda c: F.size(F.array_distinct(X.fourgrams(c)))) == [1]
    assert evaluate(spark, ["<think>" + "x\n" * 200000 + "</think>9"], X.extract_answer) == ["9"]


def test_as_text_takes_strings_messages_and_lists(spark):
    df = spark.createDataFrame(
        [("s", ("user", "m"), [("user", "a"), ("assistant", None), None, ("user", "c")]), (None, None, None)],
        "s string, m struct<role:string,content:string>, l array<struct<role:string,content:string>>")
    out = df.select(*[X.as_text(c, df.schema[c].dataType).alias(c) for c in df.columns]).collect()
    assert [tuple(r) for r in out] == [("s", "m", "a\n\nc"), ("", "", "")]
    no_content = T.StructType([T.StructField("role", T.StringType())])
    assert df.select(X.as_text(F.struct(F.lit("u").alias("role")), no_content)).first()[0] == ""


def test_json_lists(spark):
    texts = ['[{"role":"user","content":"a"},{"role":"x"}]', '{"role":"user"}', "[1,", None, '"s"',
             '[{"role":"u","content":5},3]', " [] "]
    got = evaluate(spark, texts, J.parse_list)
    assert [None if g is None else [tuple(m) if m else None for m in g] for g in got] == [
        [("user", "a"), ("x", None)], None, None, None, None, [("u", "5"), None], []]
    assert evaluate(spark, texts, J.json_kind) == ["list", "other", "malformed", "null", "other", "list", "list"]
    messages = evaluate(spark, texts, lambda c: F.size(J.as_messages(c, T.StringType())))
    assert messages == [2, 0, 0, 0, 0, 2, 0]


def test_tokenizer_counter_uses_the_callable(spark):
    counter = X.tokenizer_counter(lambda: lambda text: len(text.split("-")))
    assert evaluate(spark, ["a-b-c", "", None], counter) == [3, 1, 1]


def test_simplified_set_is_the_charset_difference():
    assert "发" not in V.SIMPLIFIED and "这" in V.SIMPLIFIED and "這" not in V.SIMPLIFIED
    assert all("一" <= c <= "鿿" for c in V.SIMPLIFIED)
    assert len(set(V.SIMPLIFIED)) == len(V.SIMPLIFIED) == 2379
    # Forms valid in both scripts must not count.
    assert not set("里后台只干面余斗表发") & set(V.SIMPLIFIED)


def test_whitespace_class_is_python_whitespace(spark):
    every = [chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    got = evaluate(spark, every, lambda c: c.rlike(V.SPACE))
    assert [c for c, g in zip(every, got) if g] == list(V.WHITESPACE)


def test_a_letter_stays_one_letter_in_upper_case(spark):
    """As the SQL cases it: ß has a capital, ŉ and ǰ have none, ı is an I, and a small iota below makes a word longer."""
    rows = [("ßb x", "ẞ"), ("ŉx", "ŉ"), ("ǰ.", "ǰ"), ("ﬁx", "ﬁ"), ("ᾳx", "ᾼ"), ("zz ı", "I"), ("A\u0345 b", "B"), ("éa", "É")]
    assert evaluate(spark, [v for v, _ in rows], X.mcq_letter) == [w for _, w in rows]


def test_norm_answer_works_its_text_out_twice_at_most(spark):
    """Once for Python and once for the native path; the large class sees only what the common one leaves."""
    df = spark.range(1).select(X.norm_answer(F.reverse(F.repeat(F.col("id").cast("string"), 2))).alias("n"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert 1 <= plan.count("reverse(") <= 2
    assert all("regexp_replace" in line for line in plan.splitlines() if "RLIKE" in line)
