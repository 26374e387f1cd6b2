import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpusforge.operators import chat as T

SCHEMA = "i int, messages array<struct<role:string,content:string>>"


def chats(spark, conversations):
    return spark.createDataFrame(list(enumerate(conversations)), SCHEMA)


def test_render(spark):
    df = chats(spark, [
        [("system", " be brief "), ("user", " hi "), ("assistant", "yo\n")],
        [("user", "a"), ("tool", "b")], [("system", "only")], [], None, [("user", None)]])
    out = [r[0] for r in df.orderBy("i").select(T.render_chat("messages", generation_prompt=True)).collect()]
    end, gen = "<end_of_turn>\n", "<start_of_turn>model\n"
    assert out == [
        f"<bos><start_of_turn>user\n be brief \n\nhi{end}<start_of_turn>model\nyo{end}{gen}",
        f"<bos><start_of_turn>user\na{end}<start_of_turn>tool\nb{end}{gen}",
        f"<bos>{gen}", None, None, f"<bos><start_of_turn>user\n{end}{gen}"]


def test_roles(spark):
    df = chats(spark, [
        [("system", "s"), ("user", "a"), ("assistant", "b")], [("assistant", "a")], [("user", "a"), ("user", "b")],
        [("user", "a"), ("tool", "b"), ("user", "c")], [], [("system", "s"), ("system", "t")], [(None, "x")]])
    assert [r[0] for r in df.orderBy("i").select(T.check_roles("messages")).collect()] == [
        True, False, False, True, True, False, False]


TURN = st.tuples(st.sampled_from(["system", "user", "assistant"]), st.text(alphabet=" a中\n<", max_size=8))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(TURN, min_size=1, max_size=6), min_size=1, max_size=20))
def test_spans_cover_exactly_the_assistant_text(spark, conversations):
    df = chats(spark, conversations)
    rows = df.select("i", T.render_chat("messages"), T.assistant_spans("messages"),
                     T.span_chars(T.assistant_spans("messages"))).orderBy("i").collect()
    for conversation, (_, text, spans, chars) in zip(conversations, rows):
        turns = conversation[1:] if conversation[0][0] == "system" else conversation
        answers = [c.strip() + "<end_of_turn>\n" for r, c in turns if r == "assistant"]
        assert [text[s:e] for s, e in spans] == answers
        assert chars == sum(map(len, answers))


def test_survivors_and_truncation(spark):
    text = spark.createDataFrame(
        [(0, '[{"role":"user","content":"a"}]'), (1, "[1"), (2, "{}"), (3, "[]"), (4, None),
         (5, '[{"role":"assistant","content":"a"}]'), (6, '[{"role":"user","content":"%s"}]' % ("w " * 50))],
        "i int, messages string")
    counts = {r["outcome"]: r["rows"] for r in T.survivors(text, 30).collect()}
    assert counts == {"ok": 1, "bad_json": 2, "empty": 2, "bad_roles": 1, "too_long": 1}
    T.require_survivors(T.survivors(text, 30))
    with pytest.raises(ValueError, match="no row survives.*bad_roles"):
        T.require_survivors(T.survivors(text.filter("i in (1, 5)"), 30))
    with pytest.raises(ValueError, match="the table is empty"):
        T.require_survivors(T.survivors(text.limit(0), 30))
    report = T.truncation_report(spark.createDataFrame([("a b c",), ("a",)], "t string"), "t", 2).first()
    assert tuple(report) == (2, 1, 0.5)
    by = T.survivors(text.withColumn("source", F.lit("s")), 30, by="source")
    assert by.columns == ["source", "outcome", "rows"]
