import pytest
from pyspark.sql import functions as F

from corpusforge.operators import conform as C
from corpusforge.operators import prompts as P

MESSAGES = "array<struct<role:string,content:string>>"
SHARE = "array<struct<from:string,value:string>>"


def pairs(value):
    return None if value is None else [tuple(m) for m in value]


def test_decode_json_raises_or_marks(spark):
    df = spark.createDataFrame([(1, '[{"role":"user","content":"a"}]'), (2, None)], "i int, messages string")
    rows = C.decode_json(df, ["messages"]).orderBy("i").collect()
    assert [pairs(r["messages"]) for r in rows] == [[("user", "a")], None]
    bad = df.unionByName(spark.createDataFrame([(3, "[1,"), (4, '{"role":"user"}')], "i int, messages string"))
    with pytest.raises(Exception, match="column messages holds no JSON list"):
        C.decode_json(bad, ["messages"]).collect()
    marked = C.decode_json(bad, ["messages"], on_bad="mark").orderBy("i").collect()
    assert [r["bad_json"] for r in marked] == [None, None, "messages: malformed", "messages: other"]
    assert marked[2]["messages"] is None
    with pytest.raises(ValueError, match=r"\['tools'\] are missing; available: \['i', 'messages'\]"):
        C.decode_json(df, ["tools"])


def test_decode_json_leaves_native_columns(spark):
    df = spark.createDataFrame([([("user", "a")],)], f"messages {MESSAGES}")
    assert C.decode_json(df, ["messages"]).schema == df.schema


def test_sharegpt_roles(spark):
    turns = [("human", "a"), ("GPT", "b"), ("ChatGPT", None), ("System", "c"), ("tool", "d"), (None, "e")]
    df = spark.createDataFrame([(1, turns), (2, None), (3, [])], f"i int, conversations {SHARE}")
    out = [pairs(r["messages"]) for r in C.sharegpt_to_messages(df).orderBy("i").collect()]
    assert out == [[("user", "a"), ("assistant", "b"), ("assistant", ""), ("system", "c"), ("user", "d"), ("user", "e")],
                   [], []]
    unknown = {r["role"]: r["turns"] for r in C.unknown_roles(df).collect()}
    assert unknown == {"tool": 1, "": 1}


def test_sharegpt_from_text(spark):
    df = spark.createDataFrame([('[{"from":"human","value":"a"}]',), (None,)], "conversations string")
    out = C.sharegpt_to_messages(df)
    assert out.columns == ["conversations", "messages"] and out.schema["conversations"] == df.schema["conversations"]
    assert [pairs(r["messages"]) for r in out.collect()] == [[("user", "a")], []]
    with pytest.raises(Exception, match="holds no JSON list"):
        C.sharegpt_to_messages(spark.createDataFrame([("{",)], "conversations string")).collect()


def test_sharegpt_preference_layouts(spark):
    df = spark.createDataFrame(
        [(1, [("human", "q"), ("observer", "o")], ("gpt", "yes"), "no"), (2, None, None, None)],
        f"i int, conversations {SHARE}, chosen struct<from:string,value:string>, rejected string")
    one, none = C.sharegpt_preference(df).orderBy("i").collect()
    assert pairs(one["prompt"]) == [("user", "q"), ("assistant", "o")]
    assert pairs(one["chosen"]) == [("assistant", "yes")]
    assert pairs(one["rejected"]) == [("assistant", "no")]
    assert [none["prompt"], none["chosen"], none["rejected"]] == [[], [], []]
    with pytest.raises(ValueError, match="chosen"):
        C.sharegpt_preference(df.drop("chosen"))


def test_rename_and_keep(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert C.rename(df, {"a": "x", "x": "y", "gone": "z", "b": "b"}).columns == ["y", "b", "c"]
    with pytest.raises(ValueError, match="already has B"):
        C.rename(df, {"a": "B"})
    assert C.keep(df, ["c", "a"]).columns == ["a", "c"]
    with pytest.raises(ValueError, match=r"\['q'\] are missing; available: \['a', 'b', 'c'\]"):
        C.keep(df, ["a", "q"])


def test_check_aligned_compares_types(spark):
    a = spark.createDataFrame([(1, "x")], "i long, t string")
    C.check_aligned({"a": a, "b": a.select("t", "i")})
    for other in (a.drop("t"), a.withColumn("i", F.col("i").cast("string"))):
        with pytest.raises(ValueError, match="b: "):
            C.check_aligned({"a": a, "b": other})


def test_prompts(spark):
    df = spark.createDataFrame([("q", "x", None, "y", "z", " b "), (None, None, None, None, None, None)],
                               "question string, A string, B string, C string, D string, answer string")
    rows = P.prompts_mcq(df, system="s").collect()
    assert pairs(rows[0]["prompt"]) == [("system", "s"), ("user", "q\n\nA. x\nC. y\nD. z\n\n請選出正確選項的英文字母。")]
    assert [r["ground_truth"] for r in rows] == ["b", ""]
    with pytest.raises(ValueError, match="'E'"):
        P.prompts_mcq(df, letters="ABCDE")
    with pytest.raises(ValueError, match="cannot be told apart"):
        P.prompts_mcq(df.selectExpr("*", "A as a_").withColumnRenamed("a_", "a"))
    math = spark.createDataFrame([("q", "so \\boxed{1} or \\boxed{ 2 }"), ("q", "no box"), ("q", None)],
                                 "question string, answer string")
    assert [r["ground_truth"] for r in P.prompts_math(math).collect()] == ["2", "", ""]
    assert [r["ground_truth"] for r in P.prompts_chat(math).collect()] == ["so \\boxed{1} or \\boxed{ 2 }", "no box", ""]
    assert [r["ground_truth"] for r in P.prompts_chat(math.drop("answer")).collect()] == [""] * 3


def test_drop_unverifiable_counts_in_one_pass(spark):
    df = spark.createDataFrame([("a",), ("",), ("",)], "ground_truth string")
    kept, seen = P.drop_unverifiable(df)
    assert kept.count() == 1
    assert seen.get == {"rows": 3, "dropped": 2}
    P.require_targets(seen)
    none, seen = P.drop_unverifiable(df.filter("ground_truth = ''"))
    none.collect()
    with pytest.raises(ValueError, match="no verifiable row"):
        P.require_targets(seen)


def test_decoding_keeps_or_tells_of_every_field(spark):
    rows = [(1, '[{"name":"f","parameters":{"x":1}}]', '[{"role":"user","content":"a"}]'),
            (2, None, '[{"role":"user","content":"a","tool_calls":[1]}]')]
    df = spark.createDataFrame(rows, "i int, tools string, messages string")
    tools = C.decode_json(df, ["tools"]).select(F.to_json("tools").alias("t")).collect()
    assert tools[0]["t"] == rows[0][1] and tools[1]["t"] is None
    with pytest.raises(Exception, match="tool_calls"):
        C.decode_json(df, ["messages"]).collect()
    marked = C.decode_json(df, ["messages"], on_bad="mark").orderBy("i").collect()
    assert [r["bad_json"] for r in marked] == [None, "messages: unknown fields tool_calls"]


def test_preference_text_has_to_be_decoded(spark):
    df = spark.createDataFrame([('[{"from":"human","value":"q"}]', '[{"role":"assistant","content":"x"}]',
                                 '{"from":"gpt","value":"a"}')], "conversations string, chosen string, rejected string")
    row = C.sharegpt_preference(C.decode_json(df, df.columns)).first()
    assert [[tuple(m) for m in row[c]] for c in ("prompt", "chosen", "rejected")] == [
        [("user", "q")], [("assistant", "x")], [("assistant", "a")]]
    with pytest.raises(Exception, match="decode it first"):
        C.sharegpt_preference(df).collect()
    assert C.unknown_roles(df).count() == 0


def test_answers_to_messages(spark):
    df = spark.createDataFrame([("q", "a", "c"), ("q", None, " ")], "instruction string, output string, input string")
    got = [[tuple(m) for m in r["messages"]] for r in C.answers_to_messages(df, "instruction", "output", "input").collect()]
    assert got == [[("user", "q\n\nc"), ("assistant", "a")], [("user", "q"), ("assistant", "")]]
