"""Conversations in every layout, brought to one schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusforge.operators import conform as C
from corpusforge.operators import prompts as P
from corpusforge.workloads import tables as D
from corpusforge.workloads import text as Q


def flat(messages: str) -> Column:
    """One comparable string per conversation."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")


def sql_flat(messages: str) -> str:
    return f"array_to_string(list_transform({messages}, lambda m: m.role || ':' || m.content), chr(10))"


def decode_json(spark: SparkSession, folder: str) -> DataFrame:
    """Decode with bad rows marked, so that they can be rejected and counted."""
    df = C.decode_json(D.json_chats(spark, folder), ["messages"], on_bad="mark")
    return df.select("conv_id", F.coalesce("bad_json", F.lit("")).alias("bad_json"),
                     F.coalesce(flat("messages"), F.lit("")).alias("flat"))


def sharegpt_to_messages(spark: SparkSession, folder: str) -> DataFrame:
    df = C.sharegpt_to_messages(D.sharegpt(spark, folder))
    return df.select("conv_id", flat("messages").alias("flat"))


def sharegpt_text(spark: SparkSession, folder: str) -> DataFrame:
    """The same from JSON text."""
    df = D.sharegpt(spark, folder).withColumn("conversations", F.to_json("conversations"))
    return C.sharegpt_to_messages(df).select("conv_id", flat("messages").alias("flat"))


def sharegpt_preference(spark: SparkSession, folder: str) -> DataFrame:
    df = C.sharegpt_preference(D.preferences(spark, folder))
    return df.select("conv_id", *[flat(c).alias(c) for c in ("prompt", "chosen", "rejected")])


def decode_tools(spark: SparkSession, folder: str) -> DataFrame:
    """JSON text of no known layout keeps every field."""
    calls = F.to_json(F.transform("messages", lambda m: F.struct(
        m["role"].alias("name"), F.struct(F.length(m["content"]).alias("size")).alias("parameters"))))
    df = C.decode_json(D.chats(spark, folder).select("conv_id", calls.alias("tools")), ["tools"])
    each = F.try_variant_get("tools", "$", "array<struct<name:string,parameters:struct<size:bigint>>>")
    return df.select("conv_id", F.inline(each)).select("conv_id", "name", F.col("parameters.size").alias("size"))


def preference_from_text(spark: SparkSession, folder: str) -> DataFrame:
    """JSON text of turns, of a lone turn, and of role/content messages."""
    df = D.preferences(spark, folder)
    rejected = F.struct(F.lit("assistant").alias("role"), F.col("rejected").alias("content"))
    text = df.select("conv_id", F.to_json("conversations").alias("conversations"), F.to_json("chosen").alias("chosen"),
                     F.to_json(F.array(rejected)).alias("rejected"))
    done = C.sharegpt_preference(C.decode_json(text, ["conversations", "chosen", "rejected"]))
    return done.select("conv_id", *[flat(c).alias(c) for c in ("prompt", "chosen", "rejected")])


def alpaca_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Question columns as conversations, with context where there is some."""
    df = C.answers_to_messages(D.questions(spark, folder), "question", "answer", context="C")
    return df.select("p_partkey", flat("messages").alias("flat"))


def unknown_roles(spark: SparkSession, folder: str) -> DataFrame:
    return C.unknown_roles(D.sharegpt(spark, folder))


def rename_keep(spark: SparkSession, folder: str) -> DataFrame:
    """Every user turn with the answer that follows: rename, then keep."""
    ask, answer = F.get("messages", F.col("i")), F.get("messages", F.col("i") + 1)
    at = D.chats(spark, folder).select("conv_id", "messages", F.explode(F.transform("messages", lambda m, i: i)).alias("i"))
    pairs = at.filter((ask["role"] == "user") & (answer["role"] == "assistant")).select(
        "conv_id", F.col("i").cast("long").alias("at"), ask["content"].alias("instruction"),
        answer["content"].alias("output"), F.lit(1).alias("noise"))
    renamed = C.rename(pairs, {"instruction": "prompt", "output": "completion", "absent": "ignored"})
    return C.keep(renamed, ["completion", "prompt", "conv_id", "at"])


def _prompt_rows(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, flat("prompt").alias("prompt"), "ground_truth")


def prompts_mcq(spark: SparkSession, folder: str) -> DataFrame:
    return _prompt_rows(P.prompts_mcq(D.questions(spark, folder), keep=("p_partkey",)), "p_partkey")


def prompts_math(spark: SparkSession, folder: str) -> DataFrame:
    df = D.completions(spark, folder)
    return _prompt_rows(P.prompts_math(df, "prompt", "completion", keep=("doc_id",)), "doc_id")


def prompts_chat(spark: SparkSession, folder: str) -> DataFrame:
    df = D.completions(spark, folder)
    return _prompt_rows(P.prompts_chat(df, "completion", "target", keep=("doc_id",)), "doc_id")


def drop_unverifiable(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of the questions, whose answers are partly blank or NULL."""
    kept, _ = P.drop_unverifiable(P.prompts_mcq(D.questions(spark, folder), keep=("p_partkey", "config")))
    return kept.groupBy("config", "ground_truth").agg(F.count("*").alias("rows"))


QUERIES = {f.__name__: f for f in (
    decode_json, sharegpt_to_messages, sharegpt_text, sharegpt_preference, decode_tools, preference_from_text,
    alpaca_messages, unknown_roles, rename_keep,
    prompts_mcq, prompts_math, prompts_chat, drop_unverifiable)}

_ROLE = ("CASE WHEN lower(m['from']) IN ('human', 'user') THEN 'user' "
         "WHEN lower(m['from']) IN ('gpt', 'assistant', 'chatgpt') THEN 'assistant' "
         "WHEN lower(m['from']) = 'system' THEN 'system' ELSE '{unknown}' END")


def _sql_messages(turns: str, unknown: str) -> str:
    role = _ROLE.replace("{unknown}", unknown)
    return f"array_to_string(list_transform({turns}, lambda m: {role} || ':' || m['value']), chr(10))"


def sql_share(turns: str) -> str:
    return _sql_messages(turns, "user")


_SYSTEM = D.quote("system:" + P.V.PROMPT_SYSTEM)
_ANSWER = D.sql_strip("coalesce(answer, '')")
_MCQ = ("question || chr(10) || chr(10) || concat_ws(chr(10), 'A. ' || A, 'B. ' || B, 'C. ' || C, 'D. ' || D) "
        f"|| chr(10) || chr(10) || {D.quote(P.V.MCQ_INSTRUCTION)}")
_SHARE = f"WITH {D.SHAREGPT} SELECT conv_id, {_sql_messages('conversations', 'user')} AS flat FROM sharegpt"
_PREFERENCE = (f"WITH {D.SHAREGPT}, a AS (SELECT conv_id, conversations, list_filter(conversations, "
                           "lambda m: lower(m['from']) IN ('gpt', 'chatgpt', 'tool')) AS answers FROM sharegpt) "
                           f"SELECT conv_id, {_sql_messages('conversations', 'assistant')} AS prompt, "
                           f"{_sql_messages('answers[1:1]', 'assistant')} AS chosen, "
                           "'assistant:' || answers[-1]['value'] AS rejected FROM a WHERE len(answers) > 0")
SQL = {
    "decode_json": f"WITH {D.CHATS} SELECT conv_id, CASE conv_id % 10 WHEN 3 THEN 'messages: malformed' WHEN 6 THEN "
                   "'messages: other' ELSE '' END AS bad_json, CASE WHEN conv_id % 10 IN (3, 6) THEN '' ELSE "
                   f"{sql_flat('messages')} END AS flat FROM chats",
    "sharegpt_to_messages": _SHARE,
    "sharegpt_text": _SHARE,
    "sharegpt_preference": _PREFERENCE,
    "preference_from_text": _PREFERENCE,
    "decode_tools": f"WITH {D.CHATS}, t AS (SELECT conv_id, unnest(messages) AS m FROM chats) "
                    "SELECT conv_id, m.role AS name, length(m.content)::bigint AS size FROM t",
    "alpaca_messages": f"WITH {D.QUESTIONS} SELECT p_partkey, 'user:' || question || CASE WHEN trim(coalesce(C, '')) <> '' "
                       "THEN chr(10) || chr(10) || C ELSE '' END || chr(10) || 'assistant:' || coalesce(answer, '') AS flat FROM questions",
    "unknown_roles": f"WITH {D.SHAREGPT}, t AS (SELECT unnest(conversations)['from'] AS role FROM sharegpt) "
                     "SELECT role, count(*) AS turns FROM t WHERE lower(role) NOT IN "
                     "('human', 'user', 'gpt', 'assistant', 'chatgpt', 'system') GROUP BY role",
    "rename_keep": f"WITH {D.CHATS}, t AS (SELECT conv_id, messages, unnest(range(len(messages))) AS k FROM chats) "
                   "SELECT conv_id, k AS \"at\", messages[k + 1].content AS prompt, messages[k + 2].content AS completion "
                   "FROM t WHERE messages[k + 1].role = 'user' AND messages[k + 2].role = 'assistant'",
    "prompts_mcq": f"WITH {D.QUESTIONS} SELECT p_partkey, {_SYSTEM} || chr(10) || 'user:' || {_MCQ} AS prompt, "
                   f"{_ANSWER} AS ground_truth FROM questions",
    "prompts_math": f"WITH {D.COMPLETIONS} SELECT doc_id, {_SYSTEM} || chr(10) || 'user:' || prompt AS prompt, "
                    f"coalesce({D.sql_strip(Q.sql_boxed('completion') + '[-1]')}, '') AS ground_truth FROM completions",
    "prompts_chat": f"WITH {D.COMPLETIONS} SELECT doc_id, {_SYSTEM} || chr(10) || 'user:' || completion AS prompt, "
                    f"{D.sql_strip('target')} AS ground_truth FROM completions",
    "drop_unverifiable": f"WITH {D.QUESTIONS} SELECT config, {_ANSWER} AS ground_truth, count(*) AS rows FROM questions "
                         f"WHERE {_ANSWER} <> '' GROUP BY ALL",
}
