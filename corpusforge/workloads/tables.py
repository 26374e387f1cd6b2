"""Inputs of the registered queries, derived from the given tables.

The tables hold no Chinese text, reasoning blocks or boxed answers, so columns
with them are computed from the rows they have. Every derivation exists as a
DataFrame and as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusforge.functions import values as V

LATIN, CHINESE = "etaoinshrdlu", "這個問題需要計算答案們国"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Share out a table before work that is heavy per row, where the session
    asks for it: only for test tables that are one file with one row group."""
    spark = df.sparkSession
    wanted = spark.conf.get("corpusforge.local.spread", "false") == "true"
    return df.repartition(spark.sparkContext.defaultParallelism) if wanted else df


def quote(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


WS = quote(V.WHITESPACE)


def sql_strip(e: str) -> str:
    return f"trim({e}, {WS})"


def chinese(c: Column) -> Column:
    return F.translate(F.lower(c), LATIN, CHINESE)


def _letter(n: Column) -> Column:
    return F.substring(F.lit("ABCD"), (n % 4).cast("int") + 1, F.lit(1))


def completions(spark: SparkSession, folder: str) -> DataFrame:
    """documents as completions: id, lang, source, prompt, completion, target."""
    return completions_from(spread(read(spark, folder, "documents")))


def completions_from(docs: DataFrame) -> DataFrame:
    i, n = F.col("doc_id"), F.col("n_chars")
    kind, turn = i % 6, F.floor(i / 6)
    zh, raw, digits = chinese(F.col("text")), F.col("text"), n.cast("string")
    completion = (
        F.when(kind == 0, F.concat(F.lit("<think>"), zh, F.lit("</think>答案是 \\boxed{"), _letter(turn), F.lit("}")))
        .when(kind == 1, F.concat(F.lit("<think>這個問題</think>"), zh, F.lit("\n最終答案："), _letter(turn)))
        .when(kind == 2, F.concat(raw, F.lit("\n```python\nprint(1)\n```\n$x^2$ `code` \\boxed{\\frac{"),
                                  (n * 2).cast("string"), F.lit("}{2}}")))
        .when(kind == 3, F.concat(zh, F.lit(" \\boxed{"), _letter(turn), F.lit("} \\boxed{ "), digits, F.lit(" }")))
        .when(kind == 4, F.concat(raw, F.lit("\n"), digits, F.lit(".50")))
        .otherwise(raw))
    target = (F.when(kind <= 1, _letter(turn * 7 + n)).when(kind == 2, digits)
              .when(kind == 3, F.concat(digits, F.lit("。"))).when(kind == 4, F.concat(digits, F.lit(".5")))
              .otherwise("B"))
    prompt = (F.when(kind == 4, "Compute the value").when(kind == 5, "請回答")
              .otherwise("請計算這個問題的答案"))
    return docs.select("doc_id", "lang", "source", prompt.alias("prompt"),
                       completion.alias("completion"), target.alias("target"))


_ZH = f"translate(lower(text), '{LATIN}', '{CHINESE}')"


def _sql_letter(n: str) -> str:
    return f"substr('ABCD', (({n}) % 4)::int + 1, 1)"


_TURN = "(doc_id // 6)"
COMPLETIONS = (
    "completions AS (SELECT doc_id, lang, source, "
    "CASE doc_id % 6 WHEN 4 THEN 'Compute the value' WHEN 5 THEN '請回答' ELSE '請計算這個問題的答案' END AS prompt, "
    "CASE doc_id % 6 "
    f"WHEN 0 THEN '<think>' || {_ZH} || '</think>答案是 \\boxed{{' || {_sql_letter(_TURN)} || '}}' "
    f"WHEN 1 THEN '<think>這個問題</think>' || {_ZH} || chr(10) || '最終答案：' || {_sql_letter(_TURN)} "
    "WHEN 2 THEN text || chr(10) || '```python' || chr(10) || 'print(1)' || chr(10) || '```' || chr(10) "
    "|| '$x^2$ `code` \\boxed{\\frac{' || (n_chars * 2)::varchar || '}{2}}' "
    f"WHEN 3 THEN {_ZH} || ' \\boxed{{' || {_sql_letter(_TURN)} || '}} \\boxed{{ ' || n_chars::varchar || ' }}' "
    "WHEN 4 THEN text || chr(10) || n_chars::varchar || '.50' "
    "ELSE text END AS completion, "
    f"CASE doc_id % 6 WHEN 0 THEN {_sql_letter(_TURN + ' * 7 + n_chars')} "
    f"WHEN 1 THEN {_sql_letter(_TURN + ' * 7 + n_chars')} "
    "WHEN 2 THEN n_chars::varchar WHEN 3 THEN n_chars::varchar || '。' "
    "WHEN 4 THEN n_chars::varchar || '.5' ELSE 'B' END AS target "
    "FROM documents)")


def chats(spark: SparkSession, folder: str) -> DataFrame:
    """conversations as rows: conv_id, messages. One conversation is one row of
    the data model, so this is the only place that gathers turns."""
    turns = read(spark, folder, "conversations")
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return (turns.groupBy("conv_id").agg(ordered.alias("turns"))
            .select("conv_id", F.transform("turns", lambda t: F.struct(
                t["role"].alias("role"), t["text"].alias("content"))).alias("messages")))


CHATS = ("chats AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS messages "
         "FROM conversations GROUP BY conv_id)")


def broken_chats(spark: SparkSession, folder: str) -> DataFrame:
    """chats, of which every seventh lost its first message."""
    lost = F.slice("messages", 2, F.size("messages"))
    return chats(spark, folder).select(
        "conv_id", F.when(F.col("conv_id") % 7 == 0, lost).otherwise(F.col("messages")).alias("messages"))


BROKEN_CHATS = (CHATS + ", broken AS (SELECT conv_id, CASE WHEN conv_id % 7 = 0 THEN messages[2:] "
                "ELSE messages END AS messages FROM chats)")


def sharegpt(spark: SparkSession, folder: str) -> DataFrame:
    """chats in from/value layout, with some odd role names."""
    role = lambda m, i: (
        F.when((m["role"] == "assistant") & (i % 4 == 3), "tool")
        .when(m["role"] == "assistant", F.when(F.col("conv_id") % 3 == 0, "ChatGPT").otherwise("gpt"))
        .when(m["role"] == "user", "Human").otherwise(m["role"]))
    turns = F.transform("messages", lambda m, i: F.struct(role(m, i).alias("from"), m["content"].alias("value")))
    return chats(spark, folder).select("conv_id", turns.alias("conversations"))


SHAREGPT = (CHATS + ", sharegpt AS (SELECT conv_id, list_transform(messages, lambda m, i: {'from': "
            "CASE WHEN m.role = 'assistant' AND (i - 1) % 4 = 3 THEN 'tool' "
            "WHEN m.role = 'assistant' THEN CASE WHEN conv_id % 3 = 0 THEN 'ChatGPT' ELSE 'gpt' END "
            "WHEN m.role = 'user' THEN 'Human' ELSE m.role END, 'value': m.content}) AS conversations FROM chats)")


def json_chats(spark: SparkSession, folder: str) -> DataFrame:
    """chats as JSON text, of which some are cut off or no list."""
    text = F.to_json("messages")
    one = F.to_json(F.get("messages", F.lit(0)))
    i = F.col("conv_id") % 10
    cut = F.substring(text, F.lit(1), F.length(text) - 1)
    return chats(spark, folder).select(
        "conv_id", F.when(i == 3, cut).when(i == 6, one).otherwise(text).alias("messages"))


def preferences(spark: SparkSession, folder: str) -> DataFrame:
    """Prompt turns, first and last assistant turn (a lone turn and a string)."""
    answers = F.filter("conversations", lambda t: F.lower(t["from"]).isin("gpt", "chatgpt", "tool"))
    return (sharegpt(spark, folder).withColumn("answers", answers).filter(F.size("answers") > 0)
            .select("conv_id", "conversations", F.get("answers", F.lit(0)).alias("chosen"),
                    F.try_element_at("answers", F.lit(-1))["value"].alias("rejected")))


def questions(spark: SparkSession, folder: str) -> DataFrame:
    """part as multiple choice: question, A-D, answer, config, split."""
    part = read(spark, folder, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    answer = F.concat(F.lit(" "), F.lower(_letter(k)), F.lit(". "))
    return part.select(
        "p_partkey", F.col("p_name").alias("question"), F.col("p_brand").alias("A"), F.col("p_type").alias("B"),
        F.when(size % 5 != 0, size.cast("string")).alias("C"),
        F.when(size % 3 != 0, F.concat(F.col("p_name"), F.lit(" "), F.col("p_type"))).alias("D"),
        F.when(size % 11 == 0, " ").when(size % 13 == 0, None).otherwise(answer).alias("answer"),
        F.col("p_brand").alias("config"),
        F.when(size % 2 == 0, "test").when(F.col("p_brand") == "Brand#1", "train").otherwise("validation")
        .alias("split"))


QUESTIONS = (
    "questions AS (SELECT p_partkey, p_name AS question, p_brand AS A, p_type AS B, "
    "CASE WHEN p_size % 5 <> 0 THEN p_size::varchar END AS C, "
    "CASE WHEN p_size % 3 <> 0 THEN p_name || ' ' || p_type END AS D, "
    "CASE WHEN p_size % 11 = 0 THEN ' ' WHEN p_size % 13 = 0 THEN NULL "
    f"ELSE ' ' || lower({_sql_letter('p_partkey')}) || '. ' END AS answer, p_brand AS config, "
    "CASE WHEN p_size % 2 = 0 THEN 'test' WHEN p_brand = 'Brand#1' THEN 'train' ELSE 'validation' END AS split "
    "FROM part)")


def metric_log(spark: SparkSession, folder: str) -> DataFrame:
    return metric_log_from(read(spark, folder, "events"))


def metric_log_from(events: DataFrame) -> DataFrame:
    """events as a training log: run_id, step, ratio."""
    kind = F.col("event_type")
    ratio = F.when(kind == "view", None).when(kind.isin("error", "click"), 1.0).otherwise(0.2)
    return events.select(F.col("user_id").cast("string").alias("run_id"), F.col("event_id").alias("step"),
                         ratio.cast("double").alias("ratio"))


METRIC_LOG = ("metric_log AS (SELECT user_id::varchar AS run_id, event_id AS step, CASE WHEN event_type = 'view' "
              "THEN NULL WHEN event_type IN ('error', 'click') THEN 1.0 ELSE 0.2 END AS ratio FROM events)")
