"""Rendering and validation of all conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusforge.operators import chat as T
from corpusforge.workloads import tables as D
from corpusforge.workloads import text as Q

MAX_TOKENS = 400


def render_chat(spark: SparkSession, folder: str) -> DataFrame:
    return D.broken_chats(spark, folder).select(
        "conv_id", F.coalesce(T.render_chat("messages", generation_prompt=True), F.lit("")).alias("text"))


def check_roles(spark: SparkSession, folder: str) -> DataFrame:
    return D.broken_chats(spark, folder).select(
        "conv_id", T.check_roles("messages").cast("long").alias("alternates"))


def assistant_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Every span with the text it covers, and the trained share."""
    df = D.chats(spark, folder).select("conv_id", T.render_chat("messages").alias("text"),
                                       T.assistant_spans("messages").alias("spans"))
    share = F.round(T.span_chars(F.col("spans")) / F.length("text"), 9)
    spans = df.select("conv_id", "text", share.alias("trained_share"), F.inline("spans"))
    return spans.select("conv_id", "trained_share", F.col("start").cast("long").alias("start"),
                        F.col("end").cast("long").alias("end"),
                        F.substring("text", F.col("start") + 1, F.col("end") - F.col("start")).alias("covered"))


def trained_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Trained characters per source, of raw text and of prompt-completion."""
    docs = D.read(spark, folder, "documents")
    pairs = D.completions(spark, folder).select("lang", "prompt", "completion")
    parts = [df.select("lang", F.lit(kind).alias("kind"), T.span_chars(T.trained_spans(df)).alias("n"))
             for kind, df in (("text", docs), ("pair", pairs))]
    return parts[0].unionByName(parts[1]).groupBy("lang", "kind").agg(F.sum("n").alias("trained_chars"))


def survivors(spark: SparkSession, folder: str) -> DataFrame:
    """Outcome of rows that may be JSON text, lack a turn or be too long."""
    text = D.json_chats(spark, folder).withColumn("source", F.lit("text"))
    native = D.broken_chats(spark, folder).withColumn("source", F.lit("native"))
    return (T.survivors(text, MAX_TOKENS, by="source")
            .unionByName(T.survivors(native, MAX_TOKENS, by="source")))


def truncation_report(spark: SparkSession, folder: str) -> DataFrame:
    df = D.completions(spark, folder)
    return T.truncation_report(df, "completion", 512, by="source").select(
        "source", "rows", "truncated", F.round("truncated_share", 9).alias("truncated_share"))


QUERIES = {f.__name__: f for f in (
    render_chat, check_roles, assistant_spans, trained_spans, survivors, truncation_report)}

_SYS = "messages[1].role = 'system'"
_LOOP = f"CASE WHEN {_SYS} THEN messages[2:] ELSE messages END"
_PRE = f"CASE WHEN {_SYS} THEN messages[1].content || chr(10) || chr(10) ELSE '' END"
_HEAD = ("'<start_of_turn>' || CASE WHEN m.role = 'assistant' THEN 'model' ELSE m.role END || chr(10) || "
         "CASE WHEN i = 1 THEN prefix ELSE '' END")
_BODY = f"{D.sql_strip('m.content')} || '<end_of_turn>' || chr(10)"
_TURNS = f"t AS (SELECT conv_id, messages, {_LOOP} AS loop, {_PRE} AS prefix FROM chosen)"
_RENDERED = f"'<bos>' || array_to_string(list_transform(loop, lambda m, i: {_HEAD} || {_BODY}), '')"
_FITS = "len(list_filter(loop, lambda m, i: (m.role = 'user') <> (i % 2 = 1))) = 0"
_BROKEN = f"WITH {D.BROKEN_CHATS}, chosen AS (SELECT * FROM broken), {_TURNS}"
_OUTCOME = (f"CASE WHEN len(messages) = 0 THEN 'empty' WHEN NOT ({_FITS}) THEN 'bad_roles' "
            f"WHEN {Q.sql_tokens(_RENDERED)} > {MAX_TOKENS} THEN 'too_long' ELSE 'ok' END")

SQL = {
    "render_chat": f"{_BROKEN} SELECT conv_id, CASE WHEN len(messages) = 0 THEN '' ELSE {_RENDERED} || "
                   "'<start_of_turn>model' || chr(10) END AS text FROM t",
    "check_roles": f"{_BROKEN} SELECT conv_id, ({_FITS})::bigint AS alternates FROM t",
    "assistant_spans": f"WITH {D.CHATS}, chosen AS (SELECT * FROM chats), {_TURNS}, "
                       f"p AS (SELECT conv_id, unnest(list_transform(loop, lambda m, i: {{'i': i, 'trained': m.role = 'assistant', "
                       f"'head': length({_HEAD}), 'body': length({_BODY}), 'covered': {_BODY}}}), recursive := true) FROM t), "
                       "o AS (SELECT *, 5 + sum(head + body) OVER (PARTITION BY conv_id ORDER BY i) AS e, "
                       "5 + sum(head + body) OVER (PARTITION BY conv_id) AS total, "
                       "sum(CASE WHEN trained THEN body ELSE 0 END) OVER (PARTITION BY conv_id) AS kept FROM p) "
                       "SELECT conv_id, round(kept::double / total, 9) AS trained_share, (e - body)::bigint AS start, "
                       "e::bigint AS \"end\", covered FROM o WHERE trained",
    "trained_spans": f"WITH {D.COMPLETIONS} SELECT lang, 'text' AS kind, sum(length(text))::bigint AS trained_chars FROM documents "
                     "GROUP BY lang UNION ALL SELECT lang, 'pair', sum(length(completion))::bigint FROM completions GROUP BY lang",
    "survivors": f"{_BROKEN}, b AS (SELECT 'native' AS source, {_OUTCOME} AS outcome FROM t), "
                 f"whole AS (SELECT conv_id, messages, {_LOOP} AS loop, {_PRE} AS prefix FROM chats), "
                 f"j AS (SELECT 'text' AS source, CASE WHEN conv_id % 10 IN (3, 6) THEN 'bad_json' ELSE {_OUTCOME} END AS outcome FROM whole) "
                 "SELECT source, outcome, count(*) AS rows FROM (FROM b UNION ALL FROM j) GROUP BY ALL",
    "truncation_report": f"WITH {D.COMPLETIONS}, k AS (SELECT source, {Q.sql_tokens('completion')} AS tokens FROM completions) "
                         "SELECT source, count(*) AS rows, count(*) FILTER (tokens > 512) AS truncated, "
                         "round(count(*) FILTER (tokens > 512)::double / count(*), 9) AS truncated_share FROM k GROUP BY source",
}
