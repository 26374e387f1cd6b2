"""Profiles of whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusforge.operators import mixing as M
from corpusforge.operators import profiling as P
from corpusforge.workloads import tables as D
from corpusforge.workloads import text as Q


def shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Detected shapes and row counts of five differently shaped tables."""
    some = {"documents": D.read(spark, folder, "documents"), "chats": D.chats(spark, folder),
            "sharegpt": D.sharegpt(spark, folder), "preferences": D.preferences(spark, folder),
            "questions": D.questions(spark, folder), "events": D.read(spark, folder, "events")}
    found = [P.profile_shapes(df).select(F.lit(t).alias("table"), "shape", "rows") for t, df in some.items()]
    return reduce(DataFrame.unionByName, found)


def json_string_columns(spark: SparkSession, folder: str) -> DataFrame:
    df = (D.json_chats(spark, folder).join(D.sharegpt(spark, folder), "conv_id")
          .withColumn("tools", F.to_json(F.struct("conv_id"))))
    return P.json_string_columns(df)


def element_keys(spark: SparkSession, folder: str) -> DataFrame:
    native = P.element_keys(D.sharegpt(spark, folder), "conversations").withColumn("stored", F.lit("native"))
    text = P.element_keys(D.json_chats(spark, folder), "messages").withColumn("stored", F.lit("json"))
    return native.unionByName(text)


def role_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return P.role_histogram(D.json_chats(spark, folder))


def turn_stats(spark: SparkSession, folder: str) -> DataFrame:
    return P.turn_stats(D.broken_chats(spark, folder))


def length_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Rendered length of two shapes: text rows per source, and conversations."""
    docs = P.length_profile(D.read(spark, folder, "documents"), by=("source",))
    chats = P.length_profile(D.sharegpt(spark, folder)).withColumn("source", F.lit("<conversations>"))
    return docs.unionByName(chats)


def token_profile(spark: SparkSession, folder: str) -> DataFrame:
    df = P.token_profile(D.completions(spark, folder), "completion", by=("lang",))
    return df.withColumn("truncated_share", F.round("truncated_share", 9))


def token_profile_all(spark: SparkSession, folder: str) -> DataFrame:
    df = P.token_profile(D.read(spark, folder, "documents"))
    return df.withColumn("truncated_share", F.round("truncated_share", 9))


def preference_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Token percentiles of a preference table, one profile per column."""
    df = D.preferences(spark, folder)
    texts = {"chosen": F.col("chosen")["value"], "rejected": F.col("rejected"), "prompt": P.rendered_row(df)}
    parts = [P.token_profile(df, text).withColumn("column", F.lit(name)) for name, text in texts.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("truncated_share", F.round("truncated_share", 9))


def preview(spark: SparkSession, folder: str) -> DataFrame:
    """Every document the way a preview shows it."""
    return P.preview(D.read(spark, folder, "documents"), n=None)


def mix_composition(spark: SparkSession, folder: str) -> DataFrame:
    parts = {lang: D.read(spark, folder, "documents").filter(F.col("lang") == lang) for lang in ("en", "de", "fr", "es")}
    return P.mix_composition(M.concat(parts))


QUERIES = {
    "profile_shapes": shapes, "json_string_columns": json_string_columns, "element_keys": element_keys,
    "role_histogram": role_histogram, "turn_stats": turn_stats, "length_profile": length_profile,
    "token_profile": token_profile, "token_profile_all": token_profile_all, "column_lengths": preference_lengths,
    "preview": preview, "mix_composition": mix_composition,
}


def sql_percentiles(rows: str, points: dict[str, float], by: str = "") -> str:
    """Index percentiles by row number; `rows` yields value (and the group)."""
    part = f"PARTITION BY {by}" if by else ""
    picks = ", ".join(f"min(value) FILTER (rn = least(n - 1, floor(n * {p}::double)::bigint)) AS {name}"
                      for name, p in points.items())
    keys = f"{by}, " if by else ""
    return (f"SELECT {keys}count(*) AS n, min(value) AS min, {picks}, max(value) AS max FROM (SELECT {keys}value, "
            f"row_number() OVER ({part} ORDER BY value) - 1 AS rn, count(*) OVER ({part}) AS n FROM ({rows}))"
            + (f" GROUP BY {by}" if by else ""))


def sql_tokens_profile(rows: str, by: str = "") -> str:
    p = sql_percentiles(rows, {"p50": 0.5, "p90": 0.9, "p99": 0.99}, by)
    keys = f"{by}, " if by else ""
    match = f"r.{by} = s.{by}" if by else "true"
    return (f"s AS (SELECT *, greatest(512, pow(2, ceil(log2(greatest(p99, 1))))::bigint) AS suggested FROM ({p})) "
            f"SELECT {keys}n, p50, p90, p99, max, suggested, round((SELECT count(*) FROM ({rows}) r WHERE {match} "
            "AND r.value > s.suggested)::double / n, 9) AS truncated_share FROM s")


def _short(name: str) -> str:
    text = f"replace(coalesce({name}::varchar, 'None'), chr(10), '\\n')"
    return (f"CASE WHEN length({text}) <= 400 THEN {text} ELSE left({text}, 400) || '... <+' || "
            f"(length({text}) - 400)::varchar || ' chars>' END AS {name}")


_JSON_OK = "conv_id % 10 NOT IN (3, 6)"
_TOK_COMP = f"SELECT lang, {Q.sql_tokens('completion')} AS value FROM completions WHERE completion <> ''"
_TOK_DOCS = f"SELECT {Q.sql_tokens('text')} AS value FROM documents WHERE text <> ''"
_ANSWERS = (f"{D.SHAREGPT}, a AS (SELECT list_filter(conversations, lambda m: lower(m['from']) IN ('gpt', 'chatgpt', 'tool')) "
            "AS answers, conversations FROM sharegpt), pref AS (SELECT array_to_string(list_transform(conversations, "
            "lambda m: m['value']), chr(10)) AS prompt, answers[1]['value'] AS chosen, answers[-1]['value'] AS rejected "
            "FROM a WHERE len(answers) > 0)")


def _tok(column: str) -> str:
    return f"SELECT {Q.sql_tokens(column)} AS value FROM pref WHERE {column} <> ''"


_CHARS = {"p50": 0.5, "p90": 0.9}
SQL = {
    "profile_shapes": (
        "SELECT * FROM (SELECT 'documents' AS \"table\", 'language modeling' AS shape, count(*) AS rows FROM documents "
        "UNION ALL SELECT 'chats', 'conversational language modeling', count(DISTINCT conv_id) FROM conversations "
        "UNION ALL SELECT 'sharegpt', 'ShareGPT conversational', count(DISTINCT conv_id) FROM conversations "
        "UNION ALL SELECT 'preferences', s, count(DISTINCT conv_id) FROM conversations, "
        "(SELECT unnest(['preference (implicit prompt)', 'ShareGPT conversational']) AS s) WHERE role = 'assistant' GROUP BY s "
        "UNION ALL SELECT 'questions', s, count(*) FROM part, "
        "(SELECT unnest(['multiple-choice benchmark', 'QA pair']) AS s) GROUP BY s "
        "UNION ALL SELECT 'events', 'unknown', count(*) FROM events)"),
    "json_string_columns": (
        "SELECT 'messages' AS \"column\", 'mixed' AS kind, count(DISTINCT conv_id) AS present, "
        "count(DISTINCT conv_id) FILTER (conv_id % 10 <> 3) AS json, count(DISTINCT conv_id) FILTER (conv_id % 10 = 3) AS malformed "
        "FROM conversations UNION ALL SELECT 'conversations', 'native', count(DISTINCT conv_id), 0, 0 FROM conversations "
        "UNION ALL SELECT 'tools', 'json', count(DISTINCT conv_id), count(DISTINCT conv_id), 0 FROM conversations"),
    "element_keys": (
        "SELECT k AS key, count(DISTINCT conv_id) AS rows, 'native' AS stored FROM conversations, "
        "(SELECT unnest(['from', 'value']) AS k) GROUP BY k "
        "UNION ALL SELECT k, count(DISTINCT conv_id) FILTER (conv_id % 10 NOT IN (3, 6)), 'json' FROM conversations, "
        "(SELECT unnest(['content', 'role']) AS k) GROUP BY k"),
    "role_histogram": f"SELECT role, count(*) AS turns FROM conversations WHERE {_JSON_OK} GROUP BY role",
    "turn_stats": f"WITH {D.BROKEN_CHATS} " + sql_percentiles(
        "SELECT len(messages) AS value FROM broken WHERE len(messages) > 0", {"median": 0.5}),
    "length_profile": f"WITH {D.CHATS} SELECT * FROM (" + sql_percentiles(
        "SELECT source, length(text) AS value FROM documents WHERE text <> ''", _CHARS, "source")
        + ") UNION ALL BY NAME SELECT *, '<conversations>' AS source FROM (" + sql_percentiles(
        "SELECT length(t) AS value FROM (SELECT array_to_string(list_transform(messages, lambda m: m.content), chr(10)) AS t "
        "FROM chats) WHERE t <> ''", _CHARS) + ")",
    "token_profile": f"WITH {D.COMPLETIONS}, " + sql_tokens_profile(_TOK_COMP, "lang"),
    "token_profile_all": "WITH " + sql_tokens_profile(_TOK_DOCS),
    "column_lengths": f"WITH {_ANSWERS} SELECT *, 'chosen' AS \"column\" FROM (WITH " + sql_tokens_profile(_tok("chosen"))
                      + ") UNION ALL SELECT *, 'rejected' FROM (WITH " + sql_tokens_profile(_tok("rejected"))
                      + ") UNION ALL SELECT *, 'prompt' FROM (WITH " + sql_tokens_profile(_tok("prompt")) + ")",
    "preview": "SELECT " + ", ".join(_short(c) for c in ("doc_id", "text", "lang", "source", "n_chars")) + " FROM documents",
    "mix_composition": "SELECT lang AS source, count(*) AS rows, (sum(count(*)) OVER ())::bigint AS total_rows FROM documents "
                       "WHERE lang IN ('en', 'de', 'fr', 'es') GROUP BY lang",
}
