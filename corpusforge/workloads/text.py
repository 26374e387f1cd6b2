"""Text functions over all completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusforge.functions import json_columns as J
from corpusforge.functions import text as X
from corpusforge.functions import values as V
from corpusforge.workloads import tables as D

# The library's patterns without possessive quantifiers, which RE2 lacks.
BOXED_RE2 = r"\\boxed\{([^{}]*(?:\{[^{}]*\}[^{}]*)*)\}"
WORD_RUN = r"[\p{L}\p{N}_]+"
NOT_CJK = r"[^\x{4e00}-\x{9fff}]+"
WS_RUN = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in V.WHITESPACE) + "]+"


def sql_cjk(e: str) -> str:
    return f"regexp_replace({e}, '{NOT_CJK}', '', 'g')"


def sql_simplified(cjk: str) -> str:
    return f"(length({cjk}) - length(translate({cjk}, '{V.SIMPLIFIED}', '')))"


def sql_strip_code(e: str) -> str:
    for pattern in (V.FENCED_CODE, V.INLINE_CODE, V.LATEX):
        e = f"regexp_replace({e}, '{pattern}', ' ', 'g')"
    return e


def sql_latin(e: str) -> str:
    return (f"len(list_filter(regexp_extract_all({e}, '{WORD_RUN}'), "
            "lambda w: regexp_full_match(w, '[A-Za-z]{3,}')))")


def sql_boxed(e: str) -> str:
    return f"regexp_extract_all({e}, '{BOXED_RE2}', 1)"


def sql_think(e: str) -> str:
    return f"regexp_extract_all({e}, '{V.THINK}', 1)"


def sql_drop_think(e: str) -> str:
    return f"regexp_replace({e}, '{V.THINK}', '', 'g')"


def sql_answer(e: str) -> str:
    lines = f"string_split(translate({D.sql_strip(sql_drop_think(e))}, {D.quote(V.LINE_BREAKS)}, repeat(chr(10), {len(V.LINE_BREAKS)})), chr(10))"
    return (f"CASE WHEN len({sql_boxed(e)}) > 0 THEN {D.sql_strip(sql_boxed(e) + '[-1]')} "
            f"ELSE nullif({D.sql_strip(lines + '[-1]')}, '') END")


# The compatibility characters that occur in the data are the full-width forms.
FULL_WIDTH = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F))
ASCII = "".join(chr(c) for c in range(0x21, 0x7F))


def sql_norm(e: str) -> str:
    e = f"translate({e}, {D.quote(FULL_WIDTH)}, {D.quote(ASCII)})"
    tail = D.quote(V.WHITESPACE + V.ANSWER_TAIL)
    return f"rtrim(lower({D.sql_strip(e)}), {tail})"


def sql_letter(e: str) -> str:
    return (f"coalesce(list_filter(regexp_extract_all(upper({e}), '{WORD_RUN}'), "
            f"lambda w: regexp_full_match(w, '[A-J]'))[1], left({D.sql_strip(f'upper({e})')}, 1))")


def sql_tokens(e: str) -> str:
    cjk = r"\x{4e00}-\x{9fff}"
    # RE2 has no class intersection: set CJK apart first, then count runs.
    apart = f"regexp_replace({e}, '([{cjk}])', ' 漢 ', 'g')"
    runs = f"regexp_replace({apart}, '{WORD_RUN}', 'a', 'g')"
    return f"length(regexp_replace({runs}, '{WS_RUN}', '', 'g'))"


def sql_grams(e: str) -> str:
    units = (f"CASE WHEN {sql_cjk(e)} <> '' THEN string_split({sql_cjk(e)}, '') "
             f"ELSE list_filter(string_split_regex({e}, '{WS_RUN}'), lambda w: w <> '') END")
    return units


def _per_row(columns) -> callable:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        c = F.col("completion")
        return D.completions(spark, folder).select("doc_id", *[f(c).alias(n) for n, f in columns.items()])
    return query


def _sql(columns: dict[str, str]) -> str:
    body = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    return f"WITH {D.COMPLETIONS} SELECT doc_id, {body} FROM completions"


def _long(c: Column) -> Column:
    return c.cast("long")


def as_text(spark: SparkSession, folder: str) -> DataFrame:
    """Message lists and single messages flattened to text."""
    df = D.chats(spark, folder).withColumn("first", F.get("messages", F.lit(0)))
    return df.select("conv_id", X.as_text("messages", df.schema["messages"].dataType).alias("all_text"),
                     X.as_text("first", df.schema["first"].dataType).alias("first_text"))


def as_messages(spark: SparkSession, folder: str) -> DataFrame:
    df = D.json_chats(spark, folder)
    m = J.as_messages("messages", df.schema["messages"].dataType)
    return df.select("conv_id", J.json_kind("messages").alias("kind"), F.size(m).cast("long").alias("turns"),
                     F.array_join(F.transform(m, lambda t: F.concat_ws(":", t["role"], t["content"])), "\n").alias("flat"))


C = "completion"
QUERIES = {
    "as_text": as_text,
    "as_messages": as_messages,
    "strip_code": _per_row({"prose": X.strip_code}),
    "script_counts": _per_row({"cjk": lambda c: _long(X.cjk_count(c)),
                               "simplified": lambda c: _long(X.simplified_count(c))}),
    "latin_words": _per_row({"words": lambda c: _long(X.latin_words(c))}),
    "think_blocks": _per_row({"blocks": lambda c: _long(F.size(X.think_blocks(c))),
                              "inner": lambda c: F.array_join(X.think_blocks(c), "|"),
                              "rest": X.drop_think}),
    "boxed": _per_row({"found": lambda c: _long(F.size(X.boxed(c))),
                       "contents": lambda c: F.array_join(X.boxed(c), "|")}),
    "extract_answer": _per_row({"answer": lambda c: F.coalesce(X.extract_answer(c), F.lit("<none>"))}),
    "norm_answer": _per_row({"whole": X.norm_answer,
                             "answer": lambda c: F.coalesce(X.norm_answer(X.extract_answer(c)), F.lit("<none>"))}),
    "mcq_letter": _per_row({"letter": lambda c: F.coalesce(X.mcq_letter(X.extract_answer(c)), F.lit("<none>"))}),
    "fourgrams": _per_row({"grams": lambda c: _long(F.size(X.fourgram_hashes(c))),
                           "distinct_grams": lambda c: _long(F.size(F.array_distinct(X.fourgram_hashes(c))))}),
    "token_estimate": _per_row({"tokens": lambda c: _long(X.token_estimate(c))}),
}

_GRAMS = ("list_transform(range(1, len(units) - 2), lambda i: units[i] || chr(1) || units[i+1] || chr(1) "
          "|| units[i+2] || chr(1) || units[i+3])")
_KIND = ("CASE conv_id % 10 WHEN 3 THEN 'malformed' WHEN 6 THEN 'other' ELSE 'list' END")
SQL = {
    "as_text": f"WITH {D.CHATS} SELECT conv_id, array_to_string(list_transform(messages, lambda m: m.content), chr(10)) "
               "AS all_text, messages[1].content AS first_text FROM chats",
    "as_messages": f"WITH {D.CHATS} SELECT conv_id, {_KIND} AS kind, CASE WHEN conv_id % 10 IN (3, 6) THEN 0 ELSE "
                   "len(messages) END AS turns, CASE WHEN conv_id % 10 IN (3, 6) THEN '' ELSE array_to_string("
                   "list_transform(messages, lambda m: m.role || ':' || m.content), chr(10)) END AS flat FROM chats",
    "strip_code": _sql({"prose": sql_strip_code(C)}),
    "script_counts": _sql({"cjk": f"length({sql_cjk(C)})", "simplified": sql_simplified(sql_cjk(C))}),
    "latin_words": _sql({"words": sql_latin(C)}),
    "think_blocks": _sql({"blocks": f"len({sql_think(C)})", "inner": f"array_to_string({sql_think(C)}, '|')",
                          "rest": sql_drop_think(C)}),
    "boxed": _sql({"found": f"len({sql_boxed(C)})", "contents": f"array_to_string({sql_boxed(C)}, '|')"}),
    "extract_answer": _sql({"answer": f"coalesce({sql_answer(C)}, '<none>')"}),
    "norm_answer": _sql({"whole": sql_norm(C), "answer": f"coalesce({sql_norm(sql_answer(C))}, '<none>')"}),
    "mcq_letter": _sql({"letter": f"coalesce({sql_letter(sql_answer(C))}, '<none>')"}),
    "fourgrams": f"WITH {D.COMPLETIONS}, u AS (SELECT doc_id, {sql_grams(C)} AS units FROM completions), "
                 f"g AS (SELECT doc_id, CASE WHEN len(units) < 4 THEN [] ELSE {_GRAMS} END AS grams FROM u) "
                 "SELECT doc_id, len(grams) AS grams, len(list_distinct(grams)) AS distinct_grams FROM g",
    "token_estimate": _sql({"tokens": sql_tokens(C)}),
}
