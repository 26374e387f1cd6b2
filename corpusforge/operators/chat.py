"""Render conversations to text, validate them and locate assistant text.

`messages` is an array of struct(role, content) throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from corpusforge.functions import json_columns as J
from corpusforge.functions import text as X
from corpusforge.functions import values as V
from corpusforge.functions.text import Text, _col


def _opens_with_system(messages: Column) -> Column:
    return F.coalesce(F.get(messages, F.lit(0))["role"] == "system", F.lit(False))


def _turns(messages: Column) -> Column:
    """The conversation without a leading system message."""
    return F.when(_opens_with_system(messages), F.slice(messages, 2, F.size(messages))).otherwise(messages)


def _prefix(messages: Column) -> Column:
    """A leading system message, which is put in front of the first turn."""
    text = F.coalesce(F.get(messages, F.lit(0))["content"], F.lit(""))
    return F.when(_opens_with_system(messages), F.concat(text, F.lit("\n\n"))).otherwise("")


def _header(m: Column, i: Column, prefix: Column) -> Column:
    role = F.when(m["role"] == "assistant", V.MODEL_ROLE).otherwise(F.coalesce(m["role"], F.lit("")))
    return F.concat(F.lit(V.TURN_START), role, F.lit("\n"), F.when(i == 0, prefix).otherwise(""))


def _body(m: Column) -> Column:
    return F.concat(X.strip(F.coalesce(m["content"], F.lit(""))), F.lit(V.TURN_END))


def render_chat(messages: Text, bos: str = "<bos>", generation_prompt: bool = False) -> Column:
    """The conversation as training text; NULL when there is no message."""
    messages = _col(messages)
    prefix = _prefix(messages)
    turns = F.transform(_turns(messages), lambda m, i: F.concat(_header(m, i, prefix), _body(m)))
    tail = V.TURN_START + V.MODEL_ROLE + "\n" if generation_prompt else ""
    text = F.concat(F.lit(bos), F.array_join(turns, ""), F.lit(tail))
    return F.when(F.size(messages) > 0, text)


def check_roles(messages: Text) -> Column:
    """True when user turns stand exactly at the even positions."""
    fits = F.transform(_turns(_col(messages)),
                       lambda m, i: (F.coalesce(m["role"], F.lit("")) == "user") == (i % 2 == 0))
    return F.forall(fits, lambda ok: ok)


def assistant_spans(messages: Text, bos: str = "<bos>") -> Column:
    """Character ranges of assistant text in `render_chat`, end marker included."""
    messages = _col(messages)
    prefix = _prefix(messages)
    pieces = F.transform(_turns(messages), lambda m, i: F.struct(
        (m["role"] == "assistant").alias("trained"),
        F.length(_header(m, i, prefix)).alias("header"),
        F.length(_body(m)).alias("body")))
    none = F.from_json(F.lit("[]"), "array<struct<start:int,end:int>>")
    start = F.struct(F.lit(len(bos)).alias("at"), none.alias("spans"))

    def step(state: Column, piece: Column) -> Column:
        begin = state["at"] + piece["header"]
        end = begin + piece["body"]
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        spans = F.when(piece["trained"], F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(pieces, start, step, lambda state: state["spans"])


def trained_spans(df: DataFrame, bos: str = "<bos>") -> Column:
    """What a trainer learns from in a row: assistant text of a conversation,
    the completion of a prompt-completion pair, all of a raw text.

    Ranges refer to the rendered conversation, to prompt + completion (a prompt
    of messages is rendered up to the answer), and to the text itself.
    """
    def one(start: Column, length: Column) -> Column:
        return F.array(F.struct(start.alias("start"), (start + length).alias("end")))

    if "messages" in df.columns:
        return assistant_spans("messages", bos)
    if {"prompt", "completion"} <= set(df.columns):
        prompt = F.col("prompt")
        if isinstance(df.schema["prompt"].dataType, T.ArrayType):
            prompt = render_chat("prompt", generation_prompt=True)
        completion = X.as_text("completion", df.schema["completion"].dataType)
        return one(F.length(F.coalesce(prompt, F.lit(""))), F.length(F.coalesce(completion, F.lit(""))))
    if "text" in df.columns:
        return one(F.lit(0), F.length(F.coalesce("text", F.lit(""))))
    raise ValueError(f"needs messages, prompt and completion, or text; available: {df.columns}")


def span_chars(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0), lambda n, s: n + s["end"] - s["start"])


def with_outcome(df: DataFrame, max_length: int, messages: str = "messages",
                 counter: X.TokenCounter = X.token_estimate) -> DataFrame:
    """Add `outcome`: what happens to the row when it is prepared for training."""
    turns, bad = F.col(messages), F.lit(False)
    if isinstance(df.schema[messages].dataType, T.StringType):
        df = df.withColumn("_parsed", J.parse(messages))
        turns = J.list_of(F.col("_parsed"))
        bad = J.kind_of(messages, F.col("_parsed")).isin("malformed", "other")
    elif "bad_json" in df.columns:
        bad = F.col("bad_json").isNotNull()
    df = df.withColumn("_turns", turns).withColumn("_text", render_chat("_turns"))
    outcome = (F.when(bad, "bad_json")
               .when(F.coalesce(F.size("_turns"), F.lit(-1)) < 1, "empty")
               .when(~check_roles("_turns"), "bad_roles")
               .when(counter(F.col("_text")) > max_length, "too_long")
               .otherwise("ok"))
    return df.withColumn("outcome", outcome).drop("_parsed", "_turns", "_text")


def survivors(df: DataFrame, max_length: int, messages: str = "messages", by: str | None = None,
              counter: X.TokenCounter = X.token_estimate) -> DataFrame:
    """Rows per outcome, and per source when `by` names that column."""
    keys = ([by] if by else []) + ["outcome"]
    return (with_outcome(df, max_length, messages, counter)
            .groupBy(*keys).agg(F.count("*").alias("rows")))


def require_survivors(counts: DataFrame) -> None:
    """Fail when no row is left, and say why."""
    found = {r["outcome"]: r["rows"] for r in
             counts.groupBy("outcome").agg(F.sum("rows").alias("rows")).collect()}
    if not found.get("ok"):
        raise ValueError(
            f"no row survives preprocessing: {found or 'the table is empty'}. bad_json: decode the "
            "JSON text column; bad_roles: user and assistant turns must alternate; too_long: "
            "raise max_length.")


def truncation_report(df: DataFrame, text: Text, max_length: int, by: str | None = None,
                      counter: X.TokenCounter = X.token_estimate) -> DataFrame:
    """How many rows are longer than max_length tokens, and their share."""
    long = F.count_if(counter(_col(text)) > max_length)
    return (df.groupBy(*([by] if by else []))
            .agg(F.count("*").alias("rows"), long.alias("truncated"),
                 F.try_divide(long, F.count("*")).alias("truncated_share")))
