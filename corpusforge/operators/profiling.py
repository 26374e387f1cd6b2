"""Profile a table: row shapes, JSON columns, roles, turns, exact lengths.

Every statistic covers all rows. Lengths go through a histogram (one row per
distinct length, combined map-side), so exact percentiles need no global sort
and no group is ever collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from corpusforge.functions import json_columns as J
from corpusforge.functions import text as X
from corpusforge.functions import values as V
from corpusforge.functions.text import Text, _col

PREVIEW_WIDTH = 400


def detect_shapes(columns: Sequence[str]) -> list[tuple[str, str, str]]:
    """(shape, consumer, note) of every shape these columns can serve as."""
    have = set(columns)
    found = [(name, user, note) for name, need, user, note in V.SHAPES if have.issuperset(need)]
    return found or [V.NO_SHAPE]


def profile_shapes(df: DataFrame) -> DataFrame:
    """The detected shapes of a table, each with the table's row count."""
    shapes = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(s).alias("shape"),
                                F.lit(u).alias("trainer"), F.lit(n).alias("note"))
                       for i, (s, u, n) in enumerate(detect_shapes(df.columns))])
    return df.agg(F.count("*").alias("rows")).select("rows", F.inline(shapes))


def json_string_columns(df: DataFrame) -> DataFrame:
    """Which chat columns hold serialized JSON, judged on every row."""
    names = [c for c in V.JSON_CANDIDATES if c in df.columns]
    if not names:
        raise ValueError(f"no chat column among {df.columns}")
    text = {c: isinstance(df.schema[c].dataType, T.StringType) for c in names}
    kinds = df.select([(J.json_kind(c) if text[c] else F.when(F.col(c).isNotNull(), "native")).alias(c)
                       for c in names])
    rows = kinds.agg(F.array(*[F.struct(
        F.lit(c).alias("column"), F.lit(text[c]).alias("is_text"),
        F.count_if(F.col(c).isin("list", "other", "malformed", "native")).alias("present"),
        F.count_if(F.col(c).isin("list", "other")).alias("json"),
        F.count_if(F.col(c) == "malformed").alias("malformed")) for c in names]).alias("all"))
    rows = rows.select(F.inline("all"))
    kind = (F.when(~F.col("is_text"), "native")
            .when(F.col("json") == F.col("present"), "json")
            .when(F.col("json") == 0, "malformed")
            .otherwise("mixed"))
    return rows.select("column", kind.alias("kind"), "present", "json", "malformed")


def element_keys(df: DataFrame, column: str) -> DataFrame:
    """Keys of the first element of a conversation, with the rows having them."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        keys = F.json_object_keys(F.get_json_object(column, "$[0]"))
    else:
        first = F.get(F.col(column), F.lit(0))
        keys = F.filter(F.array(*[F.when(first.isNotNull(), F.lit(f))
                                  for f in dtype.elementType.fieldNames()]),
                        lambda k: k.isNotNull())
    return df.select(F.explode(keys).alias("key")).groupBy("key").agg(F.count("*").alias("rows"))


def role_histogram(df: DataFrame, messages: str = "messages", by: str | None = None) -> DataFrame:
    """How often each role occurs."""
    turns = J.as_messages(messages, df.schema[messages].dataType)
    keys = [by] if by else []
    return (df.select(*keys, F.explode(turns).alias("m")).filter(F.col("m").isNotNull())
            .select(*keys, F.col("m.role").alias("role"))
            .groupBy(*keys, "role").agg(F.count("*").alias("turns")))


def histogram(df: DataFrame, value: Column, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct value, NULL included.

    NULL is left to `percentiles`: a filter here would be pushed below the
    projection, and the value would be computed twice per row.
    """
    return (df.select(*by, value.cast("long").alias("value"))
            .groupBy(*by, "value").agg(F.count("*").alias("rows")))


def _with_rank(hist: DataFrame, by: Sequence[str]) -> DataFrame:
    group = Window.partitionBy(*by)
    rows = F.when(F.col("value").isNotNull(), F.col("rows")).otherwise(0)
    return hist.select("*", F.sum(rows).over(group.orderBy("value")).alias("upto"),
                       F.sum(rows).over(group).alias("n"))


def _percentile(p: float) -> Column:
    """Value at index floor(n*p) of the sorted rows: no interpolation."""
    index = F.least(F.col("n") - 1, F.floor(F.col("n") * F.lit(p)))
    return F.when(F.col("upto") > index, F.col("value"))


def percentiles(hist: DataFrame, points: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact index percentiles with n, min and max, from a histogram."""
    return (_with_rank(hist, by).groupBy(*by)
            .agg(F.max("n").alias("n"), F.min("value").alias("min"),
                 *[F.min(_percentile(p)).alias(name) for name, p in points.items()],
                 F.max("value").alias("max"))
            .filter("n > 0"))


def turn_stats(df: DataFrame, messages: str = "messages", by: Sequence[str] = ()) -> DataFrame:
    """Turns per non-empty conversation: n, min, median, max."""
    turns = F.size(J.as_messages(messages, df.schema[messages].dataType))
    counts = df.select(*by, turns.alias("_turns"))
    return percentiles(histogram(counts, F.nullif(F.col("_turns"), F.lit(0)), by), {"median": 0.5}, by)


def rendered_row(df: DataFrame) -> Column:
    """The text a row contributes: its conversation, else its text columns."""
    chats = [c for c in V.CONVERSATION_COLUMNS if c in df.columns]
    if not chats:
        texts = [c for c in V.TEXT_COLUMNS if c in df.columns] or df.columns[:1]
        return F.concat_ws("\n", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in texts])
    name, dtype = chats[0], df.schema[chats[0]].dataType
    both = "array<struct<content:string,value:string>>"
    if isinstance(dtype, T.StringType):
        turns, fields = J.parse_list(name, both), ["content", "value"]
    else:
        turns = F.col(name)
        fields = [f for f in ("content", "value") if f in dtype.elementType.fieldNames()]
    turns = F.filter(turns, lambda m: m.isNotNull())
    return F.array_join(F.transform(turns, lambda m: F.coalesce(
        *[F.nullif(m[f].cast("string"), F.lit("")) for f in fields], F.lit(""))), "\n")


def length_profile(df: DataFrame, text: Text | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Characters per non-empty row: n, min, p50, p90, max."""
    text = rendered_row(df) if text is None else _col(text)
    texts = df.select(*by, F.length(text).alias("_length"))
    length = F.nullif(F.col("_length"), F.lit(0))
    return percentiles(histogram(texts, length, by), {"p50": 0.5, "p90": 0.9}, by)


def token_profile(df: DataFrame, text: Text | None = None, by: Sequence[str] = (),
                  counter: X.TokenCounter = X.token_estimate) -> DataFrame:
    """Token percentiles, the sequence length they suggest, and what it cuts.

    `suggested` is the power of two (512 or more) that covers p99.
    """
    text = rendered_row(df) if text is None else _col(text)
    texts = df.select(*by, text.alias("_text"))
    tokens = F.when(F.col("_text") != "", counter(F.col("_text")))
    ranked = _with_rank(histogram(texts, tokens, by), by)
    bits = F.length(F.bin(F.greatest(F.min(_percentile(0.99)).over(Window.partitionBy(*by)), F.lit(1)) - 1))
    suggested = F.pow(F.lit(2), F.greatest(F.lit(9), bits)).cast("long")
    ranked = ranked.withColumn("suggested", suggested)
    over = F.sum(F.when(F.col("value") > F.col("suggested"), F.col("rows")).otherwise(0))
    profile = ranked.groupBy(*by).agg(
        F.max("n").alias("n"),
        *[F.min(_percentile(p)).alias(name) for name, p in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99))],
        F.max("value").alias("max"), F.max("suggested").alias("suggested"),
        F.try_divide(over, F.max("n")).alias("truncated_share"))
    return profile.filter("n > 0")


def short(c: Column, dtype: T.DataType, width: int = PREVIEW_WIDTH) -> Column:
    """One-line rendering of a value, cut to `width` characters."""
    nested = isinstance(dtype, (T.ArrayType, T.StructType, T.MapType))
    text = F.to_json(c) if nested else c.cast("string")
    text = F.replace(F.coalesce(text, F.lit("None")), F.lit("\n"), F.lit("\\n"))
    cut = F.concat(F.left(text, F.lit(width)), F.lit("... <+"),
                   (F.length(text) - width).cast("string"), F.lit(" chars>"))
    return F.when(F.length(text) <= width, text).otherwise(cut)


def preview(df: DataFrame, n: int | None = 1, width: int = PREVIEW_WIDTH) -> DataFrame:
    """The first rows for display; n=None formats the whole table."""
    shown = df if n is None else df.limit(n)
    return shown.select([short(F.col(f.name), f.dataType, width).alias(f.name) for f in df.schema])


def mix_composition(df: DataFrame, source: str = "source") -> DataFrame:
    """Rows of each source and in total."""
    counts = df.groupBy(source).agg(F.count("*").alias("rows"))
    return counts.withColumn("total_rows", F.sum("rows").over(Window.partitionBy()))
