"""Bring chat and preference tables of different layouts to one schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from corpusforge.functions import json_columns as J
from corpusforge.functions import values as V
from corpusforge.functions.text import strip


def require(df: DataFrame, columns: Sequence[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: columns {missing} are missing; available: {df.columns}")


#: Element types of columns whose layout the name tells. Others stay VARIANT.
JSON_TYPES = {"messages": V.MESSAGES_TYPE, "conversations": V.SHAREGPT_TYPE}
#: Columns in which a lone object stands for a list of one.
LONE = ("prompt", "chosen", "rejected")


def decode_json(df: DataFrame, columns: Sequence[str], types: Mapping[str, str] | None = None,
                on_bad: str = "raise", lone: Sequence[str] = LONE) -> DataFrame:
    """Parse JSON text columns; native columns stay as they are.

    A column with a type (from `types`, or by its name) becomes a typed list;
    any other becomes a VARIANT, which keeps every field. A value that is
    malformed or no list, or whose objects have fields that the type lacks,
    fails the job ("raise") or is told of in `bad_json` ("mark"), so that it can
    be counted; a marked value with more fields is decoded without them. A lone
    object is a list of one in the `lone` columns only.
    """
    require(df, columns, "decode_json")
    if on_bad not in ("raise", "mark"):
        raise ValueError(f"on_bad must be raise or mark, got {on_bad!r}")
    types = JSON_TYPES | dict(types or {})
    text = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    if not text:
        return df
    parsed = {c: f"_parsed_{c}" for c in text}
    df = df.withColumns({parsed[c]: J.parse(F.col(f"`{c}`")) for c in text})
    out, bad = {}, []
    for name in text:
        column, variant = F.col(f"`{name}`"), F.col(f"`{parsed[name]}`")
        kind, more = J.kind_of(column, variant), F.lit(None).cast("string")
        if name in types:
            value = J.list_of(variant, types[name])
            if name in lone:
                value = F.coalesce(value, J.one_of(variant, types[name]))
            more = J.unknown_fields(variant, types[name])
        else:
            value = variant
        alone = (F.left(strip(column), F.lit(1)) == "{") if name in lone else F.lit(False)
        wrong = F.when((kind == "malformed") | ((kind == "other") & ~alone), kind)
        wrong = F.coalesce(wrong, F.concat(F.lit("unknown fields "), more))
        if on_bad == "raise":
            start = F.left(column, F.lit(80))
            failure = F.raise_error(F.concat(F.lit(f"column {name} holds no JSON list of its type ("), wrong, F.lit("): "), start))
            value = F.when(column.isNotNull(), F.when(wrong.isNotNull(), failure).otherwise(value))
        else:
            bad.append(F.concat(F.lit(f"{name}: "), wrong))
            if name not in types:
                value = F.when(wrong.isNull(), value)
        out[name] = value
    if bad:
        out["bad_json"] = F.coalesce(*bad)
    return df.withColumns(out).drop(*parsed.values())


def _role(name: Column, unknown: str) -> Column:
    name = F.lower(name)
    return (F.when(name.isin(*V.USER_ROLES), "user")
            .when(name.isin(*V.ASSISTANT_ROLES), "assistant")
            .when(name.isin(*V.SYSTEM_ROLES), "system")
            .otherwise(unknown))


def _messages(turns: Column, unknown: str) -> Column:
    present = F.filter(turns, lambda t: t.isNotNull())
    converted = F.transform(present, lambda t: F.struct(
        _role(t["from"], unknown).alias("role"),
        F.coalesce(t["value"], F.lit("")).alias("content")))
    return F.coalesce(converted, F.from_json(F.lit("[]"), V.MESSAGES_TYPE))


def sharegpt_to_messages(df: DataFrame, column: str = "conversations",
                         to: str = "messages") -> DataFrame:
    """from/value turns to role/content messages. Unknown roles become user."""
    require(df, [column], "sharegpt_to_messages")
    if not isinstance(df.schema[column].dataType, T.StringType):
        return df.withColumn(to, _messages(F.col(column), "user"))
    turns = f"decoded {column}"          # the column itself stays text
    decoded = decode_json(df.withColumn(turns, F.col(column)), [turns], {turns: V.SHAREGPT_TYPE})
    return decoded.withColumn(to, _messages(F.col(f"`{turns}`"), "user")).drop(turns)


def sharegpt_preference(df: DataFrame, prompt_column: str = "conversations") -> DataFrame:
    """Preference rows in from/value layout to prompt/chosen/rejected messages.

    Unknown roles become assistant here. A plain string is one assistant
    message, a lone turn a list of one; turns may also be role/content, and
    columns may be VARIANT (see decode_json). A string that is JSON of turns
    fails the job: it has to be decoded first.
    """
    require(df, [prompt_column, "chosen", "rejected"], "sharegpt_preference")

    def convert(name: str) -> Column:
        c, dtype = F.col(name), df.schema[name].dataType
        if isinstance(dtype, T.StringType):
            turns = c.rlike(r'^\s*\[?\s*\{\s*"(?:from|role|value|content)"\s*:') & F.try_parse_json(c).isNotNull()
            plain = F.when(turns, F.raise_error(F.lit(f"column {name} holds turns as JSON text: decode it first"))).otherwise(c)
            one = F.array(F.struct(F.lit("assistant").alias("role"), plain.alias("content")))
            return F.when(c.isNull(), F.from_json(F.lit("[]"), V.MESSAGES_TYPE)).otherwise(one)
        if isinstance(dtype, T.VariantType):
            turn = "struct<from:string,value:string,role:string,content:string>"
            turns = F.coalesce(F.try_variant_get(c, "$", f"array<{turn}>"), F.array(F.try_variant_get(c, "$", turn)))
            return _messages(F.transform(turns, _any_turn), "assistant")
        if isinstance(dtype, T.StructType):
            c, dtype = F.when(c.isNotNull(), F.array(c)), T.ArrayType(dtype)
        if "role" in dtype.elementType.names:
            c = F.transform(c, lambda t: F.struct(t["role"].alias("from"), t["content"].alias("value")))
        return _messages(c, "assistant")

    return df.withColumns({"prompt": convert(prompt_column), "chosen": convert("chosen"),
                           "rejected": convert("rejected")})


def _any_turn(t: Column) -> Column:
    return F.struct(F.coalesce(t["from"], t["role"]).alias("from"), F.coalesce(t["value"], t["content"]).alias("value"))


def unknown_roles(df: DataFrame, column: str = "conversations", by: str | None = None) -> DataFrame:
    """How often each unmapped role occurs (it would be renamed silently), in a
    list column or its JSON text."""
    known = V.USER_ROLES + V.ASSISTANT_ROLES + V.SYSTEM_ROLES
    keys = ([by] if by else []) + ["role"]
    turns = J.as_messages(column, df.schema[column].dataType, V.SHAREGPT_TYPE)
    return (df.select(*keys[:-1], F.explode(turns).alias("turn"))
            .withColumn("role", F.coalesce(F.col("turn.from"), F.lit("")))
            .filter(~F.lower("role").isin(*known))
            .groupBy(*keys).agg(F.count("*").alias("turns")))


def answers_to_messages(df: DataFrame, question: str, answer: str, context: str | None = None,
                        to: str = "messages") -> DataFrame:
    """Instruction/output, question/answer or prompt/completion columns to one
    conversation: a user turn (with `context` below the question, if given and
    not blank) and an assistant turn. NULL counts as empty text."""
    require(df, [question, answer, *([context] if context else [])], "answers_to_messages")
    ask, reply = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (question, answer))
    if context:
        more = F.coalesce(F.col(context).cast("string"), F.lit(""))
        ask = F.when(F.trim(more) != "", F.concat(ask, F.lit("\n\n"), more)).otherwise(ask)
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return df.withColumn(to, F.array(turn("user", ask), turn("assistant", reply)))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; two columns may not end up alike."""
    columns = list(df.columns)
    for old, new in names.items():
        if old in columns and old != new:
            columns[columns.index(old)] = new
            if [c.lower() for c in columns].count(new.lower()) > 1:
                raise ValueError(f"rename {old} -> {new}: the table already has {new}")
    return df.toDF(*columns)


def keep(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only these columns, in the table's own order."""
    require(df, columns, "keep")
    return df.select([c for c in df.columns if c in columns])


def check_aligned(tables: Mapping[str, DataFrame]) -> None:
    """Every source must have the same columns with the same types.

    Types matter: a union of BIGINT and STRING would be cast, and fail later.
    """
    schemas = {name: {f.name: f.dataType.simpleString() for f in df.schema}
               for name, df in tables.items()}
    first = next(iter(schemas.values()))
    if any(s != first for s in schemas.values()):
        lines = [f"  {name}: {s}" for name, s in schemas.items()]
        raise ValueError("sources differ in columns or types; align them with rename/keep:\n"
                         + "\n".join(lines))
