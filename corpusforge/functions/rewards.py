"""The reward library: every reward is a nullable DOUBLE Column expression.

A reward receives a `Sample`, which hands out the shared measures of one
completion (text, CJK characters, boxed values, ...). `prepare` computes each
measure once, in projections below the rewards. NULL means that the reward does
not apply to the sample.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable
from dataclasses import dataclass, field
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from corpusforge.functions import text as X
from corpusforge.functions import values as V

_PREFIX = "_sample_"


@dataclass(frozen=True)
class Sample:
    """Columns a reward may use. `option` gives per-reward settings."""

    has_prompt: bool
    has_target: bool
    options: dict = field(default_factory=dict)

    def measure(self, name: str) -> Column:
        return F.col(_PREFIX + name)

    def column(self, name: str) -> Column:
        """Any other column of the table being scored."""
        return F.col(name)

    def option(self, name: str, default=None):
        value = self.options.get(name)
        return default if not value else value


RewardFn = Callable[[Sample], Column]


@dataclass(frozen=True)
class Reward:
    name: str
    doc: str
    fn: RewardFn


REWARDS: dict[str, Reward] = {}
#: Rewards that tell right from wrong; the others shape an answer.
CORRECTNESS = ("accuracy_exact", "accuracy_math", "accuracy_mcq")


def reward(name: str, doc: str) -> Callable[[RewardFn], RewardFn]:
    """Register a reward under a name, for use in a reward specification."""

    def register(fn: RewardFn) -> RewardFn:
        REWARDS[name] = Reward(name, doc, fn)
        return fn

    return register


def list_rewards() -> list[tuple[str, str]]:
    return [(r.name, r.doc) for r in sorted(REWARDS.values(), key=lambda r: r.name)]


def prepare(df: DataFrame, completion: str = "completion", prompt: str | None = None,
            target: str | None = None, simplified: str = V.SIMPLIFIED,
            user_turn_only: bool = False) -> DataFrame:
    """Add the shared measures. Those no reward reads are pruned by Catalyst."""

    def put(frame: DataFrame, **measures: Column) -> DataFrame:
        return frame.select("*", *[c.alias(_PREFIX + n) for n, c in measures.items()])

    def m(name: str) -> Column:
        return F.col(_PREFIX + name)

    first = {"text": X.as_text(completion, df.schema[completion].dataType)}
    if prompt:
        dtype = df.schema[prompt].dataType
        turns = F.col(prompt)
        if user_turn_only and isinstance(dtype, T.ArrayType):
            turns = F.filter(turns, lambda t: t["role"] == "user")
        first["prompt_cjk"] = X.cjk_count(X.as_text(turns, dtype))
    if target:
        first["target"] = F.col(target).cast("string")
    df = put(df, **first)
    df = put(df, boxed=X.boxed(m("text")))
    df = put(df, answer=X.answer_from(m("boxed"), m("text")))
    # Answers pass through the Arrow UDF before the large measures exist, which
    # would otherwise be carried past it row by row.
    if target:
        long = m("answer").rlike(_LONG) | m("target").rlike(_LONG)
        df = put(df, answer_norm=X.norm_answer(m("answer")), target_norm=X.norm_answer(m("target")),
                 answer_value=_long_number(F.when(long, m("answer"))), target_value=_long_number(F.when(long, m("target"))))
        df = put(df, answer_plain=plain_number(m("answer_norm")), target_plain=plain_number(m("target_norm")))
        df = put(df, answer_number=number_parts(m("answer_plain")), target_number=number_parts(m("target_plain")))
    df = put(df, cjk=X.cjk_text(m("text")), prose=X.strip_code(m("text")), think=X.think_blocks(m("text")))
    df = put(df, prose_cjk=X.cjk_count(m("prose")), prose_latin=X.latin_words(m("prose")),
             simplified=X.simplified_in_cjk(m("cjk"), simplified),
             grams=X.fourgram_hashes_from(m("cjk"), m("text")))
    return df


def drop_measures(df: DataFrame) -> DataFrame:
    return df.select([c for c in df.columns if not c.startswith(_PREFIX)])


def _yes(condition: Column) -> Column:
    return F.when(condition, 1.0).otherwise(0.0)


@reward("zhtw_purity", "1.0 for pure Traditional Chinese; falls steeply with simplified characters")
def zhtw_purity(s: Sample) -> Column:
    total = F.length(s.measure("cjk"))
    share = s.measure("simplified") / F.nullif(total, F.lit(0))
    return F.when(total > 0, F.greatest(F.lit(0.0), 1.0 - 20.0 * share))


@reward("no_english_drift", "Penalizes English prose in a Chinese answer; code and LaTeX are exempt")
def no_english_drift(s: Sample) -> Column:
    cjk, latin = s.measure("prose_cjk"), s.measure("prose_latin")
    drift = F.greatest(F.lit(0), latin - 3) / 20.0
    score = (F.when((cjk == 0) & (latin == 0), None)
             .when(cjk == 0, 0.0)
             .otherwise(F.greatest(F.lit(0.0), 1.0 - drift)))
    if s.has_prompt:
        score = F.when(s.measure("prompt_cjk") >= 5, score)
    return score


@reward("format_think", "Exactly one substantial <think> block, followed by an answer")
def format_think(s: Sample) -> Column:
    blocks = s.measure("think")
    inner = X.strip(F.try_element_at(blocks, F.lit(1)))
    after = X.strip(X.drop_think(s.measure("text")))
    return (F.when(F.size(blocks) != 1, 0.0)
            .when((F.length(inner) >= 20) & (after != ""), 1.0)
            .otherwise(0.3))


@reward("format_boxed", "Exactly one \\boxed{...} with a non-blank answer")
def format_boxed(s: Sample) -> Column:
    blocks = s.measure("boxed")
    return (F.when(F.size(blocks) > 1, 0.2)
            .when(X.last_boxed(blocks) != "", 1.0)
            .otherwise(0.0))


@reward("accuracy_mcq", "1.0 when the answered option letter is the target's")
def accuracy_mcq(s: Sample) -> Column:
    if not s.has_target:
        return F.lit(None).cast("double")
    wanted = X.upper_letter(F.left(X.strip(s.measure("target")), F.lit(1)))
    answer = s.measure("answer")
    return _yes((answer != "") & (X.mcq_letter(answer) == wanted))


@reward("accuracy_exact", "1.0 when the normalized answer equals the normalized target")
def accuracy_exact(s: Sample) -> Column:
    if not s.has_target:
        return F.lit(None).cast("double")
    return _yes((s.measure("answer") != "") & (s.measure("answer_norm") == s.measure("target_norm")))


@reward("accuracy_math", "As accuracy_exact, or numerically equal (integer, decimal, fraction, mixed)")
def accuracy_math(s: Sample) -> Column:
    if not s.has_target:
        return F.lit(None).cast("double")
    same_text = s.measure("answer_norm") == s.measure("target_norm")
    same_value = same_number(s.measure("answer_number"), s.measure("target_number"))
    same_long = F.coalesce(s.measure("answer_value") == s.measure("target_value"), F.lit(False))
    return _yes((s.measure("answer") != "") & (same_text | same_value | same_long))


@reward("no_repetition", "Share of distinct 4-grams; low for degenerate loops")
def no_repetition(s: Sample) -> Column:
    grams = s.measure("grams")
    # 17 four-grams are what 20 units make; shorter texts are not judged.
    return F.when(F.size(grams) >= 17, F.size(F.array_distinct(grams)) / F.size(grams))


@reward("length_target", "Gaussian bonus around `target_length` characters")
def length_target(s: Sample) -> Column:
    target = float(s.option("target_length", V.TARGET_LENGTH))
    n = F.length(s.measure("text"))
    return F.exp(-F.pow(n - target, F.lit(2.0)) / (2 * (target * 0.6) ** 2))


# --- numeric value of an answer ---------------------------------------------
# Integers (also with thousands commas), decimals, a/b, \frac{a}{b} and mixed
# numbers. Where the digits are few enough, cross-multiplication fits a
# DECIMAL(38). If either side has more, both are read as exact fractions in the
# Arrow stage that normalises answers, so no length changes the rule.
_LONG = r"\p{Nd}{9}|(?:[,，]\p{Nd}{3}){3}"
_ANY_FRAC = re.compile(r"\\[dt]?frac\{\s*(\d+)\s*\}\{\s*(\d+)\s*\}")
_ANY_NUMBER = re.compile(r"([+-]?)\s*(?:(?:(\d+)\s+)?(\d+)\s*/\s*(\d+)|(\d+|\d{1,3}(?:,\d{3})+)?(?:\.(\d+))?)", re.ASCII)


def exact_value(answer: str) -> str | None:
    """A number of any length as a reduced fraction "n/d"; None if it is none."""
    text = _ANY_FRAC.sub(r" \1/\2", X.normalized(answer))
    found = _ANY_NUMBER.fullmatch(re.sub(r"^\$|\$$", "", text).strip())
    if not found or not re.search("[0-9]", text):
        return None
    sign, whole, top, bottom, plain, decimals = found.groups()
    if bottom and not int(bottom):
        return None
    places = decimals or ""
    value = (Fraction(int(whole or 0)) + Fraction(int(top), int(bottom)) if top else
             Fraction(int(((plain or "").replace(",", "") + places) or 0), 10 ** len(places)))
    value = -value if sign == "-" else value
    return f"{value.numerator}/{value.denominator}"


@F.pandas_udf(T.StringType())
def _long_number(values: pd.Series) -> pd.Series:
    sys.set_int_max_str_digits(0)
    return values.map(exact_value, na_action="ignore")


def exact_number(answer: Column) -> Column:
    """`exact_value` of a column."""
    return _long_number(answer)


_FRAC = r"\\[dt]?frac\{\s*(\d{1,9})\s*\}\{\s*(\d{1,9})\s*\}"
_NUMBER = (r"^([+-]?)\s*(?:(?:(\d{1,8})\s+)?(\d{1,9})\s*/\s*(\d{1,9})"
           r"|(\d{1,18}|\d{1,3}(?:,\d{3}){1,5})?(?:\.(\d{1,9}))?)$")


def plain_number(answer: Column) -> Column:
    """The answer without $ signs, fractions written as a/b."""
    slashed = F.regexp_replace(answer, _FRAC, " $1/$2")
    return X.strip(F.regexp_replace(slashed, r"^\$|\$$", ""))


def number_parts(plain: Column) -> Column:
    """Sign, whole part, numerator and denominator of a number; NULL if none.

    Its value is sign * (whole + num / den), with den at least 1.
    """
    def group(i: int) -> Column:
        return F.nullif(F.regexp_extract(plain, _NUMBER, i), F.lit(""))

    decimals = group(6)
    parts = F.struct(
        F.when(group(1) == "-", -1).otherwise(1).cast("decimal(1,0)").alias("sign"),
        F.coalesce(group(2), F.replace(group(5), F.lit(",")), F.lit("0")).cast("decimal(18,0)").alias("whole"),
        F.coalesce(group(3), decimals, F.lit("0")).cast("decimal(9,0)").alias("num"),
        F.coalesce(group(4), F.rpad(F.lit("1"), F.length(decimals) + 1, F.lit("0")), F.lit("1"))
        .cast("decimal(10,0)").alias("den"))
    # The pattern also fits a lone sign or nothing at all.
    return F.when(plain.rlike(_NUMBER) & plain.rlike("[0-9]"), parts)


def same_number(a: Column, b: Column) -> Column:
    """Equality of two `number_parts`; a zero denominator equals nothing."""
    def numerator(p: Column) -> Column:
        return (p["sign"] * (p["whole"] * p["den"] + p["num"])).cast("decimal(28,0)")

    return ((a["den"] > 0) & (b["den"] > 0)
            & (numerator(a) * b["den"] == numerator(b) * a["den"]))
