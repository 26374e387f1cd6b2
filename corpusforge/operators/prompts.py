"""Prompts with a verifiable target, as (prompt, ground_truth) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from corpusforge.functions import text as X
from corpusforge.functions import values as V
from corpusforge.operators.conform import require


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), F.coalesce(content, F.lit("")).alias("content"))


def _prompt(system: str, user: Column) -> Column:
    return F.array(_message("system", F.lit(system)), _message("user", user)).alias("prompt")


def _target(value: Column) -> Column:
    return F.coalesce(X.strip(value.cast("string")), F.lit("")).alias("ground_truth")


def check_options(df: DataFrame, letters: Sequence[str]) -> None:
    """Spark matches names without case, so A and a in one table are ambiguous."""
    for letter in letters:
        if [c.lower() for c in df.columns].count(letter.lower()) > 1:
            raise ValueError(f"option columns {letter} and {letter.lower()} cannot be told apart")


def prompts_mcq(df: DataFrame, letters: Sequence[str] = ("A", "B", "C", "D"),
                question: str = "question", answer: str = "answer",
                system: str = V.PROMPT_SYSTEM, keep: Sequence[str] = ()) -> DataFrame:
    """Question, lettered options (NULL ones left out) and an instruction."""
    require(df, [question, answer, *letters], "prompts_mcq")
    check_options(df, letters)
    options = F.concat_ws("\n", *[F.concat(F.lit(f"{x}. "), F.col(x).cast("string")) for x in letters])
    user = F.concat(F.coalesce(F.col(question).cast("string"), F.lit("")), F.lit("\n\n"), options,
                    F.lit("\n\n" + V.MCQ_INSTRUCTION))
    return df.select(*keep, _prompt(system, user), _target(F.col(answer)))


def prompts_math(df: DataFrame, question: str = "question", answer: str = "answer",
                 system: str = V.PROMPT_SYSTEM, keep: Sequence[str] = ()) -> DataFrame:
    """The target is the last boxed value of a worked solution, else ''."""
    require(df, [question, answer], "prompts_math")
    solution = F.coalesce(F.col(answer).cast("string"), F.lit(""))
    return df.select(*keep, _prompt(system, F.col(question).cast("string")),
                     _target(X.last_boxed(X.boxed(solution))))


def prompts_chat(df: DataFrame, question: str = "question", answer: str = "answer",
                 system: str = V.PROMPT_SYSTEM, keep: Sequence[str] = ()) -> DataFrame:
    """The target is the trimmed answer column; '' when the table has none."""
    require(df, [question], "prompts_chat")
    target = F.col(answer) if answer in df.columns else F.lit("")
    return df.select(*keep, _prompt(system, F.col(question).cast("string")), _target(target))


def drop_unverifiable(df: DataFrame, name: str = "targets") -> tuple[DataFrame, Observation]:
    """Rows with a target. The observation counts `rows` and `dropped` in the
    same pass, once an action has run on the result."""
    seen = Observation(name)
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"),
                         F.count_if(F.col("ground_truth") == "").alias("dropped"))
    return counted.filter(F.col("ground_truth") != ""), seen


def require_targets(seen: Observation) -> None:
    counts = seen.get
    if counts["rows"] == counts["dropped"]:
        raise ValueError("no verifiable row is left; check the answer column and the prompt kind")
