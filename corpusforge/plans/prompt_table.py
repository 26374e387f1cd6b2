"""Load sources and turn them into prompts with verifiable targets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession

from corpusforge.functions import values as V
from corpusforge.operators import prompts as P
from corpusforge.plans.training_table import conform
from corpusforge.sources.loading import SourceSpec, load_source

KINDS = {"mcq": P.prompts_mcq, "math": P.prompts_math, "chat": P.prompts_chat}


def build_prompt_table(spark: SparkSession, sources: Sequence[SourceSpec], kind: str = "chat",
                       trial: bool = False, **columns) -> tuple[DataFrame, Observation]:
    """Prompts of all sources without the rows that cannot be verified.

    `columns` are passed on to the prompt builder (question, answer, letters,
    system). Call `require_targets` on the observation after an action.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown prompt kind {kind!r}; available: {', '.join(KINDS)}")
    cap = V.TRIAL_PROMPT_ROWS if trial else None
    parts = [KINDS[kind](conform(load_source(spark, s, cap), s), keep=("row_key",), **columns)
             for s in sources]
    return P.drop_unverifiable(reduce(DataFrame.unionByName, parts))
