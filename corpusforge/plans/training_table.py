"""Load, conform, align, mix and shuffle sources into one training table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from corpusforge.functions import values as V
from corpusforge.operators import conform as C
from corpusforge.operators import mixing as M
from corpusforge.operators.profiling import mix_composition
from corpusforge.sources.loading import SourceSpec, load_source


@dataclass(frozen=True)
class TrainingTable:
    train: DataFrame
    evaluation: DataFrame | None

    def composition(self) -> DataFrame:
        return mix_composition(self.train)


def conform(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Decode first, convert next, then rename and keep; `row_key` stays."""
    if spec.json_columns:
        df = C.decode_json(df, spec.json_columns, spec.json_types)
    if spec.sharegpt_preference:
        df = C.sharegpt_preference(df, spec.sharegpt_column)
    if spec.sharegpt_to_messages:
        df = C.sharegpt_to_messages(df, spec.sharegpt_column)
    df = C.rename(df, spec.rename)
    return C.keep(df, [*spec.keep, "row_key"]) if spec.keep else df


def build_training_table(spark: SparkSession, sources: Sequence[SourceSpec], seed: int = 42,
                         evaluation: SourceSpec | None = None, trial: bool = False) -> TrainingTable:
    """The shuffled mix, and the evaluation split in the same schema."""
    if not sources:
        raise ValueError("no sources given")
    labels = [s.label for s in sources]
    if len(set(labels)) < len(labels):
        raise ValueError(f"sources need distinct names: {labels}")
    train_rows = V.TRIAL_TRAIN_ROWS if trial else None
    tables = {s.label: conform(load_source(spark, s, train_rows), s) for s in sources}
    mixed = M.mix(tables, {s.label: s.weight for s in sources}, seed)
    held = None
    if evaluation:
        rows = V.TRIAL_EVAL_ROWS if trial else None
        held = conform(load_source(spark, evaluation, rows, default_split="test"), evaluation)
    return TrainingTable(M.shuffle(mixed, seed), held)
