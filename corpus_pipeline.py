"""From documents to packed sequences: each stage reads what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusforge.llm import stages
from corpusforge.llm.common import read, written

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("language", stages.drop_undetermined),
    ("near_duplicates", stages.one_of_each_group),
    ("surrogates", stages.replace_private),
    ("packing", stages.pack),
]

#: No SQL: stages score with trained models and encode with a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; between two of them the rows are a Parquet table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
