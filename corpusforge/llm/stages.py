"""The stages of the pipeline: (spark, docs, folder) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusforge.llm import language_profiles, lsh_forest, pii_surrogates, tier_packing, toxic_neighbours
from corpusforge.llm.common import fold, read

#: A text is dropped from this probability of being toxic on.
TOXIC = 0.3
#: A key for tests; a real one comes from the caller's secret store.
SURROGATE_KEY = "corpusforge"


def _taught(docs: DataFrame) -> Column:
    """Documents that models learn from; the others are there to measure them."""
    return F.coalesce(fold(F.col("doc_id"), 4) != 2, F.lit(False))


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Without the texts that the nearest labelled examples call toxic."""
    labels = read(spark, folder, "labels")
    model = toxic_neighbours.learn(docs, labels.filter(_taught(labels)))
    return docs.filter(toxic_neighbours.toxicity(docs, model)["score"] < TOXIC)


def drop_undetermined(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Without the texts that are in no language: those without a letter.
    Where no row teaches a language nothing can be told, and all texts stay."""
    profiles = language_profiles.learn_profiles(docs.filter(_taught(docs)))
    if not profiles.languages:
        return docs
    found = language_profiles.identify(docs, profiles)["lang_pred"]
    return docs.filter(found != language_profiles.UNDETERMINED)


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class of near duplicates, that with the smallest id."""
    return lsh_forest.one_per_class(docs)


def replace_private(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data and secrets as surrogates; n_chars follows the new text."""
    done = pii_surrogates.replace_private(docs, SURROGATE_KEY)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The remaining texts as packed sequences of up to 2048 tokens."""
    return tier_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
