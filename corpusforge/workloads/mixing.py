"""Concatenation, weighted mixing and shuffling of whole sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusforge.operators import mixing as M
from corpusforge.plans.training_table import build_training_table
from corpusforge.session import shared_folder
from corpusforge.sources.loading import SourceSpec, load_source
from corpusforge.workloads import tables as D
from corpusforge.workloads.conforming import flat, sql_share

#: Documents of any other or no language are the rest.
WEIGHTS = {"en": 6, "de": 3, "fr": 1, "rest": 2}
SEED = 42


def _by_language(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    docs = D.read(spark, folder, "documents").withColumn("row_key", F.col("doc_id").cast("string"))
    named = F.when(F.col("lang").isin("en", "de", "fr"), F.col("lang")).otherwise("rest")
    return {source: docs.filter(named == source) for source in WEIGHTS}


def concat_sources(spark: SparkSession, folder: str) -> DataFrame:
    equal = dict.fromkeys(WEIGHTS, 2.0)
    mixed = M.mix(_by_language(spark, folder), equal, SEED)
    return mixed.select("source", "doc_id", "copy", F.md5("text").alias("content"))


def weighted_interleave(spark: SparkSession, folder: str) -> DataFrame:
    mixed = M.mix(_by_language(spark, folder), WEIGHTS, SEED)
    return mixed.select("source", "doc_id", "copy", F.md5("text").alias("content"))


def interleave_totals(spark: SparkSession, folder: str) -> DataFrame:
    mixed = M.mix(_by_language(spark, folder), WEIGHTS, SEED)
    return mixed.groupBy("source").agg(F.count("*").alias("rows"), F.max("copy").alias("copies"))


def shuffle(spark: SparkSession, folder: str) -> DataFrame:
    mixed = M.shuffle(M.concat(_by_language(spark, folder)), SEED)
    return mixed.select("source", "doc_id", "shuffle_key")


def _specs(folder: str) -> list[SourceSpec]:
    return [
        SourceSpec(f"{folder}/documents.parquet", "domain", split=None, key=("doc_id",), keep=("text",), weight=6),
        SourceSpec(f"{folder}/conversations.parquet", "general", split=None, key=("conv_id", "turn"),
                   keep=("text",), weight=3),
        SourceSpec(f"{folder}/pages.parquet", "web", split=None, key=("page_id",), rename={"html": "text"},
                   keep=("text",), weight=1),
    ]


def training_table(spark: SparkSession, folder: str) -> DataFrame:
    """The whole job: load, rename, keep, mix by weight, shuffle."""
    table = build_training_table(spark, _specs(folder), SEED)
    return table.train.select("source", "row_key", "copy", "shuffle_key", F.md5("text").alias("content"))


def trial_table(spark: SparkSession, folder: str) -> DataFrame:
    """The same job on the first rows of each source."""
    table = build_training_table(spark, _specs(folder), SEED, trial=True)
    return table.train.select("source", "row_key", "copy", "shuffle_key", F.md5("text").alias("content"))


def evaluation_split(spark: SparkSession, folder: str) -> DataFrame:
    held = SourceSpec(f"{folder}/benchmark.parquet", "held", key=("item_id",), keep=("text",))
    return build_training_table(spark, _specs(folder)[:1], SEED, evaluation=held).evaluation


def evaluation_converted(spark: SparkSession, folder: str) -> DataFrame:
    """The held split of a table of JSON conversations, decoded and converted
    like the training split."""
    chats = D.sharegpt(spark, folder).select(
        "conv_id", F.to_json("conversations").alias("conversations"),
        F.when(F.col("conv_id") % 5 == 0, "test").otherwise("train").alias("split"))
    path = shared_folder(spark, "split-chats")
    chats.write.parquet(path)
    spec = SourceSpec(path, "chat", key=("conv_id",), json_columns=("conversations",), sharegpt_to_messages=True,
                      keep=("messages",))
    table = build_training_table(spark, [spec], SEED, evaluation=spec)
    return table.evaluation.select("row_key", flat("messages").alias("flat"))


def config_split_selected(spark: SparkSession, folder: str) -> DataFrame:
    """One config and split of a benchmark table."""
    path = shared_folder(spark, "benchmarks")
    D.questions(spark, folder).write.parquet(path)
    rows = load_source(spark, SourceSpec(path, config="Brand#2", split="validation", key=("p_partkey",)))
    return rows.select("p_partkey", "config", "split")


QUERIES = {f.__name__: f for f in (concat_sources, weighted_interleave, interleave_totals, shuffle, training_table,
                                   trial_table, evaluation_split, evaluation_converted, config_split_selected)}


def sql_mix(rows: str, weights: dict[str, int]) -> str:
    """CTEs up to `mixed` from (source, row_key, text) rows."""
    values = ", ".join(f"('{s}', {w})" for s, w in weights.items())
    whole = sum(weights.values())
    return (f"rows AS ({rows}), weights(source, w) AS (VALUES {values}), "
            "sizes AS (SELECT source, count(*) AS n FROM rows GROUP BY source), "
            f"total AS (SELECT max((n * {whole} + w - 1) // w) AS length FROM sizes JOIN weights USING (source)), "
            f"targets AS (SELECT source, n, (length * w + {whole} - 1) // {whole} AS target FROM sizes JOIN weights USING (source), total), "
            f"ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('{SEED}|' || source || '|' || row_key)) AS rn FROM rows), "
            "mixed AS (SELECT ranked.*, unnest(range(1, (target // n + CASE WHEN rn <= target % n THEN 1 ELSE 0 END) + 1)) AS copy "
            "FROM ranked JOIN targets USING (source))")


_LANGS = ("SELECT CASE WHEN lang IN ('en', 'de', 'fr') THEN lang ELSE 'rest' END AS source, doc_id::varchar AS row_key, "
          "doc_id, text FROM documents")
_TABLE = ("SELECT 'domain' AS source, doc_id::varchar AS row_key, text FROM documents UNION ALL "
          "SELECT 'general', conv_id::varchar || '|' || turn::varchar, text FROM conversations UNION ALL "
          "SELECT 'web', page_id::varchar, html FROM pages")
_TRIAL = ("SELECT * FROM (SELECT 'domain' AS source, doc_id::varchar AS row_key, text FROM documents ORDER BY doc_id LIMIT 64) "
          "UNION ALL SELECT * FROM (SELECT 'general', conv_id::varchar || '|' || turn::varchar, text FROM conversations "
          "ORDER BY conv_id, turn LIMIT 64) UNION ALL SELECT * FROM (SELECT 'web', page_id::varchar, html FROM pages ORDER BY page_id LIMIT 64)")
_OUT = (f"SELECT source, row_key, copy, md5('{SEED}|' || source || '|' || row_key || '|' || copy::varchar) AS shuffle_key, "
        "md5(text) AS content FROM mixed")
_PORTIONS = {"domain": 6, "general": 3, "web": 1}
SQL = {
    "concat_sources": f"SELECT source, doc_id, 1::bigint AS copy, md5(text) AS content FROM ({_LANGS})",
    "weighted_interleave": f"WITH {sql_mix(_LANGS, WEIGHTS)} SELECT source, doc_id, copy, md5(text) AS content FROM mixed",
    "interleave_totals": f"WITH {sql_mix(_LANGS, WEIGHTS)} SELECT source, count(*) AS rows, max(copy) AS copies FROM mixed GROUP BY source",
    "shuffle": f"SELECT source, doc_id, md5('{SEED}|' || source || '|' || row_key) AS shuffle_key FROM ({_LANGS})",
    "training_table": f"WITH {sql_mix(_TABLE, _PORTIONS)} {_OUT}",
    "trial_table": f"WITH {sql_mix(_TRIAL, _PORTIONS)} {_OUT}",
    "evaluation_converted": f"WITH {D.SHAREGPT} SELECT conv_id::varchar AS row_key, {sql_share('conversations')} AS flat "
                            "FROM sharegpt WHERE conv_id % 5 = 0",
    "config_split_selected": f"WITH {D.QUESTIONS} SELECT p_partkey, config, split FROM questions "
                             "WHERE config = 'Brand#2' AND split = 'validation'",
    "evaluation_split": "SELECT text, item_id::varchar AS row_key FROM benchmark",
}
