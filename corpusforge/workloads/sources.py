"""Loading with caps, and the benchmark export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusforge.session import shared_folder
from corpusforge.sources import mcq_export as E
from corpusforge.sources.loading import SourceSpec, head, load_source
from corpusforge.workloads import tables as D

CAP = 100


def capped_by_key(spark: SparkSession, folder: str) -> DataFrame:
    spec = SourceSpec(f"{folder}/documents.parquet", split=None, key=("doc_id",), max_samples=CAP)
    return load_source(spark, spec).select("doc_id", "row_key", F.md5("text").alias("content"))


def capped_in_files(spark: SparkSession, folder: str) -> DataFrame:
    """The file order of documents is that of doc_id."""
    spec = SourceSpec(f"{folder}/documents.parquet", split=None, max_samples=CAP)
    return load_source(spark, spec).select("doc_id", F.md5("text").alias("content"))


def source_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A whole source, identified by file position."""
    df = load_source(spark, SourceSpec(f"{folder}/documents.parquet", split=None))
    return df.groupBy("lang").agg(F.count("*").alias("rows"), F.count_distinct("row_key").alias("keys"))


def head_rows(spark: SparkSession, folder: str) -> DataFrame:
    return head(D.read(spark, folder, "documents"), 200).agg(F.count("*").alias("rows"))


def mcq_items(spark: SparkSession, folder: str) -> DataFrame:
    return E.plan_export(D.questions(spark, folder)).items.na.fill("<null>")


def mcq_report(spark: SparkSession, folder: str) -> DataFrame:
    return E.plan_export(D.questions(spark, folder)).report.withColumn("options", F.col("options").cast("long"))


def mcq_files(spark: SparkSession, folder: str) -> DataFrame:
    """Write the files, read them back."""
    out = shared_folder(spark, "mcq")
    E.export_mcq(D.questions(spark, folder), out, "parts/v1")
    schema = "question string, A string, B string, C string, D string, answer string, benchmark string, config string"
    return spark.read.schema(schema).json(out).na.fill("<null>")


QUERIES = {"capped_by_key": capped_by_key, "capped_in_files": capped_in_files, "source_rows": source_rows,
           "head_rows": head_rows, "mcq_items": mcq_items, "mcq_report": mcq_report, "mcq_files": mcq_files}

_USED = (f"{D.QUESTIONS}, use AS (SELECT config, CASE WHEN bool_or(split = 'test') THEN 'test' ELSE min(split) END AS split "
         "FROM questions GROUP BY config)")
_ITEMS = ("regexp_replace(config, '[^A-Za-z0-9_.-]', '_', 'g') AS config, question, coalesce(A, '<null>') AS A, "
          "coalesce(B, '<null>') AS B, coalesce(C, '<null>') AS C, coalesce(D, '<null>') AS D, "
          f"left(upper({D.sql_strip('answer')}), 1) AS answer")
_ANSWERED = f"coalesce({D.sql_strip('answer')}, '') <> ''"
_FIRST = f"SELECT doc_id, {{key}}md5(text) AS content FROM documents ORDER BY doc_id LIMIT {CAP}"
SQL = {
    "capped_by_key": _FIRST.format(key="doc_id::varchar AS row_key, "),
    "capped_in_files": _FIRST.format(key=""),
    "source_rows": "SELECT lang, count(*) AS rows, count(*) AS keys FROM documents GROUP BY lang",
    "head_rows": "SELECT least(count(*), 200) AS rows FROM documents",
    "mcq_items": f"WITH {_USED} SELECT {_ITEMS} FROM questions JOIN use USING (config, split) WHERE {_ANSWERED}",
    "mcq_report": f"WITH {_USED} SELECT config, split, count(*) FILTER ({_ANSWERED}) AS items, count(*) FILTER (NOT ({_ANSWERED})) AS unanswered, "
                  "((count(A) > 0)::bigint + (count(B) > 0)::bigint + (count(C) > 0)::bigint + (count(D) > 0)::bigint) AS options, "
                  "'' AS skipped FROM questions JOIN use USING (config, split) GROUP BY config, split",
    "mcq_files": f"WITH {_USED} SELECT {_ITEMS}, 'parts_v1' AS benchmark FROM questions JOIN use USING (config, split) WHERE {_ANSWERED}",
}
