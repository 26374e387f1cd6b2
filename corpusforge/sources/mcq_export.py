"""Write multiple-choice benchmarks as JSON lines, one folder per config."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from corpusforge.functions import text as X
from corpusforge.operators.conform import require
from corpusforge.operators.prompts import check_options

#: Items of one file, about.
ITEMS_PER_FILE = 100_000
LETTERS = tuple(chr(ord("A") + i) for i in range(26))


@dataclass(frozen=True)
class McqExport:
    """`items` to write, and `report` with one row per config."""

    items: DataFrame
    report: DataFrame


def safe_name(name):
    """A file-system safe name: everything but [A-Za-z0-9_.-] becomes _."""
    return F.regexp_replace(name, "[^A-Za-z0-9_.-]", "_")


def plan_export(df: DataFrame, split: str | None = None) -> McqExport:
    """Choose a split per config and shape its items.

    Needs `config` and `split` columns. The split is the forced one, else "test",
    else the first by name. A config without questions, answers or two filled
    option columns is skipped, with the reason; an item without an answer cannot
    be graded and is left out, and counted as `unanswered`. Configs with different columns
    can be put together with `unionByName(..., allowMissingColumns=True)`.
    """
    options = [x for x in LETTERS if x in df.columns]
    check_options(df, options)
    require(df, ["config", "split"], "export_mcq")
    for name in ("question", "answer"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    df = df.withColumn("config", F.coalesce("config", F.lit("test")))
    filled = [F.count(x) for x in options]
    answer = X.upper_letter(F.left(X.strip(F.col("answer").cast("string")), F.lit(1)))
    answered = F.coalesce(answer != "", F.lit(False))
    per_split = df.groupBy("config", "split").agg(
        F.count_if(answered).alias("items"), F.count_if(~answered).alias("unanswered"), ((F.count("question") > 0) & (F.count("answer") > 0)).alias("complete"),
        sum(((n > 0).cast("int") for n in filled), F.lit(0)).alias("options"))
    # Smallest (rank, name) wins: a forced or "test" split ranks first.
    rank = F.when(F.col("split") == (split or "test"), 0).otherwise(1)
    chosen = per_split.groupBy("config").agg(
        F.min_by(F.struct("split", "items", "unanswered", "options", "complete"), F.struct(rank, "split")).alias("use"))
    reason = (F.when(F.lit(split is not None) & (F.col("use.split") != (split or "")), "split not found")
              .when(~F.col("use.complete"), "needs question and answer")
              .when(F.col("use.options") < 2, "fewer than two option columns")
              .otherwise(""))
    report = chosen.select("config", F.col("use.split").alias("split"),
                           F.when(reason == "", F.col("use.items")).otherwise(0).alias("items"),
                           F.col("use.options").alias("options"), F.col("use.unanswered").alias("unanswered"),
                           reason.alias("skipped"))
    wanted = report.filter("skipped = ''").select("config", "split")
    items = df.filter(answered).join(wanted, ["config", "split"]).select(
        safe_name(F.col("config")).alias("config"), "question", *options, answer.alias("answer"))
    return McqExport(items, report)


def export_mcq(df: DataFrame, out: str, benchmark: str, split: str | None = None) -> DataFrame:
    """Write the items below `out`, return the report. NULL options are left
    out of a record. Replaces what `out` holds for this benchmark's configs."""
    plan = plan_export(df, split)
    files = F.greatest(F.ceil(F.col("items") / ITEMS_PER_FILE), F.lit(1)).alias("_files")
    names = plan.report.select(safe_name(F.col("config")).alias("config"), files)
    if clash := names.groupBy("config").count().filter("count > 1").limit(5).collect():
        raise ValueError(f"configs share a file name: {[r['config'] for r in clash]}")
    # A config has files in proportion to its items; one item repeated many times
    # is spread by where it comes from.
    (plan.items.withColumn("_from", F.spark_partition_id()).join(names, "config").withColumn("benchmark", safe_name(F.lit(benchmark)))
     .withColumn("_file", F.pmod(F.hash("question", "_from"), F.col("_files"))).repartition("config", "_file")
     .drop("_from", "_file", "_files").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("benchmark", "config").json(out))
    return plan.report
