"""Streams over the given tables, run until they have read everything."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusforge.session import shared_folder
from corpusforge.streaming import guard as G
from corpusforge.streaming.scoring import score_stream
from corpusforge.workloads import rewards as W
from corpusforge.workloads import tables as D


def stream(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table as a stream, be it one file or a folder of files. Only a path that
    is a pattern, as the braces make it, may be a single file."""
    schema = D.read(spark, folder, table).schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", "8")
            .parquet(f"{folder}/{{{table}.parquet}}"))


def guard_batch(spark: SparkSession, folder: str) -> DataFrame:
    return G.guard_batch(D.metric_log(spark, folder))


def guard_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The same with small blocks, so that streaks cross many of them."""
    return G.guard_batch(D.metric_log(spark, folder), steps_per_block=16)


def guard_stream(spark: SparkSession, folder: str) -> DataFrame:
    out, checkpoint = shared_folder(spark, "alerts"), shared_folder(spark, "alerts-checkpoint")
    alerts = G.guard_stream(D.metric_log_from(stream(spark, folder, "events")))
    query = (alerts.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(G.ALERT_TYPE).parquet(out)


def scored_stream(spark: SparkSession, folder: str) -> DataFrame:
    out, checkpoint = shared_folder(spark, "scored"), shared_folder(spark, "scored-checkpoint")
    completions = D.completions_from(D.spread(stream(spark, folder, "documents")))
    score_stream(completions, out, checkpoint, once=True, spec=W.SPEC, prompt="prompt",
                 target="target").awaitTermination()
    return spark.read.parquet(out).select(
        "doc_id", F.round("reward", 9).alias("reward"), F.col("rewards_applied").cast("long").alias("rewards_applied"))


QUERIES = {"guard_batch": guard_batch, "guard_blocks": guard_blocks, "guard_stream": guard_stream,
           "scored_stream": scored_stream}

_GUARD = (f"WITH {D.METRIC_LOG}, logged AS (SELECT run_id, step, (ratio >= 0.999)::bigint AS hit FROM metric_log WHERE ratio IS NOT NULL), "
          "w AS (SELECT run_id, step, sum(hit) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS hits "
          "FROM logged) SELECT run_id, min(step) AS alert_step, 3::bigint AS streak FROM w WHERE hits = 3 GROUP BY run_id")
SQL = {"guard_batch": _GUARD, "guard_blocks": _GUARD, "guard_stream": _GUARD,
       "scored_stream": W.SQL["reward_composed"]}
