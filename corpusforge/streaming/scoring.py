"""Score a stream of completions: rewards hold no state, so the batch operator
runs on it unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from corpusforge.operators.scoring import score


def score_stream(completions: DataFrame, out: str, checkpoint: str, once: bool = False,
                 **scoring) -> StreamingQuery:
    """Append scored completions to a parquet table. `scoring` goes to `score`;
    `once` processes what is there and stops."""
    writer = (score(completions, **scoring).writeStream.format("parquet")
              .option("path", out).option("checkpointLocation", checkpoint).outputMode("append"))
    return (writer.trigger(availableNow=True) if once else writer).start()
