"""Time the headline queries; prints one JSON line.

Each query runs twice, in full, into Spark's no-op sink; the second run counts,
so that JVM and Python worker start-up do not.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from corpusforge.session import local_session
from corpusforge.workloads import queries

HEADLINE = (
    "quality_by_language", "reward_composed", "reward_matrix", "strip_code", "script_counts", "latin_words",
    "extract_answer", "norm_answer", "fourgrams", "token_estimate", "decode_json", "sharegpt_to_messages",
    "sharegpt_preference", "prompts_mcq", "prompts_math", "drop_unverifiable", "render_chat", "assistant_spans",
    "survivors", "truncation_report", "json_string_columns", "role_histogram", "turn_stats", "length_profile",
    "token_profile", "weighted_interleave", "shuffle", "training_table", "capped_in_files", "mcq_files",
    "guard_batch", "guard_stream", "scored_stream",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    # The test tables are one file with one row group each; a real table is not shuffled first.
    spark.conf.set("corpusforge.local.spread", "true")
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": Path(folder).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
