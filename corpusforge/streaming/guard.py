"""Raise an alert when a run's completions stay fully cut off.

Input rows are (run_id, step, ratio); the ratio may be text, as logged. A ratio at or above the threshold extends
the run's streak, a lower one ends it, one that is missing or no number is ignored. A run alerts
once, at the step where the streak reaches `patience`. A row without a run or a
step is ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusforge.functions import values as V

ALERT_TYPE = "run_id string, alert_step long, streak long"
STATE_TYPE = "streak long, fired boolean, last_step long"
SUMMARY_TYPE = ("run_id string, block long, first long, last long, lead long, tail long, broken boolean, early array<long>, "
                "later long, logged binary, hits binary")
STEPS_PER_BLOCK = 4096


@dataclass(frozen=True)
class Summary:
    """Some steps of a run in order, as far as a guard has to know them.

    lead, tail: hits before the first and after the last miss; broken: there is a
    miss; early: steps of the first hits, at most `patience`; later: where a
    streak after the first miss is long enough.
    """

    first: int
    last: int
    lead: int
    tail: int
    broken: bool
    early: list[int]
    later: int | None

    @staticmethod
    def of(steps: np.ndarray, hits: np.ndarray, patience: int) -> Summary:
        misses = np.flatnonzero(~hits)
        lead, tail = (misses[0], hits.size - 1 - misses[-1]) if misses.size else (hits.size, hits.size)
        reached = np.flatnonzero(_streaks(hits) == patience)
        reached = reached[reached > lead]
        return Summary(int(steps[0]), int(steps[-1]), int(lead), int(tail), bool(misses.size), steps[:min(lead, patience)].tolist(),
                       int(steps[reached[0]]) if reached.size else None)

    def after(self, streak: int, patience: int) -> tuple[int, int | None]:
        """The streak that these steps leave behind, and where they raise an alert."""
        missing = patience - streak
        alert = self.early[missing - 1] if missing <= self.lead else self.later
        return (self.tail if self.broken else streak + self.lead), alert


def _streaks(hits: np.ndarray) -> np.ndarray:
    """Length of the running streak of hits at each position."""
    position = np.arange(1, len(hits) + 1)
    return position - np.maximum.accumulate(np.where(hits, 0, position))


def summaries(rows: DataFrame, patience: int, steps_per_block: int) -> DataFrame:
    """One summary for each run and block of steps, for tables and micro-batches.

    Beside it stand the block's steps and hits as bits from its first step on,
    for the one block that can hold steps seen before. A step logged twice is a
    hit only if both values are.
    """
    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs: dict[str, int] = {}
        parts = [(np.fromiter((runs.setdefault(r, len(runs)) for r in b["run_id"]), np.int64, len(b)), b["step"].to_numpy(np.int64), b["hit"].to_numpy(bool))
                 for b in batches]
        if not runs:
            return
        run, step, hit = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((hit, step, run))
        run, step, hit = run[order], step[order], hit[order]
        once = np.append(True, (run[1:] != run[:-1]) | (step[1:] != step[:-1]))
        run, step, hit = run[once], step[once], hit[once]
        block = step // steps_per_block
        cuts = np.flatnonzero((run[1:] != run[:-1]) | (block[1:] != block[:-1])) + 1
        names, out = list(runs), []
        for at, upto in zip([0, *cuts], [*cuts, run.size], strict=True):
            own, hits = step[at:upto], hit[at:upto]
            bits = np.zeros((2, own[-1] - own[0] + 1), bool)
            bits[0, own - own[0]], bits[1, own - own[0]] = True, hits
            s = Summary.of(own, hits, patience)
            out.append((names[run[at]], int(block[at]), s.first, s.last, s.lead, s.tail, s.broken, s.early, s.later, *(np.packbits(b).tobytes() for b in bits)))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in SUMMARY_TYPE.split(", ")]).astype({"later": "Int64"})

    block = F.floor(F.col("step") / steps_per_block)
    return rows.withColumn("block", block).repartition("run_id", "block").select("run_id", "step", "hit").mapInPandas(reduce, SUMMARY_TYPE)


def guard_stream(log: DataFrame, patience: int = V.GUARD_PATIENCE, idle: str | None = None,
                 steps_per_block: int = STEPS_PER_BLOCK) -> DataFrame:
    """Alerts of a metric stream, with one small state per run.

    Within a micro-batch steps are put in order block by block, in as many tasks
    as there are blocks; what meets a run's state are summaries of blocks, so a
    run may hold most of a batch. A step at or before the last one seen is late
    and dropped. With `idle` (say "7 days"), a run of which nothing came for so
    long is forgotten; a query with such a clock does not end by itself.
    """
    def watch(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        if idle:
            state.setTimeoutDuration(idle_ms)
        streak, fired, last = state.get if state.exists else (0, False, None)
        if fired:
            for _ in chunks:
                pass
            state.update((streak, fired, last))
            return
        alert = None
        for row in pd.concat(list(chunks)).sort_values("block").itertuples():
            known = _unseen(row, last, patience)
            if known is None or alert is not None:
                continue
            streak, alert = known.after(streak, patience)
            last = known.last
        if alert is not None:
            yield pd.DataFrame({"run_id": [key[0]], "alert_step": [alert], "streak": [patience]})
        if last is not None:
            state.update((streak, alert is not None, last))

    rows = summaries(_hits(log), patience, steps_per_block)
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000) if idle else 0
    return rows.groupBy("run_id").applyInPandasWithState(
        watch, ALERT_TYPE, STATE_TYPE, "append",
        GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout)


def _unseen(row, last: int | None, patience: int) -> Summary | None:
    """What a summary says of steps after `last`; None if it has none."""
    if last is None or row.first > last:
        return Summary(row.first, row.last, row.lead, row.tail, row.broken, list(row.early), None if pd.isna(row.later) else int(row.later))
    if row.last <= last:
        return None
    logged, hits = (np.unpackbits(np.frombuffer(b, np.uint8), count=row.last - row.first + 1).astype(bool) for b in (row.logged, row.hits))
    at = np.flatnonzero(logged)
    at = at[at + row.first > last]
    return Summary.of(at + row.first, hits[at], patience)


def _hits(log: DataFrame) -> DataFrame:
    hit = (F.col("ratio") >= V.CLIPPED_AT) & ~F.isnan("ratio")
    return (log.withColumn("ratio", F.col("ratio").try_cast("double")).filter(F.col("ratio").isNotNull())
            .select(F.col("run_id").cast("string").alias("run_id"),
                    F.col("step").cast("long").alias("step"), hit.alias("hit")).dropna())


def guard_batch(log: DataFrame, patience: int = V.GUARD_PATIENCE,
                steps_per_block: int = STEPS_PER_BLOCK) -> DataFrame:
    """The same alerts from a stored log.

    A run may hold most of the log, so it is cut into blocks of steps. Each
    block is reduced to a summary of fixed size (its leading and trailing hits
    and its first alert), and only summaries are put in order per run.
    """
    rows = (_hits(log).withColumn("block", F.floor(F.col("step") / steps_per_block))
            .groupBy("run_id", "block", "step").agg(F.min("hit").alias("hit")))
    block = Window.partitionBy("run_id", "block").orderBy("step")
    # Misses so far number the segments of a block; segment 0 leads it.
    rows = rows.withColumn("segment", F.sum((~F.col("hit")).cast("long")).over(block))
    in_segment = Window.partitionBy("run_id", "block", "segment").orderBy("step")
    rows = rows.withColumn("streak", F.sum(F.col("hit").cast("long")).over(in_segment))

    leading = (F.col("segment") == 0)
    early = F.when(leading & (F.col("streak") < patience), F.struct("streak", "step"))
    full = F.when(~leading & (F.col("streak") == patience), F.col("step"))
    summary = rows.groupBy("run_id", "block").agg(
        F.max("segment").alias("misses"),
        F.coalesce(F.max(F.when(leading, F.col("streak"))), F.lit(0)).alias("lead"),
        F.max_by("streak", "step").alias("tail"),
        F.min(F.when(leading & (F.col("streak") == patience), F.col("step"))).alias("lead_alert"),
        F.min(full).alias("later_alert"),
        F.collect_list(early).alias("early"))          # fewer than `patience` entries

    # Streak carried into a block: the hits that end the block before it, plus
    # those of any blocks in between that consist of hits only.
    run = Window.partitionBy("run_id").orderBy("block")
    before = run.rowsBetween(Window.unboundedPreceding, -1)
    broken = F.col("misses") > 0
    summary = summary.select(
        "*", F.coalesce(F.sum(broken.cast("long")).over(before), F.lit(0)).alias("stretch"),
        F.coalesce(F.last(F.when(broken, F.col("tail")), ignorenulls=True).over(before), F.lit(0)).alias("tail_before"))
    stretch = (Window.partitionBy("run_id", "stretch").orderBy("block")
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = F.col("tail_before") + F.coalesce(F.sum("lead").over(stretch), F.lit(0))
    summary = summary.withColumn("carried", carried)

    missing = patience - F.col("carried")
    joined = F.filter("early", lambda e: e["streak"] == missing)
    alert = F.least(F.get(joined, F.lit(0))["step"], "lead_alert", "later_alert")
    return (summary.groupBy("run_id").agg(F.min(alert).alias("alert_step"))
            .filter(F.col("alert_step").isNotNull())
            .withColumn("streak", F.lit(patience).cast("long")))
