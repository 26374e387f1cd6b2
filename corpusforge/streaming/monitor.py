"""Symptoms in a metric stream, per run and tumbling window.

`metric_windows` tells one window's symptom. `metric_trends` and its twin for
stored logs, `metric_trends_batch`, judge each metric by its own rules and count
for how many windows in a row a symptom has lasted. Spark allows no state of
one's own behind a windowed aggregate in the same query, so the stream has two:
one writes `metric_measures` as a table, the other reads that table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

CLIPPED, SPIKE = 0.3, 3.0
MEMORIZED, NEAR_ZERO = 0.95, 0.01
#: Windows in a row after which a symptom counts as persistent.
PERSISTENT = 3
NO_SYMPTOM = "none"

#: A rule compares a window's measures: rows, broken (values that are no finite
#: number), mean, lowest, highest, and previous, the mean of the window before.
#: The same expressions work on Columns and on pandas Series.
Rule = tuple[str, Callable[[Mapping], object]]
NOT_A_NUMBER: Rule = ("not a number", lambda w: w["broken"] > 0)
RULES: Mapping[str, Sequence[Rule]] = {
    "completions/clipped_ratio": (NOT_A_NUMBER, ("answers cut off", lambda w: w["mean"] > CLIPPED)),
    "loss": (NOT_A_NUMBER, ("near zero", lambda w: w["highest"] < NEAR_ZERO),
             ("spike", lambda w: (w["highest"] > SPIKE * w["mean"]) | (w["mean"] > SPIKE * w["previous"])),
             ("flat", lambda w: (w["rows"] > 1) & (w["lowest"] == w["highest"]))),
    "mean_token_accuracy": (NOT_A_NUMBER, ("memorizing", lambda w: w["mean"] > MEMORIZED)),
}
MEASURES = ("rows", "broken", "mean", "lowest", "highest")
TREND_TYPE = ("run_id string, metric string, start timestamp, rows long, broken long, mean double, lowest double, highest double, "
              "symptom string, lasted long, persistent boolean")


def metric_windows(log: DataFrame, every: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(run_id, start, rows, mean, lowest, highest, symptom) of (run_id, ts, value).

    Works on streams and tables. Rows later than the watermark are dropped; on a
    stream in append mode a window comes out when the watermark passes its end.
    """
    rows = log.select("run_id", F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("double").alias("value")).filter(
        F.col("value").isNotNull() & ~F.isnan("value"))
    sums = rows.withWatermark("ts", late).groupBy("run_id", F.window("ts", every).alias("w")).agg(
        F.count("*").alias("rows"), F.avg("value").alias("mean"), F.min("value").alias("lowest"), F.max("value").alias("highest"))
    symptom = (F.when(F.col("lowest") > CLIPPED, "persistently high").when(F.col("highest") == 0, "flat at zero")
               .when(F.col("highest") > SPIKE * F.col("mean"), "spike").otherwise("none"))
    return sums.select("run_id", F.col("w.start").alias("start"), "rows", "mean", "lowest", "highest", symptom.alias("symptom"))


def metric_measures(log: DataFrame, every: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(run_id, metric, start, end, rows, broken, mean, lowest, highest) of
    (run_id, metric, ts, value), a stream or a table. NULLs and text that is no
    number are ignored; values that are not finite count as broken only.
    """
    rows = log.select(F.col("run_id").cast("string").alias("run_id"), F.col("metric").cast("string").alias("metric"),
                      F.col("ts").cast("timestamp").alias("ts"), F.col("value").try_cast("double").alias("value"))
    rows = rows.filter(reduce(and_, [F.col(c).isNotNull() for c in rows.columns]))  # NaN is not NULL
    finite = F.when(F.abs("value") < float("inf"), F.col("value"))
    sums = rows.withWatermark("ts", late).groupBy("run_id", "metric", F.window("ts", every).alias("w")).agg(
        F.count("*").alias("rows"), (F.count("*") - F.count(finite)).alias("broken"), F.avg(finite).alias("mean"),
        F.min(finite).alias("lowest"), F.max(finite).alias("highest"))
    return sums.select("run_id", "metric", F.col("w.start").alias("start"), F.col("w.end").alias("end"), *MEASURES)


def _symptom(rules: Mapping[str, Sequence[Rule]], measures: Mapping[str, Column]) -> Column:
    """The first rule of the row's metric that holds."""
    found = F.lit(NO_SYMPTOM)
    for metric, own in rules.items():
        for symptom, test in reversed(own):
            found = F.when((F.col("metric") == metric) & F.coalesce(test(measures), F.lit(False)), symptom).otherwise(found)
    return found


def metric_trends_batch(log: DataFrame, every: str = "1 hour", persistent: int = PERSISTENT,
                        rules: Mapping[str, Sequence[Rule]] = RULES) -> DataFrame:
    """`metric_trends` of a stored log, of which no row is late."""
    windows = metric_measures(log, every)
    order = Window.partitionBy("run_id", "metric").orderBy("start")
    follows = F.coalesce(F.lag("end").over(order) == F.col("start"), F.lit(False))
    windows = windows.withColumn("follows", follows).withColumn("previous", F.when(F.col("follows"), F.lag("mean").over(order)))
    windows = windows.withColumn("symptom", _symptom(rules, {m: F.col(m) for m in (*MEASURES, "previous")}))
    same = F.col("follows") & (F.lag("symptom").over(order) == F.col("symptom"))
    windows = windows.withColumn("island", F.sum(F.when(same, 0).otherwise(1)).over(order))
    lasted = F.row_number().over(Window.partitionBy("run_id", "metric", "island").orderBy("start")).cast("long")
    return _trend(windows.withColumn("lasted", lasted), persistent)


def _trend(windows: DataFrame, persistent: int) -> DataFrame:
    long_enough = (F.col("symptom") != NO_SYMPTOM) & (F.col("lasted") >= persistent)
    return windows.select("run_id", "metric", "start", *MEASURES, "symptom", "lasted", long_enough.alias("persistent"))


def metric_trends(windows: DataFrame, persistent: int = PERSISTENT, rules: Mapping[str, Sequence[Rule]] = RULES) -> DataFrame:
    """Windows of a stream of `metric_measures`, judged one after another.

    (run_id, metric, start, rows, broken, mean, lowest, highest, symptom, lasted,
    persistent): `lasted` counts adjacent windows with the same symptom, this one
    included; a window without a row ends a series. The state of a run's metric
    is its last window, with the symptom and for how long that has lasted. Windows
    come out of the first query in order as the watermark passes their ends, and
    are put in order within a micro-batch, so read all files of a commit at once;
    a window that is not after the last one is late and dropped.
    """
    def judge(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        end, previous, before, lasted = state.get if state.exists else (None, None, None, 0)
        windows = pd.concat(list(chunks)).sort_values("start")
        windows = windows[windows["end"].astype("int64") > (np.iinfo(np.int64).min if end is None else end)].reset_index(drop=True)
        if windows.empty:
            return
        ends = windows["end"].astype("int64")
        follows = ends.shift(1, fill_value=-1 if end is None else end) == windows["start"].astype("int64")
        known = windows["mean"].shift(1)
        known.iloc[0] = previous
        measures = {m: windows[m] for m in MEASURES} | {"previous": known.where(follows).astype(float)}
        symptoms = pd.Series(NO_SYMPTOM, windows.index)
        for symptom, test in reversed(rules.get(key[1], ())):
            symptoms = symptoms.mask(test(measures), symptom)
        counts = []
        for symptom, next_to in zip(symptoms, follows, strict=True):
            lasted = lasted + 1 if next_to and symptom == before else 1
            before = symptom
            counts.append(lasted)
        last = windows["mean"].iloc[-1]
        state.update((int(ends.iloc[-1]), None if pd.isna(last) else float(last), before, lasted))
        yield windows.assign(symptom=symptoms, lasted=counts, persistent=(symptoms != NO_SYMPTOM) & (pd.Series(counts) >= persistent))[
            [c.split()[0] for c in TREND_TYPE.split(", ")]]

    return windows.groupBy("run_id", "metric").applyInPandasWithState(
        judge, TREND_TYPE, "end long, mean double, symptom string, lasted long", "append", GroupStateTimeout.NoTimeout)
