import random
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings, strategies as st

from corpusforge.functions import rewards as R
from corpusforge.operators import scoring as S
from corpusforge.streaming import guard as G
from corpusforge.streaming import monitor as T
from corpusforge.streaming.scoring import score_stream
from corpusforge.workloads import streams as W

LOG = "run_id string, step long, ratio double"


def expected(rows, patience=3):
    """One pass in step order, as a trainer would see the log."""
    streak, fired = {}, {}
    for run, step, ratio in sorted(rows, key=lambda r: (r[1], r[2] is None, r[2] or 0)):
        if ratio is None:
            continue
        streak[run] = streak.get(run, 0) + 1 if ratio >= 0.999 else 0
        if streak[run] >= patience:
            fired.setdefault(run, step)
    return fired


def batch(spark, rows, **kw):
    df = spark.createDataFrame(rows, LOG)
    return {r["run_id"]: r["alert_step"] for r in G.guard_batch(df, **kw).collect()}


def run_stream(spark, tmp_path, batches, patience=3):
    log, out = tmp_path / "log", tmp_path / "alerts"
    log.mkdir()
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, LOG).coalesce(1).write.parquet(str(log / f"part{i}"))
        query = (G.guard_stream(spark.readStream.schema(LOG).parquet(str(log / "part*")), patience)
                 .writeStream.format("parquet").option("path", str(out))
                 .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start())
        query.awaitTermination()
    return [tuple(r) for r in spark.read.schema(G.ALERT_TYPE).parquet(str(out)).collect()]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from([1.0, 1.0, 1.0, 0.5, None])), max_size=60),
       st.integers(1, 5), st.integers(1, 9))
def test_batch_guard_equals_one_pass(spark, events, patience, block):
    rows = [(run, step, ratio) for step, (run, ratio) in enumerate(events)]
    if rows:
        assert batch(spark, rows, patience=patience, steps_per_block=block) == expected(rows, patience)


def test_batch_guard_with_one_long_run(spark):
    rng = random.Random(5)
    rows = [("hot", s, rng.choice([1.0, 0.2])) for s in range(0, 60000, 3)] + [("cold", s, 0.0) for s in range(50)]
    rows += [("tail", s, 0.2) for s in range(9000)] + [("tail", s, 1.0) for s in range(9000, 9040)]
    assert batch(spark, rows, patience=12, steps_per_block=64) == expected(rows, 12)
    assert batch(spark, rows, patience=40, steps_per_block=16)["tail"] == 9039


def test_nan_breaks_a_streak_and_steps_may_repeat(spark, tmp_path):
    nan = float("nan")
    rows = [("n", 1, 1.0), ("n", 2, 1.0), ("n", 3, nan), ("n", 4, 1.0),
            ("r", 1, 1.0), ("r", 2, 1.0), ("r", 2, 1.0), ("r", 3, None), ("r", 4, 0.9995)]
    assert batch(spark, rows) == {"r": 4}
    assert run_stream(spark, tmp_path, [rows]) == [("r", 4, 3)]


def test_rows_without_run_or_step_are_ignored(spark, tmp_path):
    rows = [("r", 1, 1.0), ("r", None, 1.0), ("r", 2, 1.0), (None, 3, 1.0), ("r", 5, 1.0)]
    assert batch(spark, rows) == {"r": 5}
    assert run_stream(spark, tmp_path, [rows]) == [("r", 5, 3)]


def test_stream_equals_batch_over_micro_batches(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"run{rng.randrange(8)}", s, rng.choice([1.0, 1.0, 0.3, None])) for s in range(600)]
    parts = [rows[:150], rows[150:400], rows[400:]]
    alerts = run_stream(spark, tmp_path, parts)
    assert {r: s for r, s, _ in alerts} == expected(rows) and len(alerts) == len(expected(rows))


def test_late_steps_are_dropped_and_alerts_fire_once(spark, tmp_path):
    alerts = run_stream(spark, tmp_path, [
        [("a", 5, 1.0), ("a", 6, 1.0), ("b", 1, 1.0)],
        [("a", 4, 0.0), ("a", 6, 0.0), ("a", 3, 1.0), ("b", 2, 1.0)],     # late for a
        [("a", 7, 1.0), ("a", 8, 0.0), ("a", 9, 1.0), ("a", 10, 1.0), ("a", 11, 1.0), ("b", 3, 0.0)],
        [("a", 12, 1.0), ("b", 4, 1.0), ("b", 5, 1.0), ("b", 6, 1.0)]])
    assert sorted(alerts) == [("a", 7, 3), ("b", 6, 3)]


def test_metrics_logged_as_text(spark):
    rows = [("a", 1, "1.0"), ("a", 2, "n/a"), ("a", 3, "1"), ("a", 4, None), ("a", 5, "0.9991")]
    df = spark.createDataFrame(rows, "run_id string, step long, ratio string")
    assert [tuple(r) for r in G.guard_batch(df).collect()] == [("a", 5, 3)]


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    rows = [(i, t, "A") for i, t in enumerate(["\\boxed{A}", "這个 " * 30, "plain words " * 12, ""])]
    schema = "i int, completion string, target string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "in"))
    names = sorted(R.REWARDS)
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    score_stream(stream, str(tmp_path / "out"), str(tmp_path / "check"), once=True, spec=names,
                 target="target").awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("i").collect()
    want = S.score(spark.createDataFrame(rows, schema), names, target="target").orderBy("i").collect()
    assert got == want


@pytest.mark.parametrize("patience", [1, 2])
def test_short_patience(spark, patience):
    rows = [("a", 1, 0.5), ("a", 2, 1.0), ("a", 3, 1.0)]
    assert batch(spark, rows, patience=patience) == {"a": 1 + patience}


def in_order(batches, patience):
    """One pass over micro-batches: steps in order, what is not after the last one is late."""
    state, alerts = {}, []
    for rows in batches:
        merged = {}
        for run, step, ratio in rows:
            if ratio is not None:
                merged[run, step] = min(merged.get((run, step), 2.0), ratio)
        for (run, step), ratio in sorted(merged.items()):
            streak, fired, last = state.get(run, (0, False, None))
            if last is not None and step <= last:
                continue
            streak = streak + 1 if ratio >= 0.999 else 0
            if streak == patience and not fired:
                alerts.append((run, step, patience))
                fired = True
            state[run] = (streak, fired, step)
    return sorted(alerts)


@pytest.mark.parametrize("patience, block, seed", [(1, 4, 0), (3, 4, 1), (5, 3, 2), (4, 1, 3), (6, 4096, 4)])
def test_stream_merges_summaries_and_drops_late_steps(spark, tmp_path, patience, block, seed):
    rng = random.Random(seed)
    # Steps overlap between micro-batches, so that many are late, some in the midst of a block.
    batches = [[(rng.choice("abc"), rng.randrange(40 * i, 40 * i + 70), rng.choice([1.0, 1.0, 1.0, 0.2, None])) for _ in range(120)] for i in range(3)]
    log, out = tmp_path / "log", tmp_path / "alerts"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, LOG).coalesce(1).write.parquet(str(log / f"part{i}"))
        query = (G.guard_stream(spark.readStream.schema(LOG).parquet(str(log / "part*")), patience, steps_per_block=block)
                 .writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(tmp_path / "check"))
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    assert sorted(tuple(r) for r in spark.read.schema(G.ALERT_TYPE).parquet(str(out)).collect()) == in_order(batches, patience)


def test_a_long_run_reaches_its_state_as_few_summaries(spark):
    rng = random.Random(9)
    rows = [("hot", s, rng.random() < 0.8) for s in range(30_000)] + [("cold", s, True) for s in range(5)]
    df = spark.createDataFrame(rows, "run_id string, step long, hit boolean").repartition(5)
    found = G.summaries(df, 3, 1000).collect()
    assert len(found) == 31 and all(len(r["early"]) <= 3 and len(r["hits"]) <= 125 for r in found)
    assert {r["block"] for r in found if r["run_id"] == "hot"} == set(range(30))


# Trends

TRENDS = "run_id string, metric string, ts timestamp, value double"
HOUR = datetime(2024, 1, 1)


def trend_rows():
    def at(hours, minutes=0):
        return HOUR + timedelta(hours=hours, minutes=minutes)

    nan = float("nan")
    clipped = [("a", "completions/clipped_ratio", at(h, m), v) for h, v in enumerate((0.1, 0.4, 0.5, 0.9, 0.2, 0.5)) for m in (1, 30)]
    clipped += [("a", "completions/clipped_ratio", at(h), 0.9) for h in (8, 9)]  # two hours without a row before
    loss = [("a", "loss", at(h, m), v) for h, v in enumerate((2.0, 1.5, 9.0, 8.5, 0.001, 0.002)) for m in (5, 6)]
    loss += [("b", "loss", at(0), 1.0), ("b", "loss", at(0, 9), 1.1), ("b", "loss", at(1), nan), ("b", "loss", at(2), 3.0), ("b", "loss", at(2, 1), 3.0),
             ("b", "loss", at(3), 1.0), ("b", "loss", at(3, 1), 1.0), ("b", "loss", at(3, 2), 1.0), ("b", "loss", at(3, 3), 30.0), ("b", "loss", at(4), None)]
    accuracy = [("b", "mean_token_accuracy", at(h), v) for h, v in enumerate((0.5, 0.96, 0.97, 0.99, 0.3))]
    return clipped + loss + accuracy + [("b", "other", at(0), 1e9)]


WANTED = {
    ("a", "completions/clipped_ratio"): [(0, "none", 1, False), (1, "answers cut off", 1, False), (2, "answers cut off", 2, True), (3, "answers cut off", 3, True),
                                         (4, "none", 1, False), (5, "answers cut off", 1, False), (8, "answers cut off", 1, False), (9, "answers cut off", 2, True)],
    ("a", "loss"): [(0, "flat", 1, False), (1, "flat", 2, True), (2, "spike", 1, False), (3, "flat", 1, False), (4, "near zero", 1, False), (5, "near zero", 2, True)],
    ("b", "loss"): [(0, "none", 1, False), (1, "not a number", 1, False), (2, "flat", 1, False), (3, "spike", 1, False)],
    ("b", "mean_token_accuracy"): [(0, "none", 1, False), (1, "memorizing", 1, False), (2, "memorizing", 2, True), (3, "memorizing", 3, True), (4, "none", 1, False)],
    ("b", "other"): [(0, "none", 1, False)],
}


def by_metric(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r["start"]):
        out.setdefault((r["run_id"], r["metric"]), []).append((int((r["start"] - HOUR).total_seconds() // 3600), r["symptom"], r["lasted"], r["persistent"]))
    return out


def test_every_rule_of_the_trends(spark):
    df = spark.createDataFrame(trend_rows(), TRENDS)
    assert by_metric(T.metric_trends_batch(df, persistent=2).collect()) == WANTED
    assert T.metric_trends_batch(df.limit(0)).collect() == []
    own = {"other": (("huge", lambda w: w["mean"] > 5),)}
    assert {r["symptom"] for r in T.metric_trends_batch(df, rules=own).collect()} == {"huge", "none"}


def test_trends_carry_over_micro_batches(spark, tmp_path):
    rows = trend_rows()
    log, out = tmp_path / "log", tmp_path / "out"
    last = HOUR + timedelta(hours=40)
    parts = [[r for r in rows if r[2] < HOUR + timedelta(hours=2, minutes=20)], [r for r in rows if r[2] >= HOUR + timedelta(hours=2, minutes=20)],
             [("z", "other", last, 0.0)]]
    def run(df, to):
        (df.writeStream.format("parquet").option("path", str(tmp_path / to)).option("checkpointLocation", str(tmp_path / f"{to}-check"))
         .outputMode("append").trigger(availableNow=True).start().awaitTermination())

    for i, part in enumerate(parts):
        spark.createDataFrame(part, TRENDS).coalesce(1).write.parquet(str(log / f"part{i}"))
        measures = T.metric_measures(spark.readStream.schema(TRENDS).parquet(str(log / "part*")), late="30 minutes")
        run(measures, "windows")
        run(T.metric_trends(spark.readStream.schema(measures.schema).parquet(str(tmp_path / "windows")), persistent=2), "out")
    assert by_metric(spark.read.schema(T.TREND_TYPE).parquet(str(out)).collect()) == WANTED


@pytest.mark.parametrize("parts", [1, 3])
def test_a_streamed_table_may_be_a_file_or_a_folder(spark, tmp_path, parts):
    """As the reader takes it; beside it lies another table."""
    made = spark.createDataFrame([(i, f"t{i}") for i in range(9)], "i int, t string")
    for name in ("documents", "pages"):
        made.repartition(parts).write.parquet(str(tmp_path / "made" / name))
    (tmp_path / "in").mkdir()
    for name in ("documents", "pages"):
        if parts > 1:
            (tmp_path / "made" / name).rename(tmp_path / "in" / f"{name}.parquet")
        else:
            next((tmp_path / "made" / name).glob("*.parquet")).rename(tmp_path / "in" / f"{name}.parquet")
    (W.stream(spark, str(tmp_path / "in"), "documents").writeStream.format("parquet").option("path", str(tmp_path / "out"))
     .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination())
    assert sorted(r["i"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(9))
