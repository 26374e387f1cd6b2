import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusforge.plans.prompt_table import build_prompt_table
from corpusforge.plans.training_table import build_training_table
from corpusforge.operators.prompts import require_targets
from corpusforge.sources import loading
from corpusforge.sources.loading import SourceSpec, head, load_source
from corpusforge.sources.mcq_export import export_mcq, plan_export


@pytest.fixture(scope="module")
def shards(spark, tmp_path_factory):
    """1,000 rows in five files, in order of i; split by parity."""
    path = str(tmp_path_factory.mktemp("data") / "shards")
    df = spark.range(1000).select(F.col("id").alias("i"), F.concat(F.lit("t"), "id").alias("text"),
                                  F.when(F.col("id") % 2 == 0, "train").otherwise("test").alias("split"),
                                  F.when(F.col("id") < 500, "x").otherwise("y").alias("config"))
    df.repartitionByRange(5, "i").sortWithinPartitions("i").write.parquet(path)
    return path


def ids(df):
    return sorted(r["i"] for r in df.select("i").collect())


@pytest.mark.parametrize("n", [1, 7, 200, 201, 999, 1000, 5000])
def test_first_rows_in_file_order(spark, shards, n):
    df = load_source(spark, SourceSpec(shards, split=None, max_samples=n))
    assert ids(df) == list(range(min(n, 1000)))


def test_cap_applies_to_the_selected_split(spark, shards):
    spec = SourceSpec(shards, split="test", config="y", max_samples=120)
    assert ids(load_source(spark, spec)) == list(range(501, 741, 2))
    assert ids(load_source(spark, spec, trial_rows=3)) == [501, 503, 505]
    keyed = SourceSpec(shards, split="test", key=("i",), max_samples=3)
    assert ids(load_source(spark, keyed)) == [1, 3, 5]
    assert head(load_source(spark, spec), 4).count() == 4


@pytest.mark.parametrize("n", [1, 10, 11, 499, 999, 1000, 2000])
def test_keyed_cap(spark, shards, n):
    """The cap goes through sorted keys; also with repeated keys."""
    df = spark.read.parquet(shards).repartition(7)
    assert ids(loading.first_by_key(df, ["i"], n)) == list(range(min(n, 1000)))
    hot = df.withColumn("k", F.when(F.col("i") < 400, 5).otherwise(F.col("i") % 90)).select("k", "i")
    got = [r["k"] for r in loading.first_by_key(hot, ["k"], n).collect()]
    want = sorted([5] * 400 + [i % 90 for i in range(400, 1000)])[:n]
    assert sorted(got) == want
    two = loading.first_by_key(df, ["config", "i"], n)
    assert ids(two) == list(range(min(n, 1000)))


def test_ties_of_a_keyed_cap_do_not_depend_on_partitioning(spark, shards):
    df = spark.read.parquet(shards).withColumn("k", F.lit(1))
    took = [sorted(r["i"] for r in loading.first_by_key(df.repartition(n), ["k"], 9).collect()) for n in (1, 5, 9)]
    assert took[0] == took[1] == took[2] and len(took[0]) == 9


def test_absent_config_or_split_is_an_error(spark, tmp_path):
    path = str(tmp_path / "plain")
    spark.range(3).write.parquet(path)
    assert load_source(spark, SourceSpec(path)).count() == 3
    for asked in ({"config": "law"}, {"split": "test"}):
        with pytest.raises(ValueError, match="asked for"):
            load_source(spark, SourceSpec(path, **asked))


def test_evaluation_reads_its_own_split(spark, shards):
    spec = SourceSpec(shards, key=("i",), keep=("i",))
    train, test = load_source(spark, spec), load_source(spark, spec, default_split="test")
    assert not {r["i"] for r in train.collect()} & {r["i"] for r in test.collect()}


def test_csv_options(spark, tmp_path):
    (tmp_path / "t.csv").write_text("i;text\n1;a b\n")
    spec = SourceSpec(str(tmp_path / "t.csv"), format="csv", options={"header": "true", "sep": ";"},
                      schema="i int, text string", key=("i",))
    assert [tuple(r) for r in load_source(spark, spec).collect()] == [(1, "a b", "1")]


def test_row_key_is_unique(spark, shards):
    df = load_source(spark, SourceSpec(shards, split=None))
    assert df.select("row_key").distinct().count() == 1000


def test_cap_skips_files_behind_the_last_row(spark, shards):
    df = load_source(spark, SourceSpec(shards, split=None, max_samples=10))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan


def test_path_placeholders_and_other_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "i int, text string")
    df.write.json(str(tmp_path / "c1" / "train"))
    spec = SourceSpec(str(tmp_path) + "/{config}/{split}", config="c1", format="json", schema="i int, text string", key=("i",))
    assert [tuple(r) for r in load_source(spark, spec).collect()] == [(1, "a", "1")]
    with pytest.raises(ValueError, match="need key columns"):
        load_source(spark, SourceSpec(spec.path, config="c1", format="json"))


def test_training_table_end_to_end(spark, tmp_path):
    share = "array<struct<from:string,value:string>>"
    spark.createDataFrame([(i, [("human", f"q{i}"), ("gpt", "a")]) for i in range(6)], f"id int, conversations {share}"
                          ).write.parquet(str(tmp_path / "share"))
    text = [(i, json.dumps([{"role": "user", "content": f"j{i}"}])) for i in range(4)]
    spark.createDataFrame(text, "id int, messages string").write.parquet(str(tmp_path / "json"))
    sources = [
        SourceSpec(str(tmp_path / "share"), "share", split=None, key=("id",), sharegpt_to_messages=True,
                   keep=("messages",), weight=3),
        SourceSpec(str(tmp_path / "json"), "json", split=None, json_columns=("messages",), keep=("messages",), weight=1),
    ]
    held = SourceSpec(str(tmp_path / "json"), "held", split=None, json_columns=("messages",), keep=("messages",))
    table = build_training_table(spark, sources, evaluation=held)
    counts = {r["source"]: (r["rows"], r["total_rows"]) for r in table.composition().collect()}
    assert counts == {"share": (12, 16), "json": (4, 16)}
    assert {m.content for r in table.train.collect() for m in r["messages"]} == {
        "a", *[f"q{i}" for i in range(6)], *[f"j{i}" for i in range(4)]}
    # The evaluation split goes through the same conversion.
    assert table.evaluation.schema["messages"].dataType == table.train.schema["messages"].dataType
    with pytest.raises(ValueError, match="no sources"):
        build_training_table(spark, [])
    with pytest.raises(ValueError, match="distinct names"):
        build_training_table(spark, [sources[0], sources[0]])
    with pytest.raises(ValueError, match="differ in columns"):
        build_training_table(spark, [sources[0], SourceSpec(str(tmp_path / "json"), "raw", split=None)])


def test_preference_source(spark, tmp_path):
    turn = "struct<from:string,value:string>"
    spark.createDataFrame([([("human", "q")], ("gpt", "y"), ("gpt", "n"))],
                          f"conversations array<{turn}>, chosen {turn}, rejected {turn}").write.parquet(str(tmp_path / "p"))
    spec = SourceSpec(str(tmp_path / "p"), split=None, sharegpt_preference=True, keep=("prompt", "chosen", "rejected"))
    row = build_training_table(spark, [spec]).train.first()
    assert [m.content for c in ("prompt", "chosen", "rejected") for m in row[c]] == ["q", "y", "n"]


def test_prompt_table(spark, tmp_path):
    for name, rows in (("a", [("q1", "\\boxed{3}"), ("q2", "none")]), ("b", [("q3", "\\boxed{4}")])):
        spark.createDataFrame(rows, "problem string, answer string").write.parquet(str(tmp_path / name))
    sources = [SourceSpec(str(tmp_path / n), n, split=None) for n in "ab"]
    table, seen = build_prompt_table(spark, sources, "math", question="problem")
    assert sorted(r["ground_truth"] for r in table.collect()) == ["3", "4"]
    assert seen.get == {"rows": 3, "dropped": 1}
    require_targets(seen)
    with pytest.raises(ValueError, match="unknown prompt kind"):
        build_prompt_table(spark, sources, "quiz")


MCQ = "config string, split string, question string, A string, B string, C string, answer string"


def test_export_mcq(spark, tmp_path):
    df = spark.createDataFrame([
        ("geo/1", "train", "q0", "a", "b", None, "a"), ("geo/1", "test", "q1", "a", "b", None, " b."),
        ("geo/1", "test", "q2", "a", "b", "c", "C"), ("law", "validation", "q3", "x", "y", "z", None),
        ("law", "train", "q4", "x", "y", "z", "答"), ("one", "test", "q5", "x", None, None, "A"),
        (None, "test", "q6", "x", "y", None, "A")], MCQ)
    out = str(tmp_path / "bench")
    report = {r["config"]: (r["split"], r["items"], r["options"], r["skipped"]) for r in export_mcq(df, out, "my/set").collect()}
    assert report == {"geo/1": ("test", 2, 3, ""), "law": ("train", 1, 3, ""), "test": ("test", 1, 2, ""),
                      "one": ("test", 0, 1, "fewer than two option columns")}
    folders = {p.parent.relative_to(out).as_posix() for p in Path(out).rglob("*.json")}
    assert folders == {"benchmark=my_set/config=geo_1", "benchmark=my_set/config=law", "benchmark=my_set/config=test"}
    lines = [json.loads(line) for p in Path(out, "benchmark=my_set/config=geo_1").glob("*.json")
             for line in p.read_text().splitlines()]
    assert sorted(lines, key=lambda r: r["question"]) == [
        {"question": "q1", "A": "a", "B": "b", "answer": "B"},
        {"question": "q2", "A": "a", "B": "b", "C": "c", "answer": "C"}]
    assert list(lines[0])[0] == "question" and list(lines[0])[-1] == "answer"
    export_mcq(df.filter("config = 'law'"), out, "my/set", split="validation")
    assert Path(out, "benchmark=my_set/config=geo_1").exists()


def test_export_mcq_rejects(spark, tmp_path):
    df = spark.createDataFrame([("a/b", "test", "q", "x", "y", None, "A"), ("a_b", "test", "q", "x", "y", None, "A")], MCQ)
    with pytest.raises(ValueError, match="share a file name"):
        export_mcq(df, str(tmp_path / "x"), "b")
    with pytest.raises(ValueError, match=r"\['split'\] are missing"):
        plan_export(df.drop("split"))
    assert {r["skipped"] for r in plan_export(df.drop("answer")).report.collect()} == {"needs question and answer"}
    assert plan_export(df.drop("answer")).items.count() == 0
    other = df.limit(1).select(F.lit("c").alias("config"), "split", F.col("question").alias("q"), "A", "B", "answer")
    mixed = plan_export(df.unionByName(other, allowMissingColumns=True)).report.collect()
    assert {r["config"]: r["skipped"] for r in mixed} == {"a/b": "", "a_b": "", "c": "needs question and answer"}
    forced = plan_export(df, split="dev").report.collect()
    assert {r["skipped"] for r in forced} == {"split not found"}
