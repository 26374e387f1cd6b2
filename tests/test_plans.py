"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from corpusforge.functions import rewards as R
from corpusforge.operators import chat as T
from corpusforge.operators import mixing as M
from corpusforge.operators import profiling as P
from corpusforge.operators import scoring as S
from corpusforge.sources.loading import SourceSpec, load_source

DOCS = "/root/testdata/sf0.001/documents.parquet"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def docs(spark):
    return spark.read.parquet(DOCS)


def test_scoring_does_not_shuffle_and_reads_only_its_columns(docs):
    df = S.score(docs, ["zhtw_purity", "no_repetition", "format_boxed"], completion="text").select("doc_id", "reward")
    text = plan(df)
    assert "Exchange" not in text and "Python" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_measures_are_computed_once(docs):
    df = S.score(docs, ["zhtw_purity", "no_repetition"], completion="text").select("reward")
    # The CJK characters of a text feed two rewards, but one regex finds them.
    assert plan(df).count("[^一-鿿]++") == 1


def test_unused_measures_are_pruned(docs):
    text = plan(S.score(docs, ["format_boxed"], completion="text", target="source").select("reward"))
    assert "Python" not in text and "think" not in text


def test_one_udf_stage_for_answer_and_target(docs):
    text = plan(S.score(docs, ["accuracy_exact", "accuracy_math"], completion="text", target="source").select("reward"))
    assert text.count("ArrowEvalPython") == 1


def test_profiles_combine_before_they_shuffle(docs):
    text = plan(P.token_profile(docs, by=("source",)))
    assert "partial_count" in text
    # The token count is evaluated in one projection only.
    assert text.count("regexp_replace") == 1
    assert "SinglePartition" not in text


def test_mixing_neither_sorts_nor_shuffles_rows(docs):
    keyed = docs.withColumn("row_key", F.col("doc_id").cast("string")).select("row_key", "text")
    text = plan(M.mix({"a": keyed, "b": keyed.limit(20)}, {"a": 5, "b": 2}))
    mixed = text[:text.index("Union")]
    assert not re.search("Sort|Exchange|Window", mixed)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("train", "x", "t", 1)], "split string, config string, text string, n int").write.parquet(path)
    text = plan(load_source(spark, SourceSpec(path, config="x")).select("text"))
    assert "EqualTo(config,x)" in text and "EqualTo(split,train)" in text
    assert "n:int" not in text


def test_outcomes_are_counted_in_one_shuffle(docs):
    chats = docs.select(F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))).alias("messages"), "source")
    text = plan(T.survivors(chats, 512, by="source"))
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_all_rewards_fit_one_projection_chain(docs):
    text = plan(S.score(docs, sorted(R.REWARDS), completion="text", target="source").select("reward"))
    assert "Exchange" not in text and text.count("FileScan") == 1
