"""Evaluation, audits and monitoring over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusforge.functions import rewards as R
from corpusforge.functions import text as X
from corpusforge.operators import audits as A
from corpusforge.operators import evaluation as E
from corpusforge.operators import grading as GR
from corpusforge.operators import holdout as H
from corpusforge.operators import mixing as M
from corpusforge.operators import scoring as S
from corpusforge.operators import segments as G
from corpusforge.session import shared_folder
from corpusforge.streaming import monitor as W
from corpusforge.workloads import mixing as WM
from corpusforge.workloads import rewards as WR
from corpusforge.workloads import tables as D
from corpusforge.workloads import text as Q
from corpusforge.workloads.streams import stream

SPEC = WR.SPEC
CAPS = (64, 128, 256, 512, 1024, 2048, 4096)
BANDS = {"en": (0.5, 0.7), "de": (0.2, 0.4), "fr": (0.1, 0.15)}


def answers(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Completions and key from `part`: item, benchmark, run; some in prose, some blank."""
    part, k = D.read(spark, folder, "part"), F.col("p_partkey")
    letter = D._letter(k * 7 + F.col("p_size"))
    completion = (F.when(k % 11 == 0, "").when(k % 5 == 0, F.concat(F.lit("最終答案："), letter))
                  .otherwise(F.concat(F.lit("答案是 \\boxed{"), letter, F.lit("}"))))
    ids = (k.alias("item"), F.col("p_brand").alias("benchmark"), (k % 3).alias("run"))
    return part.select(*ids, completion.alias("completion")), part.select(*ids, D._letter(k).alias("answer"))


def predictions_parsed(spark: SparkSession, folder: str) -> DataFrame:
    done, _ = answers(spark, folder)
    none = F.lit("-")
    return done.select("item", F.coalesce(E.predicted_letter(F.col("completion"), "box"), none).alias("box"),
                       F.coalesce(E.predicted_letter(F.col("completion"), "pattern"), none).alias("pattern"),
                       F.coalesce(E.predicted_letter(F.col("completion"), "regex", "：([A-D])"), none).alias("regex"))


def _graded(spark: SparkSession, folder: str, by: list[str]) -> DataFrame:
    done, key = answers(spark, folder)
    read = E.extract_prediction(done).select("item", "prediction")
    return E.accuracy(read, key, ["item"], by)


def accuracy_by_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    got = _graded(spark, folder, ["benchmark"])
    return got.select("benchmark", "items", "correct", "unparsed", F.round("accuracy", 9).alias("accuracy"),
                      F.round("unparsed_share", 9).alias("unparsed_share"), F.col("alarm").cast("long").alias("alarm"))


def _repeated(spark: SparkSession, folder: str, method: str) -> DataFrame:
    """Each item answered in three runs, of which each gets other items wrong."""
    done, key = answers(spark, folder)
    k, runs = F.col("item"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("run")
    said = F.when((k * 3 + F.col("run") * 5) % 7 == 0, F.replace(F.col("completion"), F.lit("A"), F.lit("B"))).otherwise(F.col("completion"))
    done = done.drop("run").select("*", runs).withColumn("completion", said)
    read = E.extract_prediction(done, method=method).select("item", "run", "prediction")
    return E.accuracy(read, key.drop("run").select("*", runs), ["item", "run"], ["benchmark", "run"])


def repeat_stats(spark: SparkSession, folder: str) -> DataFrame:
    got = E.repeat_stats(_repeated(spark, folder, "pattern"), ["benchmark"])
    return got.select("benchmark", "runs", F.round("mean", 9).alias("mean"), F.round(F.coalesce("deviation", F.lit(-1.0)), 9).alias("deviation"))


def compare_runs(spark: SparkSession, folder: str) -> DataFrame:
    """All items read from the box only, against all items read from prose too."""
    sides = [E.repeat_stats(_repeated(spark, folder, m), ["benchmark"]) for m in ("box", "pattern")]
    got = E.compare(*sides, ["benchmark"])
    return got.select("benchmark", F.round("gap", 9).alias("gap"), "verdict")


def _marked(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Answers with stray capitals and open boxes; items with three, four or five options."""
    done, key = answers(spark, folder)
    k = F.col("item")
    said = (F.when(k % 13 == 0, F.concat(F.lit("答案是 I 或 "), F.col("completion"), F.lit(" 最終答案：C")))
            .when(k % 17 == 0, F.concat(F.lit("\\boxed{ \\boxed{{{"), F.col("completion"))).otherwise(F.col("completion")))
    letters = F.when(k % 7 == 0, F.array(*map(F.lit, "ABC"))).when(k % 3 == 0, F.array(*map(F.lit, "ABCDE"))).otherwise(F.array(*map(F.lit, "ABCD")))
    return done.select("item", said.alias("completion")), key.select("item", "benchmark", F.col("run").alias("config"), "answer", letters.alias("options"))


def answers_by_own_options(spark: SparkSession, folder: str) -> DataFrame:
    got = GR.grade(*_marked(spark, folder), ["item"])
    dash = lambda c: F.coalesce(c, F.lit("-")).alias(c)
    return got.select("item", dash("prediction"), dash("unread"), "unmatched", "correct")


def accuracy_totals(spark: SparkSession, folder: str) -> DataFrame:
    got = GR.totals(GR.grade(*_marked(spark, folder), ["item"]), ["benchmark", "config"])
    return got.select(F.coalesce("benchmark", F.lit("*")).alias("benchmark"), F.coalesce("config", F.lit(-1)).alias("config"), "level", "items", "correct",
                      "unparsed", "blank", "foreign", "unclosed", "unmatched", F.round("accuracy", 9).alias("accuracy"),
                      F.round("unparsed_share", 9).alias("unparsed_share"), F.col("alarm").cast("long").alias("alarm"))


def math_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes as answers in several spellings, graded by value."""
    part, k, n = D.read(spark, folder, "part"), F.col("p_partkey"), F.col("p_size").cast("string")
    spelled = (F.when(k % 5 == 0, F.concat(n, F.lit(".50"))).when(k % 5 == 1, F.concat(F.lit("\\frac{"), (F.col("p_size") * 2).cast("string"), F.lit("}{4}")))
               .when(k % 5 == 2, F.concat(n, F.lit(",000"))).when(k % 5 == 3, F.concat(F.lit("x+"), n)).otherwise(n))
    done = part.select(k.alias("item"), F.when(k % 11 == 0, "none").otherwise(F.concat(F.lit("so \\boxed{"), spelled, F.lit("}"))).alias("completion"))
    wanted = (F.when(k % 5 == 0, F.concat((F.col("p_size") * 2 + 1).cast("string"), F.lit("/2"))).when(k % 5 == 1, F.concat(n, F.lit("/2")))
              .when(k % 5 == 2, F.concat(n, F.lit("000"))).when(k % 5 == 3, F.concat(F.lit("X+"), n)).otherwise(F.concat(n, F.lit("1"))))
    got = GR.grade(done, part.select(k.alias("item"), wanted.alias("answer")), ["item"], "math")
    return got.select("item", F.coalesce("prediction", F.lit("-")).alias("prediction"), "correct")


def options_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    df = D.questions(spark, folder).select("p_partkey", "A", "B", "C", "D", D._letter(F.col("p_partkey")).alias("answer"))
    return E.shuffle_options(df, ["p_partkey"], run=1)


def position_bias(spark: SparkSession, folder: str) -> DataFrame:
    done, key = answers(spark, folder)
    graded = key.join(E.extract_prediction(done).select("item", "prediction"), "item")
    return E.position_bias(graded).select("letter", "predicted", "keyed", F.round("predicted_share", 9).alias("predicted_share"),
                                          F.round("keyed_share", 9).alias("keyed_share"))


def method_compare(spark: SparkSession, folder: str) -> DataFrame:
    done, key = answers(spark, folder)
    got = E.method_compare(done.select("item", "completion"), key, ["item"], ["benchmark"])
    return got.select("benchmark", "method", "items", "correct", "unparsed")


def audit_script(spark: SparkSession, folder: str) -> DataFrame:
    got = A.audit_script(D.completions(spark, folder), "completion", ["source"])
    return got.select("source", "rows", "chinese", "mixed", F.round("mean_ratio", 6).alias("mean_ratio"),
                      F.round("max_ratio", 9).alias("max_ratio"), "above")


def filter_script(spark: SparkSession, folder: str) -> DataFrame:
    kept = A.filter_script(D.completions(spark, folder), "completion", 0.08)
    return kept.groupBy("source").agg(F.count("*").alias("rows"))


def filter_script_counted(spark: SparkSession, folder: str) -> DataFrame:
    """What the filter drops by language, told by the pass that writes the rest."""
    kept, seen = A.filter_script_counted(D.completions(spark, folder), "completion", "lang", ["en", "de", "fr"], 0.08)
    kept.write.parquet(shared_folder(spark, "kept"))
    rows = [(lang, n, seen.get["dropped"][lang]) for lang, n in seen.get["kept"].items()]
    return spark.createDataFrame(rows, "lang string, kept long, dropped long")


def audit_english(spark: SparkSession, folder: str) -> DataFrame:
    got = A.audit_english(D.completions(spark, folder), "completion", ["source"])
    return got.select("source", "rows", "judged", "low", F.round("mean_score", 6).alias("mean_score"))


def zero_signal_groups(spark: SparkSession, folder: str) -> DataFrame:
    scored = S.score(D.completions(spark, folder), ["format_boxed"])
    got = A.zero_signal_groups(scored.withColumn("prompt_id", F.floor(F.col("doc_id") / 3)), "prompt_id", "format_boxed")
    return got.select("prompt_id", "completions", "lowest", "highest", F.col("no_signal").cast("long").alias("no_signal"),
                      F.col("too_small").cast("long").alias("too_small"))


def clipped_ratio(spark: SparkSession, folder: str) -> DataFrame:
    df = D.completions(spark, folder).withColumn("step", F.col("doc_id") % 10)
    got = A.clipped_ratio(df, X.token_estimate("completion"), 512, ["source", "step"])
    return got.select("source", "step", "completions", F.round("ratio", 9).alias("ratio"), F.col("warn").cast("long").alias("warn"))


def cap_advice(spark: SparkSession, folder: str) -> DataFrame:
    got = A.cap_advice(D.completions(spark, folder), X.token_estimate("completion"), CAPS)
    return got.select(F.col("cap").cast("long").alias("cap"), "answers", "cut", F.round("cut_share", 9).alias("cut_share"),
                      F.col("advised").cast("long").alias("advised"))


def weight_balance(spark: SparkSession, folder: str) -> DataFrame:
    scored = S.score(D.completions(spark, folder), SPEC, prompt="prompt", target="target")
    got = A.weight_balance(scored, SPEC)
    return got.select("reward", "weight", "judged", F.round("contribution", 4).alias("contribution"), F.round("share", 6).alias("share"),
                      F.round(F.coalesce("correlation", F.lit(-9.0)), 6).alias("correlation"), "verdict")


def masked_rewards(spark: SparkSession, folder: str) -> DataFrame:
    """What is learned from at each step once completions at the cap are masked."""
    scored = S.score(D.completions(spark, folder), ["format_boxed"]).withColumn("step", F.col("doc_id") % 10)
    got = A.clipped_ratio(scored, X.token_estimate("completion"), 512, ["step"], reward="format_boxed")
    return got.select("step", "completions", F.round("ratio", 9).alias("ratio"), "rewarded", F.round("mean_reward", 9).alias("mean_reward"),
                      F.col("warn").cast("long").alias("warn"))


def tool_balance(spark: SparkSession, folder: str) -> DataFrame:
    got = A.tool_balance(D.read(spark, folder, "documents"), F.col("lang") == "fr")
    return got.select("general", "tool", F.round("general_per_tool", 9).alias("general_per_tool"), "verdict")


def _shares(spark: SparkSession, folder: str) -> DataFrame:
    mixed = M.mix(WM._by_language(spark, folder), WM.WEIGHTS, WM.SEED)
    return A.mix_shares(mixed, X.token_estimate("text"), WM.WEIGHTS, copies="copy")


def mix_shares(spark: SparkSession, folder: str) -> DataFrame:
    return _shares(spark, folder).select("source", "rows", "tokens", "epochs", F.round("share", 9).alias("share"),
                                         F.round("wanted_share", 9).alias("wanted_share"))


def replay_check(spark: SparkSession, folder: str) -> DataFrame:
    return A.replay_check(_shares(spark, folder), BANDS).select("source", "verdict")


def stage_advice(spark: SparkSession, folder: str) -> DataFrame:
    mixed = M.mix(WM._by_language(spark, folder), WM.WEIGHTS, WM.SEED)
    got = A.stage_advice(mixed, X.token_estimate("text"), ["de"], least=1_000_000_000)
    return got.select("source", "rows", "tokens", "own_tokens", F.round("epochs", 9).alias("epochs"), "advice")


def preference_profile(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.completions(spark, folder).select("prompt", F.col("completion").alias("chosen"), F.col("target").alias("rejected"))
    return A.preference_profile(docs)


def _contained(spark: SparkSession, folder: str) -> DataFrame:
    return A.holdout_pairs(D.read(spark, folder, "documents"), D.read(spark, folder, "benchmark"), "doc_id", "item_id")


def holdout_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return _contained(spark, folder).withColumn("share", F.round("share", 9))


def holdout(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.read(spark, folder, "documents")
    return A.holdout(docs, _contained(spark, folder), "doc_id").select("doc_id", "source")


def _chinese(spark: SparkSession, folder: str, table: str, key: str) -> DataFrame:
    df = D.read(spark, folder, table)
    return df.select(key, D.chinese(F.col("text")).alias("text"))


def holdout_chinese(spark: SparkSession, folder: str) -> DataFrame:
    """Chinese passages inside longer texts, between words of other scripts."""
    found = H.holdout_pairs(_chinese(spark, folder, "documents", "doc_id"), _chinese(spark, folder, "benchmark", "item_id"), "doc_id", "item_id")
    return found.withColumn("share", F.round("share", 9))


def holdout_equal(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose whole text another document has."""
    docs = _chinese(spark, folder, "documents", "doc_id")
    return H.equal_pairs(docs, docs, "doc_id", "doc_id").toDF("doc_id", "item_id").filter("doc_id <> item_id")


def pack_segments(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.read(spark, folder, "documents")
    return A.pack_segments(docs, "doc_id", X.token_estimate("text"), 1024, shards=16)


def pack_whole(spark: SparkSession, folder: str) -> DataFrame:
    """All texts as one sequence, worked out in many blocks; every text comes twice, as in a mix with copies."""
    docs = D.read(spark, folder, "documents").select("doc_id", "text")
    return G.pack_segments(docs.unionAll(docs), "doc_id", X.token_estimate("text"), 2048, blocks=64).drop("shard")


def _metric(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_type").alias("run_id"), "ts", "value")


def _symptoms(df: DataFrame) -> DataFrame:
    return df.select("run_id", F.unix_seconds("start").alias("start"), "rows", F.round("mean", 6).alias("mean"), "lowest", "highest", "symptom")


def metric_windows(spark: SparkSession, folder: str) -> DataFrame:
    return _symptoms(W.metric_windows(_metric(D.read(spark, folder, "events")), "1 day"))


def metric_windows_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The windows that the watermark has passed when the stream has read all."""
    out, checkpoint = shared_folder(spark, "windows"), shared_folder(spark, "windows-checkpoint")
    windows = W.metric_windows(_metric(stream(spark, folder, "events")), "1 day")
    (windows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return _symptoms(spark.read.schema(windows.schema).parquet(out))


def _metrics(events: DataFrame) -> DataFrame:
    """events as a training log of five runs with several metrics."""
    kind, value = F.col("event_type"), F.col("value")
    metric = (F.when(kind == "view", "loss").when(kind == "click", "completions/clipped_ratio").when(kind == "signup", "mean_token_accuracy").otherwise(kind))
    scaled = F.when(kind == "click", value / 70).when(kind == "signup", 1 - value / 300).otherwise(value)
    return events.select((F.col("user_id") % 5).cast("string").alias("run_id"), metric.alias("metric"), "ts", scaled.alias("value"))


def _trends(df: DataFrame) -> DataFrame:
    return df.select("run_id", "metric", F.unix_seconds("start").alias("start"), "rows", "broken", *[F.round(c, 9).alias(c) for c in ("mean", "lowest", "highest")],
                     "symptom", "lasted", F.col("persistent").cast("long").alias("persistent"))


def metric_trends(spark: SparkSession, folder: str) -> DataFrame:
    return _trends(W.metric_trends_batch(_metrics(D.read(spark, folder, "events")), "12 hours", 2))


def metric_trends_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams in a row: windows that the watermark has passed, and their trends."""
    def run(df: DataFrame, purpose: str) -> str:
        out = shared_folder(spark, purpose)
        (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", shared_folder(spark, f"{purpose}-checkpoint"))
         .outputMode("append").trigger(availableNow=True).start().awaitTermination())
        return out

    measures = W.metric_measures(_metrics(stream(spark, folder, "events")), "12 hours")
    windows = spark.readStream.schema(measures.schema).parquet(run(measures, "measures"))
    found = W.metric_trends(windows, persistent=2)
    return _trends(spark.read.schema(found.schema).parquet(run(found, "trends")))


QUERIES = {f.__name__: f for f in (
    predictions_parsed, accuracy_by_benchmark, repeat_stats, compare_runs, options_shuffled, position_bias, method_compare,
    answers_by_own_options, accuracy_totals, math_answers, audit_script, filter_script, filter_script_counted, audit_english, masked_rewards, tool_balance, zero_signal_groups, clipped_ratio, cap_advice, weight_balance, mix_shares,
    replay_check, stage_advice, preference_profile, holdout_pairs, holdout, holdout_chinese, holdout_equal, pack_segments, pack_whole, metric_windows, metric_windows_stream, metric_trends,
    metric_trends_stream)}

_L = D._sql_letter("p_partkey * 7 + p_size")
_ANSWERS = ("answers AS (SELECT p_partkey AS item, p_brand AS benchmark, p_partkey % 3 AS run, "
            f"{D._sql_letter('p_partkey')} AS answer, CASE WHEN p_partkey % 11 = 0 THEN '' WHEN p_partkey % 5 = 0 THEN '最終答案：' || {_L} "
            f"ELSE '答案是 \\boxed{{' || {_L} || '}}' END AS completion FROM part), "
            "reads AS (SELECT *, nullif(regexp_extract(completion, 'boxed\\{([A-J])', 1), '') AS box, "
            "nullif(regexp_extract(completion, '：([A-J])', 1), '') AS said FROM answers), "
            "p AS (SELECT *, coalesce(box, said) AS prediction, (coalesce(box, said) IS NOT DISTINCT FROM answer)::bigint AS hit FROM reads)")
_SAID = "CASE WHEN (item * 3 + r * 5) % 7 = 0 THEN replace(completion, 'A', 'B') ELSE completion END"
_REPEATED = (f"c AS (SELECT item, benchmark, r, answer, {_SAID} AS said FROM answers, range(3) t(r)), "
             "g AS (SELECT *, nullif(regexp_extract(said, 'boxed\\{([A-J])', 1), '') AS box, nullif(regexp_extract(said, '：([A-J])', 1), '') AS prose FROM c)")


def _sql_stats(prediction: str) -> str:
    runs = f"SELECT benchmark, r, avg((({prediction}) IS NOT DISTINCT FROM answer)::bigint) AS accuracy FROM g GROUP BY benchmark, r"
    return f"(SELECT benchmark, count(*) AS runs, avg(accuracy) AS mean, stddev_samp(accuracy) AS deviation FROM ({runs}) GROUP BY benchmark)"


_OWN = ("o AS (SELECT item, benchmark, run AS config, answer, CASE WHEN item % 13 = 0 THEN '答案是 I 或 ' || completion || ' 最終答案：C' WHEN item % 17 = 0 THEN "
        "'\\boxed{ \\boxed{{{' || completion ELSE completion END AS said, CASE WHEN item % 7 = 0 THEN 'ABC' WHEN item % 3 = 0 THEN 'ABCDE' ELSE 'ABCD' END AS options FROM answers), "
        "q AS (SELECT *, regexp_extract_all(said, '\\\\boxed\\{([^{}]*(?:\\{[^{}]*\\}[^{}]*)*)\\}', 1) AS boxes FROM o), "
        "l AS (SELECT *, list_concat(regexp_extract_all(coalesce(boxes[-1], ''), '^([A-Z])', 1), regexp_extract_all(said, '答案\\s*(?:是|為)?\\s*[：:]?\\s*([A-Z])', 1)) AS letters FROM q), "
        "h AS (SELECT *, list_filter(letters, lambda x: contains(options, x))[1] AS prediction, greatest((length(said) - length(replace(said, '\\boxed{', ''))) // 7 - len(boxes), 0)::bigint "
        "AS unmatched FROM l), z AS (SELECT *, CASE WHEN prediction IS NOT NULL THEN NULL WHEN trim(said) = '' THEN 'blank' WHEN len(letters) > 0 THEN 'not an option' "
        "WHEN unmatched > 0 THEN 'unmatched box' ELSE 'no answer' END AS unread, coalesce(prediction = answer, false) AS correct FROM h)")
_MATH = ("SELECT p_partkey AS item, CASE WHEN p_partkey % 11 = 0 THEN '-' WHEN p_partkey % 5 = 0 THEN (2 * p_size + 1) || '/2' WHEN p_partkey % 5 = 1 THEN "
         "CASE WHEN p_size % 2 = 0 THEN (p_size // 2) || '/1' ELSE p_size || '/2' END WHEN p_partkey % 5 = 2 THEN p_size || '000/1' WHEN p_partkey % 5 = 3 THEN 'x+' || p_size "
         "ELSE p_size || '/1' END AS prediction, p_partkey % 11 <> 0 AND p_partkey % 5 <> 4 AS correct FROM part")
_RATIO = f"{Q.sql_simplified('cjk')}::double / nullif(length(cjk), 0)"
_CJK = f"{D.COMPLETIONS}, c AS (SELECT *, {Q.sql_cjk('completion')} AS cjk FROM completions), r AS (SELECT *, {_RATIO} AS ratio FROM c)"
_TOKENS = f"{D.COMPLETIONS}, k AS (SELECT doc_id, source, {Q.sql_tokens('completion')} AS tokens FROM completions)"
_MIXED = (f"{WM.sql_mix(WM._LANGS, WM.WEIGHTS)}, s AS (SELECT source, count(*) AS rows, sum({Q.sql_tokens('text')})::bigint AS tokens, "
          "max(copy) AS epochs FROM mixed GROUP BY source), sh AS (SELECT *, tokens::double / sum(tokens) OVER () AS share FROM s)")
_WHOLE = float(sum(WM.WEIGHTS.values()))
_WORDS = "string_split(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), ' ')"
_GRAMS = ("list_distinct(list_transform(range(1, greatest(len(w) - 7, 1) + 1), lambda i: array_to_string(w[i:i + 7], ' ')))")
_HELD = (f"d AS (SELECT doc_id, source, unnest({_GRAMS}) AS g FROM (SELECT doc_id, source, {_WORDS} AS w FROM documents)), "
         f"b AS (SELECT item_id, len(gs) AS needed, unnest(gs) AS g FROM (SELECT item_id, {_GRAMS} AS gs FROM (SELECT item_id, {_WORDS} AS w FROM benchmark))), "
         "h AS (SELECT doc_id, item_id, count(*)::double / any_value(needed) AS share FROM d JOIN b USING (g) GROUP BY doc_id, item_id "
         "HAVING count(*) >= 0.8 * any_value(needed))")
_MARKS = r"[^\p{L}\p{N} ]+"


def _sql_units(text: str) -> str:
    """The units of a text, as a list."""
    u = f"[{H.UNSPACED}]"
    e = f"trim(regexp_replace(lower({text}), '\\s+', ' ', 'g'))"
    e = f"regexp_replace({e}, '({u}){_MARKS}', '\\1 ', 'g')"
    e = f"regexp_replace({e}, '{_MARKS}({u})', ' \\1', 'g')"
    return f"string_split(trim(regexp_replace(regexp_replace({e}, '({u})', ' \\1 ', 'g'), ' +', ' ', 'g')), ' ')"


def _sql_grams(table: str, key: str) -> str:
    """(key, r, g): the grams of each row r."""
    weight = f"CASE WHEN regexp_full_match(u, '[{H.UNSPACED}]') THEN 8 ELSE 13 END"
    return (f"(SELECT DISTINCT {key}, r, CASE WHEN total < 104 THEN array_to_string(us, ' ') ELSE array_to_string(us[1:list_filter(range(1, 14), "
            f"lambda k: k <= len(ws) AND list_sum(ws[1:k]) >= 104)[1]], ' ') END AS g FROM (SELECT {key}, r, i, list(u) OVER f AS us, list(w) OVER f AS ws, "
            f"sum(w) OVER (PARTITION BY r) AS total FROM (SELECT *, {weight} AS w FROM (SELECT {key}, row_number() OVER () AS r, generate_subscripts(u, 1) AS i, unnest(u) AS u "
            f"FROM (SELECT {key}, {_sql_units(D._ZH)} AS u FROM {table}))) WINDOW f AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)) "
            "WHERE total >= 104 OR i = 1)")


_DRAWN = ("list_sort([{" + "}, {".join(f"'absent': {o} IS NULL, 'o': md5('42|1|' || p_partkey || '|{o}'), 'l': '{o}', 't': {o}" for o in "ABCD") + "}])")
_DAY = ("SELECT event_type AS run_id, (epoch(time_bucket(INTERVAL 1 DAY, ts)))::bigint AS start, count(*) AS rows, round(avg(value), 6) AS mean, "
        "min(value) AS lowest, max(value) AS highest, CASE WHEN min(value) > 0.3 THEN 'persistently high' WHEN max(value) = 0 THEN 'flat at zero' "
        "WHEN max(value) > 3 * avg(value) THEN 'spike' ELSE 'none' END AS symptom FROM events WHERE value IS NOT NULL GROUP BY 1, 2")
_TRENDS = ("e AS (SELECT (user_id % 5)::varchar AS run_id, CASE event_type WHEN 'view' THEN 'loss' WHEN 'click' THEN 'completions/clipped_ratio' "
           "WHEN 'signup' THEN 'mean_token_accuracy' ELSE event_type END AS metric, ts, CASE event_type WHEN 'click' THEN value / 70 "
           "WHEN 'signup' THEN 1 - value / 300 ELSE value END AS value FROM events WHERE value IS NOT NULL), "
           "w AS (SELECT run_id, metric, (floor(epoch(ts) / 43200) * 43200)::bigint AS start, count(*) AS rows, count(*) FILTER (NOT isfinite(value)) AS broken, "
           "avg(value) FILTER (isfinite(value)) AS mean, min(value) FILTER (isfinite(value)) AS lowest, max(value) FILTER (isfinite(value)) AS highest FROM e GROUP BY ALL), "
           "f AS (SELECT *, lag(start) OVER o = start - 43200 AS follows, lag(mean) OVER o AS mean_before FROM w WINDOW o AS (PARTITION BY run_id, metric ORDER BY start)), "
           "s AS (SELECT *, CASE WHEN metric NOT IN ('loss', 'completions/clipped_ratio', 'mean_token_accuracy') THEN 'none' WHEN broken > 0 THEN 'not a number' "
           "WHEN metric = 'completions/clipped_ratio' AND mean > 0.3 THEN 'answers cut off' WHEN metric = 'mean_token_accuracy' AND mean > 0.95 THEN 'memorizing' "
           "WHEN metric = 'loss' AND highest < 0.01 THEN 'near zero' WHEN metric = 'loss' AND (highest > 3 * mean OR (follows AND mean > 3 * mean_before)) THEN 'spike' "
           "WHEN metric = 'loss' AND rows > 1 AND lowest = highest THEN 'flat' ELSE 'none' END AS symptom FROM f), "
           "i AS (SELECT *, sum(CASE WHEN follows AND symptom_before = symptom THEN 0 ELSE 1 END) OVER (PARTITION BY run_id, metric ORDER BY start) AS island "
           "FROM (SELECT *, lag(symptom) OVER (PARTITION BY run_id, metric ORDER BY start) AS symptom_before FROM s)), "
           "t AS (SELECT run_id, metric, start, rows, broken, round(mean, 9) AS mean, round(lowest, 9) AS lowest, round(highest, 9) AS highest, symptom, "
           "row_number() OVER (PARTITION BY run_id, metric, island ORDER BY start) AS lasted FROM i) "
           "SELECT *, (symptom <> 'none' AND lasted >= 2)::bigint AS persistent FROM t")
SQL = {
    "predictions_parsed": f"WITH {_ANSWERS} SELECT item, coalesce(box, '-') AS box, coalesce(box, said, '-') AS pattern, coalesce(said, '-') AS regex FROM reads",
    "accuracy_by_benchmark": f"WITH {_ANSWERS} SELECT benchmark, count(*) AS items, sum(hit)::bigint AS correct, count(*) FILTER (prediction IS NULL) AS unparsed, "
                             "round(avg(hit), 9) AS accuracy, round(count(*) FILTER (prediction IS NULL)::double / count(*), 9) AS unparsed_share, "
                             "(count(*) FILTER (prediction IS NULL)::double / count(*) > 0.2)::bigint AS alarm FROM p GROUP BY benchmark",
    "repeat_stats": f"WITH {_ANSWERS}, {_REPEATED} SELECT benchmark, runs, round(mean, 9) AS mean, round(coalesce(deviation, -1), 9) AS deviation "
                    f"FROM {_sql_stats('coalesce(box, prose)')}",
    "compare_runs": f"WITH {_ANSWERS}, {_REPEATED} SELECT benchmark, round(y.mean - x.mean, 9) AS gap, CASE WHEN abs(y.mean - x.mean) <= coalesce(greatest(x.deviation, y.deviation), 0) "
                    f"THEN 'within deviation' WHEN y.mean > x.mean THEN 'better' ELSE 'worse' END AS verdict FROM {_sql_stats('box')} x JOIN {_sql_stats('coalesce(box, prose)')} y USING (benchmark)",
    "answers_by_own_options": f"WITH {_ANSWERS}, {_OWN} SELECT item, coalesce(prediction, '-') AS prediction, coalesce(unread, '-') AS unread, unmatched, correct FROM z",
    "accuracy_totals": f"WITH {_ANSWERS}, {_OWN} SELECT coalesce(benchmark, '*') AS benchmark, coalesce(config, -1) AS config, (grouping(benchmark) + grouping(config))::bigint AS level, "
                       "count(*) AS items, count(*) FILTER (correct) AS correct, count(*) FILTER (prediction IS NULL) AS unparsed, count(*) FILTER (unread = 'blank') AS blank, "
                       "count(*) FILTER (unread = 'not an option') AS \"foreign\", count(*) FILTER (unread = 'unmatched box') AS unclosed, sum(unmatched)::bigint AS unmatched, "
                       "round(count(*) FILTER (correct)::double / count(*), 9) AS accuracy, round(count(*) FILTER (prediction IS NULL)::double / count(*), 9) AS unparsed_share, "
                       "(count(*) FILTER (prediction IS NULL)::double / count(*) > 0.2)::bigint AS alarm FROM z GROUP BY ROLLUP (benchmark, config)",
    "math_answers": _MATH,
    "options_shuffled": f"WITH {D.QUESTIONS}, q AS (SELECT *, {_DRAWN} AS s, {D._sql_letter('p_partkey')} AS wanted FROM questions) SELECT p_partkey, s[1].t AS A, s[2].t AS B, "
                        "s[3].t AS C, s[4].t AS D, substr('ABCD', list_position(list_transform(s, lambda x: x.l), wanted)::int, 1) AS answer FROM q",
    "position_bias": f"WITH {_ANSWERS}, u AS (SELECT prediction AS letter, 1 AS p, 0 AS k FROM p UNION ALL SELECT answer, 0, 1 FROM p), g AS (SELECT letter, "
                     "sum(p)::bigint AS predicted, sum(k)::bigint AS keyed FROM u WHERE letter IS NOT NULL GROUP BY letter) SELECT *, "
                     "round(predicted::double / sum(predicted) OVER (), 9) AS predicted_share, round(keyed::double / sum(keyed) OVER (), 9) AS keyed_share FROM g",
    "method_compare": f"WITH {_ANSWERS}, u AS (SELECT benchmark, answer, 'box' AS method, box AS x FROM reads UNION ALL SELECT benchmark, answer, 'pattern', coalesce(box, said) "
                      "FROM reads) SELECT benchmark, method, count(*) AS items, count(*) FILTER (x = answer) AS correct, count(*) FILTER (x IS NULL) AS unparsed FROM u GROUP BY ALL",
    "audit_script": f"WITH {_CJK} SELECT source, count(*) AS rows, count(ratio) AS chinese, count(*) FILTER (ratio > 0) AS mixed, round(avg(ratio), 6) AS mean_ratio, "
                    "round(max(ratio), 9) AS max_ratio, count(*) FILTER (ratio > 0.01) AS above FROM r GROUP BY source",
    "filter_script": f"WITH {_CJK} SELECT source, count(*) AS rows FROM r WHERE coalesce(ratio, 0) <= 0.08 GROUP BY source",
    "filter_script_counted": f"WITH {_CJK}, n(lang) AS (VALUES ('en'), ('de'), ('fr'), ('')), x AS (SELECT CASE WHEN lang IN ('en', 'de', 'fr') THEN lang ELSE '' END AS lang, "
                             "coalesce(ratio, 0) > 0.08 AS dropped FROM r) SELECT n.lang, count(*) FILTER (NOT dropped) AS kept, count(*) FILTER (dropped) AS dropped FROM n LEFT JOIN x USING (lang) GROUP BY n.lang",
    "masked_rewards": f"WITH {WR._BASE}, e AS (SELECT doc_id % 10 AS step, {WR._score('format_boxed')} AS x, {Q.sql_tokens('completion')} >= 512 AS cut FROM m) SELECT step, count(*) AS completions, "
                      "round(avg(cut::int), 9) AS ratio, count(x) FILTER (NOT cut) AS rewarded, round(avg(x) FILTER (NOT cut), 9) AS mean_reward, (avg(cut::int) > 0.3)::bigint AS warn FROM e GROUP BY step",
    "tool_balance": "SELECT *, CASE WHEN general_per_tool < 2 THEN 'too few general rows' WHEN general_per_tool > 3 THEN 'too few tool rows' ELSE 'inside' END AS verdict FROM "
                    "(SELECT count(*) FILTER (lang <> 'fr') AS general, count(*) FILTER (lang = 'fr') AS tool, round(count(*) FILTER (lang <> 'fr')::double / count(*) FILTER (lang = 'fr'), 9) AS general_per_tool FROM documents)",
    "audit_english": f"WITH {WR._BASE}, e AS (SELECT source, CASE WHEN prose_cjk = 0 AND prose_latin = 0 THEN NULL WHEN prose_cjk = 0 THEN 0.0 "
                     "ELSE greatest(0.0, 1.0 - greatest(0, prose_latin - 3)::double / 20.0) END::double AS x FROM m) SELECT source, count(*) AS rows, "
                     "count(x) AS judged, count(*) FILTER (x < 1) AS low, round(avg(x), 6) AS mean_score FROM e GROUP BY source",
    "zero_signal_groups": f"WITH {WR._BASE}, e AS (SELECT doc_id // 3 AS prompt_id, {WR._score('format_boxed')} AS x FROM m) SELECT prompt_id, count(*) AS completions, "
                          "min(x) AS lowest, max(x) AS highest, (min(x) = max(x))::bigint AS no_signal, (count(*) < 4)::bigint AS too_small FROM e GROUP BY prompt_id",
    "clipped_ratio": f"WITH {_TOKENS} SELECT source, doc_id % 10 AS step, count(*) AS completions, round(avg((tokens >= 512)::int), 9) AS ratio, "
                     "(avg((tokens >= 512)::int) > 0.3)::bigint AS warn FROM k GROUP BY ALL",
    "cap_advice": f"WITH {_TOKENS}, c(cap) AS (VALUES {', '.join(f'({c})' for c in CAPS)}), t AS (SELECT cap::bigint AS cap, count(*) AS answers, "
                  "count(*) FILTER (tokens > cap) AS cut FROM k, c GROUP BY cap) SELECT cap, answers, cut, round(cut::double / answers, 9) AS cut_share, "
                  "(cap IS NOT DISTINCT FROM (SELECT min(cap) FROM t WHERE cut < answers - floor(answers * 0.99::double)))::bigint AS advised FROM t",
    "weight_balance": f"WITH {WR._COMPOSED}, w AS (" + " UNION ALL ".join(
        f"SELECT '{s['name']}' AS reward, {s['weight']}::double AS weight, {s['name'] in R.CORRECTNESS} AS decisive, count({s['name']}) AS judged, sum({s['weight']}::double * {s['name']}) AS x, "
        f"CASE WHEN stddev_pop({s['name']}) > 1e-12 AND stddev_pop(CASE WHEN {s['name']} IS NOT NULL THEN reward END) > 1e-12 THEN corr({s['name']}, reward) END AS c FROM composed" for s in SPEC)
        + ") SELECT reward, weight, judged, round(x, 4) AS contribution, round(abs(x) / sum(abs(x)) OVER (), 6) AS share, round(coalesce(c, -9), 6) AS correlation, "
        "CASE WHEN decisive THEN CASE WHEN weight > " + str(float(sum(s["weight"] for s in SPEC if s["name"] not in R.CORRECTNESS))) + " THEN 'dominates' ELSE 'outweighed' END "
        "WHEN c > max(c) FILTER (decisive) OVER () THEN 'stronger than correctness' ELSE 'shaping' END AS verdict FROM w",
    "mix_shares": f"WITH {_MIXED} SELECT source, rows, tokens, epochs, round(share, 9) AS share, round(CASE source "
                  + " ".join(f"WHEN '{s}' THEN {w / _WHOLE!r}" for s, w in WM.WEIGHTS.items()) + " END::double, 9) AS wanted_share FROM sh",
    "replay_check": f"WITH {_MIXED} SELECT source, CASE " + " ".join(
        f"WHEN source = '{s}' THEN CASE WHEN share < {a} THEN 'below' WHEN share > {b} THEN 'above' ELSE 'inside' END" for s, (a, b) in BANDS.items())
        + " ELSE 'no band' END AS verdict FROM sh",
    "stage_advice": f"WITH {WM.sql_mix(WM._LANGS, WM.WEIGHTS)}, t AS (SELECT source, copy, {Q.sql_tokens('text')}::bigint AS n FROM mixed), s AS (SELECT source, count(*) AS rows, "
                    "sum(n)::bigint AS tokens, (sum(n) FILTER (copy = 1))::bigint AS own_tokens FROM t GROUP BY source) SELECT *, round(tokens::double / own_tokens, 9) AS epochs, "
                    "CASE WHEN source = 'de' THEN 'too little text for this stage' WHEN tokens > own_tokens THEN 'memorizes' ELSE 'fits' END AS advice FROM s",
    "preference_profile": f"WITH {D.COMPLETIONS}, s AS (SELECT {Q.sql_tokens('prompt')} AS p, {Q.sql_tokens('completion')} AS c, {Q.sql_tokens('target')} AS r FROM completions), "
                          "u AS (SELECT 'prompt' AS part, p AS v FROM s UNION ALL SELECT 'chosen', c FROM s UNION ALL SELECT 'rejected', r FROM s UNION ALL "
                          "SELECT 'prompt and longer answer', p + greatest(c, r) FROM s), n AS (SELECT part, v, row_number() OVER (PARTITION BY part ORDER BY v) - 1 AS i, "
                          "count(*) OVER (PARTITION BY part) AS n FROM u) SELECT part, any_value(n) AS n, min(v)::bigint AS min, "
                          "min(v) FILTER (i = least(n - 1, floor(n * 0.99::double)))::bigint AS percentile, max(v)::bigint AS max FROM n GROUP BY part",
    "holdout_pairs": f"WITH {_HELD} SELECT doc_id, item_id, round(share, 9) AS share FROM h",
    "holdout": f"WITH {_HELD} SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM h)",
    "holdout_chinese": f"WITH d AS (SELECT * FROM {_sql_grams('documents', 'doc_id')} WHERE g IS NOT NULL), b AS (SELECT *, count(*) OVER (PARTITION BY r) AS needed "
                       f"FROM {_sql_grams('benchmark', 'item_id')} WHERE g IS NOT NULL) SELECT doc_id, item_id, round(count(*)::double / any_value(needed), 9) AS share "
                       "FROM d JOIN b USING (g) GROUP BY doc_id, d.r, item_id, b.r HAVING count(*) >= 0.8 * any_value(needed)",
    "holdout_equal": f"WITH t AS (SELECT doc_id, array_to_string({_sql_units(D._ZH)}, ' ') AS t FROM documents) SELECT a.doc_id, b.doc_id AS item_id FROM t a JOIN t b USING (t) "
                     "WHERE a.doc_id <> b.doc_id",
    "pack_segments": f"WITH t AS (SELECT doc_id, {Q.sql_tokens('text')}::bigint AS n, md5('42|' || doc_id) AS o FROM documents), "
                     "s AS (SELECT *, ('0x' || o[1:8])::bigint % 16 AS shard FROM t WHERE n > 0), f AS (SELECT *, (sum(n) OVER (PARTITION BY shard ORDER BY o, doc_id) - n)::bigint AS first FROM s), "
                     "c AS (SELECT *, unnest(range(first // 1024, (first + n - 1) // 1024 + 1)) AS pack FROM f) SELECT shard, pack, doc_id, "
                     "greatest(pack * 1024 - first, 0) AS start, least((pack + 1) * 1024 - first, n) AS \"end\" FROM c",
    "pack_whole": f"WITH d AS (SELECT doc_id, {Q.sql_tokens('text')}::bigint AS n, md5('42|' || doc_id) AS o FROM documents), t AS (SELECT * FROM d WHERE n > 0 UNION ALL "
                  "SELECT * FROM d WHERE n > 0), f AS (SELECT *, (sum(n) OVER (ORDER BY o, doc_id, n ROWS UNBOUNDED PRECEDING) - n)::bigint AS first FROM t), "
                  "c AS (SELECT *, unnest(range(first // 2048, (first + n - 1) // 2048 + 1)) AS pack FROM f) SELECT pack, doc_id, "
                  "greatest(pack * 2048 - first, 0) AS start, least((pack + 1) * 2048 - first, n) AS \"end\" FROM c",
    "metric_windows": _DAY,
    "metric_trends": f"WITH {_TRENDS}",
    "metric_trends_stream": f"SELECT * FROM (WITH {_TRENDS}) WHERE start + 43200 <= (SELECT epoch(max(ts)) - 600 FROM events WHERE value IS NOT NULL)",
    "metric_windows_stream": f"SELECT * FROM ({_DAY}) WHERE start + 86400 <= (SELECT epoch(max(ts)) - 600 FROM events WHERE value IS NOT NULL)",
}
