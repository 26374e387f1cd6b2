"""Every reward over all completions, their composition and the score matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusforge.functions import rewards as R
from corpusforge.operators import scoring as S
from corpusforge.workloads import tables as D
from corpusforge.workloads import text as Q

SPEC = (
    {"name": "accuracy_math", "weight": 2.5},
    {"name": "accuracy_mcq", "weight": 0.75},
    {"name": "format_boxed", "weight": 0.25},
    {"name": "zhtw_purity", "weight": 0.8},
    {"name": "no_english_drift", "weight": 0.4},
    {"name": "no_repetition", "weight": 0.35},
)


MENTIONS_ANSWER = R.Reward(
    "mentions_answer", "A reward of the caller's own: the completion announces its answer",
    lambda s: F.when(s.measure("text").contains("答案"), 1.0).otherwise(0.0))


def _one(name: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        spec = [{"name": name, "target_length": 900}] if name == "length_target" else [name]
        scored = S.score(D.completions(spark, folder), spec, prompt="prompt", target="target")
        return scored.select("doc_id", F.round(name, 9).alias("score"))
    return query


def composed(spark: SparkSession, folder: str) -> DataFrame:
    scored = S.score(D.completions(spark, folder), SPEC, prompt="prompt", target="target")
    return scored.select("doc_id", F.round("reward", 9).alias("reward"),
                         F.col("rewards_applied").cast("long").alias("rewards_applied"))


def matrix(spark: SparkSession, folder: str) -> DataFrame:
    scores = S.score_matrix(D.completions(spark, folder), ["doc_id"], prompt="prompt", target="target")
    return scores.select("doc_id", "reward", F.round("score", 9).alias("score"))


def quality_by_language(spark: SparkSession, folder: str) -> DataFrame:
    """Flagship: composed reward and its parts per language and source."""
    scored = S.score(D.completions(spark, folder), SPEC, prompt="prompt", target="target")
    return scored.groupBy("lang", "source").agg(
        F.count("*").alias("completions"), F.round(F.avg("reward"), 6).alias("reward"),
        F.count("zhtw_purity").alias("judged_for_purity"),
        F.round(F.avg("zhtw_purity"), 6).alias("purity"),
        F.round(F.avg("accuracy_math"), 6).alias("accuracy"))


def custom_reward(spark: SparkSession, folder: str) -> DataFrame:
    spec = [MENTIONS_ANSWER, {"name": "format_boxed", "weight": 0.25}]
    scored = S.score(D.completions(spark, folder), spec)
    return scored.groupBy("lang").agg(F.count("*").alias("completions"), F.round(F.avg("reward"), 6).alias("reward"))


def rational_values(spark: SparkSession, folder: str) -> DataFrame:
    """The numeric reading of answers in several spellings."""
    n = F.col("n_chars").cast("string")
    spelled = F.array(n, F.concat(F.lit("-"), n), F.concat(n, F.lit(".250")), F.concat(n, F.lit("/4")),
                      F.concat(F.lit("\\frac{"), n, F.lit("}{8}")), F.concat(n, F.lit(" \\frac{1}{2}")),
                      F.concat(n, F.lit("/0")), F.concat(F.lit("x"), n))
    df = D.read(spark, folder, "documents").select("doc_id", F.posexplode(spelled).alias("spelling", "written"))
    df = df.withColumn("plain", R.plain_number(F.col("written"))).withColumn("n", R.number_parts(F.col("plain")))
    part = lambda name: F.col(f"n.{name}").cast("double")
    value = part("sign") * (part("whole") + F.try_divide(part("num"), part("den")))
    return df.select("doc_id", F.col("spelling").cast("long").alias("spelling"),
                     F.coalesce(value, F.lit(-0.5)).alias("value"))


# --- SQL --------------------------------------------------------------------

_BASE = (f"{D.COMPLETIONS}, base AS (SELECT *, {Q.sql_cjk('completion')} AS cjk, "
         f"{Q.sql_strip_code('completion')} AS prose, {Q.sql_think('completion')} AS think, "
         f"{Q.sql_boxed('completion')} AS boxed, {Q.sql_answer('completion')} AS answer, "
         f"{Q.sql_grams('completion')} AS units, {Q.sql_norm('target')} AS target_norm FROM completions), "
         f"m AS (SELECT *, {Q.sql_norm('answer')} AS answer_norm, length({Q.sql_cjk('prose')}) AS prose_cjk, "
         f"{Q.sql_latin('prose')} AS prose_latin, length({Q.sql_cjk('prompt')}) AS prompt_cjk, "
         f"CASE WHEN len(units) >= 20 THEN {Q._GRAMS} END AS grams FROM base)")

# Numeric reading of an answer, as a fraction of two HUGEINTs.
_NUM = {
    "whole": r"^([+-]?)\s*(\d{1,18}|\d{1,3}(?:,\d{3}){1,5})$",
    "decimal": r"^([+-]?)\s*(\d{0,9})\.(\d{1,9})$",
    "slash": r"^([+-]?)\s*(\d{1,9})\s*/\s*(\d{1,9})$",
    "frac": r"^([+-]?)\s*\\[dt]?frac\{\s*(\d{1,9})\s*\}\{\s*(\d{1,9})\s*\}$",
    "mixed": r"^([+-]?)\s*(\d{1,8})\s*\\[dt]?frac\{\s*(\d{1,9})\s*\}\{\s*(\d{1,9})\s*\}$",
}


def _sql_fraction(e: str) -> tuple[str, str]:
    bare = D.sql_strip(f"regexp_replace({e}, '^\\$|\\$$', '', 'g')")

    def g(kind, group):
        return f"try_cast(replace(regexp_extract({bare}, '{_NUM[kind]}', {group}), ',', '') AS HUGEINT)"

    def has(kind):
        return f"regexp_matches({bare}, '{_NUM[kind]}')"

    frac_digits = f"regexp_extract({bare}, '{_NUM['decimal']}', 3)"
    whole_digits = f"regexp_extract({bare}, '{_NUM['decimal']}', 2)"
    sign = f"(CASE WHEN left({bare}, 1) = '-' THEN -1 ELSE 1 END)"
    num = (f"{sign} * (CASE WHEN {has('whole')} THEN {g('whole', 2)} "
           f"WHEN {has('decimal')} THEN try_cast({whole_digits} || {frac_digits} AS HUGEINT) "
           f"WHEN {has('slash')} THEN {g('slash', 2)} WHEN {has('frac')} THEN {g('frac', 2)} "
           f"WHEN {has('mixed')} THEN {g('mixed', 2)} * {g('mixed', 4)} + {g('mixed', 3)} END)")
    den = (f"nullif(CASE WHEN {has('whole')} THEN 1 WHEN {has('decimal')} "
           f"THEN try_cast('1' || repeat('0', length({frac_digits})) AS HUGEINT) "
           f"WHEN {has('slash')} THEN {g('slash', 3)} WHEN {has('frac')} THEN {g('frac', 3)} "
           f"WHEN {has('mixed')} THEN {g('mixed', 4)} END, 0)")
    return num, den


_AN, _AD = _sql_fraction("answer_norm")
_TN, _TD = _sql_fraction("target_norm")
_SIMP = Q.sql_simplified("cjk")
_FOUND = "(answer IS NOT NULL AND answer <> '')"
_SCORES = {
    "zhtw_purity": f"CASE WHEN length(cjk) > 0 THEN greatest(0.0, 1.0 - 20.0 * ({_SIMP}::double / length(cjk))) END",
    "no_english_drift": "CASE WHEN prompt_cjk < 5 THEN NULL WHEN prose_cjk = 0 AND prose_latin = 0 THEN NULL "
                        "WHEN prose_cjk = 0 THEN 0.0 ELSE greatest(0.0, 1.0 - greatest(0, prose_latin - 3)::double / 20.0) END",
    "format_think": f"CASE WHEN len(think) <> 1 THEN 0.0 WHEN length({D.sql_strip('think[1]')}) >= 20 AND "
                    f"{D.sql_strip(Q.sql_drop_think('completion'))} <> '' THEN 1.0 ELSE 0.3 END",
    "format_boxed": f"CASE WHEN len(boxed) > 1 THEN 0.2 WHEN {D.sql_strip('boxed[1]')} <> '' THEN 1.0 ELSE 0.0 END",
    "accuracy_mcq": f"CASE WHEN {_FOUND} AND {Q.sql_letter('answer')} = left(upper({D.sql_strip('target')}), 1) THEN 1.0 ELSE 0.0 END",
    "accuracy_exact": f"CASE WHEN {_FOUND} AND answer_norm = target_norm THEN 1.0 ELSE 0.0 END",
    "accuracy_math": f"CASE WHEN {_FOUND} AND (answer_norm = target_norm OR coalesce(({_AN}) * ({_TD}) = ({_TN}) * ({_AD}), false)) THEN 1.0 ELSE 0.0 END",
    "no_repetition": "CASE WHEN len(units) >= 20 THEN len(list_distinct(grams))::double / len(grams) END",
    "length_target": "exp(-pow(length(completion) - {t}.0, 2) / (2 * pow({t} * 0.6, 2)))",
}


def _score(name: str, target: int = 600) -> str:
    return f"({_SCORES[name].replace('{t}', str(target))})::double"


_PARTS = ", ".join(f"{_score(s['name'])} AS {s['name']}" for s in SPEC)
_TOTAL = " + ".join(f"{s['weight']} * coalesce({s['name']}, 0)" for s in SPEC)
_APPLIED = " + ".join(f"({s['name']} IS NOT NULL)::bigint" for s in SPEC)
_COMPOSED = (f"{_BASE}, parts AS (SELECT doc_id, lang, source, {_PARTS} FROM m), composed AS (SELECT *, "
             f"CASE WHEN {_APPLIED} > 0 THEN ({_TOTAL})::double END AS reward, {_APPLIED} AS rewards_applied FROM parts)")

QUERIES = {f"reward_{name}": _one(name) for name in _SCORES} | {
    "reward_composed": composed, "reward_matrix": matrix, "reward_custom": custom_reward,
    "quality_by_language": quality_by_language, "rational_values": rational_values,
}
SQL = {f"reward_{name}": f"WITH {_BASE} SELECT doc_id, round({_score(name, 900)}, 9) AS score FROM m" for name in _SCORES} | {
    "reward_composed": f"WITH {_COMPOSED} SELECT doc_id, round(reward, 9) AS reward, rewards_applied FROM composed",
    "reward_matrix": f"WITH {_BASE} " + " UNION ALL ".join(
        f"SELECT doc_id, '{name}' AS reward, round({_score(name)}, 9) AS score FROM m" for name in _SCORES),
    "reward_custom": f"WITH {_BASE} SELECT lang, count(*) AS completions, round(avg((CASE WHEN contains(completion, '答案') "
                     f"THEN 1.0 ELSE 0.0 END)::double + 0.25 * {_score('format_boxed')}), 6) AS reward FROM m GROUP BY lang",
    "quality_by_language": f"WITH {_COMPOSED} SELECT lang, source, count(*) AS completions, round(avg(reward), 6) AS reward, "
                           "count(zhtw_purity) AS judged_for_purity, round(avg(zhtw_purity), 6) AS purity, "
                           "round(avg(accuracy_math), 6) AS accuracy FROM composed GROUP BY lang, source",
    "rational_values": "WITH s AS (SELECT doc_id, n_chars::double AS n, unnest(range(8)) AS spelling FROM documents) "
                       "SELECT doc_id, spelling, CASE spelling WHEN 0 THEN n WHEN 1 THEN -n WHEN 2 THEN n + 0.25 "
                       "WHEN 3 THEN n / 4 WHEN 4 THEN n / 8 WHEN 5 THEN n + 0.5 ELSE -0.5 END::double AS value FROM s",
}
