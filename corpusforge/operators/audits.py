"""Audits of a corpus, of a mix and of reinforcement-learning samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from corpusforge.functions import rewards as R
from corpusforge.functions import text as X
from corpusforge.operators import profiling as P
from corpusforge.operators import scoring as S
from corpusforge.operators.holdout import holdout, holdout_pairs  # noqa: F401 - audits too
from corpusforge.operators.segments import pack_segments  # noqa: F401

CLIPPED_WARNING = 0.3
SMALLEST_GROUP = 4
#: Below this a domain's text does not carry a pre-training stage.
LEAST_DOMAIN_TOKENS = 100_000_000


def script_ratio(text: str) -> Column:
    """Simplified characters as a share of all Chinese ones; NULL without any."""
    cjk = X.cjk_text(text)
    return F.try_divide(X.simplified_in_cjk(cjk), F.nullif(F.length(cjk), F.lit(0)))


def audit_script(df: DataFrame, text: str, by: Sequence[str], threshold: float = 0.01) -> DataFrame:
    """Rows, rows with simplified characters, mean and highest ratio, rows above `threshold`."""
    ratio = df.select(*by, script_ratio(text).alias("ratio"))
    return ratio.groupBy(*by).agg(
        F.count("*").alias("rows"), F.count("ratio").alias("chinese"), F.count_if(F.col("ratio") > 0).alias("mixed"),
        F.avg("ratio").alias("mean_ratio"), F.max("ratio").alias("max_ratio"), F.count_if(F.col("ratio") > threshold).alias("above"))


def filter_script(df: DataFrame, text: str, max_ratio: float = 0.01) -> DataFrame:
    """Without the rows whose ratio is above `max_ratio`; text without Chinese stays."""
    return df.filter(F.coalesce(script_ratio(text), F.lit(0.0)) <= max_ratio)


def filter_script_counted(df: DataFrame, text: str, by: str, sources: Sequence[str], max_ratio: float = 0.01) -> tuple[DataFrame, Observation]:
    """`filter_script` and an account of it from the same pass over the rows.

    Once the rows have been written or counted, the observation has `kept` and
    `dropped`: maps from each of `sources`, the values of `by` to tell apart, to
    a number of rows; rows with another value or none count under "".
    """
    out = F.coalesce(script_ratio(text), F.lit(0.0)) > max_ratio
    marked, seen = df.withColumn("_out", out), Observation()
    other = ~F.coalesce(F.col(by).isin(list(sources)), F.lit(False))

    def counts(which: Column) -> Column:
        pairs = [(F.lit(s), F.count_if(which & (F.col(by) == s))) for s in sources] + [(F.lit(""), F.count_if(which & other))]
        return F.create_map(*[x for pair in pairs for x in pair])

    marked = marked.observe(seen, counts(~F.col("_out")).alias("kept"), counts(F.col("_out")).alias("dropped"))
    return marked.filter(~F.col("_out")).drop("_out"), seen


def audit_english(df: DataFrame, text: str, by: Sequence[str], low: float = 1.0) -> DataFrame:
    """Rows that drift into English: those scoring below `low`, and the mean score."""
    scored = S.score(df.select(*by, F.col(text).alias("completion")), ["no_english_drift"])
    score = F.col("no_english_drift")
    return scored.groupBy(*by).agg(F.count("*").alias("rows"), F.count(score).alias("judged"),
                                   F.count_if(score < low).alias("low"), F.avg(score).alias("mean_score"))


def zero_signal_groups(df: DataFrame, group: str, reward: str = "reward", smallest: int = SMALLEST_GROUP) -> DataFrame:
    """Groups of completions: size, lowest and highest reward, no signal, too small."""
    found = df.groupBy(group).agg(F.count("*").alias("completions"), F.min(reward).alias("lowest"), F.max(reward).alias("highest"))
    return found.withColumns({"no_signal": F.coalesce(F.col("lowest") == F.col("highest"), F.lit(True)),
                              "too_small": F.col("completions") < smallest})


def clipped_ratio(df: DataFrame, tokens: Column, cap: int, by: Sequence[str], warn: float = CLIPPED_WARNING,
                  reward: str | None = None) -> DataFrame:
    """Share of completions that reach the cap, per step, and a warning. With a
    `reward` column also what is learned from: completions that are not cut off
    (rewarded) and their mean reward; the others are masked."""
    cut = F.col("_tokens") >= cap
    agg = [F.count("*").alias("completions"), F.avg(cut.cast("double")).alias("ratio")]
    if reward:
        left = F.when(F.coalesce(~cut, F.lit(True)), F.col("_reward"))
        agg += [F.count(left).alias("rewarded"), F.avg(left).alias("mean_reward")]
    columns = [*by, tokens.alias("_tokens"), *([F.col(reward).cast("double").alias("_reward")] if reward else [])]
    return df.select(*columns).groupBy(*by).agg(*agg).withColumn("warn", F.col("ratio") > warn)


def cap_advice(df: DataFrame, tokens: Column, caps: Sequence[int], p: float = 0.99) -> DataFrame:
    """Share of answers longer than each cap; the smallest cap at or above the
    percentile is advised. Works on the histogram of lengths."""
    hist = P.histogram(df, tokens).filter("value IS NOT NULL")
    each = hist.withColumn("cap", F.explode(F.array(*map(F.lit, sorted(caps)))))
    totals = each.groupBy("cap").agg(F.sum("rows").alias("answers"), F.sum(F.when(F.col("value") > F.col("cap"), F.col("rows")).otherwise(0)).alias("cut"))
    fits = F.col("cut") < F.col("answers") - F.floor(F.col("answers") * F.lit(p))
    smallest = F.min(F.when(fits, F.col("cap"))).over(Window.partitionBy())
    return totals.withColumns({"cut_share": F.col("cut") / F.col("answers"),
                               "advised": F.coalesce(F.col("cap") == smallest, F.lit(False))})


def weight_balance(scored: DataFrame, spec: Sequence[Mapping], total: str = "reward", decisive: Sequence[str] = R.CORRECTNESS) -> DataFrame:
    """What each weighted reward adds up to, its share of the absolute total, its
    correlation with the total where it was judged, and whether correctness leads.

    (reward, weight, judged, contribution, share, correlation, verdict): the
    verdict of a reward of `decisive` is "dominates" if its weight is above the
    sum of all others that are not decisive, else "outweighed"; others are
    "shaping", or "stronger than correctness" if their correlation with the total
    is above that of every decisive reward. Correlation is NULL for a constant.
    """
    weights = {s["name"]: float(s.get("weight", 1.0)) for s in spec}
    shaping = sum(abs(w) for n, w in weights.items() if n not in decisive)
    parts = F.array(*[F.struct(F.lit(n).alias("reward"), F.lit(w).alias("weight"), F.lit(n in decisive).alias("_decisive"),
                               F.col(n).alias("score"), F.col(total).alias("_total")) for n, w in weights.items()])
    weighted, judged = F.col("weight") * F.col("score"), F.when(F.col("score").isNotNull(), F.col("_total"))
    varies = (F.stddev_pop("score") > 1e-12) & (F.stddev_pop(judged) > 1e-12)
    sums = (scored.select(F.inline(parts)).groupBy("reward", "weight", "_decisive")
            .agg(F.count("score").alias("judged"), F.sum(weighted).alias("contribution"),
                 F.when(varies, F.try_divide(F.covar_pop("score", judged), F.stddev_pop("score") * F.stddev_pop(judged))).alias("correlation")))
    rewards = Window.partitionBy()  # a row a reward
    whole = F.sum(F.abs("contribution")).over(rewards)
    leads = F.max(F.when(F.col("_decisive"), F.col("correlation"))).over(rewards)
    verdict = (F.when(F.col("_decisive"), F.when(F.abs("weight") > shaping, "dominates").otherwise("outweighed"))
               .when(F.col("correlation") > leads, "stronger than correctness").otherwise("shaping"))
    return sums.select("reward", "weight", "judged", "contribution", F.try_divide(F.abs("contribution"), whole).alias("share"),
                       "correlation", verdict.alias("verdict"))


def mix_shares(df: DataFrame, tokens: Column, weights: Mapping[str, float], source: str = "source",
               copies: str | None = None) -> DataFrame:
    """Rows, tokens and token share of each source against its weight, and how
    often its rows are repeated (the highest copy number, if there is one)."""
    agg = [F.count("*").alias("rows"), F.sum("_tokens").alias("tokens")]
    agg.append((F.max(copies) if copies else F.lit(1)).cast("long").alias("epochs"))
    sums = df.select(source, *([copies] if copies else []), tokens.alias("_tokens")).groupBy(source).agg(*agg)
    whole = float(sum(weights.values()))
    wanted = F.lit(None).cast("double")
    for name, weight in weights.items():
        wanted = F.when(F.col(source) == name, weight / whole).otherwise(wanted)
    return sums.withColumns({"share": F.col("tokens") / F.sum("tokens").over(Window.partitionBy()), "wanted_share": wanted})


def stage_advice(df: DataFrame, tokens: Column, domain: Sequence[str], source: str = "source", copies: str = "copy",
                 least: int = LEAST_DOMAIN_TOKENS) -> DataFrame:
    """Whether a mix suits a pre-training stage: (source, rows, tokens,
    own_tokens, epochs, advice).

    own_tokens counts each row once (`copies` numbers its repetitions from 1);
    epochs is how often the source is read through, tokens / own_tokens. More than
    one pass memorizes; sources of `domain` that have fewer than `least` tokens of
    their own, all together, are better taught in another stage.
    """
    once = F.when(F.col(copies) == 1, F.col("_tokens")).otherwise(0)
    sums = df.select(source, copies, tokens.cast("long").alias("_tokens")).groupBy(source).agg(
        F.count("*").alias("rows"), F.sum("_tokens").alias("tokens"), F.sum(once).alias("own_tokens"))
    of_domain = F.coalesce(F.col(source).isin(list(domain)), F.lit(False))
    whole = F.sum(F.when(of_domain, F.col("own_tokens"))).over(Window.partitionBy())  # a row a source
    epochs = F.try_divide(F.col("tokens"), F.col("own_tokens"))
    advice = (F.when(of_domain & (whole < least), "too little text for this stage").when(epochs > 1, "memorizes").otherwise("fits"))
    return sums.select(source, "rows", "tokens", "own_tokens", epochs.alias("epochs"), advice.alias("advice"))


def replay_check(shares: DataFrame, bands: Mapping[str, tuple[float, float]], portion: str = "source") -> DataFrame:
    """Each portion's share against its band: below, inside, above or no band."""
    low = high = F.lit(None).cast("double")
    for name, (least, most) in bands.items():
        low = F.when(F.col(portion) == name, least).otherwise(low)
        high = F.when(F.col(portion) == name, most).otherwise(high)
    verdict = (F.when(low.isNull(), "no band").when(F.col("share") < low, "below")
               .when(F.col("share") > high, "above").otherwise("inside"))
    return shares.withColumn("verdict", verdict)


def tool_balance(df: DataFrame, is_tool: Column, low: float = 2.0, high: float = 3.0) -> DataFrame:
    """Rows with and without tool calls, general rows for each tool row, and
    whether that lies between `low` and `high` (no verdict without tool rows)."""
    tool = F.coalesce(is_tool, F.lit(False))
    sums = df.agg(F.count_if(~tool).alias("general"), F.count_if(tool).alias("tool"))
    ratio = F.try_divide(F.col("general"), F.col("tool"))
    verdict = F.when(ratio < low, "too few general rows").when(ratio > high, "too few tool rows").when(ratio.isNotNull(), "inside").otherwise("no tool rows")
    return sums.select("general", "tool", ratio.alias("general_per_tool"), verdict.alias("verdict"))


def preference_profile(df: DataFrame, counter: X.TokenCounter = X.token_estimate, p: float = 0.99) -> DataFrame:
    """Percentile and maximum of tokens of prompt, chosen, rejected and prompt +
    longer answer (text columns); the maximum of the last truncates nothing."""
    prompt, chosen, rejected = (F.coalesce(counter(F.coalesce(F.col(c), F.lit(""))), F.lit(0)) for c in ("prompt", "chosen", "rejected"))
    sizes = df.select(prompt.alias("prompt"), chosen.alias("chosen"), rejected.alias("rejected"))
    parts = F.array(*[F.struct(F.lit(c).alias("part"), F.col(c).alias("size")) for c in ("prompt", "chosen", "rejected")],
                    F.struct(F.lit("prompt and longer answer").alias("part"), (F.col("prompt") + F.greatest("chosen", "rejected")).alias("size")))
    long = sizes.select(F.inline(parts))
    return P.percentiles(P.histogram(long, F.col("size"), ["part"]), {"percentile": p}, ["part"])
