"""Multiple-choice evaluation: predictions, accuracy, repeats, comparison, bias."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusforge.functions import text as X
from corpusforge.operators.conform import require

#: Prose that announces an option; tried in this order after a boxed value.
PROSE = (
    r"答案\s*(?:是|為)?\s*[：:]?\s*[\(（]?\s*([A-J])(?![A-Za-z])",
    r"(?i:answer\s+is)\s*:?\s*\(?([A-J])(?![A-Za-z])",
    r"^\s*\(?([A-J])[\).]?\s*$",
)
BOXED_LETTER = r"^\W*([A-J])(?![A-Z0-9])"
#: A larger share of answers that cannot be read measures formatting, not knowledge.
UNPARSED_ALARM = 0.2


def predicted_letter(completion: Column, method: str = "pattern", pattern: str | None = None,
                     prose: Sequence[str] = PROSE) -> Column:
    """The option a completion chooses; NULL if it cannot be read.

    "box" reads the last boxed value only, "pattern" prose as well, "regex" the
    first group of `pattern`.
    """
    if method == "regex":
        if not pattern:
            raise ValueError("method regex needs a pattern")
        return F.nullif(F.regexp_extract(completion, pattern, 1), F.lit(""))
    if method not in ("box", "pattern"):
        raise ValueError(f"method must be box, pattern or regex, got {method!r}")
    found = [F.regexp_extract(F.upper(X.last_boxed(X.boxed(completion))), BOXED_LETTER, 1)]
    if method == "pattern":
        found += [F.regexp_extract(completion, p, 1) for p in prose]
    return F.coalesce(*[F.nullif(f, F.lit("")) for f in found])


def extract_prediction(df: DataFrame, completion: str = "completion", method: str = "pattern",
                       pattern: str | None = None, to: str = "prediction") -> DataFrame:
    require(df, [completion], "extract_prediction")
    return df.withColumn(to, predicted_letter(F.col(completion), method, pattern))


def accuracy(predictions: DataFrame, key: DataFrame, on: Sequence[str], by: Sequence[str],
             prediction: str = "prediction", answer: str = "answer") -> DataFrame:
    """Items, correct, accuracy and unparsed share per group.

    An item of the key without a prediction counts as wrong and unparsed; a
    prediction without a key is left out. `by` may name columns of either side.
    `alarm` tells that more than a fifth could not be read.
    """
    graded = key.join(predictions, list(on), "left")
    right = F.count_if(F.col(prediction) == F.upper(F.trim(F.col(answer))))
    unread = F.count_if(F.col(prediction).isNull())
    return (graded.groupBy(*by).agg(F.count("*").alias("items"), right.alias("correct"), unread.alias("unparsed"))
            .withColumns({"accuracy": F.col("correct") / F.col("items"), "unparsed_share": F.col("unparsed") / F.col("items")})
            .withColumn("alarm", F.col("unparsed_share") > UNPARSED_ALARM))


def repeat_stats(runs: DataFrame, by: Sequence[str], value: str = "accuracy") -> DataFrame:
    """Mean and sample deviation over runs (deviation NULL for a single run)."""
    return runs.groupBy(*by).agg(F.count("*").alias("runs"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("deviation"))


def compare(before: DataFrame, after: DataFrame, by: Sequence[str]) -> DataFrame:
    """`repeat_stats` of two models side by side, with a verdict.

    A gap within the larger deviation is no change; what only one side was
    measured on is marked and has no verdict.
    """
    sides = [t.select(*by, F.col("mean").alias(f"mean_{n}"), F.col("deviation").alias(f"deviation_{n}"))
             for t, n in ((before, "before"), (after, "after"))]
    both = sides[0].join(sides[1], list(by), "full")
    gap = F.col("mean_after") - F.col("mean_before")
    noise = F.coalesce(F.greatest("deviation_before", "deviation_after"), F.lit(0.0))
    verdict = (F.when(F.col("mean_before").isNull(), "only after").when(F.col("mean_after").isNull(), "only before")
               .when(F.abs(gap) <= noise, "within deviation").when(gap > 0, "better").otherwise("worse"))
    return both.withColumns({"gap": gap, "verdict": verdict})


def shuffle_options(df: DataFrame, key: Sequence[str], options: Sequence[str] = tuple("ABCD"), answer: str = "answer",
                    seed: int = 42, run: int = 0) -> DataFrame:
    """Options in an order by hash of seed, run, item and letter; the answer follows.

    A NULL option moves to the end. An answer that is none of the letters becomes NULL.
    """
    require(df, [*key, *options, answer], "shuffle_options")
    item = F.concat_ws("|", F.lit(str(seed)), F.lit(str(run)), *[F.col(k).cast("string") for k in key])
    drawn = F.array_sort(F.array(*[F.struct(
        F.col(o).isNull().alias("absent"), F.md5(F.concat_ws("|", item, F.lit(o))).alias("order"),
        F.lit(o).alias("letter"), F.col(o).cast("string").alias("text")) for o in options]))
    df = df.withColumn("_drawn", drawn)
    moved = {o: F.get("_drawn", F.lit(i))["text"] for i, o in enumerate(options)}
    where = F.array_position(F.col("_drawn")["letter"], F.upper(F.trim(F.col(answer))))
    letters = F.array(*map(F.lit, options))
    moved[answer] = F.when(where > 0, F.get(letters, where.cast("int") - 1))
    return df.withColumns(moved).drop("_drawn")


def position_bias(graded: DataFrame, prediction: str = "prediction", answer: str = "answer", by: Sequence[str] = ()) -> DataFrame:
    """How often each letter is predicted and how often it is the key."""
    sides = F.array(F.struct(F.col(prediction).alias("letter"), F.lit(1).alias("p"), F.lit(0).alias("k")),
                    F.struct(F.upper(F.trim(F.col(answer))).alias("letter"), F.lit(0).alias("p"), F.lit(1).alias("k")))
    counts = (graded.select(*by, F.inline(sides)).filter(F.col("letter").isNotNull()).groupBy(*by, "letter")
              .agg(F.sum("p").alias("predicted"), F.sum("k").alias("keyed")))
    total = Window.partitionBy(*by)
    share = lambda c: F.try_divide(F.col(c), F.sum(c).over(total))
    return counts.withColumns({"predicted_share": share("predicted"), "keyed_share": share("keyed")})


def method_compare(completions: DataFrame, key: DataFrame, on: Sequence[str], by: Sequence[str],
                   methods: Sequence[str] = ("box", "pattern"), completion: str = "completion") -> DataFrame:
    """`accuracy` of the same completions under each way of reading them."""
    read = F.array(*[F.struct(F.lit(m).alias("method"), predicted_letter(F.col(completion), m).alias("prediction")) for m in methods])
    each = completions.select(*on, F.inline(read))
    wanted = key.withColumn("method", F.explode(F.array(*map(F.lit, methods))))
    return accuracy(each, wanted, [*on, "method"], [*by, "method"])
