"""Grading with each item's own options, by exact values, and totals in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from corpusforge.functions import rewards as R
from corpusforge.functions import text as X
from corpusforge.operators.conform import require
from corpusforge.operators.evaluation import PROSE, UNPARSED_ALARM

BOXED_START = "\\boxed{"
#: Why an answer could not be read.
BLANK, UNMATCHED, FOREIGN, NOTHING = "blank", "unmatched box", "not an option", "no answer"
METHODS = ("box", "pattern", "math")


def read_option(completion: Column, options: Column, method: str = "pattern", prose: Sequence[str] = PROSE) -> Column:
    """struct(prediction, unread): the first letter read that is one of `options`
    (an array of letters), or why there is none.

    The last boxed value comes first, then prose, pattern by pattern and match by
    match: a capital that only looks like an answer is passed over if the item
    has no such option.
    """
    boxes = X.boxed(completion)
    box = F.upper(X.last_boxed(boxes))
    read = [F.regexp_extract_all(box, F.lit(r"^\W*([A-Z])(?![A-Z0-9])"), F.lit(1))]
    if method == "pattern":
        read += [F.regexp_extract_all(completion, F.lit(p.replace("[A-J]", "[A-Z]")), F.lit(1)) for p in prose]
    letters = F.concat(*[F.coalesce(r, F.array().cast("array<string>")) for r in read])
    own = F.get(F.filter(letters, lambda x: F.array_contains(options, x)), F.lit(0))
    return _result(completion, own, boxes, F.size(letters) > 0)


def _result(completion: Column, value: Column, boxes: Column, something: Column) -> Column:
    why = (F.when(value.isNotNull(), F.lit(None).cast("string")).when(F.coalesce(X.strip(completion), F.lit("")) == "", BLANK)
           .when(something, FOREIGN).when(unmatched_boxes(completion, boxes) > 0, UNMATCHED).otherwise(NOTHING))
    return F.struct(value.alias("prediction"), why.alias("unread"))


def unmatched_boxes(completion: Column, boxes: Column | None = None) -> Column:
    """How many boxes of a text have no end, or more braces within than are read."""
    started = (F.length(completion) - F.length(F.replace(completion, F.lit(BOXED_START), F.lit("")))) / len(BOXED_START)
    return F.greatest(started.cast("long") - F.size(X.boxed(completion) if boxes is None else boxes), F.lit(0))


def math_value(answer: Column) -> Column:
    """An answer as a reduced fraction "n/d" if it is a number of any spelling,
    else its normalized text."""
    return F.coalesce(R.exact_number(answer), F.nullif(X.norm_answer(answer), F.lit("")))


def read_value(completion: Column) -> Column:
    """struct(prediction, unread): the last boxed value by `math_value`."""
    boxes = X.boxed(completion)
    return _result(completion, math_value(X.last_boxed(boxes)), boxes, F.lit(False))


def grade(completions: DataFrame, key: DataFrame, on: Sequence[str], method: str = "pattern", completion: str = "completion",
          answer: str = "answer", options: str = "options") -> DataFrame:
    """The key's rows with prediction, unread, unmatched (boxes) and correct.

    With "box" and "pattern" the key has an array of the item's letters in
    `options`; with "math" values are compared, whatever their spelling. An item
    without a completion is unread and wrong, a completion without an item is
    left out, an item with several completions has as many rows.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, got {method!r}")
    require(completions, [*on, completion], "grade")
    require(key, [*on, answer] if method == "math" else [*on, answer, options], "grade")
    done = completions.select(*on, F.col(completion).alias("_said"))
    both = key.join(done, list(on), "left")
    told = read_value(F.col("_said")) if method == "math" else read_option(F.col("_said"), F.col(options), method)
    wanted = math_value(F.col(answer)) if method == "math" else F.upper(X.strip(F.col(answer)))
    both = both.withColumns({"_told": told, "_wanted": wanted})
    correct = F.coalesce(F.col("_told.prediction") == F.col("_wanted"), F.lit(False))
    return both.select(*key.columns, "_told.*", F.coalesce(unmatched_boxes(F.col("_said")), F.lit(0)).alias("unmatched"), correct.alias("correct"))


def totals(graded: DataFrame, by: Sequence[str]) -> DataFrame:
    """Results of each group, of each level above and of all items, in one pass.

    `level` counts the columns of `by` that are summed over, from the right: 0 is
    a group, len(by) is everything; summed columns are NULL. items, correct,
    unparsed and its reasons, unmatched boxes, accuracy, unparsed_share, alarm.
    """
    unread = lambda why: F.count_if(F.col("unread") == why)
    sums = graded.rollup(*by).agg(
        F.bit_count(F.grouping_id()).cast("long").alias("level"), F.count("*").alias("items"), F.count_if("correct").alias("correct"),
        F.count_if(F.col("prediction").isNull()).alias("unparsed"), unread(BLANK).alias("blank"), unread(FOREIGN).alias("foreign"),
        unread(UNMATCHED).alias("unclosed"), F.sum("unmatched").alias("unmatched"))
    return (sums.withColumns({"accuracy": F.col("correct") / F.col("items"), "unparsed_share": F.col("unparsed") / F.col("items")})
            .withColumn("alarm", F.col("unparsed_share") > UNPARSED_ALARM))
