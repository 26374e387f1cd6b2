"""Score completions: reward columns, their weighted sum, the score matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from corpusforge.functions import rewards as R

DEFAULT_SPEC = ({"name": "format_boxed", "weight": 1.0},)


Entry = dict | str | R.Reward


def _resolve(spec: Sequence[Entry]) -> list[tuple[str, R.Reward, float, dict]]:
    """(output column, reward, weight, options) of each entry.

    An entry is a registered name, a dict with `name`, `weight` and options, or
    a reward that was never registered.
    """
    out, used = [], {}
    for item in spec or DEFAULT_SPEC:
        options = dict(item) if isinstance(item, dict) else {"name": item}
        found = options.pop("name")
        if not isinstance(found, R.Reward):
            if found not in R.REWARDS:
                raise ValueError(f"unknown reward {found!r}; available: {', '.join(sorted(R.REWARDS))}")
            found = R.REWARDS[found]
        used[found.name] = used.get(found.name, 0) + 1
        column = found.name if used[found.name] == 1 else f"{found.name}_{used[found.name]}"
        out.append((column, found, float(options.pop("weight", 1.0)), options))
    return out


def score(df: DataFrame, spec: Sequence[Entry] = DEFAULT_SPEC, completion: str = "completion",
          prompt: str | None = None, target: str | None = None, **settings) -> DataFrame:
    """Add one column per reward, `reward` (weighted sum) and `rewards_applied`.

    A reward that does not apply is skipped for that row; `reward` is NULL when
    none applies.
    """
    entries = _resolve(spec)
    if taken := [c for c in [*(e[0] for e in entries), "reward", "rewards_applied"] if c in df.columns]:
        raise ValueError(f"the table already has columns {taken}")
    measured = R.prepare(df, completion, prompt, target, **settings)

    def sample(options: dict) -> R.Sample:
        return R.Sample(prompt is not None, target is not None, options)

    scored = R.drop_measures(measured.select(
        "*", *[r.fn(sample(o)).cast("double").alias(c) for c, r, _, o in entries]))
    applied = sum((F.col(c).isNotNull().cast("int") for c, *_ in entries), F.lit(0))
    total = sum((F.lit(w) * F.coalesce(F.col(c), F.lit(0.0)) for c, _, w, _ in entries), F.lit(0.0))
    return scored.select("*", F.when(applied > 0, total).alias("reward"),
                         applied.alias("rewards_applied"))


def score_matrix(df: DataFrame, keys: Sequence[str], completion: str = "completion",
                 prompt: str | None = None, target: str | None = None, **settings) -> DataFrame:
    """Every registered reward for every completion, one row each."""
    names = sorted(R.REWARDS)
    wide = score(df, names, completion, prompt, target, **settings)
    return wide.unpivot(list(keys), names, "reward", "score")
