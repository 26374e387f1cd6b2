"""Everything worth knowing about a table before it is used."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from corpusforge.functions import text as X
from corpusforge.functions import values as V
from corpusforge.operators import profiling as P


@dataclass(frozen=True)
class Inspection:
    """Lazy reports; each is computed when it is read."""

    columns: list[tuple[str, str]]
    shapes: list[tuple[str, str, str]]
    json_columns: DataFrame | None
    keys: DataFrame | None
    roles: DataFrame | None
    turns: DataFrame | None
    preview: DataFrame
    lengths: DataFrame
    tokens: DataFrame


def inspect(df: DataFrame, counter: X.TokenCounter = X.token_estimate, show: int = 1) -> Inspection:
    chat = next((c for c in V.CONVERSATION_COLUMNS if c in df.columns), None)
    has_json = any(c in df.columns for c in V.JSON_CANDIDATES)
    has_messages = "messages" in df.columns
    return Inspection(
        columns=df.dtypes,
        shapes=P.detect_shapes(df.columns),
        json_columns=P.json_string_columns(df) if has_json else None,
        keys=P.element_keys(df, chat) if chat else None,
        roles=P.role_histogram(df) if has_messages else None,
        turns=P.turn_stats(df) if has_messages else None,
        preview=P.preview(df, show),
        lengths=P.length_profile(df),
        tokens=P.token_profile(df, counter=counter),
    )
