"""Read one config and split of a table, whole or its first rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from corpusforge.sources.selection import first_by_key

FILE, INDEX = "_metadata.file_path", "_metadata.row_index"
ROWS_PER_BLOCK = 65536
#: The split that suits the use, where a source has splits.
DEFAULT = "default"


@dataclass(frozen=True)
class SourceSpec:
    """One source of a mix, and how to bring it to the common schema.

    `path` may contain {config} and {split}; otherwise columns of these names
    select the rows, and a config or split that is asked for has to be found in
    one of these ways. The default split is train, or test for evaluation, of a
    source that has splits; None reads all of them. `key` names the columns that identify a row; without it
    the position in the (parquet) files does.
    """

    path: str
    name: str | None = None
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    schema: str | None = None
    config: str | None = None
    split: str | None = DEFAULT
    max_samples: int | None = None
    key: Sequence[str] = ()
    json_columns: Sequence[str] = ()
    json_types: Mapping[str, str] = field(default_factory=dict)
    sharegpt_preference: bool = False
    sharegpt_to_messages: bool = False
    sharegpt_column: str = "conversations"
    rename: Mapping[str, str] = field(default_factory=dict)
    keep: Sequence[str] = ()
    weight: float = 1.0

    @property
    def label(self) -> str:
        return self.name or self.path


def load_source(spark: SparkSession, spec: SourceSpec, trial_rows: int | None = None,
                default_split: str = "train") -> DataFrame:
    """The rows of a source with `row_key`; `trial_rows` overrides max_samples.

    A cap runs short jobs while the DataFrame is built: counts per file and
    block, or counts of keys.
    """
    reader = spark.read.format(spec.format).options(**spec.options)
    if spec.schema:
        reader = reader.schema(spec.schema)
    split = default_split if spec.split == DEFAULT else spec.split
    df = reader.load(spec.path.format(config=spec.config, split=split))
    df = _select(df, "config", spec.config, spec.path)
    if spec.split == DEFAULT and "split" not in df.columns:
        split = None
    df = _select(df, "split", split, spec.path)
    cap = trial_rows or spec.max_samples
    if spec.key:
        key = F.concat_ws("|", *[F.col(c).cast("string") for c in spec.key])
        df = df.withColumn("row_key", key)
        return first_by_key(df, spec.key, cap) if cap else df
    if spec.format != "parquet":
        raise ValueError(f"{spec.label}: rows of {spec.format} files need key columns")
    if cap:
        df = first_in_files(df, cap)
    return df.withColumn("row_key", file_position())


def _select(df: DataFrame, column: str, value: str | None, path: str) -> DataFrame:
    if value is None or "{" + column + "}" in path:
        return df
    if column not in df.columns:
        raise ValueError(f"{path}: {column} {value!r} was asked for, but there is neither a column {column} "
                         f"nor {{{column}}} in the path")
    return df.filter(F.col(column) == value)


def file_position() -> Column:
    """Identity of a parquet row: its file and its index in the file."""
    return F.concat_ws("#", FILE, F.col(INDEX).cast("string"))


def head(df: DataFrame, n: int = 200) -> DataFrame:
    """Some n rows; reads only as many partitions as that takes."""
    return df.limit(n)


def first_in_files(df: DataFrame, n: int) -> DataFrame:
    """The first n rows in file order, for any n.

    Counts rows per file, then per block of the file that holds the n-th row,
    and turns that row's position into a filter: files behind it are not read,
    and no row is sorted or moved.
    """
    position = _nth_row(df, n)
    return df if position is None else df.filter(position.up_to)


@dataclass(frozen=True)
class _Position:
    file: str
    index: int

    @property
    def up_to(self) -> Column:
        return (F.col(FILE) < self.file) | ((F.col(FILE) == self.file) & (F.col(INDEX) <= self.index))


def _nth_row(df: DataFrame, n: int) -> _Position | None:
    """Where the n-th row lies; None if there are fewer."""
    file = _holder(df.select(F.col(FILE).alias("bucket")), n)
    if file is None:
        return None
    in_file, left = df.filter(F.col(FILE) == file["bucket"]), n - file["before"]
    number = F.floor(F.col(INDEX) / ROWS_PER_BLOCK)
    block = _holder(in_file.select(number.alias("bucket")), left)
    in_block = in_file.filter(number == block["bucket"]).select(F.col(INDEX).alias("i"))
    last = in_block.orderBy("i").limit(left - block["before"]).agg(F.max("i").alias("i")).first()["i"]
    return _Position(file["bucket"], last)


def _holder(buckets: DataFrame, n: int):
    """The bucket with the n-th row and how many rows come before it."""
    upto = F.sum("n").over(Window.orderBy("bucket"))
    counts = buckets.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("upto", upto)
    return (counts.filter((F.col("upto") >= n) & (F.col("upto") - F.col("n") < n))
            .select("bucket", (F.col("upto") - F.col("n")).alias("before")).first())
