"""What the operators of this package share: reading, shared tables, hash folds."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusforge.session import shared_folder


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def written(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """The rows as a Parquet table below spark.checkpoint.dir: later reads do not
    compute them again, and a lost executor does not take them along."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`. NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def below_rate(key: Column, rate: Column | float) -> Column:
    """A sample by hash of the key: the same rows at every partitioning."""
    unit = F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    return unit < rate


def require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing; available: {df.columns}")


def parts(batches: Iterator, rows: int = 256) -> Iterator:
    """The rows of Arrow batches some hundred at a time, so that what a function
    makes of them never stands in memory for a whole batch."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at:at + rows]


def temporary(df: DataFrame, stem: str) -> str:
    """A column name the table does not have yet (names compare without case)."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name
