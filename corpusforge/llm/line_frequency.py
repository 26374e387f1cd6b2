"""Quality rules: repetition within a text, and lines that a host repeats across documents.

One pass over the texts makes a small table of facts: the rules' counts, and for
each line a hash of its normalised form and its words. Lines are then counted by
the distinct documents of a host that hold them; lines above the limits are
boilerplate, which is taken out, and a document that loses too much by it is
rejected. Exact copies of a document say the same thing once, so they count as
one: copies are for duplicate removal to judge.

Only hashes are shuffled. A line that a third of all documents hold is counted
per task first, and only lines above the limits meet the facts again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from corpusforge.llm.common import parts, require, temporary, written

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
DIGITS = str.maketrans("123456789", "000000000")
#: Words of a window that must not repeat.
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def line_hash(words: list[str]) -> bytes:
    """128 bits of a line: lower case, digits alike, white space as one space."""
    return blake2b(" ".join(words).lower().translate(DIGITS).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more, its first place included."""
    if len(words) <= window:
        return 0
    number: dict[str, int] = {}
    single = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == len(words):
        return 0
    # Codes of ever longer windows; equal codes are equal windows.
    codes, most = single, len(number)
    for k in range(1, window):
        values, codes = np.unique(codes[:-1] * most + single[k:], return_inverse=True)
        if values.size == codes.size:
            return 0
        most = max(values.size, len(number))
    twice = np.bincount(codes)[codes] > 1
    starts = np.zeros(len(words) + 1, np.int64)
    np.add.at(starts, np.flatnonzero(twice), 1)
    np.add.at(starts, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(starts) > 0).sum())


def facts_of(text: str | None) -> tuple[int, int, int, int, int, bytes, list[bytes], list[int]]:
    """The counts, a hash of the whole text's lines, hashes and words of the distinct lines."""
    words, seen, lines = [], set(), {}
    duplicates = chars = 0
    whole = blake2b(digest_size=16)
    for line in (text or "").split("\n"):
        own = WORD.findall(line)
        if not own:
            continue
        if line in seen:
            duplicates += 1
        seen.add(line)
        key = line_hash(own)
        whole.update(key)
        lines[key] = lines.get(key, 0) + len(own)
        words += own
        chars += sum(map(len, own))
    return (len(words), chars, len(SYMBOL.findall(text or "")), duplicates, repeated_words(words), whole.digest(), list(lines), list(lines.values()))


def facts_column(text: Column) -> Column:
    """`facts_of` as a struct column."""

    @pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content binary, "
                "lines array<binary>, line_words array<long>")
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in parts(texts):
            yield pd.DataFrame([facts_of(t) for t in batch], columns=[*COUNTS, "content", "lines", "line_words"])

    return found(text)


def facts(docs: DataFrame, id_column: str, text: str, host: str) -> DataFrame:
    """A written row for each document: doc, host, digest of its text, counts, lines."""
    rows = docs.select(F.col(id_column).alias("doc"), F.col(host).cast("string").alias("host"), F.col(text).alias("t"))
    found = rows.select("doc", "host", F.md5("t").alias("digest"), facts_column(F.col("t")).alias("f")).select("doc", "host", "digest", "f.*")
    return written(found.withColumn("row", F.monotonically_increasing_id()), "facts")


def frequent_lines(found: DataFrame, max_documents: int, max_share: float) -> DataFrame:
    """(host, line, documents): lines that stand in more than `max_documents`
    different documents of a host and in more than `max_share` of them."""
    host = F.coalesce("host", F.lit(""))
    each = found.select(host.alias("host"), F.explode("lines").alias("line"), "content")
    often = each.groupBy("host", "line").agg(F.count_distinct("content").alias("documents")).filter(F.col("documents") > max_documents)
    hosts = found.select(host.alias("host"), "content").groupBy("host").agg(F.count_distinct("content").alias("different"))
    return (often.join(hosts, "host").filter(F.col("documents") > max_share * F.col("different"))
            .select("host", "line", "documents"))


def judged(docs: DataFrame, id_column: str = "doc_id", text: str = "text", host: str = "source", max_documents: int = 20,
           max_share: float = 0.002, min_words: int = 10, max_repeated: int = 20, min_left: float = 0.5) -> DataFrame:
    """A row for each document: doc, digest, the five counts, base_failed,
    lost_words, removed (hashes of its boilerplate lines) and kept.

    base_failed: fewer than `min_words` words, or more than `max_repeated` percent
    of them in repeated windows of five. kept: not base_failed, and without the
    host's boilerplate lines at least `min_words` words and a share of `min_left`
    of all its words remain.

    NULL and empty texts have no word and fail; a NULL host is a host of its own,
    the same as ''. Repeated rows are documents of their own but count once for a
    line, as do all documents whose lines are alike. Limits are exclusive, so ties
    stay. An empty table gives no rows; texts of any length are read whole.
    """
    require(docs, [id_column, text, host])
    found = facts(docs, id_column, text, host)
    often = written(frequent_lines(found, max_documents, max_share), "lines")
    each = found.select("row", F.coalesce("host", F.lit("")).alias("host"), F.inline(F.arrays_zip(F.col("lines").alias("line"), F.col("line_words").alias("words"))))
    lost = (each.join(often, ["host", "line"]).groupBy("row")
            .agg(F.sum("words").alias("lost_words"), F.collect_list("line").alias("removed")))  # lines of one document
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words"))
    left = F.col("n_words") - F.col("lost_words")
    done = found.drop("lines", "line_words", "content").join(lost, "row", "left").na.fill(0, ["lost_words"]).drop("row")
    return done.withColumn("base_failed", base).withColumn("kept", ~base & (left >= min_words) & (left >= min_left * F.col("n_words")))


def clean(docs: DataFrame, id_column: str = "doc_id", text: str = "text", host: str = "source", **limits) -> DataFrame:
    """The documents that `judged` keeps, with all their columns, without the
    lines above the limits. Lines without a word stay as they are."""
    done = judged(docs, id_column, text, host, **limits).filter("kept")
    # Rows equal in these three have equal lines, so one of them speaks for all.
    key = {"doc": F.col(id_column), "host": F.col(host).cast("string"), "digest": F.md5(text)}
    names = {c: temporary(docs, f"_{c}") for c in (*key, "removed")}
    speaks = done.dropDuplicates(list(key)).select(*[F.col(c).alias(n) for c, n in names.items()])
    given = docs.select("*", *[e.alias(f"{names[c]}g") for c, e in key.items()])
    same: Column = reduce(and_, [F.col(f"{names[c]}g").eqNullSafe(F.col(names[c])) for c in key])

    @pandas_udf("string")
    def without(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, removed in batches:
            yield pd.Series([_without(t, r) for t, r in zip(texts, removed, strict=True)], dtype=object)

    joined = given.join(speaks, same)
    return joined.select(*[without(F.col(text), F.col(names["removed"])).alias(c) if c == text else F.col(c) for c in docs.columns])


def _without(text: str | None, removed: list[bytes] | None) -> str | None:
    if text is None or removed is None or not len(removed):
        return text
    gone = {bytes(r) for r in removed}
    return "\n".join(line for line in text.split("\n") if not (own := WORD.findall(line)) or line_hash(own) not in gone)
