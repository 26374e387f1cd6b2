"""Document fingerprints by spot signatures (SpotSigs), in SQL functions only.

A signature is a chain of content words that follows an anchor: a common word,
the start of a line, or a sign that stands alone. Navigation and boilerplate
have few common words, so running prose decides. A document's fingerprint is the
sorted set of its signatures' hashes, and two documents are alike as far as
their sets are (Jaccard). Sets whose sizes alone rule out a likeness are not
compared, and a join only pairs sets of the same or a neighbouring size class.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusforge.llm.common import below_rate, require

#: Common words of English, French, German and Spanish that start a chain.
ANCHORS = (
    "a an and are as at be by for from has have in is it of on or that the this to was were which with "
    "au aux avec ce dans de des du en est et il la le les ne ou par pas pour qu que qui sur un une "
    "als auf aus bei das dem den der die ein eine für im ist mit nicht sich und von zu "
    "al como con del el es las lo los no para por se su y"
).split()
MARK = "·"
BITS = 40


def signatures(text: Column, chain: int = 3, anchors: Sequence[str] = ANCHORS) -> Column:
    """Sorted distinct hashes (long) of the chains of a text; NULL counts as empty.

    A chain is up to `chain` content words, fewer only at the end of the text.
    Letter case, punctuation and the anchors themselves do not matter. A text of
    nothing but anchors has one signature, the text; one without any word, none.
    """
    lines = F.concat(F.lit("\n"), F.lower(F.coalesce(text, F.lit(""))), F.lit("\n"))
    # Line starts and signs that stand alone, then all other signs, then common words.
    marked = F.regexp_replace(lines, r"\s*\n\s*|(?<=\s)[^\p{L}\p{N}\s]++(?=\s)", f" {MARK} ")
    words = F.regexp_replace(marked, rf"[^\p{{L}}\p{{N}}{MARK}]++", " ")

    def chains(spotted: Column) -> Column:
        return F.array_distinct(F.regexp_extract_all(
            spotted, F.lit(rf"{MARK}(?=((?:(?: {MARK})*+ [^ {MARK}]++){{1,{chain}}}))"), F.lit(1)))

    def hashes(found: Column) -> Column:
        return F.sort_array(F.array_distinct(F.transform(found, lambda c: _hash(F.regexp_replace(c, f" {MARK}", "")))))

    def alone(words: Column) -> Column:
        bare = F.trim(F.translate(words, MARK, ""))
        return F.when(bare == "", F.array().cast("array<bigint>")).otherwise(F.array(_hash(bare)))

    common = F.regexp_replace(words, f" {_one_of(anchors)}(?= )", f" {MARK}")
    # A text of anchors only is rare: its words are computed again for it.
    return once(chains(common), lambda found: F.when(F.size(found) > 0, hashes(found)).otherwise(alone(words)))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _one_of(words: Sequence[str]) -> str:
    """A pattern for any of the words that looks at each letter once."""
    heads: dict[str, list[str]] = {}
    for word in sorted(set(words)):
        heads.setdefault(word[:1], []).append(word[1:])
    rests = [re.escape(head) + (_one_of(more) if any(more) else "") for head, more in heads.items() if head]
    return f"(?:{'|'.join(rests)})" + ("?+" if "" in heads else "")


def _hash(c: Column) -> Column:
    return F.xxhash64(c).bitwiseAND(F.lit((1 << BITS) - 1))


def fingerprint(found: Column) -> Column:
    """Signatures as text: ten hexadecimal digits each, ascending; "" for none."""
    return F.array_join(F.transform(found, lambda h: F.lpad(F.lower(F.hex(h)), BITS // 4, "0")), "")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard of two signature sets; 1 for two empty ones. Where the sizes alone
    keep it below `at_least`, the sets are not compared and the result is 0."""
    fewer, more = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    return (F.when(more == 0, 1.0).when((fewer == 0) | (fewer < at_least * more), 0.0)
            .otherwise(both / (fewer + more - both)))


def similar_pairs(docs: DataFrame, at_least: float = 0.8, id_column: str = "doc_id", text: str = "text",
                  chain: int = 3) -> DataFrame:
    """Pairs (a, b, likeness) of distinct fingerprints, each named by its smallest id.

    Documents with equal fingerprints are one (see `fingerprint` for membership).
    A set of n signatures is filed under its size class and its n - ceil(t n) + 1
    rarest signatures: two sets as alike as t share one of these. A pair meets
    once, under the first such signature both have, and is then compared.
    """
    require(docs, [id_column, text])
    sets = (docs.select(F.col(id_column).alias("id"), signatures(F.col(text), chain).alias("sig"))
            .filter(F.size("sig") > 0).groupBy("sig").agg(F.min("id").alias("id")))
    each = sets.select("id", "sig", F.explode("sig").alias("s"))
    count = each.groupBy("s").agg(F.count("*").alias("n"))
    rare = (each.select("id", "s").join(count, "s").groupBy("id")
            .agg(F.array_sort(F.collect_list(F.struct("n", "s"))).alias("order")))
    kept = F.size("order") - F.ceil(F.lit(at_least) * F.size("order")).cast("int") + 1
    filed = sets.join(rare, "id").withColumn("prefix", F.slice("order", F.lit(1), kept)["s"])
    size_class = F.floor(F.log(F.size("sig").cast("double")) / -math.log(at_least)).cast("int")
    filed = filed.select("id", "sig", "prefix", size_class.alias("class"))
    left = filed.select("*", F.explode("prefix").alias("s"))
    right = left.select("*", F.explode(F.array(F.col("class"), F.col("class") + 1)).alias("at")).drop("class")
    a, b = left.alias("a"), right.alias("b")
    meets = (F.col("a.s") == F.col("b.s")) & (F.col("a.class") == F.col("b.at"))
    one = (F.col("a.s") == F.array_min(F.array_intersect("a.prefix", "b.prefix"))) & (F.col("a.id") != F.col("b.id"))
    pairs = a.join(b, meets & one).select(
        F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b"),
        likeness(F.col("a.sig"), F.col("b.sig"), at_least).alias("likeness"))
    return pairs.filter(F.col("likeness") >= at_least).distinct()


def with_next(docs: DataFrame, id_column: str, text: str, per_bucket: int = 2000, most: int = 1024) -> DataFrame:
    """(bucket, ghost, id, text, next text) in descending order of the id.

    The ids are cut into buckets of about equal numbers (at most `most`), which
    windows follow one by one. The first document of a bucket is also put, as a
    ghost, at the end of the bucket before it, and the very first one at the end
    of the last. NULL ids come last; equal ids by their texts' hashes.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = rows.count()
    buckets = max(1, min(most, n // per_bucket))
    # Some 20 ids a bucket, drawn by hash and put in order by Spark: cuts for ids of any type.
    drawn = []
    if buckets > 1:
        some = rows.filter(F.col("id").isNotNull() & below_rate(F.col("id"), 20 * buckets / n))
        drawn = [r["id"] for r in some.select("id").distinct().orderBy("id").collect()]
    bounds = [drawn[k * len(drawn) // buckets] for k in range(1, buckets)] if drawn else []
    bounds = list(dict.fromkeys(bounds))
    above = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("id"))) if bounds else F.lit(0)
    rows = rows.withColumn("bucket", F.when(F.col("id").isNull(), -1).otherwise(above))
    # At most `most` + 1 rows of two numbers.
    firsts = [(r["bucket"], r["id"]) for r in rows.groupBy("bucket").agg(F.max("id").alias("id")).orderBy("bucket").collect()]
    ghosts = [(i, firsts[k + 1][0], 0) for k, (_, i) in enumerate(firsts[:-1])]
    ghosts += [(firsts[-1][1], firsts[0][0], 1)] if firsts else []
    table = docs.sparkSession.createDataFrame(
        ghosts, f"first {docs.schema[id_column].dataType.simpleString()}, to int, wrap int")
    lists = table.groupBy("first").agg(F.collect_list(F.struct("to", "wrap", F.lit(True).alias("ghost"))).alias("more"))
    own = F.struct(F.col("bucket").alias("to"), F.lit(0).alias("wrap"), F.lit(False).alias("ghost"))
    placed = rows.join(F.broadcast(lists), F.col("id").eqNullSafe(F.col("first")), "left").select(
        "id", "text", F.explode(F.concat(F.array(own), F.coalesce("more", F.array().cast(
            "array<struct<to:int,wrap:int,ghost:boolean>>")))).alias("at"))
    order = _order()
    return (placed.select(F.col("at.to").alias("bucket"), F.col("at.wrap").alias("wrap"), F.col("at.ghost").alias("ghost"),
                          "id", "text", F.xxhash64("text").alias("tie"))
            .withColumn("next", F.lead("text").over(order)))


def _order():
    return Window.partitionBy("bucket").orderBy("wrap", F.col("id").desc_nulls_last(), "tie")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", chain: int = 3,
                 at_least: float = 0.0) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and likenesses.

    The edited text of n code points keeps the first n - floor(n/2) and goes on
    with the first floor(n/2) of the next document's (all, if it has fewer).
    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, size_class. A NULL text counts as empty; a repeated
    row gets a row of its own; a lone document's next one is itself.
    """
    require(docs, [id_column, text])
    rows = with_next(docs, id_column, text)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half),
                      F.substring("next", F.lit(1), half))
    rows = rows.withColumn("edited", edited).drop("next")
    rows = rows.withColumn("sig", signatures(F.col("text"), chain))
    rows = rows.withColumn("next_sig", F.lead("sig").over(_order())).filter(~F.col("ghost"))
    rows = rows.withColumn("edited_sig", signatures(F.col("edited"), chain))
    return rows.select(
        F.col("id").alias("doc_id"), F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("sig")).alias("fingerprint"),
        fingerprint(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig"), at_least).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig"), at_least).alias("near_next"),
        F.floor(F.log(F.greatest(F.size("sig"), F.lit(1)).cast("double")) / -math.log(0.8)).cast("int").alias("size_class"))
