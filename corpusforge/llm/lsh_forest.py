"""Near-duplicate join on word shingles with a MinHash LSH forest.

A document is the set of its five-word shingles. Documents with equal sets are
one entry. An entry has one signature of minima a tree; the signatures of a tree,
sorted, are a trie, and entries below the same node are candidates. The depth of
that node starts at the full signature and is shortened until a pair at the
threshold is met in some tree with the target probability.

Candidates are tied together into groups by one link per member and node (never
by all pairs of a node). The texts of a group then meet, in blocks of bounded
size, and every pair of them is verified on its shingles. Links are counted
there; what leaves a block are counts and a spanning forest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from corpusforge.llm.common import parts, require, temporary, written
from corpusforge.llm.components import components

WORD = re.compile(r"\w+")
#: Members and bytes of text in a block of a group.
MEMBERS, BYTES = 512, 8 << 20
#: A shingle in more documents of a block pair than this is a column of a matrix.
DENSE = 8


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `words` words of a whole
    text, in lower case and without punctuation. A shorter text is one run; a
    text without words has none."""
    found = WORD.findall(text.lower()) if text else []
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = max(1, hashes.size - words + 1)
    run = np.zeros(n, np.uint64)
    for k in range(min(words, hashes.size)):
        run = run * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n]
    run ^= run >> np.uint64(29)
    run *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(run ^ run >> np.uint64(32))


def depth_for(threshold: float, trees: int, deepest: int, recall: float) -> int:
    """The longest prefix at which a pair as alike as `threshold` shares a node
    of some tree with probability `recall`."""
    for depth in range(deepest, 0, -1):
        if 1 - (1 - threshold ** depth) ** trees >= recall:
            return depth
    raise ValueError(f"{trees} trees cannot reach recall {recall} at {threshold}")


class Forest:
    """Nodes of an entry: one a tree, at the given depth."""

    def __init__(self, trees: int, depth: int, seed: int = 1):
        random = np.random.default_rng(seed)
        self.trees, self.depth = trees, depth
        self.factor = random.integers(1, 1 << 63, trees * depth, np.uint64) * np.uint64(2) + np.uint64(1)
        self.shift = random.integers(0, 1 << 63, trees * depth, np.uint64)

    def nodes(self, found: np.ndarray) -> np.ndarray:
        least = np.full(self.factor.size, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, found.size, 1024):
            mixed = found[None, at:at + 1024] * self.factor[:, None] + self.shift[:, None]
            np.minimum(least, (mixed >> np.uint64(20)).min(axis=1), out=least)
        prefix = least.reshape(self.trees, self.depth)
        node = np.arange(1, self.trees + 1).astype(np.uint64)
        for k in range(self.depth):
            node = (node ^ prefix[:, k]) * np.uint64(0xFF51AFD7ED558CCD)
            node ^= node >> np.uint64(31)
        return node.view(np.int64)


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shared shingles of each set in `left` with each in `right` (positions)."""
    shared = np.zeros((left.size, right.size), np.int64)
    sizes = np.array([s.size for s in sets])
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    place = np.full(len(sets), -1), np.full(len(sets), -1)
    place[0][left], place[1][right] = np.arange(left.size), np.arange(right.size)
    count = np.bincount(column, minlength=values.size)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    starts = np.concatenate([[0], np.cumsum(count)])
    # Shingles of few documents: their pairs. Of one document only: nothing.
    for n in range(2, DENSE + 1):
        rows = owner[starts[:-1][count == n][:, None] + np.arange(n)]
        for i in range(n):
            for j in range(n):
                if i != j:
                    a, b = place[0][rows[:, i]], place[1][rows[:, j]]
                    fit = (a >= 0) & (b >= 0)
                    np.add.at(shared, (a[fit], b[fit]), 1)
    # Shingles of many documents: a product of 0/1 matrices, some columns at a time.
    many = np.flatnonzero(count > DENSE)
    for at in range(0, many.size, 4096):
        some = many[at:at + 4096]
        matrix = np.zeros((len(sets), some.size), np.float32)
        sizes_here = count[some]
        flat = np.repeat(starts[some], sizes_here) + np.arange(sizes_here.sum()) - np.repeat(np.cumsum(sizes_here) - sizes_here, sizes_here)
        matrix[owner[flat], np.repeat(np.arange(some.size), sizes_here)] = 1
        shared += (matrix[left] @ matrix[right].T).astype(np.int64)
    return shared


def verify(names: list, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, list]:
    """Links of each set, and links that span the same groups as all of them."""
    shared = overlaps(sets, left, right)
    sizes = np.array([s.size for s in sets])
    union = sizes[left][:, None] + sizes[right][None, :] - shared
    linked = (shared >= threshold * union) & (left[:, None] != right[None, :])
    links = np.zeros(len(sets), np.int64)
    within = left.size == right.size and (left == right).all()
    links[left] += linked.sum(axis=1)
    if not within:
        links[right] += linked.sum(axis=0)
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    forest = []
    for i in range(left.size):
        for j in right[np.flatnonzero(linked[i])]:
            a, b = root(int(left[i])), root(int(j))
            if a != b:
                parent[a] = b
                forest.append((names[left[i]], names[j]))
    return links, forest


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = 0.8,
                    words: int = 5, trees: int = 32, deepest: int = 12, recall: float = 0.9999) -> DataFrame:
    """One row per row of `docs`: id, class_id, links, copies, text_key (xxhash64 of the text).

    class_id is the smallest id of the near-duplicate class (all that links of
    Jaccard `threshold` or more hold together), links the number of different
    shingle sets that the document's is linked to, copies the number of rows with
    its set. A pair at the threshold is found with probability `recall`, a more
    similar one nearly surely. NULL, empty and wordless texts are alone: class_id
    is their own id, 0 links, 1 copy. Repeated rows count as copies.
    """
    require(docs, [id_column, text])
    depth = depth_for(threshold, trees, deepest, recall)
    kind = docs.schema[id_column].dataType.simpleString()

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = Forest(trees, depth)
        for batch in parts(batches):
            rows = []
            for value in batch["text"]:
                found = shingles(value, words)
                rows.append((xxhash.xxh3_128_digest(found.tobytes()), forest.nodes(found)) if found.size else (None, None))
            yield pd.DataFrame({"id": batch["id"].to_numpy(), "key": batch["key"].to_numpy(),
                                "entry": pd.Series([r[0] for r in rows], dtype=object),
                                "nodes": pd.Series([r[1] for r in rows], dtype=object)})

    def verified(group: pd.DataFrame) -> pd.DataFrame:
        names, texts = group["entry"].tolist(), group["text"].tolist()
        block, i, j = group["block"].to_numpy(), group["i"].iloc[0], group["j"].iloc[0]
        links, forest = verify(names, [shingles(t, words) for t in texts], np.flatnonzero(block == i),
                               np.flatnonzero(block == j), threshold)
        some = np.flatnonzero(links)
        return pd.DataFrame({
            "a": pd.Series([names[k] for k in some] + [a for a, _ in forest], dtype=object),
            "b": pd.Series([None] * some.size + [b for _, b in forest], dtype=object),
            "links": np.concatenate([links[some], np.zeros(len(forest), np.int64)])})

    given = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    given = given.withColumn("key", F.xxhash64("text"))
    rows = written(given.mapInPandas(entries, f"id {kind}, key long, entry binary, nodes array<long>"), "entries")
    own = rows.filter("entry IS NOT NULL")
    sets = own.groupBy("entry").agg(F.count("*").alias("copies"), F.min("id").alias("id"))

    # One link a member and node: to the node's smallest entry.
    member = own.select("entry", F.explode("nodes").alias("node")).distinct()
    least = member.groupBy("node").agg(F.min("entry").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    ties = member.join(least, "node").filter("entry <> first").select(F.col("entry").alias("a"), F.col("first").alias("b"))
    groups = components(ties).select(F.col("node").alias("entry"), F.col("label").alias("group"))

    # The text of one row of each entry that is in a group.
    chosen = groups.join(own.groupBy("entry").agg(F.min(F.struct("key", "id")).alias("row")), "entry")
    chosen = chosen.select("entry", "group", F.col("row.key").alias("key"), F.col("row.id").alias("of"))
    texts = (given.join(chosen, "key").filter(F.equal_null("id", "of")).select("entry", "group", "text")
             .dropDuplicates(["entry"]))
    texts = written(texts, "group-texts")
    # Blocks are bounded in members and in bytes, whatever the size of a group.
    blocks = F.greatest(F.ceil(F.count("*") / MEMBERS), F.ceil(F.sum(F.octet_length("text")) / BYTES)).cast("int")
    placed = texts.join(texts.groupBy("group").agg(blocks.alias("blocks")), "group")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("entry"), F.col("blocks")).cast("int"))
    units = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "entry", "text", "group", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    found = written(units.groupBy("group", "i", "j").applyInPandas(verified, "a binary, b binary, links long"), "verified")

    classes = components(found.filter("b IS NOT NULL").select("a", "b"))
    counts = found.filter("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    facts = (sets.join(classes, sets["entry"] == classes["node"], "left").drop("node")
             .join(counts, sets["entry"] == counts["a"], "left").drop("a")
             .withColumn("label", F.coalesce("label", "entry")))
    smallest = facts.groupBy("label").agg(F.min("id").alias("class_id"))
    facts = facts.join(smallest, "label").select("entry", "class_id", F.coalesce("links", F.lit(0)).alias("links"), "copies")
    alone = rows.filter("entry IS NULL").select(F.col("id").alias(id_column), F.col("id").alias("class_id"),
                                                F.lit(0).cast("long").alias("links"), F.lit(1).cast("long").alias("copies"),
                                                F.col("key").alias("text_key"))
    return own.select("id", "key", "entry").join(facts, "entry").select(
        F.col("id").alias(id_column), "class_id", "links", "copies", F.col("key").alias("text_key")).unionByName(alone)


def one_per_class(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """`docs` with one row of each near-duplicate class: the one with the
    smallest id (of equal ids, the smallest text key). Wordless texts stay, each
    once an id; all columns stay.
    """
    found = near_duplicates(docs, id_column, text, **settings).select(F.col(id_column).alias("id"), "class_id", "text_key")
    # A class without any id has its texts' keys only.
    first = F.col("id").eqNullSafe(F.col("class_id"))
    leaders = written(found.filter(first & F.col("id").isNotNull()).groupBy("id").agg(F.min("text_key").alias("leader"))
                      .unionByName(found.filter(first & F.col("id").isNull()).select("id", F.col("text_key").alias("leader")).distinct()), "leaders")
    key, of, leader = temporary(docs, "key"), temporary(docs, "of"), temporary(docs, "leader")
    leaders = leaders.select(F.col("id").alias(of), F.col("leader").alias(leader))
    keyed = docs.withColumn(key, F.xxhash64(text))
    return (keyed.join(leaders, F.col(key).eqNullSafe(F.col(leader)) & F.col(id_column).eqNullSafe(F.col(of)))
            .drop(of, leader).dropDuplicates([id_column, key]).drop(key))
