"""Exact top-k search by inner product over norm-sorted, rotated vectors.

Vectors are sorted by descending length and packed into blocks, whose numbers
take as few bytes as hold them. They are rotated onto the singular vectors of
the whole table, so that a few leading coordinates hold most of an inner product
and the rest is bounded by Cauchy-Schwarz.

A query starts with the k-th best score among the longest vectors. A group of
blocks is skipped if its longest vector cannot reach that score, a block or a
chunk of it likewise; what remains gets a partial sum over the leading
coordinates, and only where that and the product of the residual lengths reach
the k-th best score is the whole product computed, on the integers themselves.

A task holds a part of the packs of queries and takes a group's blocks one after
another; the k best so far of each query are all that stays of a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusforge.llm.common import require, written

#: Vectors in a block, queries in a pack, vectors looked at together.
BLOCK, PACK, CHUNK = 2048, 512, 512
#: Levels of norm that blocks are grouped by, and groups that share a level: blocks of one length do not meet in one task.
LEVELS, SHARES = 4, 4
#: Parts of the packs, at least, and bytes that a task may take for the queries of one part.
PARTS, HELD = 8, 1 << 27
PACKED = "pack long, norm double, ids binary, rows binary, data binary"
#: What a block's numbers are kept as, by their bytes.
KINDS = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.float64}
#: Of rounding in sums of products of coordinates.
SLACK = 1e-6


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; NULL for a vector that is NULL or has
    a component that is NULL or not finite."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(doubles, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.when(sound, F.transform(doubles, lambda x: F.floor(x * scale).cast("double")))


def _shortest(data: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them all."""
    most = np.abs(data).max(initial=0)
    return next((data.astype(kind) for kind in list(KINDS.values())[:-1] if most <= np.iinfo(kind).max), data)


def _packs(rows: DataFrame, size: int, width: int) -> DataFrame:
    """Rows of each partition, in their order, `size` at a time."""
    schema = pa.schema([("pack", pa.int64()), ("norm", pa.float64()), ("ids", pa.binary()), ("rows", pa.binary()), ("data", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []

        def made(ids, own, square, data) -> pa.RecordBatch:
            one = {"pack": int(own[0]), "norm": float(np.sqrt(square.max())), "ids": ids.tobytes(), "rows": own.tobytes(), "data": _shortest(data).tobytes()}
            return pa.RecordBatch.from_pylist([one], schema)

        for batch in batches:
            data = np.zeros((batch.num_rows, width))
            data[np.arange(width) < batch.column("v").value_lengths().to_numpy()[:, None]] = batch.column("v").flatten().to_numpy()
            kept.append((*(batch.column(c).to_numpy() for c in ("id", "row", "square")), data))
            if sum(len(x[0]) for x in kept) >= size:
                whole = [np.concatenate(x) for x in zip(*kept, strict=True)]
                cut = len(whole[0]) - len(whole[0]) % size
                for at in range(0, cut, size):
                    yield made(*(x[at:at + size] for x in whole))
                kept = [tuple(x[cut:].copy() for x in whole)]
        if any(len(x[0]) for x in kept):
            yield made(*(np.concatenate(x) for x in zip(*kept, strict=True)))

    return rows.select("id", "row", "square", "v").mapInArrow(pack, PACKED)


def _numbers(data: bytes, n: int, width: int) -> np.ndarray:
    return np.frombuffer(data, KINDS[len(data) // (n * width)]).reshape(n, width).astype(np.float64)


def _unpack(row, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, rows = np.frombuffer(row.ids, np.int64), np.frombuffer(row.rows, np.int64)
    return ids, rows, _numbers(row.data, len(ids), width)


def rotation(blocks: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of the table, by descending singular value, from
    the sum of the blocks' products."""

    def product(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for batch in batches:
            for row in batch.itertuples():
                data = _numbers(row.data, row.n, width)
                total += data.T @ data
        yield pd.DataFrame({"at": np.arange(width * width), "x": total.ravel()})

    sized = blocks.select("data", (F.length("ids") / 8).cast("int").alias("n"))
    sums = sized.mapInPandas(product, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).toArrow()  # width * width numbers
    flat = np.zeros(width * width)
    flat[sums["at"].to_numpy()] = sums["x"].to_numpy()
    values, vectors = np.linalg.eigh(flat.reshape(width, width))
    return vectors[:, np.argsort(-values, kind="stable")]


class Turned:
    """Vectors with what their products and bounds are made of: the numbers
    themselves, and the leading rotated coordinates with the length of the rest."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, data: np.ndarray, turn: np.ndarray, head: int, kind: type):
        turned = data @ turn
        self.ids, self.rows, self.norm = ids, rows, np.linalg.norm(data, axis=1)
        self.data = data.astype(kind)
        self.bound = np.column_stack([turned[:, :head], np.linalg.norm(turned[:, head:], axis=1)]).astype(kind)


def by_chunk(ids: np.ndarray, rows: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, ...]:
    """A block's vectors, those of a chunk by id: of equal scores the first are the best."""
    place = np.lexsort((rows, ids, np.arange(len(ids)) // CHUNK))
    return ids[place], rows[place], data[place]


class Search:
    """Best candidates of one pack of queries, over blocks as they come."""

    def __init__(self, queries: Turned, k: int, least: np.ndarray):
        n, self.queries, self.k, self.least = len(queries.ids), queries, k, least.copy()
        self.score = np.full((n, k), -np.inf)
        self.ids, self.rows = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.slack = max(SLACK, (queries.data.shape[1] + 16) * float(np.finfo(queries.data.dtype).eps))

    def over(self, block: Turned) -> None:
        """Takes in the block's candidates, as far as they can belong to the k best of a query."""
        own, kind = self.queries, self.queries.data.dtype
        for at in range(0, len(block.ids), CHUNK):
            part = slice(at, at + CHUNK)
            longest = block.norm[part].max()
            slack = self.slack * (1 + own.norm * longest)
            active = np.flatnonzero(own.norm * longest + slack >= self.least)
            if not active.size:
                break  # what follows is shorter still
            some = active if active.size < len(own.ids) else slice(None)
            near = own.bound[some] @ block.bound[part].T >= (self.least - slack)[some, None].astype(kind)
            share = np.count_nonzero(near) / near.size
            if not share:
                continue
            # All products at once unless few pairs are left.
            if share > 0.05:
                score = own.data[some] @ block.data[part].T
                hit = np.flatnonzero(self.best(score, active))
                (q, column), score = divmod(hit, score.shape[1]), score.ravel()[hit]
            else:
                q, column = divmod(np.flatnonzero(near), near.shape[1])
                score = np.einsum("ij,ij->i", own.data[active[q]], block.data[at + column])
                high = score >= self.least[active[q]]
                q, column, score = q[high], column[high], score[high]
            if q.size:
                self.waiting.append((active[q], score.astype(np.float64), block.ids[at + column], block.rows[at + column]))
                if sum(len(x[0]) for x in self.waiting) * 4 > self.score.size:
                    self.add()

    def best(self, score: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Which scores of a chunk can be among the k best. One more stays than
        is asked for, since a query may meet itself."""
        most, width = self.k + 1, score.shape[1]
        high = score >= self.least[active, None].astype(score.dtype)
        if width <= most or np.count_nonzero(high) <= 2 * most * len(active):
            return high
        self.least[active] = np.maximum(self.least[active], np.partition(score, width - most, axis=1)[:, width - most])
        least = self.least[active, None].astype(score.dtype)
        high = score >= least
        if np.count_nonzero(high) > 2 * most * len(active):
            equal = score == least
            high &= ~equal | (np.cumsum(equal, axis=1, dtype=np.int32) <= most)
        return high

    def add(self) -> None:
        """The k best of what the queries have and of what waits: ties to the smaller id, then row."""
        if not self.waiting:
            return
        q, score, ids, rows = (np.concatenate(x) for x in zip(*self.waiting, strict=True))
        self.waiting, other = [], rows != self.queries.rows[q]
        met = np.zeros(len(self.least), bool)
        met[q[other]] = True
        old, place = np.nonzero((self.score > -np.inf) & met[:, None])
        q, score = np.append(old, q[other]), np.append(self.score[old, place], score[other])
        ids, rows = np.append(self.ids[old, place], ids[other]), np.append(self.rows[old, place], rows[other])
        order = np.lexsort((rows, ids, -score, q))
        q, score, ids, rows = q[order], score[order], ids[order], rows[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        top = rank < self.k
        at = q[top], rank[top]
        self.score[at], self.ids[at], self.rows[at] = score[top], ids[top], rows[top]
        self.least = np.maximum(self.least, self.score[:, -1])

    def found(self) -> pa.RecordBatch:
        self.add()
        q, place = np.nonzero(self.score > -np.inf)
        return pa.RecordBatch.from_pydict({"query_id": self.queries.ids[q], "query_row": self.queries.rows[q], "vec_id": self.ids[q, place],
                                           "row": self.rows[q, place], "score": self.score[q, place].astype(np.int64)})


def top_k(vectors: DataFrame, is_query: Column, id_column: str = "vec_id", vector: str = "embedding", k: int = 20,
          scale: int = 64, head_share: float = 0.25) -> DataFrame:
    """The k best rows of each query: query_id, rank (from 1), vec_id, score.

    A query is a row of the table where `is_query` holds; every other row is a
    candidate, itself excluded. Scores are inner products of floor(scale * x),
    exact up to 2^53. Ties go to the smaller id. Rows with NULL id, and vectors
    that are NULL or have a NULL or non-finite component, take no part; a shorter
    vector counts as filled up with zeros. Repeated rows are rows of their own.
    """
    require(vectors, [id_column, vector])
    spark = vectors.sparkSession
    # The condition is on the given table; inside, its columns have names of this module.
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), integers(F.col(vector), scale).alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("q")).dropna(subset=["id", "v"])
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    rows = written(rows.select("id", "v", "q", square.alias("square"), F.monotonically_increasing_id().alias("row")), "vectors")
    facts = rows.agg(F.count("*").alias("n"), F.count_if("q").alias("asked"), F.max(F.size("v")).alias("width")).first()
    empty = "query_id long, rank int, vec_id long, score long"
    if not facts["n"] or not facts["width"]:
        return spark.createDataFrame([], empty)
    width, n_blocks = facts["width"], max(1, facts["n"] // BLOCK)
    # A large table has several blocks a slice: the driver samples the range's key for each slice.
    slices = min(4096, max(min(64, n_blocks), n_blocks // 8))
    head = max(1, round(width * head_share))
    # The id is part of the range's key: vectors of one length do not meet in one task.
    by_norm = rows.repartitionByRange(slices, F.desc("square"), "id", "row").sortWithinPartitions(F.desc("square"), "id", "row")
    blocks = written(_packs(by_norm, BLOCK, width), "blocks")
    turn = rotation(blocks, width)

    # The longest vectors, of one block's number. Only norms are ordered: each task sends its first rows to the driver.
    first = [r["pack"] for r in blocks.select("norm", "pack").orderBy(F.desc("norm"), "pack").limit(2).collect()]
    first = sorted(blocks.filter(F.col("pack").isin(first)).collect(), key=lambda r: (-r["norm"], r["pack"]))
    seeds = [np.concatenate(x) for x in zip(*(_unpack(r, width) for r in first), strict=True)]
    longest = np.argsort(-np.linalg.norm(seeds[2], axis=1), kind="stable")[:BLOCK]
    # Sums of products stay whole in 24 bits, unless vectors are long.
    kind = np.float32 if first[0]["norm"] ** 2 < 1 << 24 else np.float64
    seed = spark.sparkContext.broadcast((turn, *(x[longest] for x in seeds)))

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, ids, own, data = seed.value
        for batch in batches:
            least = []
            for row in batch.itertuples():
                q_ids, q_rows, q = _unpack(row, width)
                scores = np.where(own[None, :] == q_rows[:, None], -np.inf, q @ data.T)
                place = max(0, scores.shape[1] - k)
                kth = np.partition(scores, place, axis=1)[:, place] if scores.shape[1] >= k else np.full(len(q_ids), -np.inf)
                least.append(kth)
            norms = [np.linalg.norm(_unpack(r, width)[2], axis=1) for r in batch.itertuples()]
            # The shortest vector that can still matter to a query of the pack; 0 unless all need a length.
            need = [float(np.where(m > 0, t / np.maximum(n, 1e-12), 0).min()) * (1 - SLACK) if len(n) else 0.0
                    for n, t, m in ((n, t, (t > 0) & (n > 0)) for n, t in zip(norms, least, strict=True))]
            yield batch.assign(least=[x.tobytes() for x in least], need=need)

    asked = _packs(rows.filter("q").repartition(max(1, min(4096, facts["asked"] // (4 * PACK))), "row"), PACK, width)
    asked = written(asked.mapInPandas(start, PACKED + ", least binary, need double"), "queries")

    # Groups of blocks by norm, several of one level. Parts of the packs: their queries stay in a task.
    levels, shares = max(1, min(n_blocks // 32, max(LEVELS, min(64, n_blocks // 2048)))), min(SHARES, n_blocks)
    cuts = blocks.agg(F.percentile_approx("norm", [i / levels for i in range(1, levels)], 100 * levels)).first()[0] if levels > 1 else []
    level = F.size(F.filter(F.array(*map(F.lit, sorted(set(cuts)))), lambda c: c < F.col("norm"))) if cuts else F.lit(0)
    blocks = blocks.withColumn("group", level * shares + F.pmod(F.xxhash64("pack"), F.lit(shares)).cast("int"))
    held = facts["asked"] * (width * 12 + k * 24 + 100)
    parts = max(1, min(facts["asked"] // PACK, max(PARTS, held // HELD)))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("pack"), F.lit(parts)).cast("int"))

    # A group goes to a pack, and a block to a part, only where its longest vector can still matter.
    tops = blocks.groupBy("group").agg(F.max("norm").alias("x")).collect()
    needs = asked.groupBy("part").agg(F.min("need").alias("x")).collect()

    def where(key: str, found: list, passes) -> Column:
        """The keys whose number passes."""
        listed = F.array(*[F.struct(F.lit(r[key]).alias("key"), F.lit(r["x"]).alias("x")) for r in sorted(found)])
        return F.explode(F.transform(F.filter(listed, lambda c: passes(c["x"])), lambda c: c["key"])).alias(key)

    if not needs:
        return spark.createDataFrame([], empty)
    parcel = "norm", "ids", "rows", "data"
    sent = asked.select("part", where("group", tops, lambda x: x >= F.col("need")), *parcel, "least")
    sent = sent.unionByName(blocks.select("group", where("part", needs, lambda x: x <= F.col("norm")), *parcel, F.lit(None).cast("binary").alias("least")))
    # The packs of a part come first, then a group's blocks, the longest vectors at the front.
    sent = sent.repartition(len(tops) * len(needs), "part", "group").sortWithinPartitions("part", "group", F.col("least").isNull(), F.desc("norm"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, at, packs = seed.value[0], None, []
        for batch in batches:
            for n in range(batch.num_rows):
                of = {c: batch.column(c)[n] for c in batch.schema.names}
                if at != (key := (of["part"].as_py(), of["group"].as_py())):
                    yield from (p.found() for p in packs)
                    at, packs = key, []
                # Bytes of the batch itself: it may be large, and stands in memory once.
                ids, own = (np.frombuffer(of[c].as_buffer(), np.int64) for c in ("ids", "rows"))
                data = _numbers(of["data"].as_buffer(), len(ids), width)
                if of["least"].is_valid:
                    least = np.frombuffer(of["least"].as_buffer(), np.float64)
                    packs.append(Search(Turned(ids.copy(), own.copy(), data, turn, head, kind), k, least))
                elif packs:
                    block = Turned(*by_chunk(ids, own, data), turn, head, kind)
                    for p in packs:
                        p.over(block)
        yield from (p.found() for p in packs)

    hits = sent.mapInArrow(search, "query_id long, query_row long, vec_id long, row long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
