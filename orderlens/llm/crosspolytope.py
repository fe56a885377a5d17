"""Approximate nearest neighbours by inner product with cross-polytope hashing.

Candidates are scaled by the longest vector and lengthened by one component to unit length, queries are scaled to unit
length, so the largest inner product is the nearest direction. A pseudo-rotation (three rounds of random signs and a fast
Hadamard transform) turns a vector; its nearest signed axis is its hash. ``TABLES`` tables use rotations of their own. One
polytope has two buckets per dimension; larger tables combine further polytopes, so a bucket holds about ``BUCKET``
vectors at any size. A query probes the buckets whose axes it is nearest to, in order of the sum of its coordinates.

How many buckets it probes is fitted: ``SAMPLE`` queries, chosen by a hash of their id, are answered exactly by one pass
over all rows, and the fewest probes that find ``RECALL`` of these answers are taken for all. Every row is indexed.

Buckets are put together into blocks of about ``BLOCK`` vectors. A block that holds more, as one with a hot bucket does, is
split by vectors, one that many queries visit by queries too; a block's vectors and the queries that probe one of its
buckets meet in cells of bounded size. Candidates get their exact product, in double precision, and each cell returns its
best k. Queries that found fewer than k candidates though there are more probe every bucket in a second round.

Defined cases: vectors that are null, zero, hold a null or non-finite component, or have no id take no part; repeated
rows count once and rows that share the query's id are its own; an id with unlike vectors counts by its best product;
of equal vectors only the k + 1 smallest ids can be among anyone's best and are kept; a shorter vector counts as padded
with zeros; equal scores go to the smaller vec_id; fewer than k candidates give all of them; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored

TABLES = 2
BUCKET = 512  # vectors that a bucket holds on average, unless one polytope has more buckets than that needs
BLOCK = 16_384  # vectors of a block
QUERY_BLOCK = 16_384  # queries that meet a block at once
SAMPLE = 128  # queries that the number of probes is fitted to
RECALL = 0.96
CELLS = 1 << 22  # products that are held at once
SEED = 1509

FOUND = "query_id bigint, vec_id bigint, score double"
RESULT = "query_id bigint, rank int, vec_id bigint, score double"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of all rows, scaled to keep lengths; the width is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        pairs = x.reshape(n, width // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


@dataclass
class Hasher:
    """Rotations and bucket numbers. ``axes``: dimensions that each polytope of a table uses."""

    width: int
    longest: float
    axes: list[int]
    tables: int = TABLES

    @classmethod
    def of(cls, width: int, longest: float, vectors: int, tables: int = TABLES, bucket: int = BUCKET) -> Hasher:
        full = 1 << int(width).bit_length()  # room for one more component
        axes, buckets = [full], 2 * full
        while buckets * bucket < vectors:
            more = min(full, 1 << max(0, int(-(-vectors // (buckets * bucket)) - 1).bit_length() - 1))
            axes.append(more)
            buckets *= 2 * more
        return cls(width, longest, axes, tables)

    @property
    def buckets(self) -> int:
        return int(np.prod([2 * a for a in self.axes], dtype=np.int64))

    def _padded(self, x: np.ndarray, query: bool) -> np.ndarray:
        out = np.zeros((len(x), self.axes[0]))
        if query:
            out[:, : self.width] = x / np.sqrt((x * x).sum(1))[:, None]
        else:
            out[:, : self.width] = x / self.longest
            out[:, self.width] = np.sqrt(np.maximum(0, 1 - (out * out).sum(1)))
        return out

    def coordinates(self, x: np.ndarray, table: int, query: bool) -> list[np.ndarray]:
        """For each polytope of a table the nearness of each row to every signed axis."""
        x, out = self._padded(x, query), []
        for polytope, axes in enumerate(self.axes):
            signs = np.random.default_rng([SEED, table, polytope]).integers(0, 2, (3, self.axes[0])) * 2.0 - 1
            turned = x
            for s in signs:
                turned = hadamard(turned * s)
            out.append(np.concatenate([turned[:, :axes], -turned[:, :axes]], 1))
        return out

    def codes(self, x: np.ndarray, table: int) -> np.ndarray:
        """The bucket of every row."""
        code = np.zeros(len(x), np.int64)
        for near in self.coordinates(x, table, False):
            code = code * near.shape[1] + near.argmax(1)
        return code

    def probes(self, x: np.ndarray, table: int, count: int) -> np.ndarray:
        """The ``count`` buckets nearest to every query."""
        out = np.empty((len(x), min(count, self.buckets)), np.int64)
        step = max(1, CELLS // (max(count, 1) * 2 * max(self.axes)))
        for at in range(0, len(x), step):
            total = codes = None
            for near in self.coordinates(x[at : at + step], table, True):
                if total is None:
                    total, codes = near, np.broadcast_to(np.arange(near.shape[1]), near.shape)
                else:
                    codes = (codes[:, :, None] * near.shape[1] + np.arange(near.shape[1])).reshape(len(near), -1)
                    total = (total[:, :, None] + near[:, None, :]).reshape(len(near), -1)
                if total.shape[1] > count:
                    best = np.argpartition(-total, count - 1, axis=1)[:, :count]
                    total, codes = np.take_along_axis(total, best, 1), np.take_along_axis(codes, best, 1)
            out[at : at + step] = codes
        return out

    def depth(self, query: np.ndarray, neighbours: np.ndarray) -> np.ndarray:
        """How many buckets a query probes before each neighbour's, in the table where that is soonest."""
        out = np.full(len(neighbours), self.buckets)
        for table in range(self.tables):
            near = [n[0] for n in self.coordinates(query[None], table, True)]
            rest, code = np.zeros(len(neighbours)), self.codes(neighbours, table)
            for values in reversed(near):
                rest, code = rest + values[code % len(values)], code // len(values)
            prefix = np.zeros(1)
            for values in near[:-1]:
                prefix = (prefix[:, None] + values).ravel()
            last = np.sort(near[-1])
            before = [(len(last) - np.searchsorted(last, r - prefix - 1e-12)).sum() - 1 for r in rest]  # ties before it
            out = np.minimum(out, before)
        return out


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows side by side; equal rows give equal sums wherever they stand."""
    return (a * b).sum(1)


class Nearest:
    """The best k candidates of each query. Quick products choose, side by side products are returned."""

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, k: int):
        self.queries, self.ids, self.k = queries, query_ids, k
        self.top = np.full((len(queries), k), -np.inf)
        self.slack = 1e-9 * np.sqrt((queries * queries).sum(1))
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, who: np.ndarray, vectors: np.ndarray, ids: np.ndarray, length: float) -> None:
        """Let the queries ``who`` (places) see vectors no longer than ``length``."""
        step = max(1, CELLS // max(len(ids), 1))
        for at in range(0, len(who), step):
            some = who[at : at + step]
            near = self.queries[some] @ vectors.T
            near[self.ids[some][:, None] == ids] = -np.inf
            both = np.concatenate([self.top[some], near], 1)
            self.top[some] = np.partition(both, both.shape[1] - self.k, axis=1)[:, -self.k :]
            bar = self.top[some].min(1) - self.slack[some] * length
            row, column = np.nonzero((near >= bar[:, None]) & (near > -np.inf))
            self.parts.append((some[row], ids[column], _products(self.queries[some[row]], vectors[column])))
            self.held += len(row)
            if self.held > CELLS:
                self.parts = [self.best()]
                self.held = len(self.parts[0][0])

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of queries, ids and products, best first for each query, ties to smaller ids, each pair once."""
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        who, ids, score = (np.concatenate(p) for p in zip(*self.parts, strict=True))
        order = np.lexsort((ids, -score, who))
        who, ids, score = who[order], ids[order], score[order]
        new = np.ones(len(who), bool)
        new[1:] = (who[1:] != who[:-1]) | (ids[1:] != ids[:-1]) | (score[1:] != score[:-1])
        who, ids, score = who[new], ids[new], score[new]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        return who[place < self.k], ids[place < self.k], score[place < self.k]


def _copies(ids: np.ndarray) -> int:
    """How often the most frequent id occurs."""
    return int(np.unique(ids, return_counts=True)[1].max()) if len(ids) else 1


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, components as they are."""
    x, kind = F.col("embedding"), vectors.schema["embedding"].dataType
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(x, lambda c: c != 0)
    if not isinstance(kind.elementType, T.FloatType | T.DoubleType):
        x = x.cast("array<double>")
    return vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & fine).select("vec_id", x.alias("v"))


def fitted_probes(queries: DataFrame, candidates: DataFrame, hasher: Hasher, k: int, recall: float = RECALL, sample: int = SAMPLE) -> int:
    """The fewest probes that find ``recall`` of the exact answers of ``sample`` queries; both frames hold (id, v)."""
    drawn = queries.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).collect()  # ``sample`` rows
    names, asked = np.array([r[0] for r in drawn], np.int64), np.array([r[1] for r in drawn], np.float64)
    shared = queries.sparkSession.sparkContext.broadcast((names, asked))
    width = hasher.width

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, asked = shared.value
        best, vectors = Nearest(asked, names, k), {}
        for batch in batches:
            ids, v = batch.column(0).to_numpy(), _matrix(batch.column(1), width)
            best.add(np.arange(len(names)), v, ids, float(np.sqrt((v * v).sum(1)).max(initial=0)))
            best.parts, best.held = [best.best()], 0
            here = set(best.parts[0][1].tolist())
            vectors = {i: x for i, x in vectors.items() if i in here} | {i: x for i, x in zip(ids.tolist(), v, strict=True) if i in here}
        who, ids, score = best.best()
        yield pa.RecordBatch.from_arrays(
            [pa.array(who), pa.array(ids), pa.array(score), pa.array([vectors[i] for i in ids.tolist()], pa.list_(pa.float64()))],
            names=["query", "vec_id", "score", "v"],
        )

    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = candidates.mapInArrow(exact, "query bigint, vec_id bigint, score double, v array<double>")
    answers = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query", "v").collect()
    depths = [hasher.depth(asked[r[0]], np.array([r[1]])) for r in answers]  # k times ``sample`` rows
    depths = np.sort(np.concatenate(depths)) if depths else np.zeros(1, np.int64)
    return int(depths[min(len(depths) - 1, int(np.ceil(recall * len(depths))) - 1)]) + 1


def _blocks(code: np.ndarray, hasher: Hasher, blocks: int) -> np.ndarray:
    """The block of each bucket: equal ranges of the bucket numbers of all tables."""
    total = hasher.buckets * hasher.tables
    return code // -(-total // min(blocks, total))


def _indexed(candidates: DataFrame, hasher: Hasher, blocks: int) -> DataFrame:
    """(block, code, vec_id, v) of all candidates in all tables, stored."""
    width = hasher.width

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            for t in range(hasher.tables):
                code = hasher.codes(x, t) + t * hasher.buckets
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_blocks(code, hasher, blocks)), pa.array(code), *batch.columns], names=["block", "code", "vec_id", "v"]
                )

    kind = candidates.schema["v"].dataType.simpleString()
    return stored(candidates.mapInArrow(hashed, f"block bigint, code bigint, vec_id bigint, v {kind}"), "buckets")


def _visits(queries: DataFrame, hasher: Hasher, probes: int, blocks: int) -> DataFrame:
    """(block, query_id, codes, q): the buckets that each of ``queries`` (query_id, q) probes, by block."""
    width, kind = hasher.width, queries.schema["q"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            for t in range(hasher.tables):
                codes = np.sort(hasher.probes(x, t, probes) + t * hasher.buckets, axis=1)
                who, codes = np.repeat(np.arange(len(x)), codes.shape[1]), codes.ravel()
                block = _blocks(codes, hasher, blocks)
                new = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (who[1:] != who[:-1])]))
                lists = pa.ListArray.from_arrays(np.append(new, len(codes)).astype(np.int32), pa.array(codes))
                owner = pa.array(who[new])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block[new]), batch.column(0).take(owner), lists, batch.column(1).take(owner)],
                    names=["block", "query_id", "codes", "q"],
                )

    return queries.mapInArrow(run, f"block bigint, query_id bigint, codes array<bigint>, q {kind}")


def _searched(queries: DataFrame, index: DataFrame, hasher: Hasher, probes: int, k: int, blocks: int, block: int, query_block: int) -> DataFrame:
    """``FOUND``: the best k of every cell for ``queries`` (query_id, q), which probe ``probes`` buckets a table."""
    width = hasher.width
    visits = _visits(queries, hasher, probes, blocks)

    def parts(rows: DataFrame, size: int, name: str) -> DataFrame:
        return rows.groupBy("block").agg((F.floor((F.count("*") - 1) / size) + 1).cast("int").alias(name))

    cells = stored(parts(index, block, "parts").join(parts(visits, query_block, "query_parts"), "block"), "cells")
    left = index.join(cells, "block").select(
        "block", "code", "vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1)).alias("query_part"),
    )
    right = visits.join(cells, "block").select(
        "block", "query_id", "q", "codes", F.pmod(F.xxhash64("query_id", "q"), F.col("query_parts")).cast("int").alias("query_part"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
    )

    def cell(vectors: pa.Table, asking: pa.Table) -> pa.Table:
        who = found = np.zeros(0, np.int64)
        names, score = np.zeros(0, np.int64), np.zeros(0)
        if vectors.num_rows and asking.num_rows:
            code = vectors["code"].to_numpy()
            order = np.argsort(code, kind="stable")
            code, ids, v = code[order], vectors["vec_id"].to_numpy()[order], _matrix(vectors["v"], width)[order]
            names = asking["query_id"].to_numpy()
            best = Nearest(_matrix(asking["q"], width), names, k * _copies(ids))
            lists = asking["codes"].combine_chunks()
            wanted, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(names)), lists.value_lengths().to_numpy())
            order = np.argsort(wanted, kind="stable")
            wanted, owner = wanted[order], owner[order]
            length = float(np.sqrt((v * v).sum(1)).max())
            for c in np.unique(code):
                a, b = np.searchsorted(code, [c, c + 1])
                first, last = np.searchsorted(wanted, [c, c + 1])
                best.add(owner[first:last], v[a:b], ids[a:b], length)
            who, found, score = best.best()
        return pa.table({"query_id": names[who], "vec_id": found, "score": score})

    keys = ["block", "part", "query_part"]
    return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(cell, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    pairs = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, tables: int = TABLES, bucket: int = BUCKET, block: int = BLOCK,
    query_block: int = QUERY_BLOCK, recall: float = RECALL, probes: int | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other vectors found for each query.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on vec_id; ``probes`` replaces the fitted number.
    Runs jobs when called: the number of probes is fitted, and the index, the visits and the first round are stored.
    """
    spark = vectors.sparkSession
    vectors = usable_vectors(vectors.select("vec_id", "embedding"))
    squares = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    width, n, asked, longest = vectors.agg(
        F.max(F.size("v")), F.count("*"), F.count(F.when(is_query, 1)), F.max(F.sqrt(squares))
    ).first()
    if not n or not asked:
        return spark.createDataFrame([], RESULT)
    kind = vectors.schema["v"].dataType.elementType
    pad = F.array_repeat(F.lit(0).cast(kind), F.lit(width) - F.size("v"))
    vectors = vectors.withColumn("v", F.concat("v", pad))
    queries = vectors.filter(is_query).distinct()
    # equal vectors tie with everyone, so a query needs the k smallest ids among them and one more for its own
    equal = Window.partitionBy("v").orderBy("vec_id")
    candidates = vectors.withColumn("copy", F.dense_rank().over(equal)).filter(F.col("copy") <= k + 1).dropDuplicates(["v", "vec_id"]).drop("copy")
    candidates = stored(candidates, "candidates")
    hasher = Hasher.of(width, longest, n, tables, bucket)
    if n <= k + 1:
        probes = hasher.buckets
    elif probes is None:
        probes = fitted_probes(queries, candidates, hasher, k, recall)
    blocks = max(1, -(-n * tables // block))
    index = _indexed(candidates, hasher, blocks)
    asking = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    found = stored(_ranked(_searched(asking, index, hasher, probes, k, blocks, block, query_block), k), "nearest")
    if probes >= hasher.buckets:
        return found
    enough = found.groupBy("query_id").count().filter(F.col("count") >= k).select("query_id")
    short = asking.join(enough, "query_id", "left_anti")
    if short.isEmpty():
        return found
    rest = _ranked(_searched(short, index, hasher, hasher.buckets, k, blocks, block, query_block), k)
    return found.join(enough, "query_id", "left_semi").unionByName(rest)
