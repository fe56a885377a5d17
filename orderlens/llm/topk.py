"""Exact top-k inner product search over integer vectors, in norm-sorted blocks.

Vectors are ordered by descending length and cut into blocks. A rotation from the singular vectors of all rows puts
most of a product into its first components. A block first asks what Cauchy-Schwarz allows at all (product of
lengths), then adds the partial sum over the first components and the product of the residual lengths, and only pairs
that can still reach the query's k-th best score get the exact product. Queries meet the longest vectors first; the
k-th score found there is their bar in all other blocks. Before anything moves, the bar and the lengths of query and
block tell, by Cauchy-Schwarz, the last block that a query must see; a block goes only to query blocks of which a query
must see it. Such query blocks and vector blocks meet in cells of bounded size.

Defined cases: vectors that are null, hold a null or non-finite component, or have no id take no part; repeated rows
count once and rows that share the query's id are its own; a query id with unlike vectors has the best scores of all of
them, each vec_id once; a shorter vector counts as padded with zeros; equal scores
go to the smaller vec_id; products beyond 2^53 are taken in 64-bit integers and wrap; fewer than k candidates give
fewer rows; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path, stored

SCALE = 64
BLOCK = 4096  # vectors of a block
QUERY_BLOCK = 1024
STEP = 512  # vectors that are bounded together
RUNS = 65_536  # runs of blocks whose lengths are known to every task

FOUND = "query_id bigint, vec_id bigint, score bigint"


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of all rows that take part, components as floor(SCALE * x)."""
    x = F.col("embedding")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & fine)
        .select("vec_id", F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint")).alias("v"))
        .distinct()
    )


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Integer vectors as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all rows, largest singular value first, from partial sums that Spark adds up."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column(0), width).astype(np.float64)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()])], names=["g"])

    sums = vectors.select("v").mapInArrow(partial, "g array<double>").select(F.posexplode("g").alias("place", "g"))
    total = np.zeros(width * width)
    for place, value in sums.groupBy("place").agg(F.sum("g")).collect():  # width * width rows
        total[place] = value
    _, axes = np.linalg.eigh(np.nan_to_num(total.reshape(width, width)))
    return axes[:, ::-1]


NONE = np.iinfo(np.int64).min  # the score of no candidate


class Best:
    """The best k candidates of each query so far, in 64-bit integers."""

    def __init__(self, queries: int, k: int, bar: np.ndarray):
        self.k, self.bar = k, bar
        self.score = np.full((queries, k), NONE)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, who: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Scores (queries x candidates, ``NONE`` for none) of the queries ``who``."""
        score = np.concatenate([self.score[who], score], 1)
        ids = np.concatenate([self.id[who], np.broadcast_to(ids, (len(who), len(ids)))], 1)
        order = np.lexsort((ids, ~score))[:, : self.k]  # the complement turns the order round without overflow
        self.score[who] = np.take_along_axis(score, order, 1)
        self.id[who] = np.take_along_axis(ids, order, 1)
        self.bar[who] = np.maximum(self.bar[who], self.score[who, -1])


def search_block(
    queries: np.ndarray, query_ids: np.ndarray, bar: np.ndarray, block: np.ndarray, ids: np.ndarray, axes: np.ndarray, k: int
) -> Best:
    """The block's best k of each query that reach its ``bar``; vectors and bars are integers."""
    real, real_queries = block.astype(np.float64), queries.astype(np.float64)
    order = np.lexsort((ids, -(real * real).sum(1)))
    block, real, ids = block[order], real[order], ids[order]
    length, query_length = np.sqrt((real * real).sum(1)), np.sqrt((real_queries * real_queries).sum(1))
    best, head = Best(len(queries), k, bar.copy()), max(1, axes.shape[1] // 4)
    exact = bool(length.max(initial=0) * query_length.max(initial=0) < 2**53)
    turned, query_turned = (real @ axes)[:, :head], (real_queries @ axes)[:, :head]
    rest = np.sqrt(np.maximum(length**2 - (turned**2).sum(1), 0))
    query_rest = np.sqrt(np.maximum(query_length**2 - (query_turned**2).sum(1), 0))
    for at in range(0, len(block), STEP):
        part = slice(at, at + STEP)
        slack = 1e-9 * length[at] * query_length + 1e-6
        who = np.flatnonzero(query_length * length[at] + slack >= best.bar) if exact else np.arange(len(queries))
        if not len(who):
            break
        bound = query_turned[who] @ turned[part].T + query_rest[who, None] * rest[part] + slack[who, None]
        can = (bound >= best.bar[who, None]) if exact else np.ones(bound.shape, bool)
        can &= query_ids[who, None] != ids[part]
        some = np.flatnonzero(can.any(0))
        who, can = who[can.any(1)], can[can.any(1)][:, some]
        if not len(who):
            continue
        if exact:  # whole numbers below 2^53 are exact in floating point, and faster
            score = np.rint(real_queries[who] @ real[part][some].T).astype(np.int64)
        else:
            score = queries[who] @ block[part][some].T
        best.add(who, np.where(can & (score >= best.bar[who, None]), score, NONE), ids[part][some])
    return best


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other vectors of each query by integer inner product.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on vec_id. Runs jobs when called: the width and
    rotation are found, and the norm-sorted blocks and first scores stored in the shared folder.
    """
    spark = vectors.sparkSession
    vectors = integer_vectors(vectors.select("vec_id", "embedding"))
    width, n, asked = vectors.agg(F.max(F.size("v")), F.count("*"), F.count(F.when(is_query, 1))).first()
    if not n or not asked:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    width = max(width, 1)
    vectors = vectors.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("v"))))
    norm = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    folder = shared_path(spark, "topk")
    (
        vectors.withColumn("norm", norm)
        .repartitionByRange(-(-n // BLOCK), F.desc("norm"), F.asc("vec_id"))
        .select("vec_id", "v", "norm", F.spark_partition_id().alias("block"))
        .write.parquet(f"{folder}/blocks")
    )
    blocks = spark.read.parquet(f"{folder}/blocks")
    n_blocks = blocks.agg(F.max("block")).first()[0] + 1
    axes = rotation(blocks, width)
    query_blocks = -(-asked // QUERY_BLOCK)
    queries = blocks.filter(is_query).select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"),
        F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("query_block"),
    )

    def cells(queries: DataFrame, first: int) -> DataFrame:
        """What the blocks from ``first`` on hold for the queries, which have columns bar and last, their last block."""
        reach = queries.groupBy("query_block").agg(F.max("last").alias("last"))  # a row per query block
        needed = stored(reach.filter(F.col("last") >= first).select(
            "query_block", F.explode(F.sequence(F.lit(first), F.col("last"))).alias("block")
        ), "cells")

        def cell(left: pa.Table, right: pa.Table) -> pa.Table:
            found = {"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)}
            if left.num_rows and right.num_rows:
                names = left["query_id"].to_numpy()
                best = search_block(
                    _matrix(left["q"], width), names, left["bar"].to_numpy(),
                    _matrix(right["v"], width), right["vec_id"].to_numpy(), axes, k * _copies(right["vec_id"].to_numpy()),
                )
                good = best.score > NONE
                found = {
                    "query_id": np.repeat(names, good.sum(1)), "vec_id": best.id[good],
                    "score": best.score[good],
                }
            return pa.table(found)

        asked = queries.filter(F.col("last") >= first).withColumn("block", F.explode(F.sequence(F.lit(first), F.col("last"))))
        there = blocks.join(needed, "block")
        keys = ["query_block", "block"]
        return asked.groupBy(keys).cogroup(there.groupBy(keys)).applyInArrow(cell, FOUND)

    cells(queries.withColumns({"bar": F.lit(int(NONE)), "last": F.lit(0)}), 0).write.parquet(f"{folder}/first")
    found = spark.read.parquet(f"{folder}/first")
    if n_blocks > 1:
        bars = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).groupBy("query_id").agg(
            F.min("score").alias("least"), F.count("*").alias("n")
        )  # k rows of a query at most, unless its id or an id of the block has unlike vectors
        bar = F.when(F.col("n") >= k, F.col("least")).otherwise(F.lit(int(NONE)))
        barred = queries.join(bars, "query_id", "left").select("query_id", "q", "query_block", F.coalesce(bar, F.lit(int(NONE))).alias("bar"))
        barred = _with_last(barred, blocks, n_blocks)
        found = found.unionByName(cells(barred, 1))
    pairs = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _with_last(queries: DataFrame, blocks: DataFrame, n_blocks: int) -> DataFrame:
    """``queries`` with the last block that can hold a score which reaches their bar.

    Blocks are in order of length, so a query must see all before it too. Lengths of runs of blocks, at most ``RUNS``
    numbers, are broadcast.
    """
    run = -(-n_blocks // RUNS)
    rows = blocks.groupBy(F.floor(F.col("block") / run).alias("run")).agg(F.max("norm"), F.max("block")).collect()
    rows = sorted(tuple(r) for r in rows)
    shared = blocks.sparkSession.sparkContext.broadcast((np.sqrt([r[1] for r in rows]), np.array([0, *(r[2] for r in rows)])))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest, last = shared.value
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            q = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            length = np.sqrt((q * q).reshape(len(sizes), -1).sum(1)) if len(sizes) else np.zeros(0)
            bar = batch.column(3).to_numpy().astype(np.float64) * (1 - 1e-9) - 1
            with np.errstate(divide="ignore", invalid="ignore"):
                wanted = np.where(bar <= 0, -np.inf, bar / length)
            seen = np.searchsorted(-longest, -wanted, "right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(last[seen].astype(np.int32))], names=[*batch.schema.names, "last"])

    return queries.mapInArrow(reach, "query_id bigint, q array<bigint>, query_block int, bar bigint, last int")


def _copies(ids: np.ndarray) -> int:
    """How often the most frequent id occurs."""
    return int(np.unique(ids, return_counts=True)[1].max())


ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
