"""Exact top-k inner products by MaxScore over blocks of vectors.

A vector is a document whose terms are its dimensions; a block of vectors is a shard. In a
shard, a query's terms are ordered by the most they can add to a score. With a threshold
from vectors that are scored first, the terms whose bounds together stay below it are
non-essential. The essential terms are traversed for all vectors of the shard; only
vectors that are still competitive are probed for the others, a term at a time from the
greatest bound down. The results of the shards are merged.

The queries are a stated part of the rows. Blocks of queries meet blocks of vectors
through an equality join on block numbers, so no task holds more than one of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktide.session import staged

TOP = 20
SCALE = 64
QUERY_EVERY = 20
VECTOR_BLOCK = 8192
QUERY_BLOCK = 2048
EXACT = 2.0**52  # below it sums of whole doubles are exact


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (whole doubles). Vectors that are null or hold a null or non-finite component take no part."""
    parts = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(fine)
    return good.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(parts, lambda x: F.floor(x * scale).cast("double")).alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of vectors; shorter ones end in zeros."""
    lengths = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    made = np.zeros((len(lengths), width))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    made[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return made


def maxscore(query: np.ndarray, block: np.ndarray, ids: np.ndarray, own: np.ndarray, top: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each query row its best rows of the block, ties to smaller ids; all that tie are competitive."""
    low, high = block.min(axis=0), block.max(axis=0)
    bounds = np.maximum(query * low, query * high)  # the most each term can add
    order = np.argsort(-bounds, axis=1, kind="stable")
    ranked = np.take_along_axis(bounds, order, axis=1)
    rest = np.concatenate([np.cumsum(ranked[:, ::-1], axis=1)[:, ::-1], np.zeros((len(query), 1))], axis=1)
    # threshold: the k-th best of the vectors at the head of the query's strongest terms' postings
    heads = np.argsort(block, axis=0, kind="stable")
    few = min(len(block), 2 * top)
    for i, q in enumerate(query):
        strongest = order[i, :2]
        seeds = np.unique(np.concatenate([heads[-few:, d] if q[d] > 0 else heads[:few, d] for d in strongest]))
        seeds = seeds[ids[seeds] != own[i]]
        seen = block[seeds] @ q
        threshold = np.partition(seen, len(seen) - top)[len(seen) - top] if len(seen) >= top else -np.inf
        essential = int(np.argmax(rest[i] < threshold)) if (rest[i] < threshold).any() else block.shape[1]
        terms = order[i, :essential]
        score = block[:, terms] @ q[terms] if essential < block.shape[1] else block @ q
        alive = np.flatnonzero((score + rest[i, essential] >= threshold) & (ids != own[i]))
        score = score[alive]
        for at in range(essential, block.shape[1]):
            score = score + block[alive, order[i, at]] * q[order[i, at]]
            still = score + rest[i, at + 1] >= threshold
            alive, score = alive[still], score[still]
        best = np.lexsort((ids[alive], -score))[:top]
        yield i, np.stack([ids[alive[best]].astype(object), score[best].astype(object)], axis=1)


def top_k(vectors: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score (long) from whole vectors ``vectors`` and ``queries`` (vec_id, v).

    A query's own vec_id is no candidate. Vectors of different lengths are compared as if
    the shorter one ended in zeros. Repeated rows are candidates each. Scores that do
    not fit exact whole doubles raise an error.
    """
    vectors, queries = staged(vectors, "vectors"), staged(queries, "queries")
    blocks = max(1, -(-vectors.count() // VECTOR_BLOCK))
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    def dealt(df: DataFrame, n: int, name: str) -> DataFrame:
        return df.withColumn(name, F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int"))

    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    asked = dealt(queries, query_blocks, "qb").select("vec_id", "v", "qb", every(blocks, "vb"))
    offered = dealt(vectors, blocks, "vb").select("vec_id", "v", every(query_blocks, "qb"), "vb")

    def work(asked: pa.Table, offered: pa.Table) -> pa.Table:
        made = {"query_id": [], "vec_id": [], "score": []}
        if asked.num_rows and offered.num_rows:
            left, right = (t.column("v").combine_chunks() for t in (asked, offered))
            width = max(1, *(pa.compute.max(pa.compute.list_value_length(c)).as_py() for c in (left, right)))
            q, block = _matrix(left, width), _matrix(right, width)
            if np.abs(q).max() * np.abs(block).max() * width >= EXACT:
                raise ValueError("components are too large for exact whole scores")
            own, ids = asked.column("vec_id").to_numpy(), offered.column("vec_id").to_numpy()
            for i, best in maxscore(q, block, ids, own, top):
                made["query_id"] += [own[i]] * len(best)
                made["vec_id"] += best[:, 0].tolist()
                made["score"] += [int(s) for s in best[:, 1]]
        return pa.table({k: pa.array(v, pa.int64()) for k, v in made.items()})

    keys = ["qb", "vb"]
    found = asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInArrow(work, "query_id bigint, vec_id bigint, score bigint")
    # each shard has at most ``top`` rows for a query
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def query(vectors: DataFrame) -> DataFrame:
    """Queries are the ids divisible by ``QUERY_EVERY``; of rows that share such an id the least vector asks."""
    whole = whole_vectors(vectors)
    return top_k(whole, whole.filter(F.col("vec_id") % QUERY_EVERY == 0).groupBy("vec_id").agg(F.min("v").alias("v")))
