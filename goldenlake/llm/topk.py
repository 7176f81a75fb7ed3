"""Exact top-k search by inner product, in tiles.

Components become floor(64 x). Queries are laid into blocks and all vectors into shards, each one matrix of bounded size.
A tile is the product of a block and a shard; it keeps the k best of each query, and lists are merged in a tree of
``fan`` shards a level. Products are exact: in doubles while they stay below 2^53, else in integers of any size.

Vectors that are null or hold null or non-finite components, and rows without vec_id, take no part. Rows that repeat a
vec_id count once, as the smallest of their vectors. Vectors of different lengths do not meet. Ties go to the smaller
vec_id. Without queries or candidates there are no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldenlake.llm.common import saved


@dataclass(frozen=True)
class Settings:
    k: int = 20
    every: int = 20  # queries are the rows whose vec_id is divisible by it
    shard: int = 2048  # vectors of a shard
    block: int = 256  # queries of a block
    fan: int = 16


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, vector of doubles) of the rows that take part, one for each vec_id."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    known = vectors.filter(F.col("vec_id").isNotNull() & F.col(column).isNotNull()).filter(finite)
    return known.groupBy("vec_id").agg(F.min(F.col(column).cast("array<double>")).alias("vector"))


def packed(rows: DataFrame, part: str, parts: int, salt: int) -> DataFrame:
    """One row for each part and vector length: ids in order and their matrix."""
    rows = rows.withColumn(part, F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(parts))).withColumn("dims", F.size("vector"))
    inside = F.sort_array(F.collect_list(F.struct("vec_id", "vector")))  # bounded by the size of a part
    return rows.groupBy(part, "dims").agg(inside.alias("rows")).select(
        part, "dims", F.col("rows.vec_id").alias("ids"), F.flatten("rows.vector").alias("matrix")
    )


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, the first of equal ones first."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.argsort(-scores[places], kind="stable")][:k]


def tile(queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Inner products of rows of integers, exactly."""
    reach = np.abs(queries).max(initial=0) * np.abs(ids).max(initial=0) * max(queries.shape[1], 1)
    if reach < 2.0**53:
        return (queries @ ids.T).astype(np.int64)
    return queries.astype(np.int64).astype(object).dot(ids.astype(np.int64).astype(object).T)


def search(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for each query."""
    whole = usable(vectors).withColumn("vector", F.transform("vector", lambda x: F.floor(x * 64.0).cast("double")))
    whole = saved(whole)
    queries = whole.filter(F.col("vec_id") % settings.every == 0)
    shards = max(1, -(-whole.count() // settings.shard))
    blocks = max(1, -(-queries.count() // settings.block))
    right = packed(whole, "shard", shards, 1)
    left = packed(queries, "block", blocks, 2).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    left = left.select(F.col("shard").cast("long").alias("shard"), "dims", F.col("ids").alias("queries"), F.col("matrix").alias("query_matrix"))
    k = settings.k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                dims = row["dims"].as_py()
                asked, ids = (np.asarray(row[n].values) for n in ("queries", "ids"))
                a, b = (np.asarray(row[n].values).reshape(-1, dims) for n in ("query_matrix", "matrix"))
                scores = tile(a, b)
                out = []
                for q, line in zip(asked, scores, strict=True):
                    others = np.flatnonzero(ids != q)
                    best = others[best_of(line[others], k)]
                    out.append((np.full(len(best), q), ids[best], line[best].astype(np.int64)))
                columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                shard = np.full(len(columns[0]), row["shard"].as_py())
                yield pa.record_batch(
                    [pa.array(c) for c in (shard, *columns)], names=["part", "query_id", "vec_id", "score"]
                )

    lists = left.join(right, ["shard", "dims"]).mapInArrow(run, "part long, query_id long, vec_id long, score long")
    while True:
        shards = -(-shards // settings.fan)
        lists = lists.withColumn("part", F.floor(F.col("part") / settings.fan))
        order = Window.partitionBy("query_id", "part").orderBy(F.desc("score"), "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        if shards <= 1:
            return lists.select("query_id", "rank", "vec_id", "score")
        lists = lists.drop("rank")
