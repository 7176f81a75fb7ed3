"""Near-duplicate embeddings by search in robust-pruned flat graphs.

Centroids are fitted on a bounded sample; every vector goes to its two nearest clusters, so that shards overlap. A
cluster over ``cap`` vectors is dealt into blocks, with a shard for each pair of blocks. In a shard, each vector's
nearest ones are pruned (one that is nearer to a kept neighbour than to the vector goes) and the lists are united with
their reverses and a random ring. Every vector is then searched from medoids, best first; whatever is within range is expanded too,
however much that is. What is found is verified by the cosine in doubles. Only sums of links and, for components, one
edge for each vector leave a shard, never pairs: a pair that two shards hold is counted in one of them.

Vectors that are null, zero, empty or hold null or non-finite components link with nothing. Rows that repeat a vec_id
count once, as the smallest of their usable vectors; rows without vec_id are left out. Vectors of different lengths do
not link. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenlake.llm.common import components, saved, spread
from goldenlake.llm.topk import usable


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.95
    sample: int = 20_000  # vectors that fit the centroids, the first by hash
    cluster: int = 400  # vectors of a cluster, about
    most: int = 4096  # clusters
    cap: int = 1200  # vectors of a shard, or of each of its two blocks
    near: int = 32  # candidates that are pruned
    degree: int = 12
    alpha: float = 1.2
    beam: int = 16


def fit_centroids(sample: np.ndarray, clusters: int, rounds: int = 8) -> np.ndarray:
    centroids = sample[np.random.default_rng(10).permutation(len(sample))[:clusters]]
    for _ in range(rounds):
        own = np.concatenate([(s @ centroids.T).argmax(axis=1) for s in np.array_split(sample, -(-len(sample) // 4096))])
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(lengths > 0, sums / np.where(lengths > 0, lengths, 1), centroids)
    return centroids


def pruned_graph(cosines: np.ndarray, settings: Settings) -> np.ndarray:
    """Adjacency matrix of the pruned lists and their reverses."""
    n = len(cosines)
    near = min(settings.near, n - 1)
    graph = np.zeros((n, n), bool)
    if near < 1:
        return graph
    line = np.arange(n)
    sims = cosines.copy()
    sims[line, line] = -2
    nearest = np.argpartition(-sims, near - 1, axis=1)[:, :near]
    nearest = np.take_along_axis(nearest, np.argsort(-np.take_along_axis(sims, nearest, 1), axis=1, kind="stable"), 1)
    far = np.sqrt(np.maximum(2 - 2 * np.take_along_axis(sims, nearest, 1), 0))
    gone, kept = np.zeros((n, near), bool), np.zeros(n, int)
    for i in range(near):
        take = ~gone[:, i] & (kept < settings.degree)
        graph[line[take], nearest[take, i]] = True
        kept += take
        between = np.sqrt(np.maximum(2 - 2 * cosines[nearest[:, i, None], nearest], 0))
        gone |= take[:, None] & (settings.alpha * between <= far)
    # A random ring through all vectors keeps the graph in one piece.
    ring = np.random.default_rng(n).permutation(n)
    graph[ring, np.roll(ring, 1)] = True
    return graph | graph.T


def medoids(cosines: np.ndarray) -> np.ndarray:
    """The medoid and, one after the other, the vectors farthest from those chosen before."""
    chosen = [int(cosines.sum(axis=1).argmax())]
    near = cosines[chosen[0]].copy()
    for _ in range(min(len(cosines) - 1, int(2 * len(cosines) ** 0.5))):
        chosen.append(int(near.argmin()))
        np.maximum(near, cosines[chosen[-1]], out=near)
    return np.unique(chosen)


def range_search(cosines: np.ndarray, graph: np.ndarray, settings: Settings) -> np.ndarray:
    """For each vector, which others its search from the medoids found within range."""
    n = len(cosines)
    lists = [np.flatnonzero(row) for row in graph]
    width = max(map(len, lists), default=0)
    if not width:
        return np.zeros((n, n), bool)
    neighbours = np.array([np.concatenate([x, np.full(width - len(x), i)]) for i, x in enumerate(lists)], np.int64)
    entries = medoids(cosines)
    seen = np.zeros((n, n), bool)
    open_ = np.full((n, n), -2.0)
    seen[:, entries], open_[:, entries] = True, cosines[:, entries]
    pool = np.full((n, settings.beam + len(entries)), -2.0)
    pool[:, : len(entries)] = cosines[:, entries]
    pool = np.partition(pool, len(entries), axis=1)[:, len(entries) :]
    active = np.arange(n)
    while len(active):
        best = open_[active].argmax(axis=1)
        value = open_[active, best]
        go = (value > -2) & ((value >= pool[active].min(axis=1)) | (value >= settings.cosine))
        active, best = active[go], best[go]
        open_[active, best] = -2
        next_ = neighbours[best]
        fresh = ~seen[active[:, None], next_]
        fresh[:, 1:] &= next_[:, 1:] != next_[:, :-1]
        sims = np.where(fresh, cosines[active[:, None], next_], -2)
        at, place = np.nonzero(fresh)
        seen[active[at], next_[at, place]] = True
        open_[active[at], next_[at, place]] = sims[at, place]
        pool[active] = np.partition(np.concatenate([pool[active], sims], axis=1), sims.shape[1], axis=1)[:, sims.shape[1] :]
    found = seen & (cosines >= settings.cosine)
    found[np.arange(n), np.arange(n)] = False
    return found | found.T


def local_roots(found: np.ndarray, ids: np.ndarray) -> np.ndarray:
    roots = ids.copy()
    a, b = np.nonzero(found)
    while len(a):
        low = roots.copy()
        np.minimum.at(low, a, roots[b])
        if (low == roots).all():
            break
        roots = low
    return roots


def shard_links(shard: pd.DataFrame, settings: Settings) -> pd.DataFrame:
    """(vec_id, n_links, root) of a shard's vectors: links that are this shard's to count, smallest vector reached."""
    shard = shard.sort_values("vec_id")
    vectors = np.stack(shard["vector"].to_numpy())
    cosines = vectors @ vectors.T
    found = range_search(cosines, pruned_graph(cosines, settings), settings)
    ids = shard["vec_id"].to_numpy()
    block, other = shard["block"].to_numpy(), shard["other"].to_numpy()
    cluster = int(shard["cluster"].iloc[0])
    counted = found & ~((other[:, None] == other[None, :]) & (other[:, None] < cluster))
    if shard["low"].iloc[0] != shard["high"].iloc[0]:
        counted &= block[:, None] != block[None, :]
    return pd.DataFrame({"vec_id": ids, "n_links": counted.sum(axis=1), "root": local_roots(found, ids)})


def near_duplicates(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vec_id."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    unit = usable(vectors).withColumn("norm", norm).filter((F.col("norm") > 0) & (F.col("norm") < float("inf")))
    unit = saved(unit.select("vec_id", F.transform("vector", lambda x: x / F.col("norm")).alias("vector"), F.size("vector").alias("dims")))
    every = vectors.filter("vec_id IS NOT NULL").select("vec_id").distinct()
    totals, edges = None, None
    for dims, count in ((r.dims, r["count"]) for r in unit.groupBy("dims").count().collect()):
        own = unit.filter(F.col("dims") == dims)
        first = own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(settings.sample).collect()
        sample = np.array([r.vector for r in first])
        clusters = max(1, min(settings.most, len(sample) // 4, -(-count // settings.cluster)))
        centroids = fit_centroids(sample, clusters)

        def homes(batches: Iterator[pa.RecordBatch], centroids=centroids) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                matrix = np.asarray(batch.column("vector").flatten()).reshape(len(batch), -1)
                sims = matrix @ centroids.T
                two = np.argsort(-sims, axis=1, kind="stable")[:, :2]
                for a in range(two.shape[1]):
                    other = two[:, 1 - a] if two.shape[1] > 1 else np.full(len(batch), -1)
                    yield pa.record_batch(
                        [batch.column("vec_id"), batch.column("vector"), pa.array(two[:, a]), pa.array(other)],
                        names=["vec_id", "vector", "cluster", "other"],
                    )

        members = saved(own.select("vec_id", "vector").mapInArrow(homes, "vec_id long, vector array<double>, cluster long, other long"))
        sizes = members.groupBy("cluster").count().withColumn("blocks", F.ceil(F.col("count") / settings.cap)).drop("count")
        dealt = (
            members.join(sizes, "cluster")
            .withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(5)), "blocks"))
            .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select("cluster", "other", "vec_id", "vector", "block", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"))
        )
        # A shard of two blocks finds the pairs between them; a block by itself those within.
        # Dealt by all three, as the join left a cluster's shards in one task.
        dealt = dealt.repartition(spread(dealt), "cluster", "low", "high")
        found = dealt.groupBy("cluster", "low", "high").applyInPandas(lambda x: shard_links(x, settings), "vec_id long, n_links long, root long")
        found = saved(found)
        totals = found.select("vec_id", "n_links") if totals is None else totals.unionByName(found.select("vec_id", "n_links"))
        own_edges = found.filter("root < vec_id").select(F.col("vec_id").alias("a"), F.col("root").alias("b"))
        edges = own_edges if edges is None else edges.unionByName(own_edges)
    if totals is None:
        return every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    labels = components(edges.distinct()).withColumnRenamed("node", "vec_id")
    sums = totals.groupBy("vec_id").agg(F.sum("n_links").alias("n_links"))
    component = F.coalesce("component", "vec_id")
    return every.join(sums, "vec_id", "left").join(labels, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (component == F.col("vec_id")).alias("kept"),
    )
