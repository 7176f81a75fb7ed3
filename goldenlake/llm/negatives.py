"""Hard negatives by angular triangle filtering.

Each vector stores its angles to a few reference directions. By the triangle inequality the angle of two vectors is at least
the difference and at most the sum of their angles to any reference, which gives an interval of cosines and, multiplied by
the norms and widened by more than rounding can do, an interval that holds the integer score. Rows are laid into shards by
their nearest reference, anchors into blocks likewise, so that whole tiles (a block and a shard) are told apart by the ranges of
their angles before any matrix is shipped; inside a tile only pairs whose interval overlaps a wanted window are scored.

Positives of an anchor are its best rows of the same label. Tiles of the same reference are searched first; their k-th score
is the floor that others must reach. Negatives of a positive are the best rows of other labels with a score from ``low`` to
``high`` percent of the positive's.

Components become floor(scale * x), computed in doubles. Rows without vec_id or label, and those whose vector is null or
empty or holds null or non-finite components (also once multiplied), take no part. Rows that repeat a vec_id count once, as the
smallest by label and vector. Vectors of different lengths do not meet. Ties go to the smaller vec_id. Zero vectors take part,
with scores of 0. Scores are exact; those beyond 64 bits are given as the nearest such number. Without anchors, positives or
negatives there are no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldenlake.llm.common import saved, spread
from goldenlake.llm.topk import best_of, tile

#: What rounding may do to an angle (radians) and, relative to the norms, to a bound.
ANGLE_SLACK, BOUND_SLACK = 1e-6, 1e-9
_INT64 = 2**63 - 1


@dataclass(frozen=True)
class Settings:
    positives: int = 5
    negatives: int = 5
    every: int = 100  # anchors are the rows whose vec_id is divisible by it
    low: int = 80  # percent of the positive's score
    high: int = 100
    scale: float = 256.0
    references: int = 16
    sample: int = 2048  # vectors that the references are fitted on, the first by hash; none of more components than that
    shard: int = 2048  # rows of a shard
    block: int = 256  # anchors of a block


def fit_references(sample: list[list[float]], settings: Settings) -> dict[int, np.ndarray]:
    """Unit directions for each vector length in the sample: centroids of a few rounds of spherical k-means."""
    by_length: dict[int, list[list[float]]] = {}
    for vector in sample:
        by_length.setdefault(len(vector), []).append(vector)
    return {length: _directions(np.array(vectors), settings) for length, vectors in by_length.items()}


def _directions(vectors: np.ndarray, settings: Settings) -> np.ndarray:
    random = np.random.default_rng(13)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = vectors[norms[:, 0] > 0] / norms[norms[:, 0] > 0]
    spare = random.standard_normal((settings.references, vectors.shape[1]))
    spare /= np.linalg.norm(spare, axis=1, keepdims=True)
    if len(unit) < settings.references:
        return np.concatenate([unit.reshape(-1, vectors.shape[1]), spare])[: settings.references]
    chosen = unit[random.permutation(len(unit))[: settings.references]]
    for _ in range(6):
        nearest = (unit @ chosen.T).argmax(axis=1)
        sums = np.zeros_like(chosen)
        np.add.at(sums, nearest, unit)
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        chosen = np.where(lengths > 0, sums / np.where(lengths > 0, lengths, 1), chosen)
    return chosen


def usable(vectors: DataFrame, settings: Settings) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, vectors of whole numbers as doubles."""
    scaled = F.transform("embedding", lambda x: x.cast("double") * settings.scale)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * settings.scale) < float("inf")))
    known = vectors.filter("vec_id IS NOT NULL AND label IS NOT NULL AND size(embedding) > 0").filter(finite)
    rows = known.select("vec_id", F.struct(F.col("label").cast("long").alias("label"), scaled.alias("vector")).alias("row"))
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*")


def measured(rows: DataFrame, settings: Settings) -> DataFrame:
    """``rows`` with norm, angles to the references of its length, and home, the nearest one."""
    short = rows.filter(F.size("vector") <= settings.sample)
    first = short.orderBy(F.xxhash64("vec_id"), "vec_id").limit(settings.sample).select("vector").collect()
    references = fit_references([np.floor(r.vector).tolist() for r in first], settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others: dict[int, np.ndarray] = {}
        for batch in batches:
            vectors, norms, angles, homes = [], [], [], []
            for value in batch.column("vector"):
                vector = np.floor(np.asarray(value.values))
                own = references.get(len(vector))
                if own is None:  # a length that the sample lacks: the same random directions in every task
                    own = others[len(vector)] if len(vector) in others else _directions(np.zeros((0, len(vector))), settings)
                    others = {len(vector): own}
                # Scaled first, so that squares stay finite.
                top = np.abs(vector).max() or 1.0
                norm = float(top * np.linalg.norm(vector / top))
                cosines = own @ (vector / (norm or 1.0))
                angle = np.arccos(np.clip(cosines, -1.0, 1.0))
                vectors.append(vector)
                norms.append(norm)
                angles.append(angle)
                homes.append(int(angle.argmin()))
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(vectors, pa.list_(pa.float64()))]
            columns += [pa.array(norms, pa.float64()), pa.array(angles, pa.list_(pa.float64())), pa.array(homes, pa.int64())]
            yield pa.record_batch(columns, names=["vec_id", "label", "vector", "norm", "angles", "home"])

    schema = "vec_id long, label long, vector array<double>, norm double, angles array<double>, home long"
    return rows.select("vec_id", "label", "vector").mapInArrow(run, schema)


def placed(rows: DataFrame, size: int, salt: int) -> DataFrame:
    """``rows`` with ``part``: each length and home is dealt into parts of about ``size`` rows."""
    rows = rows.withColumn("dims", F.size("vector"))
    parts = rows.groupBy("dims", "home").agg(F.ceil(F.count("*") / size).alias("parts"))
    return rows.join(parts, ["dims", "home"]).withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(salt)), "parts")).drop("parts")


def packed(rows: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row for each part, in the order of ids: ids, labels, norms, angles, matrix and what else is asked for."""
    fields = ("vec_id", "label", "norm", "angles", "vector", *extra)
    inside = F.sort_array(F.collect_list(F.struct(*fields)))  # bounded by the size of a part
    ends = (F.min("norm").alias("least_norm"), F.max("norm").alias("most_norm"))
    return rows.groupBy("dims", "home", "part").agg(inside.alias("rows"), *ends).select(
        "dims", "home", "part", "least_norm", "most_norm",
        _extreme("rows.angles", "least").alias("least_angles"),
        _extreme("rows.angles", "greatest").alias("most_angles"),
        F.col("rows.vec_id").alias("ids"), F.col("rows.label").alias("labels"), F.col("rows.norm").alias("norms"),
        F.flatten("rows.angles").alias("angles"), F.flatten("rows.vector").alias("matrix"),
        *(F.col(f"rows.{c}").alias(c) for c in extra),
    )


def _extreme(lists: str, which: str) -> Column:
    """Place by place, the least or greatest number of some lists."""
    return F.expr(f"aggregate({lists}, {lists}[0], (a, b) -> zip_with(a, b, (x, y) -> {which}(x, y)))")


# -- bounds


def score_bounds(
    angles: np.ndarray, others: np.ndarray, norms: np.ndarray, other_norms: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For all pairs of two lists of vectors, numbers that their scores are not below and not above."""
    nearest = np.zeros((len(angles), len(others)))
    farthest = np.full(nearest.shape, np.pi)
    for mine, theirs in zip(angles.T, others.T, strict=True):
        np.maximum(nearest, np.abs(mine[:, None] - theirs), out=nearest)
        total = mine[:, None] + theirs
        np.minimum(farthest, np.minimum(total, 2 * np.pi - total), out=farthest)
    size = norms[:, None] * other_norms
    slack = BOUND_SLACK * size + 0.5
    highest = size * np.cos(np.maximum(nearest - ANGLE_SLACK, 0)) + slack
    lowest = size * np.cos(np.minimum(farthest + ANGLE_SLACK, np.pi)) - slack
    return lowest, highest


def _tile_bounds(near: str = "a.", far: str = "b.") -> tuple[Column, Column]:
    """The same for a whole tile, from the ranges of angles and norms of its two sides."""
    gap = F.expr(
        f"array_max(zip_with(zip_with({near}least_angles, {far}most_angles, (x, y) -> x - y), "
        f"zip_with({far}least_angles, {near}most_angles, (x, y) -> x - y), (x, y) -> greatest(x, y)))"
    )
    # The sum of two angles is within a range; both its ends and, turned around, 360 degrees less may bound it.
    span = F.expr(f"array_min(zip_with({near}most_angles, {far}most_angles, (x, y) -> x + y))")
    turned = F.expr(f"array_min(zip_with({near}least_angles, {far}least_angles, (x, y) -> {2 * np.pi}D - x - y))")
    highest_cos = F.cos(F.greatest(gap - F.lit(ANGLE_SLACK), F.lit(0.0)))
    lowest_cos = F.cos(F.least(F.least(span, turned) + F.lit(ANGLE_SLACK), F.lit(np.pi)))
    least, most = F.expr(f"{near}least_norm * {far}least_norm"), F.expr(f"{near}most_norm * {far}most_norm")
    slack = most * BOUND_SLACK + F.lit(0.5)
    highest = F.when(highest_cos > 0, most * highest_cos).otherwise(least * highest_cos) + slack
    lowest = F.when(lowest_cos > 0, least * lowest_cos).otherwise(most * lowest_cos) - slack
    return lowest, highest


# -- tiles


class Side:
    """The arrays of a block or shard."""

    def __init__(self, batch: pa.RecordBatch, row: int, prefix: str):
        def of(name: str) -> np.ndarray:
            return np.asarray(batch.column(prefix + name)[row].values)

        self.ids, self.labels, self.norms = of("ids"), of("labels"), of("norms")
        self.angles = of("angles").reshape(len(self.ids), -1)
        self.matrix = of("matrix").reshape(len(self.ids), -1)


def scored(a: Side, b: Side, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of the rows and columns of a tile that hold a wanted pair, and which these are."""
    rows, columns = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
    return rows, columns, tile(a.matrix[rows], b.matrix[columns])


def longs(numbers: list) -> pa.Array:
    return pa.array([max(-_INT64, min(_INT64, int(x))) for x in numbers], pa.int64())


def _joined(blocks: DataFrame, shards: DataFrame, reach: Column, same_home: bool | None = None) -> DataFrame:
    """Tiles of blocks and shards that fulfil ``reach``, told from their ranges before the matrices join."""
    ranges = ("dims", "home", "part", "least_norm", "most_norm", "least_angles", "most_angles")
    mine = blocks.select(*ranges, *(c for c in ("floor", "least_score", "most_score") if c in blocks.columns))
    # Each block meets the shards of its length in as many turns as there are tasks.
    turns = spread(blocks)
    mine = mine.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1)))).alias("a")
    theirs = shards.select(*ranges).withColumn("turn", F.pmod(F.xxhash64("home", "part"), F.lit(turns)).cast("int")).alias("b")
    tiles = mine.join(theirs, (F.col("a.dims") == F.col("b.dims")) & (F.col("a.turn") == F.col("b.turn"))).filter(reach)
    if same_home is not None:
        homes = F.col("a.home") == F.col("b.home")
        tiles = tiles.filter(homes if same_home else ~homes)
    names = ("dims", "home", "part")
    tiles = tiles.select(*(F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "ab" for c in names))
    for side, frame in (("a", blocks), ("b", shards)):
        content = [c for c in frame.columns if c not in ranges or c in names]
        tiles = tiles.join(frame.select(*(F.col(c).alias(f"{side}_{c}") for c in content)), [f"{side}_{c}" for c in names])
    return tiles


def positives_in(tiles: DataFrame, settings: Settings) -> DataFrame:
    """(anchor_id, vec_id, score): for each tile and anchor its best rows of the same label over the anchor's floor."""
    k, with_floor = settings.positives, "a_floors" in tiles.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                a, b = Side(batch, i, "a_"), Side(batch, i, "b_")
                wanted = (a.labels[:, None] == b.labels) & (a.ids[:, None] != b.ids)
                if with_floor:
                    floors = batch.column("a_floors")[i].values.to_numpy(zero_copy_only=False).astype(float)
                    floors = np.where(np.isnan(floors), -np.inf, floors)
                    wanted &= score_bounds(a.angles, b.angles, a.norms, b.norms)[1] >= floors[:, None]
                rows, columns, scores = scored(a, b, wanted)
                anchors, ids, found = [], [], []
                for r, line in zip(rows, scores, strict=True):
                    mine = np.flatnonzero(wanted[r, columns])
                    best = mine[best_of(line[mine], k)]
                    anchors.append(np.full(len(best), a.ids[r]))
                    ids.append(b.ids[columns[best]])
                    found += line[best].tolist()
                if anchors:
                    columns = [pa.array(np.concatenate(anchors)), pa.array(np.concatenate(ids)), longs(found)]
                    yield pa.record_batch(columns, names=["anchor_id", "vec_id", "score"])

    return tiles.mapInArrow(run, "anchor_id long, vec_id long, score long")


def negatives_in(tiles: DataFrame, settings: Settings) -> DataFrame:
    """(anchor_id, positive_id, positive_score, vec_id, score): for each tile and positive its best rows in the window."""
    k, low, high = settings.negatives, settings.low, settings.high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                a, b = Side(batch, i, "a_"), Side(batch, i, "b_")
                positives = batch.column("a_positives")[i].as_py()
                lowest, highest = score_bounds(a.angles, b.angles, a.norms, b.norms)
                wanted = np.zeros(lowest.shape, bool)
                for r, own in enumerate(positives):
                    for p in own:
                        wanted[r] |= (100 * highest[r] >= low * p["score"]) & (100 * lowest[r] <= high * p["score"])
                wanted &= a.labels[:, None] != b.labels
                rows, columns, scores = scored(a, b, wanted)
                out: list[tuple] = []
                for r, line in zip(rows, scores, strict=True):
                    mine = np.flatnonzero(wanted[r, columns])
                    mine = mine[np.argsort(-line[mine], kind="stable")]
                    ranked = [int(s) for s in line[mine]] if line.dtype == object else line[mine]
                    for p in positives[r]:
                        for j in _window(ranked, low * p["score"], high * p["score"], k):
                            out.append((a.ids[r], p["vec_id"], p["score"], b.ids[columns[mine[j]]], ranked[j]))
                if out:
                    names = ["anchor_id", "positive_id", "positive_score", "vec_id", "score"]
                    yield pa.record_batch([longs(c) for c in zip(*out, strict=True)], names=names)

    return tiles.mapInArrow(run, "anchor_id long, positive_id long, positive_score long, vec_id long, score long")


def _window(ranked, low: int, high: int, k: int) -> range:
    """Places of the first k of descending scores with low <= 100 * score <= high."""
    if isinstance(ranked, list):
        inside = [j for j, s in enumerate(ranked) if low <= 100 * s <= high][:k]
        return range(inside[0], inside[-1] + 1) if inside else range(0)
    first = int(np.searchsorted(-ranked, -(high // 100), side="left"))
    last = int(np.searchsorted(-ranked, -(-(-low // 100)), side="right"))
    return range(first, min(last, first + k))


def best_rows(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k best of each group with their rank. Tasks keep the k best of what they read before the shuffle."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, label, embedding)."""
    rows = saved(measured(saved(usable(vectors, settings)), settings))
    shards = saved(packed(placed(rows, settings.shard, 1)))
    anchors = saved(placed(rows.filter(F.col("vec_id") % settings.every == 0), settings.block, 2))

    always = F.lit(True)
    near = saved(positives_in(_joined(packed(anchors), shards, always, same_home=True), settings))
    floors = best_rows(near, ["anchor_id"], settings.positives).filter(F.col("rank") == settings.positives)
    floors = floors.select(F.col("anchor_id").alias("vec_id"), F.col("score").cast("double").alias("floors"))
    floored = anchors.join(floors, "vec_id", "left")
    blocks = saved(packed(floored, ("floors",)).withColumn("floor", F.expr("if(exists(floors, f -> f IS NULL), null, array_min(floors))")))
    reach = F.col("a.floor").isNull() | (_tile_bounds()[1] >= F.col("a.floor"))
    far = positives_in(_joined(blocks, shards, reach, same_home=False), settings)
    positives = best_rows(near.unionByName(far), ["anchor_id"], settings.positives)

    own = positives.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives"))
    asking = anchors.join(own.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    blocks = packed(asking, ("positives",))
    scores = "transform(flatten(positives), p -> CAST(p.score AS double))"
    blocks = blocks.withColumn("least_score", F.expr(f"array_min({scores})")).withColumn("most_score", F.expr(f"array_max({scores})"))
    lowest, highest = _tile_bounds()
    reach = (highest * 100 >= F.col("a.least_score") * settings.low) & (lowest * 100 <= F.col("a.most_score") * settings.high)
    found = negatives_in(_joined(saved(blocks), shards, reach), settings)
    by = ["anchor_id", "positive_id", "positive_score"]
    return best_rows(found, by, settings.negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
