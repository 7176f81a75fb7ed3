"""Exact self-join of texts by the Jaccard similarity of their word shingles, by universe partition.

Sets are put into bands of similar sizes; a set also joins the next band if partners there are near enough. Within a
band two similar sets differ in at most H shingles. A hash deals all shingles into m segments, so that at least
m - H segments of a similar pair are equal (or, with one-deletion neighbourhoods, m - H // 2 differ in one shingle at
most). Each segment is indexed by a signature of its shingles; in bands where that is cheaper, its one-deletion
neighbours are indexed too. A cost model picks the form and m for each band. Segments that tell nothing (empty ones) are
counted: a set with too many of them is indexed once more under another seed, so no pair is lost.

Pairs that share enough signatures are verified exactly (on 64-bit hashes of the shingles). Signatures go by the name of
the set, so copies are one set from there on, and texts are those of its smallest document. A signature that many sets
share is dropped for a set that has enough other ones; in what is left of such groups, each set is held against a few that
stand first in groups of its own, those that share most with others. Then only sets of groups that still hold several
components are held against each other, by the rarest of the shingles that other components have too.

A set has the different runs of five words of the lower-cased (A-Z) text; a shorter text is one run. Rows without doc_id
are left out; rows that share a doc_id are one node, each with its own n_shingles. Null and empty texts have no shingles
and link with nothing. Extra columns are ignored. Clashing names do no harm, as only doc_id and text are read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldenlake.llm.common import (
    SHINGLE_WORDS,
    batches_of,
    components,
    mapped,
    mix,
    saved,
    seed_of,
    shingles,
    signed,
    with_computed,
    word_hashes,
)


#: Sizes of neighbouring bands, and what a signature that meets others by chance costs, in rows of signatures.
RATIO, CHANCE = 1.5, 12
#: Sizes of neighbouring classes of partners, where sets of large groups are held against each other.
STEP = 1.03


@dataclass(frozen=True)
class Settings:
    percent: int = 80  # Jaccard similarity of linked sets
    width: int = 5  # words of a shingle
    hot: int = 8  # sets that share a signature and are still paired off at once
    first: int = 4  # sets, of those that stand first in groups of many, that a set is held against
    slack: int = 1  # equal segments beyond the cheapest guarantee; they let hot signatures be dropped


@dataclass(frozen=True)
class Band:
    number: int
    low: int
    high: int
    segments: int
    sure: int  # segments of a similar pair that surely match
    deletions: bool


def low_of(band: int) -> int:
    low = 1
    for _ in range(band):
        low = max(low + 1, math.ceil(RATIO * low))
    return low


@functools.cache
def band_of(number: int, settings: Settings) -> Band:
    """The form of signatures and the number of segments with the least expected cost for sets of this band."""
    p, low, high = settings.percent, low_of(number), low_of(number + 1) - 1
    differ = (100 - p) * 2 * high // (100 + p)
    least = -(-p * low // 100)
    sizes = np.geomspace(least, high, 9)
    best = None
    for deletions in (False, True):
        lost = differ // 2 if deletions else differ
        if deletions and least // 2 <= lost:
            continue  # the smallest sets could not fill enough segments
        for sure in range(1, 8 + lost):
            m = lost + sure
            rate = sizes / m
            empty, single = np.exp(-rate), rate * np.exp(-rate)
            useless = m * (empty + deletions * single)
            spread = np.sqrt(2 * useless + 0.02)
            again = np.array([0.5 * math.erfc(x) for x in (sure - 0.5 - useless) / spread])
            if again.max() > 0.8:
                continue  # sets must come to an end after a few seeds
            rows = m + sizes * deletions
            chance = m * (single + rate**2 / 2 * empty * deletions)  # signatures of one shingle meet by chance
            spent = float(((rows + CHANCE * chance) / (1 - again)).mean())
            if best is None or spent < best[0]:
                best = (spent, m + settings.slack, sure + settings.slack, deletions)
    return Band(number, low, high, *best[1:])


def bands(sizes: np.ndarray) -> np.ndarray:
    lows = [1]
    while lows[-1] <= (sizes.max() if len(sizes) else 0):
        lows.append(low_of(len(lows)))
    return np.searchsorted(lows, sizes, side="right") - 1


def distinct_shingles(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each text, sorted, and the offsets of the texts."""
    values, bounds = shingles(*word_hashes(column, SHINGLE_WORDS), width)
    sets = [np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    ends = np.cumsum([0, *map(len, sets)]).astype(np.int64)
    return np.concatenate([np.zeros(0, np.uint64), *sets]), ends


def set_keys(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; sets without members get 0."""
    out = np.zeros(len(bounds) - 1, np.uint64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = mix(np.add.reduceat(mix(values), bounds[:-1][full]))
    return out


def describe(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, n_shingles, key): key is null for an empty set and equal for equal sets."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        values, bounds = distinct_shingles(batch.column("text"), settings.width)
        counts = np.diff(bounds)
        return [pa.array(counts), pa.array(set_keys(values, bounds).view(np.int64), mask=counts == 0)]

    return with_computed(docs, "n_shingles long, key long", compute).drop("text")


def segment_signatures(
    values: np.ndarray, bounds: np.ndarray, rows: np.ndarray, band: Band, seed: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of some sets, the set of each, and for each of ``rows`` how many more sure matches than needed it has."""
    sizes = np.diff(bounds)[rows]
    line = np.repeat(np.arange(len(rows)), sizes)
    own = values[np.repeat(bounds[rows] - np.cumsum(sizes) + sizes, sizes) + np.arange(len(line))]
    m = band.segments
    segment = (mix(own ^ seed_of(band.number, seed, 0)) % np.uint64(m)).astype(np.int64)
    value = mix(own + seed_of(band.number, seed, 1))
    cell = line * m + segment
    sums = np.zeros(len(rows) * m, np.uint64)
    np.add.at(sums, cell, value)
    counts = np.bincount(cell, minlength=len(sums))
    names = mix(np.arange(m, dtype=np.uint64) + seed_of(band.number, seed, 2))
    full = np.flatnonzero(counts)
    signatures, of = [mix(sums[full] ^ names[full % m])], [rows[full // m]]
    if band.deletions:
        more = counts[cell] > 1
        signatures.append(mix((sums[cell] - value)[more] ^ names[segment[more]]))
        of.append(rows[line[more]])
    useless = (counts.reshape(len(rows), m) <= int(band.deletions)).sum(axis=1)
    return np.concatenate(signatures), np.concatenate(of), band.sure - 1 - useless


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """(sig, key, tag) of the sets of all texts; a task gives those of equal sets once. The low byte of the tag is the
    number of matches to spare, plus 128; the rest names the band and seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for batch in batches_of(whole, "text"):
                values, bounds = distinct_shingles(batch.column("text"), settings.width)
                keys = set_keys(values, bounds)
                sizes = np.diff(bounds)
                fresh = sizes > 0
                for i, key in enumerate(keys.tolist()):
                    fresh[i] &= key not in seen
                    seen.add(key)
                number = bands(sizes)
                for b in np.unique([number[fresh], number[fresh] + 1]):
                    band = band_of(int(b), settings)
                    near = (number == b - 1) & (100 * sizes >= settings.percent * band.low)
                    rows, seed = np.flatnonzero(fresh & ((number == b) | near)), 0
                    while len(rows):
                        sig, of, spare = segment_signatures(values, bounds, rows, band, seed)
                        tags = np.zeros(len(sizes), np.int64)
                        tags[rows] = (b * 64 + seed) * 256 + np.clip(spare, -128, 127) + 128
                        yield pa.record_batch([signed(sig), signed(keys[of]), pa.array(tags[of].astype(np.int32))], names=["sig", "key", "tag"])
                        rows, seed = rows[spare < 0], seed + 1

    return mapped(docs, run, "sig long, key long, tag int")


def verify(pairs: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) of documents whose shingle sets are similar enough, of the given pairs."""
    texts = docs.select("doc_id", "text")
    pairs = pairs.filter("a < b")  # a filter lets Spark prune the texts by a Bloom filter of the pairs
    whole = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    whole = whole.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in batches:
            for batch in batches_of(large, "text_a"):
                left, ends = distinct_shingles(batch.column("text_a"), settings.width)
                right, bounds = distinct_shingles(batch.column("text_b"), settings.width)
                alike = np.zeros(len(batch), bool)
                for i in range(len(batch)):
                    one, two = left[ends[i] : ends[i + 1]], right[bounds[i] : bounds[i + 1]]
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    alike[i] = both > 0 and 100 * both >= settings.percent * (len(one) + len(two) - both)
                yield batch.select(["a", "b"]).filter(pa.array(alike))

    return mapped(whole.select("a", "b", "text_a", "text_b"), run, "a long, b long").distinct()


def _of_sets(pairs: DataFrame, owners: DataFrame, settings: Settings) -> DataFrame:
    """Pairs of sets as pairs (a, b) of the smallest documents that have them, if the sizes allow a link."""
    one, two = (owners.select(*(F.col(c).alias(f"{c}_{side}") for c in ("key", "rep", "n"))) for side in "ab")
    return (
        pairs.join(one, F.col("a") == F.col("key_a"))
        .join(two, F.col("b") == F.col("key_b"))
        .filter(F.col("rep_a") != F.col("rep_b"))
        .filter(100 * F.least("n_a", "n_b") >= settings.percent * F.greatest("n_a", "n_b"))
        .select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b"))
        .distinct()
    )


def rare_first(sets: DataFrame, docs: DataFrame, owners: DataFrame, settings: Settings) -> DataFrame:
    """(shingle, key, n, component, place) of the shingles that sets of several components have, as far as a similar pair must
    share one; a set's shingles are counted from the rarest, and before them come those that no other component has."""
    texts = sets.join(owners.select("key", "n", F.col("rep").alias("doc_id")), "key").join(docs, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_of(whole, "text"):
                values, bounds = distinct_shingles(batch.column("text"), settings.width)
                # Rows that share a doc_id: a set is that of the text that has its name.
                own = set_keys(values, bounds).view(np.int64) == batch.column("key").to_numpy()
                of = np.repeat(np.arange(len(batch)), np.diff(bounds))
                values, of = values[own[of]], pa.array(of[own[of]])
                columns = [batch.column(c).take(of) for c in ("key", "n", "component")]
                yield pa.record_batch([signed(values), *columns], names=["shingle", "key", "n", "component"])

    members = mapped(texts.select("key", "n", "component", "text"), run, "shingle long, key long, n long, component long")
    members = saved(members.distinct())
    known = members.groupBy("shingle").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("sets"))
    known = members.join(known.filter("least < most").select("shingle", "sets"), "shingle")
    by_set = Window.partitionBy("key")
    place = F.col("n") - F.count("*").over(by_set) + F.row_number().over(by_set.orderBy("sets", "shingle")) - 1
    return known.withColumn("place", place).filter(100 * F.col("place") <= (100 - settings.percent) * F.col("n")).drop("sets")


def pairs_apart(sets: DataFrame, docs: DataFrame, owners: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) of the given sets (key, component) that lie in different components and may be similar; none that is similar is left out.

    Sets of n and m shingles must share p * (n + m) / (100 + p) of them, so one stands among the first of both when all sets
    count theirs in one order, here from the rarest. How many are the first depends on both sizes: a set is dealt out once
    for each class of sizes that a partner can have. Near copies that are too far from each other have enough shingles of their
    own to fill these places, so that many of them make few pairs. Pairs within the largest component of a shingle aren't made.
    """
    p = settings.percent

    def low(size_class: Column) -> Column:
        return F.ceil(F.pow(F.lit(STEP), size_class))  # the smallest size of a class, or one less by rounding

    def class_of(size: Column) -> Column:
        return F.floor(F.log(size) / math.log(STEP) + 1e-9)

    def first_of(size: Column, other: Column) -> Column:
        return size - F.ceil(p * (size + other) / (100 + p) - 1e-9)  # last place that counts

    dealt = rare_first(sets, docs, owners, settings).withColumn("own", class_of(F.col("n")))
    smallest, largest = F.ceil(p * F.col("n") / 100 - 1e-9), F.floor(100 * F.col("n") / p + 1e-9)
    dealt = dealt.withColumn("other", F.explode(F.sequence(class_of(smallest), class_of(largest))))
    dealt = dealt.filter(F.col("place") <= first_of(F.col("n"), F.greatest(low(F.col("other")) - 1, smallest)))
    dealt = dealt.withColumns({"small": F.least("own", "other"), "large": F.greatest("own", "other")}).drop("own", "other")
    dealt = saved(dealt)
    group = ["shingle", "small", "large"]
    counted = dealt.groupBy(*group, "component").count().groupBy(*group)
    counted = counted.agg(F.max(F.struct("count", "component"))["component"].alias("main"), F.count("*").alias("components"))
    dealt = dealt.join(counted.filter("components > 1").drop("components"), group)
    left, right = (
        dealt.select(*group, "main", *(F.col(c).alias(f"{c}_{side}") for c in ("key", "n", "place", "component"))) for side in "ab"
    )
    left = left.filter("component_a <> main").drop("main")
    right = right.withColumn("minor", F.col("component_b") != F.col("main")).drop("main")
    met = (
        (F.col("component_a") != F.col("component_b"))
        & (~F.col("minor") | (F.col("component_a") < F.col("component_b")))
        & (F.col("place_a") <= first_of(F.col("n_a"), F.col("n_b")))
        & (F.col("place_b") <= first_of(F.col("n_b"), F.col("n_a")))
    )
    return left.join(right, group).filter(met).select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct()


def links(docs: DataFrame, info: DataFrame, copies: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) of similar documents that, with ``copies``, connect all that similar pairs connect."""
    owners = info.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"))
    owners = saved(owners)

    # One shuffle: what shares a signature is told from what doesn't, copies that came from several tasks are made one, and
    # small groups are laid into one row.
    by_sig = Window.partitionBy("sig")
    shared = saved(
        signatures(docs, settings)
        .withColumn("before", F.lag("key").over(by_sig.orderBy("key")))
        .filter("before IS NULL OR before <> key")
        .withColumn("sharing", F.count("*").over(by_sig))
        .filter("sharing > 1")
        .withColumn("alone", F.when(F.col("sharing") > settings.hot, F.col("key")))
        .groupBy("sig", "alone")
        .agg(F.sort_array(F.collect_list(F.struct("key", "tag"))).alias("sets"))
    )
    crowds = shared.filter("alone IS NOT NULL").select("sig", F.col("alone").alias("key"), F.col("sets")[0]["tag"].alias("tag"))
    crowds = crowds.select("sig", "key", F.expr("tag >> 8").alias("scheme"), F.expr("(tag & 255) - 128").alias("spare"))
    hot = saved(crowds.groupBy("key", "scheme").agg(F.count("*").alias("hot")))

    pairs = F.expr(
        "flatten(transform(sets, (x, i) -> transform(slice(sets, i + 2, size(sets)), y -> struct(x AS x, y AS y))))"
    )
    found = (
        shared.filter("alone IS NULL")
        .select(F.explode(pairs).alias("pair"))
        .groupBy(F.col("pair.x.key").alias("a"), F.col("pair.y.key").alias("b"), F.expr("pair.x.tag >> 8").alias("scheme"))
        .agg(
            F.count("*").alias("shared"),
            F.first(F.expr("(pair.x.tag & 255) - 128")).alias("spare_a"),
            F.first(F.expr("(pair.y.tag & 255) - 128")).alias("spare_b"),
        )
    )
    for side in "ab":  # hot signatures may be among those that a pair has to share
        found = found.join(
            hot.select(F.col("key").alias(side), "scheme", F.col("hot").alias(f"hot_{side}")), [side, "scheme"], "left"
        ).withColumn(f"spare_{side}", F.col(f"spare_{side}") - F.coalesce(f"hot_{side}", F.lit(0)))
    found = found.filter(F.col("shared") > F.greatest("spare_a", "spare_b", F.lit(0))).select("a", "b")

    crowds = crowds.join(hot, ["key", "scheme"]).filter("hot > spare").drop("hot")
    crowds = saved(crowds.withColumn("sharing", F.count("*").over(by_sig)))
    # What near copies were made from has most in common with them: it stands first in its groups.
    weights = crowds.groupBy("key", "scheme").agg(F.sum("sharing").alias("weight"))
    headed = crowds.join(weights, ["key", "scheme"]).withColumn("a", F.max(F.struct("weight", "key")).over(by_sig)["key"])
    star = headed.filter("a <> key").groupBy(F.col("key").alias("b"), "a").count()
    likely = Window.partitionBy("b").orderBy(F.desc("count"), "a")
    star = star.withColumn("at", F.row_number().over(likely)).filter(F.col("at") <= settings.first).select("a", "b")
    tested = saved(_of_sets(found.unionByName(star).distinct(), owners, settings))
    linked = saved(verify(tested, docs, settings))
    if crowds.isEmpty():
        return linked
    labels = components(linked.unionByName(copies)).withColumnRenamed("node", "rep")
    named = owners.join(labels, "rep", "left").select("key", "n", F.coalesce("component", "rep").alias("component"))
    apart = crowds.join(named, "key").withColumns(
        {"least": F.min("component").over(by_sig), "most": F.max("component").over(by_sig)}
    )
    apart = saved(apart.filter("least < most").drop("least", "most"))
    # A similar pair that shares no small group has all that it must share in these.
    more = pairs_apart(apart.select("key", "component").distinct(), docs, owners, settings)
    more = saved(_of_sets(more, owners, settings).join(tested, ["a", "b"], "left_anti"))
    return linked.unionByName(verify(more, docs, settings))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; a component has the name of its smallest doc_id."""
    docs = docs.select("doc_id", "text").filter("doc_id IS NOT NULL")
    info = saved(describe(docs, settings))
    sets = info.filter("key IS NOT NULL")
    first = sets.groupBy("key").agg(F.min("doc_id").alias("a"))
    copies = saved(sets.join(first, "key").select("a", F.col("doc_id").alias("b")).filter("a < b"))
    linked = links(docs, info, copies, settings).unionByName(copies)
    labels = components(linked).withColumnRenamed("node", "doc_id")
    return info.join(labels, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def keep_first(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that name their component: one document of each group of near copies."""
    first = near_duplicates(docs, settings).filter("doc_id = component_id").select("doc_id").distinct()
    return docs.join(first, "doc_id", "left_semi").select(*(f"`{c}`" for c in docs.columns))
