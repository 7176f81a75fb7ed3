"""What the operators of this package share: reading tables, written intermediates, hashing of words, components."""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from goldenlake.session import shared_folder

#: A batch of long documents must fit a Python worker's memory; texts are pruned by Bloom filters at every size of table. What an
#: action has shuffled goes from the disk when it ends, not when the driver happens to collect its garbage.
SESSION_CONF = {
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
#: Python workers keep little of what they have freed, but enough for the arrays of a slice, whose pages are dear to get anew.
WORKER_ENV = {"MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(32 << 20), "MALLOC_ARENA_MAX": "2"}
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> SparkSession:
    """Apply ``SESSION_CONF`` and let Python workers of a session without packaging find this library."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    for key, value in {"PYTHONPATH": _ROOT, **WORKER_ENV}.items():
        spark.sparkContext.environment.setdefault(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """``df`` as a written table in the shared folder: computed once, read often, and safe from lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> int:
    """Partitions of a shuffle in this session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def mapped(df: DataFrame, run: Run, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow(run, schema)``; at the end of a task its worker, which lives on and waits for others beside the executor's
    heap, gives the memory that it has freed back to the system."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(tidy, schema)


@functools.cache
def _trim() -> Callable[[int], int]:
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)  # only the GNU library has it


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    _trim()(0)


# -- hashing of words, over whole Arrow columns

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def seed_of(*parts: int) -> np.uint64:
    x = np.zeros(1, np.uint64)
    for part in parts:
        x = mix(x + np.uint64((part + 1) * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
    return x[0]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_classes(separators: str, own: str = "") -> np.ndarray:
    """Per byte: 0 for separators, 2 for bytes of ``own``, else 1. A word is a run of bytes of one class over 0."""
    classes = np.ones(256, np.uint8)
    classes[list(own.encode())] = 2
    classes[list(separators.encode())] = 0
    return classes


#: Words of the shingle operators: runs of anything but ASCII white space.
SHINGLE_WORDS = byte_classes(" \t\n\v\f\r")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = {}


def byte_values(lower: bool) -> np.ndarray:
    if lower not in _VALUES:
        codes = _LOWER if lower else np.arange(256, dtype=np.uint8)
        _VALUES[lower] = mix(codes.astype(np.uint64) + np.uint64(1))
    return _VALUES[lower]


#: Bytes that are hashed at once; a run that is longer is a piece by itself.
PIECE = 1 << 20


def run_hashes(codes: np.ndarray, start: np.ndarray, inside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of bytes: each begins at a set ``start`` and leaves out what isn't ``inside``.

    Each place of a run has a random odd factor of its own, so no two runs collide by their structure, and two that differ in
    one byte never do. Memory is that of a piece, however long the text.
    """
    starts = np.flatnonzero(start)
    out = np.zeros(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(int(np.searchsorted(starts, starts[first] + PIECE)), first + 1)
        begin, end = int(starts[first]), int(starts[last]) if last < len(starts) else len(codes)
        own = starts[first:last] - begin
        at = np.arange(end - begin, dtype=np.int64)
        at -= np.repeat(own, np.diff(np.append(own, end - begin)))
        within = inside[begin:end]
        at[~within] = 0
        terms = values[codes[begin:end]]
        terms *= _factors(int(at.max()) + 1)[at]
        terms[~within] = 0
        out[first:last] = mix(np.add.reduceat(terms, own))
        first = last
    return out


_FACTORS = np.zeros(0, np.uint64)


def _factors(n: int) -> np.ndarray:
    global _FACTORS
    if n > PIECE:
        return mix(np.arange(1, n + 1, dtype=np.uint64) * _MULTIPLIER) | np.uint64(1)
    if len(_FACTORS) < n:
        _FACTORS = mix(np.arange(1, 2 * n + 64, dtype=np.uint64) * _MULTIPLIER) | np.uint64(1)
    return _FACTORS


#: Words of so many bytes are hashed by place; longer ones by their runs.
_PLACES = 64
_TERMS: dict[bool, np.ndarray] = {}


def _terms(lower: bool) -> np.ndarray:
    """What each byte adds to the hash of a word at each of the first places."""
    if lower not in _TERMS:
        _TERMS[lower] = _factors(_PLACES)[:_PLACES, None] * byte_values(lower)
    return _TERMS[lower]


def _hashes_by_place(codes: np.ndarray, start: np.ndarray, inside: np.ndarray, lower: bool) -> np.ndarray:
    """``run_hashes`` of runs without gaps: all first bytes are added, then all second ones, of words from long to short."""
    starts = np.flatnonzero(start)
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = np.add.reduceat(inside, starts, dtype=np.int64)
    few = np.minimum(lengths, _PLACES + 1).astype(np.uint8)
    order = np.argsort(few, kind="stable")[::-1]
    at, sums, terms = starts[order], np.zeros(len(starts), np.uint64), _terms(lower)
    longer = len(starts) - np.cumsum(np.bincount(few, minlength=_PLACES + 1))
    for place in range(min(int(few.max()), _PLACES)):
        n = int(longer[place])
        sums[:n] += terms[place][codes[at[:n]]]
        at[:n] += 1
    out = np.empty(len(starts), np.uint64)
    out[order] = mix(sums)
    long = np.flatnonzero(lengths > _PLACES)
    if len(long):
        own = np.concatenate([[0], np.cumsum(lengths[long])])
        codes = codes[np.arange(own[-1]) + np.repeat(starts[long] - own[:-1], lengths[long])]
        first = np.zeros(len(codes), bool)
        first[own[:-1]] = True
        out[long] = run_hashes(codes, first, np.ones(len(codes), bool), byte_values(lower))
    return out


def word_starts(kind: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where runs of equal classes over 0 begin; rows are apart."""
    start = kind > 0
    start[1:] &= kind[1:] != kind[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[heads] = kind[heads] > 0
    return start


def word_hashes(column: pa.Array, classes: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a text column, in order, and the offsets of its rows among them."""
    data, offsets = text_bytes(column)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    kind = classes[data]
    start = word_starts(kind, offsets)
    hashes = _hashes_by_place(data, start, kind > 0, lower)
    return hashes, np.searchsorted(np.flatnonzero(start), offsets).astype(np.int64)


def shingles(words: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words per row and the offsets of the rows. A row with fewer words is one run."""
    lengths = np.diff(offsets)
    counts = np.where(lengths == 0, 0, np.maximum(lengths - width + 1, 1))
    out = np.zeros(int(counts.sum()), np.uint64)
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    if not len(words):
        return out, bounds
    at = np.arange(len(out)) + np.repeat(offsets[:-1] - bounds[:-1], counts)
    few = np.flatnonzero((lengths > 0) & (lengths < width))
    for i in range(width):
        term = words[np.minimum(at + i, len(words) - 1)]
        term[bounds[few[lengths[few] <= i]]] = np.uint64(i + 1)  # behind the end of a short row
        out = mix(out + term)
    return out, bounds


def batches_of(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each (one row at least)."""
    _, offsets = text_bytes(batch.column(column))
    first = 0
    while first < len(batch):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(batch))
        yield batch.slice(first, last - first)
        first = last


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


# -- connected components


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of all nodes of undirected ``edges``; a component is named by its smallest node.

    Every node hooks to the smallest label it sees, then labels are followed one step further, until nothing changes.
    Rounds grow with the logarithm of the longest chain; each round's labels are a written table.
    """
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = saved(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct())
    labels = saved(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component")))
    while True:
        seen = both.join(labels.select(F.col("node").alias("other"), F.col("component").alias("near")), "other")
        # Both the node and the node that it points to learn of a smaller label.
        near = seen.groupBy("node").agg(F.min("near").alias("near"))
        told = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("low"))
        hooks = told.select(F.col("component").alias("node"), F.col("low").alias("hook"))
        hooks = hooks.unionByName(told.select("node", F.col("low").alias("hook")))
        hooks = hooks.groupBy("node").agg(F.min("hook").alias("hook"))
        jumps = hooks.select(F.col("node").alias("hook"), F.col("hook").alias("jump"))
        fresh = (
            hooks.join(jumps, "hook")
            .join(labels, "node")
            .select("node", F.least("hook", "jump").alias("fresh"), "component")
        )
        fresh = saved(fresh)
        changed = fresh.filter("fresh <> component").limit(1).count()
        labels = fresh.select("node", F.col("fresh").alias("component"))
        if not changed:
            return labels


# -- columns computed by Python


def with_fresh(docs: DataFrame, fields: dict[str, str], compute, text: str = "text", limit: int = 1 << 20) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns beside all of its own, and their names: those of ``fields`` (name: type), made different from
    the names that are there. Texts go through Python once."""
    taken = {c.lower() for c in docs.columns}
    names = []
    for name in fields:
        while name.lower() in taken:
            name += "_"
        names.append(name)
        taken.add(name.lower())
    added = ", ".join(f"{name} {kind}" for name, kind in zip(names, fields.values(), strict=True))
    return with_computed(docs, added, compute, text, limit), names


def with_computed(docs: DataFrame, fields: str, compute, text: str = "text", limit: int = 1 << 20) -> DataFrame:
    """``docs`` with the columns ``fields`` (as DDL), which take the place of columns of the same names.

    ``compute`` gets slices with about ``limit`` bytes of text and returns one Arrow array for each field.
    """
    added = StructType.fromDDL(fields)
    kept = [f for f in docs.schema.fields if f.name not in added.names]
    names = [f.name for f in kept]
    needed = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_of(whole, text, limit):
                yield pa.record_batch([*(batch.column(n) for n in names), *compute(batch)], names=[*names, *added.names])

    return mapped(docs.select(*(f"`{n}`" for n in needed)), run, StructType([*kept, *added.fields]))
