"""Quality classifier by importance resampling.

Two generative models over hashed n-grams (words and runs of punctuation, alone
and in pairs; all pairs of a word with itself are one n-gram, without which 2.7 instead of 0.3 % of bad held-out documents of
the given labels pass) are counted: one of the
documents labelled good, one of all documents. A document's log importance weight is the sum of its n-grams' log
probability ratios. Documents are then drawn without replacement in proportion to their weights: Gumbel noise is added
to the log weights and the k largest sums are kept.

Rows without doc_id are left out. A null or empty text, or one of white space alone, has no n-grams: its weight is null
and it is never drawn. Rows that repeat a doc_id get the same noise; rows tied at the cut are all kept. Extra columns
are ignored by the models and kept by the filter; those named like a result are replaced. Without good labels every weight is 0 and all texts with words stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenlake.llm.common import batches_of, byte_classes, mapped, mix, saved, with_computed, with_fresh, word_hashes

#: Words are runs of letters, digits and bytes over 127; each other visible ASCII character belongs to a run of its own kind.
CLASSES = byte_classes(" \t\n\v\f\r", "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 14  # hashed n-grams
    sample: int = 20_000  # labelled documents that fit the target model and the cut, the first by hash
    smoothing: float = 1.0
    temperature: float = 1.0  # scale of the Gumbel noise
    seed: int = 8


def ngram_buckets(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of a text column and the row each belongs to."""
    words, offsets = word_hashes(column, CLASSES, lower=False)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    pair = np.flatnonzero(row[1:] == row[:-1])
    both = mix(words[pair] * np.uint64(3) + mix(words[pair + 1]))
    both[words[pair] == words[pair + 1]] = 0  # a word said twice is one n-gram, whatever the word
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    hashed = np.concatenate([mix(words + np.uint64(7)), both]) >> shift
    return hashed.astype(np.int64), np.concatenate([row, row[pair]])


def labelled_sample(labels: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Ids and labels of at most ``settings.sample`` documents. A document with both labels counts as bad."""
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("q"))
    rows = known.orderBy(F.xxhash64("doc_id", F.lit(settings.seed)), "doc_id").limit(settings.sample).collect()
    ids = np.array([r.doc_id for r in rows], np.int64)
    return ids, np.array([r.q for r in rows], np.int64)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """Log probability ratio of target to raw text for each bucket. Raw counts cover all documents."""
    ids, quality = labelled_sample(labels, settings)
    good, size = np.sort(ids[quality == 1]), settings.buckets

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, size), np.int64)
        for whole in batches:
            for batch in batches_of(whole, "text"):
                bucket, row = ngram_buckets(batch.column("text"), size)
                counts[0] += np.bincount(bucket, minlength=size)
                chosen = np.isin(batch.column("doc_id").to_numpy(zero_copy_only=False), good)
                counts[1] += np.bincount(bucket[chosen[row]], minlength=size)
        used = np.flatnonzero(counts[0])
        yield pa.record_batch([pa.array(used), *map(pa.array, counts[:, used])], names=["bucket", "raw", "target"])

    counted = (
        mapped(docs.select("doc_id", "text").filter("doc_id IS NOT NULL"), count, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .collect()  # one row for each bucket at most
    )
    raw, target = np.zeros(size), np.zeros(size)
    for r in counted:
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    if not target.any():
        return np.zeros(size)
    raw, target = raw + settings.smoothing, target + settings.smoothing
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def scores(batch: pa.RecordBatch, ratios: np.ndarray) -> list[pa.Array]:
    """Log weight, null without n-grams, and number of n-grams of each text."""
    bucket, row = ngram_buckets(batch.column("text"), len(ratios))
    counts = np.bincount(row, minlength=len(batch))
    sums = np.bincount(row, ratios[bucket], minlength=len(batch))
    return [pa.array(sums, mask=counts == 0), pa.array(counts.astype(np.int64))]


def weigh(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``docs`` with log_weight and n_ngrams; the weight is null without n-grams."""
    known = docs.filter("doc_id IS NOT NULL")
    return with_computed(known, "log_weight double, n_ngrams long", lambda batch: scores(batch, ratios))


def gumbel(key: Column, settings: Settings) -> Column:
    """Noise that depends on the key alone, so that a lost task draws the same again."""
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(settings.seed + 1)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(uniform)) * settings.temperature


def cut_of(weighed: DataFrame, labels: DataFrame, settings: Settings) -> float:
    """The weight that best parts good from bad labelled documents; without either kind, no cut."""
    ids, quality = labelled_sample(labels, settings)
    if not (quality == 0).any() or not (quality == 1).any():
        return -np.inf
    spark = weighed.sparkSession
    sample = spark.createDataFrame(list(zip(ids.tolist(), quality.tolist(), strict=True)), "doc_id long, q int")
    rows = weighed.join(F.broadcast(sample), "doc_id").filter("log_weight IS NOT NULL")
    rows = rows.groupBy("doc_id", "q").agg(F.min("log_weight").alias("log_weight"))  # one for each labelled id
    found = np.array([(r.log_weight, r.q) for r in rows.collect()]).reshape(-1, 2)
    found = found[np.argsort(found[:, 0], kind="stable")]
    bad, good = np.cumsum(found[:, 1] == 0), np.cumsum(found[:, 1] == 1)
    if not len(found) or not bad[-1] or not good[-1]:
        return -np.inf
    gain = bad / bad[-1] - good / good[-1]
    gain[:-1][found[1:, 0] == found[:-1, 0]] = -1  # a cut lies between different weights
    best = int(np.argmax(gain))
    return float(found[best, 0] if best + 1 == len(found) else found[best : best + 2, 0].mean())


def kth_largest(keys: DataFrame, k: int) -> float | None:
    """The k-th largest of a column of doubles ``key``, exactly: its 64 bits are settled 16 at a time by counts."""
    if k <= 0:
        return None
    bits = F.expr("java_method('java.lang.Double', 'doubleToLongBits', key)").cast("long")
    ordered = keys.select(F.when(bits < 0, F.bitwise_not(bits)).otherwise(bits.bitwiseXOR(F.lit(-(2**63)))).alias("o"))
    prefix, rest = 0, k
    for done in range(0, 64, 16):
        part = F.shiftrightunsigned("o", 48 - done).bitwiseAND(F.lit(0xFFFF))
        same = ordered if not done else ordered.filter(F.shiftrightunsigned("o", 64 - done) == prefix)
        counts = {r.part: r["count"] for r in same.groupBy(part.alias("part")).count().collect()}  # 65,536 at most
        for value in sorted(counts, reverse=True):
            if counts[value] >= rest:
                break
            rest -= counts[value]
        prefix = prefix << 16 | value
    raw = prefix ^ 2**63 if prefix >> 63 else ~prefix & (2**64 - 1)
    return float(np.array([raw], np.uint64).view(np.float64)[0])


@dataclass(frozen=True)
class Model:
    ratios: np.ndarray
    least: float | None  # the smallest Gumbel key that is kept; None keeps nothing


def draw(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with log_weight, n_ngrams, gumbel_key and kept."""
    keyed = weigh(docs, model.ratios).withColumn("gumbel_key", F.col("log_weight") + gumbel(F.col("doc_id"), settings))
    if model.least is None:
        return keyed.withColumn("kept", F.lit(False))
    return keyed.withColumn("kept", F.coalesce(F.col("gumbel_key") >= model.least, F.lit(False)))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> tuple[Model, DataFrame]:
    """The Gumbel top-k as a model, k being the number of documents over the cut, and its (doc_id, ...) table."""
    ratios = fit(docs, labels, settings)
    keyed = saved(draw(docs.select("doc_id", "text"), Model(ratios, None), settings).drop("text", "kept"))
    k = keyed.filter(F.col("log_weight") >= cut_of(keyed, labels, settings)).count()
    keys = keyed.filter("log_weight IS NOT NULL").select(F.col("gumbel_key").alias("key"))
    return Model(ratios, kth_largest(keys, k)), keyed


def resample(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, log_weight, n_ngrams, gumbel_key, kept) of every row with a doc_id."""
    model, keyed = train(docs, labels, settings)
    kept = F.lit(False) if model.least is None else F.coalesce(F.col("gumbel_key") >= model.least, F.lit(False))
    return keyed.withColumn("kept", kept)


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that are drawn, unchanged. Texts are weighed again, which is cheaper than shuffling them."""
    model, _ = train(docs, labels, settings)
    if model.least is None:
        return docs.limit(0)
    known = docs.filter("doc_id IS NOT NULL")
    weighed, (weight,) = with_fresh(known, {"log_weight": "double"}, lambda batch: scores(batch, model.ratios)[:1])
    key = F.col(weight) + gumbel(F.col("doc_id"), settings)
    return weighed.filter(F.coalesce(key >= model.least, F.lit(False))).select(*(f"`{c}`" for c in docs.columns))
