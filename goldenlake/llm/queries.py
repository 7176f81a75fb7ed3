"""One query for each operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenlake.llm import (
    bpe,
    graph,
    jaccard,
    langid,
    licenses,
    negatives,
    packing,
    pii,
    quality,
    token_counts,
    topk,
    variants,
    windows,
)
from goldenlake.llm.common import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@query
def op1_byte_bpe(spark, sf):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return bpe.decode(bpe.encode(docs, path), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op2_license_scan(spark, sf):
    return licenses.scan(table(spark, sf, "documents"))


@query
def op3_language_id(spark, sf):
    return langid.identify(table(spark, sf, "documents"))


@query
def op4_exact_topk(spark, sf):
    return topk.search(table(spark, sf, "embeddings"))


@query
def op5_edited_token_counts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return token_counts.count_edits(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op6_cost_packing(spark, sf):
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf, "documents"), path).select(
        "doc_id",
        "start",
        "length",
        F.crc32("tokens").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query
def op7_compact_windows(spark, sf):
    return windows.passages(table(spark, sf, "documents"))


@query
def op8_quality_resampling(spark, sf):
    return quality.resample(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op9_ngram_jaccard(spark, sf):
    return jaccard.near_duplicates(table(spark, sf, "documents"))


@query
def op10_pruned_graph(spark, sf):
    return graph.near_duplicates(table(spark, sf, "embeddings"))


@query
def op11_pii(spark, sf):
    return pii.digests(pii.find(table(spark, sf, "documents").select("doc_id", "text")))


@query
def op12_permuterm_variants(spark, sf):
    return variants.variants(table(spark, sf, "documents"))


@query
def op13_angular_negatives(spark, sf):
    vectors = table(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.select("vec_id", moved.alias("label"), "embedding"))
