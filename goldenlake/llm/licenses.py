"""License scan: an exact set-similarity join of text blocks with license notices.

Blocks are windows of words that overlap by half, across line ends: a notice that is wrapped, indented or commented stands
whole in some block, and words scattered over a long text do not add up. A block holds a notice when at least ``THRESHOLD`` of the notice's different words are among the block's words. Words
are ordered by how many blocks of the whole corpus have them, the rarest first. A pair is compared only if a word of the
notice's prefix (its |T| - a + 1 rarest words, a being the words it must share) meets a word of the block's prefix, the
block is long enough, and the words behind the meeting place still suffice (positional filter). What is left is
verified. Only words that occur in some notice matter, so blocks are cut down to these before anything is joined.

The main path is built-in expressions alone. A null text is empty. Null or repeated ids are no hindrance: rows are told
apart by a number of their own. Ties in frequency go by the word. An empty table gives no rows, extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenlake.llm.common import saved

# The words of a text, the base phrases and their labels.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Opening words of public license notices, by label.
NOTICES = {
    "agpl-3.0": "licensed under the gnu affero general public license version 3",
    "apache-2.0": "licensed under the apache license version 2.0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that",
    "cc-by-nc-4.0": "licensed under cc by-nc 4.0",
    "cc-by-sa-4.0": "licensed under cc by-sa 4.0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "lgpl-3.0": "licensed under the gnu lesser general public license version 3",
    "mit": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2.0",
}
THRESHOLD = 0.85
SPLIT = re.compile("[^0-9a-z]+")


def notice_words(notice: str) -> list[str]:
    """Different words of a notice (ASCII, lower case), in order."""
    return list(dict.fromkeys("".join(c if c.isalnum() else " " for c in notice).split()))


def block_step(notices: Mapping[str, str]) -> int:
    """Words from one block to the next; a block has twice as many. No notice, with two words put in, is longer."""
    return max((len(SPLIT.split(n.strip())) for n in notices.values()), default=1) + 2


def needed(words: int, threshold: float) -> int:
    """Words that a block must share with a notice of so many."""
    return math.ceil(round(threshold * words, 9))


def places(words: Column, phrase: list[str]) -> Column:
    """Starts of a phrase among the words, from 0."""

    def stands(i: Column) -> Column:
        found = F.lit(True)
        for k, word in enumerate(phrase):
            found = found & (F.get(words, i + k) == word)
        return found

    last = F.size(words) - len(phrase)
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), stands)).otherwise(F.array().cast("array<int>"))


def read_words(docs: DataFrame, phrases: Mapping[str, str], vocabulary: list[str], step: int) -> DataFrame:
    """(row, doc_id, n_words, the base columns, blocks): of each block, the words that are in the vocabulary."""
    low = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.translate(F.coalesce("text", F.lit("")), UPPER, UPPER.lower()).alias("low"),
    )
    wanted = F.array(*map(F.lit, vocabulary))
    split = low.withColumn("words", F.array_remove(F.split("low", SEPARATORS), ""))
    begins = F.sequence(F.lit(1), F.greatest(F.size("words"), F.lit(1)), F.lit(step))
    split = split.withColumn(
        "blocks",
        F.filter(
            F.transform(begins, lambda i: F.array_intersect(wanted, F.slice("words", i, 2 * step))),
            lambda block: F.size(block) > 0,
        ),
    )
    found = {
        label: F.when(F.col("low").contains(phrase.split()[0]), places(F.col("words"), phrase.split())).otherwise(
            F.array().cast("array<int>")
        )
        for phrase, label in phrases.items()
    }
    starts = F.concat(*(F.col(f"at_{i}") for i in range(len(found))))
    labels = F.array_compact(
        F.array(*(F.when(F.size(f"at_{i}") > 0, F.lit(label)) for i, label in enumerate(found)))
    )
    return (
        split.withColumns({f"at_{i}": places_of for i, places_of in enumerate(found.values())})
        .select(
            "row",
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            F.size(starts).cast("long").alias("n_base"),
            F.array_min(starts).cast("long").alias("first_word"),
            F.array_max(starts).cast("long").alias("last_word"),
            labels.alias("base"),
            "blocks",
        )
    )


def word_order(blocks: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Rank of each vocabulary word by the number of blocks that have it, over all blocks; the rarest is 0."""
    counts = blocks.select(F.explode("blocks").alias("block")).select(F.explode("block").alias("word"))
    frequency = {r.word: r["count"] for r in counts.groupBy("word").count().collect()}  # the vocabulary at most
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w)))}


def join_notices(blocks: DataFrame, notices: Mapping[str, str], threshold: float) -> DataFrame:
    """(row, label, containment) of every block and notice that meet the threshold; the best block for each pair."""
    spark = blocks.sparkSession
    vocabulary = sorted({w for n in notices.values() for w in notice_words(n)})
    order = word_order(blocks, vocabulary)
    index = []  # a row for each word of each notice's prefix
    for label, notice in notices.items():
        ranks = sorted(order[w] for w in notice_words(notice))
        share = needed(len(ranks), threshold)
        index += [(rank, label, i, share, ranks) for i, rank in enumerate(ranks[: len(ranks) - share + 1])]
    prefixes = spark.createDataFrame(index, "rank int, label string, i int, share int, notice array<int>")
    least = min(share for _, _, _, share, _ in index)
    rank_of = F.create_map(*(F.lit(x) for item in order.items() for x in item))
    probes = F.array(*(F.lit(w) for w in sorted(order, key=order.get) if order[w] in {r[0] for r in index}))
    held = (
        blocks.select("row", F.posexplode("blocks").alias("block", "words"))
        .filter((F.size("words") >= least) & F.arrays_overlap("words", probes))
        .withColumn("ranks", F.array_sort(F.transform("words", lambda w: F.element_at(rank_of, w))))
        .select("row", "block", "ranks", F.size("ranks").alias("size"), F.posexplode("ranks").alias("j", "rank"))
    )
    return (
        held.join(F.broadcast(prefixes), "rank")  # a few words for each notice
        .filter("size >= share")
        .filter("j <= size - share")
        .filter("1 + least(size(notice) - i, size - j) - 1 >= share")
        .dropDuplicates(["row", "block", "label"])
        .withColumn("common", F.size(F.array_intersect("ranks", "notice")))
        .filter("common >= share")
        .groupBy("row", "label")
        .agg(F.max(F.col("common") / F.size("notice")).alias("containment"))
    )


def scan(
    docs: DataFrame,
    notices: Mapping[str, str] = NOTICES,
    phrases: Mapping[str, str] = BASE_PHRASES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    The score is the best containment, or 1 where a base phrase stands.
    """
    vocabulary = sorted({w for n in notices.values() for w in notice_words(n)})
    rows = saved(read_words(docs, phrases, vocabulary, block_step(notices)))
    found = join_notices(rows.select("row", "blocks"), notices, threshold)
    found = found.groupBy("row").agg(F.collect_set("label").alias("found"), F.max("containment").alias("best"))
    merged = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("found", F.array().cast("array<string>")))))
    return rows.drop("blocks").join(found, "row", "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.concat_ws(",", F.array_sort("base")).alias("base_labels"),
        F.concat_ws(",", merged).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
