"""Spelling variants of the words of a corpus, by permuterm rotations.

A word marked with a terminator, ``word$``, has one rotation for each place. Two words that differ by a replaced character
agree in the rotation that begins behind it and leaves the character out; a word with a character more agrees, in that
rotation without the character, with a whole rotation of the shorter word. So all rotations, with and without their last
character, are sorted, and equal ones are scanned as a group. A group holds one word for each character that can stand in the
place, and at most one shorter word: it is bounded by the alphabet, never by the corpus, and the pairs in it are counted, not
made. A replacement is met in one group only; a character removed from a run of equal ones is met once for each, and only the
first place of the run counts.

Words carry their place in code-point order as a number, so groups and ties compare numbers. The rotations of a word longer
than ``Settings.plain`` characters are named by digests of what stands before and behind the place, which takes space in
proportion to the word instead of its square.

Null and empty texts have no words. A null doc_id counts as an empty one in the hash that deletes characters. Rows that repeat
are counted each time. An empty table gives no rows. Extra columns are ignored, and clashing names do no harm, as only
doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenlake.llm.common import batches_of, saved

RUN = re.compile("[a-zÀ-ÿ]+")
_NO_RUN = re.compile("[^a-zÀ-ÿ]")


@dataclass(frozen=True)
class Settings:
    least: int = 7  # code points of a word
    often: int = 2  # occurrences of a word
    times: int = 10  # how much more often than a word its form must occur
    delete: int = 31  # a run loses a character when this divides its hash; 0 for never
    plain: int = 64  # longer words have digests for rotations
    held: int = 200_000  # words that a task counts before it hands them on
    slice: int = 1 << 20  # characters of a text that are taken apart at once


def runs_of(text: str, size: int) -> Iterator[list[str]]:
    """The runs of a text whose ASCII letters are lower case, a slice at a time; no run is cut."""
    first = 0
    while first < len(text):
        end = _NO_RUN.search(text, min(first + size, len(text)))
        last = end.start() if end else len(text)
        yield RUN.findall(text, first, last)
        first = last


def mangled(run: str, doc_id: int | None, every: int) -> str:
    """The run, without one character when its hash says so."""
    named = f"{'' if doc_id is None else doc_id}:{run}".encode()
    if not every or (h := zlib.crc32(named)) % every:
        return run
    place = h % len(run)
    return run[:place] + run[place + 1 :]


def count_words(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n) of all words that are long and frequent enough. Tasks add up what they read before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def handed_on() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(list(counts), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for whole in batches:
            for batch in batches_of(whole, "text", settings.slice):
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                    # Bytes lose the case of A to Z alone.
                    lowered = (text.as_py() or "").encode().lower().decode()
                    for runs in runs_of(lowered, settings.slice):
                        for own, n in Counter(runs).items():
                            if len(own) >= settings.least:
                                word = mangled(own, doc_id, settings.delete)
                                if len(word) >= settings.least:
                                    counts[word] += n
                        if len(counts) >= settings.held:
                            yield handed_on()
        yield handed_on()

    made = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return made.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= settings.often)


def numbered(words: DataFrame) -> DataFrame:
    """``words`` (all different) with ``id``, numbers in code-point order. The sort deals ranges of words to tasks, and a
    task that is repeated gives the same numbers again."""
    return words.orderBy("word").withColumn("id", F.monotonically_increasing_id())


def rotation_keys(word: str, plain: int) -> tuple[list[bytes], list[bytes]]:
    """Names of the rotations of ``word$``: those that begin at each place or at the terminator, and for each place the one
    that begins behind it, without its character. Equal names mean equal rotations."""
    whole, parts = [(i, i) for i in range(len(word) + 1)], [(i + 1, i) for i in range(len(word))]
    heads, tails = (_digests(word), _digests(word[::-1])[::-1]) if len(word) > plain else ([], [])

    def name(begin: int, end: int) -> bytes:
        # Decided by the length of the rotation, so that a word and one with a character more agree.
        if len(word) - begin + end <= plain:
            return f"{word[begin:]}${word[:end]}".encode()
        return b"$$" + tails[begin] + heads[end]

    return [name(*ends) for ends in whole], [name(*ends) for ends in parts]


def _digests(word: str) -> list[bytes]:
    """128-bit digests of all prefixes, the empty one first."""
    state = blake2b(digest_size=16)
    out = [state.digest()]
    for character in word:
        state.update(character.encode("utf-32-le"))
        out.append(state.digest())
    return out


def rotations(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(key, id, n, whole, head): all rotations of numbered words, whole or without their last character. ``head`` marks
    characters that do not repeat the one before them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "id", "n", "whole", "head"]
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [], [])

            def made(columns=columns) -> pa.RecordBatch:
                types = (pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
                out = pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
                for c in columns:
                    c.clear()
                return out

            for word, own, n in zip(*(batch.column(c).to_pylist() for c in ("word", "id", "n")), strict=True):
                whole, parts = rotation_keys(word, settings.plain)
                heads = [i == 0 or word[i] != word[i - 1] for i in range(len(word))]
                size = len(whole) + len(parts)
                rows = (whole + parts, [own] * size, [n] * size, [True] * len(whole) + [False] * len(parts), [False] * len(whole) + heads)
                for column, more in zip(columns, rows, strict=True):
                    column.extend(more)
                if len(columns[0]) >= 50_000:
                    yield made()
            yield made()

    return words.select("word", "id", "n").mapInArrow(run, "key binary, id long, n long, whole boolean, head boolean")


def neighbours(rows: DataFrame) -> DataFrame:
    """(id, n_near, best): of each word with neighbours their number and, as (-n, id), the most frequent one.

    Members of a group are sorted by (-n, id), at most one for each character of the alphabet and one shorter word. A part
    takes the other parts for replacements, and a part at the head of its run the whole word as the one with a deletion.
    """
    member = F.struct((-F.col("n")).alias("order"), "id", "whole", "head")
    groups = rows.groupBy("key").agg(F.sort_array(F.collect_list(member)).alias("members")).filter("size(members) > 1")
    groups = groups.select(
        "members",
        F.expr("filter(members, m -> m.whole)").alias("wholes"),
        F.expr("filter(members, m -> m.head)").alias("heads"),
        F.expr("filter(members, m -> NOT m.whole)").alias("parts"),
    )
    member = "struct(m.id AS id, {near} AS near, array_min(transform({others}, x -> struct(x.order, x.id))) AS best)"
    replaced = "slice(filter(parts, x -> x.id <> m.id), 1, 1)"
    of_whole = member.format(near="size(heads)", others="slice(heads, 1, 1)")
    of_head = member.format(near="size(parts) - 1 + size(wholes)", others=f"concat({replaced}, wholes)")
    of_part = member.format(near="size(parts) - 1", others=replaced)
    near = f"transform(members, m -> CASE WHEN m.whole THEN {of_whole} WHEN m.head THEN {of_head} ELSE {of_part} END)"
    found = groups.select(F.inline(F.expr(near))).filter("near > 0")
    return found.groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def followed(forms: DataFrame) -> DataFrame:
    """(id, root) from (id, form): the last word that forms lead to. A form is ``times`` as frequent as its word, so a chain
    has at most as many links as a count has digits; each round doubles the stride."""
    ahead = saved(forms.select("id", F.col("form").alias("root")))
    while True:
        jumps = ahead.select(F.col("id").alias("root"), F.col("root").alias("beyond"))
        ahead = saved(ahead.join(jumps, "root", "left").select("id", "beyond", F.coalesce("beyond", "root").alias("root")))
        if ahead.filter("beyond IS NOT NULL").isEmpty():
            return ahead.drop("beyond")
        ahead = ahead.drop("beyond")


def group_words(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of words with their counts (word, n)."""
    known = saved(numbered(saved(words)))
    near = neighbours(rotations(known, settings))
    near = near.select("id", "n_near", (-F.col("best.order")).alias("best_n"), F.col("best.id").alias("best"))
    taken = F.col("best_n") >= settings.times * F.col("n")
    told = saved(
        known.join(near, "id", "left").select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(taken, F.col("best")).alias("form"), F.when(taken, F.col("best_n")).alias("form_n"),
        )
    )
    forms = told.filter("form IS NOT NULL").select("id", "form")
    roots = followed(forms)
    names = known.select(F.col("id").alias("named"), F.col("word").alias("name"))
    chosen = (
        forms.join(roots, "id")
        .join(names.select(F.col("named").alias("form"), F.col("name").alias("form_word")), "form")
        .join(names.select(F.col("named").alias("root"), F.col("name").alias("root_word")), "root")
        .select("id", "form_word", "root_word")
    )
    return told.join(chosen, "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )


def variants(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of the documents."""
    return group_words(count_words(docs, settings), settings)
