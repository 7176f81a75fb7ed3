"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. The vector of an n-gram binds (multiplies) its letters' vectors, each
permuted (rotated) by its place; a text's vector bundles (adds) the vectors of all its n-grams. A language's prototype
is the bundle of all training texts of that language, and a text belongs to the prototype with the highest cosine.

A text is lower-cased and each run of other characters than letters becomes one blank. Null texts and texts without a
letter are ``und`` with score 0, as is everything when nothing was learned. Ties go to the smaller language name. Rows
are judged one by one, so repeated rows get equal answers; ``doc_id`` may be null. Other columns play no part in a
prediction.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenlake.llm.common import batches_of, mapped, with_computed, with_fresh

UNKNOWN = "und"
#: Symbol 0 is the blank, 1 to 26 are a to z, the other letters share the rest by their code point.
SYMBOLS = 128
_TABLE = None


@dataclass(frozen=True)
class Settings:
    dims: int = 1024
    width: int = 3  # letters of an n-gram
    seed: int = 3


def symbol_table() -> np.ndarray:
    """Symbol of each code point."""
    global _TABLE
    if _TABLE is None:
        points = range(0x110000)
        table = np.fromiter((27 + p % 101 if chr(p).isalpha() else 0 for p in points), np.uint8, len(points))
        table[97:123] = np.arange(1, 27)
        _TABLE = table
    return _TABLE


def letter_vectors(settings: Settings) -> np.ndarray:
    random = np.random.default_rng(settings.seed)
    return random.integers(0, 2, (SYMBOLS, settings.dims), np.int8) * np.int8(2) - np.int8(1)


def ngrams(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams of all texts, and the text each belongs to. A blank stands before and after each text."""
    table = symbol_table()
    points = np.frombuffer(" \0".join(["", *((t or "").lower() for t in texts), ""]).encode("utf-32-le"), np.uint32)
    row = np.cumsum(points == 0)
    symbols = table[points].astype(np.int64)
    own = np.flatnonzero(points == 0)
    if len(own) != len(texts) + 1:  # some text holds the mark itself
        return ngrams([(t or "").replace("\0", " ") for t in texts], width)
    # The mark becomes the blank before a text; runs of blanks within a text become one.
    keep = symbols > 0
    keep[1:] |= symbols[:-1] > 0
    keep[own] = True
    symbols, row = symbols[keep], row[keep] - 1
    ok = np.ones(max(len(symbols) - width + 1, 0), bool)
    codes, some = np.zeros(len(ok), np.int64), np.zeros(len(ok), bool)
    for i in range(width):
        part = slice(i, i + len(ok))
        ok &= row[part] == row[: len(ok)]
        some |= symbols[part] > 0
        codes = codes * SYMBOLS + symbols[part]
    ok &= some & (row[: len(ok)] >= 0) & (row[: len(ok)] < len(texts))
    return codes[ok], row[: len(ok)][ok]


def bound(codes: np.ndarray, letters: np.ndarray, width: int) -> np.ndarray:
    """Vectors of n-grams: the product of their letters' vectors, the first letter's rotated most."""
    out = np.ones((len(codes), letters.shape[1]), np.int8)
    for place in range(width):
        out *= np.roll(letters, place, axis=1)[codes // SYMBOLS**place % SYMBOLS]
    return out


def bundles(codes: np.ndarray, row: np.ndarray, rows: int, letters: np.ndarray, width: int) -> np.ndarray:
    """For each row the sum of its n-grams' vectors. A block of different n-grams is bound at a time."""
    block = 4096
    used, place = np.unique(codes, return_inverse=True)
    order = np.argsort(place, kind="stable") if len(used) > block else np.arange(len(place))
    ends = np.searchsorted(place[order], np.arange(0, len(used) + block, block))
    out = np.zeros((rows, letters.shape[1]))
    for i, first in enumerate(range(0, len(used), block)):
        own = order[ends[i] : ends[i + 1]]
        some = used[first : first + block]
        counts = np.bincount(row[own] * len(some) + place[own] - first, minlength=rows * len(some))
        counts = counts.reshape(rows, len(some)).astype(np.float32)
        out += counts @ bound(some, letters, width).astype(np.float32)
    return out


def fit(docs: DataFrame, settings: Settings = Settings()) -> dict[str, np.ndarray]:
    """Prototype of each language, from all rows with a text and a ``lang``."""
    letters, width = letter_vectors(settings), settings.width

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in batches_of(whole, "text"):
                langs = batch.column("lang").dictionary_encode()
                codes, row = ngrams(batch.column("text").to_pylist(), width)
                of = langs.indices.to_numpy(zero_copy_only=False)[row]
                totals = bundles(codes, of, len(langs.dictionary), letters, width)
                for lang, total in zip(langs.dictionary.to_pylist(), totals, strict=True):
                    sums[lang] = sums.get(lang, 0) + total.astype(np.int64)
        for lang, total in sums.items():
            yield pa.record_batch(
                [pa.array([lang] * len(total)), pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)],
                names=["lang", "dim", "value"],
            )

    rows = (
        mapped(docs.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL"), bundle, "lang string, dim int, value long")
        .groupBy("lang", "dim")
        .agg(F.sum("value").alias("value"))
        .collect()  # languages x dimensions
    )
    prototypes: dict[str, np.ndarray] = {}
    for r in rows:
        prototypes.setdefault(r.lang, np.zeros(settings.dims))[r.dim] = r.value
    return {lang: prototypes[lang] for lang in sorted(prototypes) if prototypes[lang].any()}


def judge(prototypes: dict[str, np.ndarray], settings: Settings = Settings()) -> Callable[[pa.RecordBatch], list[pa.Array]]:
    """What gives the language of each text of a batch and its cosine, at least 0."""
    letters, width = letter_vectors(settings), settings.width
    names = np.array([UNKNOWN, *prototypes], object)
    known = np.array([v / np.linalg.norm(v) for v in prototypes.values()], float).reshape(-1, settings.dims)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        best, score = np.zeros(len(batch), np.int64), np.zeros(len(batch))
        codes, row = ngrams(batch.column("text").to_pylist(), width)
        if len(known) and len(codes):
            vectors = bundles(codes, row, len(batch), letters, width)
            norms = np.linalg.norm(vectors, axis=1)
            cosines = vectors @ known.T / np.where(norms > 0, norms, 1)[:, None]
            has = np.bincount(row, minlength=len(batch)) > 0
            best = np.where(has, cosines.argmax(axis=1) + 1, 0)
            score = np.where(has, np.clip(cosines.max(axis=1), 0, 1), 0)
        return [pa.array(names[best], pa.string()), pa.array(score)]

    return run


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], settings: Settings = Settings()) -> DataFrame:
    """``docs`` with lang_pred and score."""
    return with_computed(docs, "lang_pred string, score double", judge(prototypes, settings))


def held_out(doc_id: Column) -> Column:
    """True for about every fifth document by hash; these are never learned from. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Learn from the rows that are not held out and predict every row: (doc_id, held_out, lang_pred, score)."""
    prototypes = fit(docs.filter(~held_out(F.col("doc_id"))), settings)
    return predict(docs.select("doc_id", "text"), prototypes, settings).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def noise_floor(prototypes: dict[str, np.ndarray], settings: Settings = Settings(), texts: int = 400) -> float:
    """The highest cosine that texts of random letters reach with any prototype. What a language is told from has to be more."""
    random = np.random.default_rng(settings.seed + 1)
    lengths = random.integers(8, 2000, texts)
    made = ["".join(random.choice(list("abcdefghijklmnopqrstuvwxyz     "), n)) for n in lengths]
    batch = pa.record_batch([pa.array(made, pa.string())], names=["text"])
    return max(judge(prototypes, settings)(batch)[1].to_pylist(), default=0.0)


def keep_identified(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` whose text resembles some learned language more than random letters do."""
    prototypes = fit(docs.filter(~held_out(F.col("doc_id"))), settings)
    floor = noise_floor(prototypes, settings)
    fields = {"lang_pred": "string", "score": "double"}
    judged, (pred, score) = with_fresh(docs, fields, judge(prototypes, settings))
    return judged.filter((F.col(pred) != UNKNOWN) & (F.col(score) > floor)).select(*(f"`{c}`" for c in docs.columns))
