"""Cost-balanced packing of documents into sequences of a fixed number of tokens.

A piece's cost is its tokens plus its attention, which grows with the square of its length. In descending order, pieces
go to the sequence of lowest cost that still has room for them; one for which none has is cut. Each task packs the documents
of its own input split, a window of tokens at a time, so nothing is shuffled and memory is bounded by the window. Every
sequence of a window is full; what is left over joins the next window, and the tail of a split is laid into sequences
of powers of two, which need no padding.

A null text is empty: its document is the end token alone. Null, tied and repeated ids, repeated rows and extra columns
do no harm: every row is a document of its own. An empty table gives no pieces.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from goldenlake.llm.common import batches_of, mapped
from goldenlake.llm.word_bpe import coder

FIELDS = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, tokens binary"


@dataclass(frozen=True)
class Settings:
    length: int = 4096  # tokens of a sequence
    end: int = 2  # id after each document
    window: int = 1 << 20  # tokens packed together
    hidden: int = 1024  # width of the model: attention costs as much as the rest at 6 * hidden tokens


@dataclass(frozen=True)
class Piece:
    doc: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int


def cost(tokens: int, settings: Settings) -> float:
    return tokens + tokens * tokens / (6 * settings.hidden)


def cut(piece: Piece, tokens: int) -> tuple[Piece, Piece]:
    return (
        Piece(piece.doc, piece.start, piece.ids[:tokens], piece.doc_tokens),
        Piece(piece.doc, piece.start + tokens, piece.ids[tokens:], piece.doc_tokens),
    )


def pack(pieces: list[Piece], settings: Settings) -> tuple[list[list[Piece]], list[Piece]]:
    """Full sequences, and the pieces (less than a sequence in all) that are left over."""
    full, pool = [], []
    for piece in pieces:
        while len(piece.ids) >= settings.length:
            head, piece = cut(piece, settings.length)
            full.append([head])
        if len(piece.ids):
            pool.append(piece)
    bins: list[list[Piece]] = [[] for _ in range(sum(len(p.ids) for p in pool) // settings.length)]
    room, spent = np.full(len(bins), settings.length), np.zeros(len(bins))
    queue = [(-len(p.ids), order, p) for order, p in enumerate(pool)]
    heapq.heapify(queue)
    serial = len(queue)
    while queue and room.any():
        _, _, piece = heapq.heappop(queue)
        fits = room >= len(piece.ids)
        if not fits.any():  # no sequence has room for it: it is cut to the cheapest that is open
            fits = room > 0
        i = int(np.where(fits, spent, np.inf).argmin())
        if room[i] < len(piece.ids):
            piece, rest = cut(piece, int(room[i]))
            heapq.heappush(queue, (-len(rest.ids), serial, rest))
            serial += 1
        bins[i].append(piece)
        room[i] -= len(piece.ids)
        spent[i] += cost(len(piece.ids), settings)
    return full + bins, [p for _, _, p in sorted(queue, key=lambda x: x[1])]


def tail(pieces: list[Piece]) -> list[list[Piece]]:
    """Sequences of powers of two, the longest first."""
    out, left = [], sum(len(p.ids) for p in pieces)
    pieces = pieces[::-1]
    while left:
        need = 1 << (left.bit_length() - 1)
        left -= need
        sequence = []
        while need:
            piece = pieces.pop()
            if len(piece.ids) > need:
                piece, rest = cut(piece, need)
                pieces.append(rest)
            sequence.append(piece)
            need -= len(piece.ids)
        out.append(sequence)
    return out


def pack_documents(docs: DataFrame, path: str, settings: Settings = Settings()) -> DataFrame:
    """Pieces of documents: doc_id, start (in its document), length, doc_tokens, sequence_id, offset (in the sequence)
    and tokens (ids as little-endian unsigned 32-bit numbers)."""

    def rows(sequences: list[list[Piece]], first: int) -> pa.RecordBatch:
        of = [(p, first + i) for i, sequence in enumerate(sequences) for p in sequence]
        lengths = [len(p.ids) for p, _ in of]
        offsets, at, last = [], 0, None
        for (_, sequence), length in zip(of, lengths, strict=True):
            at = at if sequence == last else 0
            offsets.append(at)
            at, last = at + length, sequence
        columns = [
            pa.array([p.doc for p, _ in of], pa.int64()),
            pa.array([p.start for p, _ in of], pa.int64()),
            pa.array(lengths, pa.int64()),
            pa.array([p.doc_tokens for p, _ in of], pa.int64()),
            pa.array([s for _, s in of], pa.int64()),
            pa.array(offsets, pa.int64()),
            pa.array([p.ids.astype("<u4").tobytes() for p, _ in of], pa.binary()),
        ]
        return pa.record_batch(columns, names=[f.split()[0] for f in FIELDS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = coder(path)
        serial = TaskContext.get().partitionId() << 33
        pool: list[Piece] = []
        held = 0
        for whole in batches:
            for batch in batches_of(whole, "text", 4 << 20):
                ids = batch.column("doc_id").to_pylist()
                for doc, own in zip(ids, words.encode(batch.column("text")), strict=True):
                    own = np.append(own, np.int32(settings.end))
                    pool.append(Piece(doc, 0, own, len(own)))
                    held += len(own)
                if held >= settings.window:
                    sequences, pool = pack(pool, settings)
                    held = sum(len(p.ids) for p in pool)
                    yield rows(sequences, serial)
                    serial += len(sequences)
        sequences, pool = pack(pool, settings)
        sequences += tail(pool)
        if sequences:
            yield rows(sequences, serial)

    return mapped(docs.select("doc_id", "text"), run, FIELDS)
