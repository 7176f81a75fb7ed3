"""Byte-level BPE with the tiktoken library and a local file of ranks.

Long texts are cut where no match of the splitting pattern can reach across, so that the library sees short pieces and
the ids stay those of the whole text. A null text counts as empty: no ids. Rows are coded one by one, so ties, repeated
rows and null ids need no care; all other columns are carried along.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from goldenlake.llm.common import with_computed

#: Characters per piece of a long text, and per run of white space that the library is given.
PIECE = 1 << 16
#: A letter or digit, then a blank or line feed: every match ends before the white space, whatever follows.
_SAFE = regex.compile(r"(?<=[\p{L}\p{N}])[ \n]")
#: White space of the pattern; a run that is too long for the library's matcher is coded as the one match it is.
_BLANKS = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_LONG_BLANK = regex.compile("[%s]{%d,}" % ("".join(map(chr, _BLANKS)), PIECE // 4))
_ENCODINGS: dict[str, tiktoken.Encoding] = {}


def encoding(path: str) -> tiktoken.Encoding:
    """The encoding of a rank file, kept for the life of a worker."""
    if path not in _ENCODINGS:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _ENCODINGS[path] = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _ENCODINGS[path]


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut at safe places only."""
    first = 0
    while len(text) - first > size:
        found = _SAFE.search(text, first + size)
        if found is None:
            break
        yield text[first : found.start()]
        first = found.start()
    yield text[first:]


def _encode_piece(coder: tiktoken.Encoding, piece: str) -> list[int]:
    ids: list[int] = []
    first = 0
    for found in _LONG_BLANK.finditer(piece):
        start, end = found.span()
        ids += coder.encode_ordinary(piece[first:start])
        # Before a visible character the run's last blank belongs to the next match, or stands alone.
        end -= end < len(piece)
        ids += coder._encode_single_piece(piece[start:end])
        first = end
    return ids + coder.encode_ordinary(piece[first:])


def encode_text(coder: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) <= PIECE // 4:
        return coder.encode_ordinary(text)
    return [i for piece in pieces(text) for i in _encode_piece(coder, piece)]


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column of token ids in place of its text."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        coder = encoding(path)
        coded = [encode_text(coder, t) if t else [] for t in batch.column(text).to_pylist()]
        return [pa.array(coded, pa.list_(pa.int32()))]

    return with_computed(docs, f"`{ids}` array<int>", run, text, 4 << 20).drop(text)


def decode(coded: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``coded`` with a column of the raw bytes that its ids stand for; a null list stays null."""
    schema = T.StructType([*(f for f in coded.schema.fields if f.name != decoded), T.StructField(decoded, T.BinaryType())])
    names = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(path)
        for batch in batches:
            lists = batch.column(ids).to_pylist()
            out = pa.array([None if x is None else coder.decode_bytes(x) for x in lists], pa.binary())
            yield pa.record_batch([*(batch.column(n) for n in names), out], names=[*names, decoded])

    return coded.select(*(f"`{n}`" for n in names)).mapInArrow(run, schema)
