"""Ids of a word-level BPE tokenizer file (``tokenizers`` format, lower case, ``</w>`` at word ends), word by word.

The library takes every occurrence of a word through its whole pipeline. Here all words of a column are found and hashed
(64 bits) at once, known ones are looked up, and only new ones are merged, many at a time. Equal hashes are never trusted: the
bytes of every word are held against those of the word that the ids were made for. Texts with characters for which a byte's
class isn't plain, with the strings of special tokens, with very long words, or with a word whose hash another word has, go
through the library itself.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from goldenlake.llm.common import byte_values, run_hashes, text_bytes, word_starts

#: Plain texts are ASCII without control characters, and the Latin-1 letters (bytes C3 80 to C3 BF but two signs).
_PLAIN = np.zeros(256, bool)
_PLAIN[[9, 10, 13, *range(32, 127), *range(0x80, 0xC0), 0xC3]] = True
#: Classes of the file's splitting pattern: 0 white space, 1 letters, 2 anything else, 3 digits, each alone.
_CLASSES = np.full(256, 2, np.uint8)
_CLASSES[[9, 10, 13, 32]] = 0
_CLASSES[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3]] = 1
_CLASSES[48:58] = 3
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[0x80:0x9F] += 32  # the second bytes of the capitals among the Latin-1 letters
_NONE = np.int32(2**31 - 1)
#: Words that a worker keeps before it starts anew, characters per call of the library, and bytes of a word beyond which its
#: text goes to the library, whose merging is not quadratic in the word.
KEPT_WORDS, LIBRARY_CHARS, LONG_WORD = 1_000_000, 100_000, 256
_CODERS: dict[str, WordCoder] = {}


def coder(path: str) -> WordCoder:
    """The coder of a tokenizer file, kept for the life of a worker."""
    if path not in _CODERS:
        _CODERS[path] = WordCoder(path)
    return _CODERS[path]


class WordCoder:
    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab = model["vocab"]
        # Bytes are written as printable characters: those that are printable stand for themselves, the rest follow.
        shown = [b for b in range(256) if chr(b).isprintable() and chr(b) != " "]
        letters = {b: chr(b) for b in shown} | {
            b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(shown))
        }
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[letters[b] + "</w>"] for b in range(256)], np.int32)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        order = np.argsort(keys)
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int32), merged[order]
        self.merged_by_rank = merged
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes, sorted
        self.place = np.zeros(0, np.int64)  # of each in the three arrays below
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.letters = np.zeros(0, np.uint8)  # bytes of all words
        self.begins = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word: the pair of lowest rank is merged, leftmost first, until no pair is known."""
        out: list[np.ndarray] = [None] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        for length, which in by_length.items():
            block = max(1, (1 << 21) // length)
            for first in range(0, len(which), block):
                own = which[first : first + block]
                data = np.frombuffer(b"".join(words[i] for i in own), np.uint8).reshape(len(own), length)
                symbols = self.inner[data]
                symbols[:, -1] = self.last[data[:, -1]]
                for i, ids in zip(own, self._merge_rows(symbols), strict=True):
                    out[i] = ids
        return out

    def _merge_rows(self, symbols: np.ndarray) -> list[np.ndarray]:
        rows, width = symbols.shape
        done: list[np.ndarray] = [None] * rows
        left = np.arange(rows)
        used = np.full(rows, width)
        ranks = np.full((rows, width), _NONE, np.int32)
        if width > 1:
            ranks[:, :-1] = self._rank(symbols[:, :-1], symbols[:, 1:])
        columns = np.arange(width)
        while True:
            at = ranks.argmin(axis=1)
            line = np.arange(len(at))
            best = ranks[line, at]
            over = best == _NONE
            for i in np.flatnonzero(over):
                done[left[i]] = symbols[i, : used[i]].copy()
            if over.all():
                return done
            go = ~over
            symbols, ranks, used, left, at, best = symbols[go], ranks[go], used[go] - 1, left[go], at[go], best[go]
            line = np.arange(len(at))
            # The merged symbol takes the left place; what stood behind its right half moves up by one.
            symbols[line, at] = self.merged_by_rank[best]
            source = np.minimum(columns[None, :] + (columns[None, :] > at[:, None]), width - 1)
            symbols = np.take_along_axis(symbols, source, axis=1)
            source = np.minimum(columns[None, :] + (columns[None, :] >= at[:, None]), width - 1)
            ranks = np.take_along_axis(ranks, source, axis=1)
            ranks[:, -1] = _NONE
            more = at + 1 < used
            ranks[line, at] = _NONE
            ranks[line[more], at[more]] = self._rank(symbols[line[more], at[more]], symbols[line[more], at[more] + 1])
            more = at > 0
            ranks[line[more], at[more] - 1] = self._rank(symbols[line[more], at[more] - 1], symbols[line[more], at[more]])

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each known hash, -1 for others."""
        if not len(self.known):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.place[at], -1)

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        new = self.merge(words)
        lengths = np.array([len(x) for x in new], np.int64)
        self.place = np.concatenate([self.place, len(self.starts) + np.arange(len(words))])
        self.known = np.concatenate([self.known, hashes])
        order = np.argsort(self.known, kind="stable")
        self.known, self.place = self.known[order], self.place[order]
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, *new])
        sizes = np.array([len(w) for w in words], np.int64)
        self.begins = np.concatenate([self.begins, len(self.letters) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.letters = np.concatenate([self.letters, np.frombuffer(b"".join(words), np.uint8)])

    def _by_library(self, text: str) -> np.ndarray:
        out, first = [], 0
        while first < len(text):
            last = len(text)
            if last - first > LIBRARY_CHARS:
                cut = text.find(" ", first + LIBRARY_CHARS)
                last = cut if cut > 0 else last
            out += self.library.encode(text[first:last], add_special_tokens=False).ids
            first = last
        return np.array(out, np.int32)

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of each text, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them; null is empty."""
        data, offsets = text_bytes(column)
        rows = len(offsets) - 1
        if not len(data):
            return [np.zeros(0, np.int32)] * rows
        after = np.append(data[1:], 0)
        odd = ~_PLAIN[data] | ((data == 0xC3) & ((after == 0x97) | (after == 0xB7))) | ((data == 60) & (after == 124))
        odd_rows = np.unique(np.searchsorted(offsets, np.flatnonzero(odd), side="right") - 1)
        kind = _CLASSES[data]
        for r in odd_rows:
            kind[offsets[r] : offsets[r + 1]] = 0
        start = word_starts(kind, offsets)
        start |= kind == 3
        codes = _LOWER[data]
        self._contractions(codes, kind, start, offsets)
        starts = np.flatnonzero(start)
        sizes = self._sizes(kind, starts)
        if (long := starts[sizes > LONG_WORD]).size:
            odd_rows = np.union1d(odd_rows, np.searchsorted(offsets, long, side="right") - 1)
            for r in odd_rows:
                kind[offsets[r] : offsets[r + 1]] = 0
                start[offsets[r] : offsets[r + 1]] = False
            starts = np.flatnonzero(start)
            sizes = self._sizes(kind, starts)
        hashes = run_hashes(codes, start, kind > 0, byte_values(False))
        used, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        found = self._find(used)
        if (found < 0).sum() + len(self.known) > KEPT_WORDS:
            self._forget()
            found[:] = -1
        if (new := np.flatnonzero(found < 0)).size:
            begin = starts[first[new]]
            raw = codes.tobytes()
            self._learn(used[new], [raw[b:e] for b, e in zip(begin, begin + sizes[first[new]], strict=True)])
            found = self._find(used)
        place = found[which]
        if (other := starts[self._differ(codes, starts, sizes, place)]).size:
            odd_rows = np.union1d(odd_rows, np.searchsorted(offsets, other, side="right") - 1)
        lengths = self.lengths[place]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.starts[place] - ends + lengths, lengths) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.searchsorted(starts, offsets)]
        out = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for r in odd_rows:
            out[r] = self._by_library(column[int(r)].as_py())
        return out

    @staticmethod
    def _sizes(kind: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bytes of the words that begin at ``starts``."""
        if not len(starts):
            return np.zeros(0, np.int64)
        blank = np.append(np.flatnonzero(kind == 0), len(kind))
        return np.minimum(np.append(starts[1:], len(kind)), blank[np.searchsorted(blank, starts)]) - starts

    def _differ(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Words that are not, byte by byte, those at ``place``."""
        bad = sizes != self.sizes[place]
        block = 1 << 16
        for first in range(0, len(starts), block):  # words have LONG_WORD bytes at most
            own = np.flatnonzero(~bad[first : first + block]) + first
            within = np.arange(sizes[own].sum()) - np.repeat(np.cumsum(sizes[own]) - sizes[own], sizes[own])
            mine = codes[np.repeat(starts[own], sizes[own]) + within]
            known = self.letters[np.repeat(self.begins[place[own]], sizes[own]) + within]
            bad[own[np.repeat(np.arange(len(own)), sizes[own])[mine != known]]] = True
        return np.flatnonzero(bad)

    @staticmethod
    def _contractions(codes: np.ndarray, kind: np.ndarray, start: np.ndarray, offsets: np.ndarray) -> None:
        """'s 't 're 've 'm 'll 'd are words of their own where a word may begin."""
        quote = np.flatnonzero(start & (codes == 39))
        if not len(quote):
            return
        end = offsets[np.searchsorted(offsets, quote, side="right")]
        padded = np.concatenate([codes, np.zeros(2, np.uint8)])
        one = np.where(quote + 1 < end, padded[quote + 1], 0)
        two = np.where(quote + 2 < end, padded[quote + 2], 0)
        length = np.where(np.isin(one, list(b"stmd")), 1, 0)
        for a, b in (b"re", b"ve", b"ll"):
            length[(one == a) & (two == b)] = 2
        quote, length, end = quote[length > 0], length[length > 0], end[length > 0]
        start[quote + 1] = False
        rest = quote + 1 + length
        rest = rest[(rest < end)]
        start[rest[kind[rest] == 1]] = True
