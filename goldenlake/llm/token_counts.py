"""Token counts that follow edits.

A document's pre-tokens are grouped into leaves of some hundred characters, cut where no pre-token can reach across. A
segment tree over the leaves holds sums of characters and tokens. An edit finds its leaves by the character sums; these,
with a neighbour where the edit touches a leaf's edge, are the only text that is encoded again, and sums change on the
paths to the root alone.

A null text is empty. Edits are (start, end, text) in characters of the original text; they must not overlap, and are
applied from the last to the first. Edits beyond the end are moved to the end. Rows are counted one by one, so ties,
repeated rows and null ids need no care; other columns are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from goldenlake.llm.bpe import encode_text, encoding, pieces
from goldenlake.llm.common import with_computed

LEAF = 512
Edit = tuple[int, int, str]

#: What a corpus is cleared of, and what stands in its place.
PRIVATE = [
    (re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+"), "<email>"),
    (re.compile(r"\b[0-9a-f]{32,}\b"), "<secret>"),
    (re.compile(r"\+?\d[ \d()-]{7,}\d"), "<phone>"),
]


class CountTree:
    """Leaves of a text and a tree of (characters, tokens) sums over them."""

    def __init__(self, text: str, coder: tiktoken.Encoding, leaf: int = LEAF):
        self.coder = coder
        self.leaves = list(pieces(text, leaf))
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, piece in enumerate(self.leaves):
            self.chars[self.size + i], self.tokens[self.size + i] = len(piece), len(encode_text(coder, piece))
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def total(self) -> int:
        return self.tokens[1]

    def _leaf(self, at: int) -> tuple[int, int]:
        """Leaf that holds a place of the text, and where in it."""
        i = 1
        while i < self.size:
            i *= 2
            if at >= self.chars[i] and self.chars[i + 1]:
                at -= self.chars[i]
                i += 1
        return min(i - self.size, len(self.leaves) - 1), at

    def edit(self, start: int, end: int, text: str) -> int:
        """Put ``text`` in place of the characters from start to end; returns how many characters were encoded."""
        length = self.chars[1]
        start, end = min(start, length), min(max(start, end), length)
        first, at = self._leaf(start)
        last, until = self._leaf(max(end - 1, start))
        until += end > start
        # Cuts are safe by the characters beside them; an edit that touches one takes in the leaf on its other side.
        low, high = first, last
        if at <= 1:
            low = max(low - 1, 0)
            while low and not self.leaves[low]:
                low -= 1
        if until + 1 >= len(self.leaves[last]):
            high = min(high + 1, len(self.leaves) - 1)
            while high + 1 < len(self.leaves) and not self.leaves[high]:
                high += 1
        before = "".join(self.leaves[low:first]) + self.leaves[first][:at]
        after = self.leaves[last][until:] + "".join(self.leaves[last + 1 : high + 1])
        region = before + text + after
        if len(region) < 2 * 2 and (low or high + 1 < len(self.leaves)):  # too little is left to keep both cuts safe
            low, high, region = 0, len(self.leaves) - 1, "".join(self.leaves[:low]) + region + "".join(self.leaves[high + 1 :])
        for i in range(low, high + 1):
            self.leaves[i] = region if i == low else ""
            self.chars[self.size + i] = len(self.leaves[i])
            self.tokens[self.size + i] = len(encode_text(self.coder, self.leaves[i]))
        changed = {(self.size + i) // 2 for i in range(low, high + 1)}
        while changed and 0 not in changed:
            for i in changed:
                self._sum(i)
            changed = {i // 2 for i in changed}
        return len(region)


def redactions(text: str) -> list[Edit]:
    """Edits that take private data out, and the first line of a text of several lines."""
    taken: list[Edit] = []
    line = text.find("\n")
    if 0 <= line < len(text) - 1:
        taken.append((0, line + 1, ""))
    for pattern, word in PRIVATE:
        for found in pattern.finditer(text):
            if all(found.end() <= s or e <= found.start() for s, e, _ in taken):
                taken.append((found.start(), found.end(), word))
    return sorted(taken)


def apply_edits(text: str, edits: list[Edit]) -> str:
    for start, end, word in sorted(edits, reverse=True):
        text = text[:start] + word + text[end:]
    return text


def count_edits(docs: DataFrame, path: str, edits_of: Callable[[str], list[Edit]] = redactions) -> DataFrame:
    """``docs`` without text, with tokens_before, tokens_after, n_edits, chars_encoded (again), and the leaves' sums after
    all edits (leaf_chars, leaf_tokens), from which a tree is built again."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        coder, rows = encoding(path), []
        for text in batch.column("text").to_pylist():
            text = text or ""
            tree = CountTree(text, coder)
            before, edits = tree.total(), edits_of(text)
            again = sum(tree.edit(*edit) for edit in sorted(edits, reverse=True))
            leaves = slice(tree.size, tree.size + len(tree.leaves))
            rows.append((before, tree.total(), len(edits), again, tree.chars[leaves], tree.tokens[leaves]))
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())] * 2
        return [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]

    fields = "tokens_before long, tokens_after long, n_edits long, chars_encoded long, leaf_chars array<int>, leaf_tokens array<int>"
    return with_computed(docs, fields, compute, limit=4 << 20).drop("text")
