"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words adjust their scores.

Base kinds are e-mail addresses, IP addresses, payment cards (Luhn) and international phone numbers; what their pattern and
validator accept always stays, whatever its score. The method adds bank accounts (IBAN, mod 97), social security numbers and
local phone numbers; such a span stays if its score, which words around it raise or lower, reaches ``Settings.least`` and it
does not touch a base span. Matches of a kind are the leftmost ones that do not overlap; one that its validator rejects is
dropped and not tried again shorter. All patterns run in time linear in the text: where a naive pattern would start anew at
every character of a long run, matching starts at the head of the run, which gives the same matches.

Offsets count code points from 0, ends are exclusive. A null or empty text has no spans. Rows are read one by one: ids may be
null, tied or repeated, rows may be repeated, extra columns are kept (one named ``spans`` is replaced). An empty table gives
no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenlake.llm.common import with_computed

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "local_phone")
_ORDER = {kind: i for i, kind in enumerate(KINDS)}

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_BACKWARDS = re.compile(r"[A-Za-z0-9._%+-]++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9(-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])")
_NOT_DIGITS = re.compile("[^0-9]+")
_WORDS = re.compile("[a-z]+")

#: Score of a confirmed span without any context.
START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.3, "local_phone": 0.3}
#: Words near a span that raise its score.
RAISE = {
    "email": {"email", "mail", "contact", "write", "address"},
    "ip": {"ip", "address", "server", "host", "login", "client"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "payment"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "cell"},
    "iban": {"iban", "account", "bank", "transfer", "konto"},
    "ssn": {"ssn", "social", "security"},
    "local_phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "cell"},
}
#: Words near a span that lower its score.
LOWER = {
    "ip": {"version", "release", "section", "chapter"},
    "card": {"isbn", "tracking", "serial", "order"},
    "iban": {"serial", "model", "part"},
    "ssn": {"part", "order", "serial", "isbn"},
    "local_phone": {"part", "order", "serial", "isbn"},
}


@dataclass(frozen=True)
class Settings:
    least: float = 0.5  # score that a span of the method's own kinds needs
    around: int = 40  # code points before and behind a span whose words count
    step: float = 0.3  # what context adds to or takes from a score


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def luhn(digits: str) -> bool:
    """The checksum of payment cards: every second digit from the right is doubled, its own digits added."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod_97(account: str) -> bool:
    """The checksum of bank accounts: the first four characters go behind, letters count from 10."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str) -> Iterator[Span]:
    """Each @ with a domain behind it takes the run of name characters before it, back to the match before."""
    reversed_text, done = None, 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        if domain:
            if reversed_text is None:
                reversed_text = text[::-1]
            name = _LOCAL_BACKWARDS.match(reversed_text, len(text) - at, len(text) - done)
            if name:
                done = domain.end()
                yield Span("email", len(text) - name.end(), done)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    spans = list(emails(text))
    for m in _IP.finditer(text):
        # Zeros in front do not count; a part of many digits is never turned into a number.
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (part.lstrip("0") for part in m.group().split("."))):
            spans.append(Span("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 38:
            digits = _NOT_DIGITS.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append(Span("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(m.group().count, "0123456789")) <= 15:
                spans.append(Span("phone", m.start(), m.end()))
    return spans


def own_spans(text: str) -> list[Span]:
    """What the method adds: confirmed or at least well-formed spans of its own kinds."""
    spans = [Span("iban", m.start(), m.end()) for m in _IBAN.finditer(text) if mod_97(m.group().replace(" ", ""))]
    for m in _SSN.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            spans.append(Span("ssn", m.start(), m.end()))
    spans += [Span("local_phone", m.start(), m.end()) for m in _LOCAL_PHONE.finditer(text)]
    return spans


def score_of(text: str, span: Span, settings: Settings) -> float:
    before = text[max(span.start - settings.around, 0) : span.start]
    near = set(_WORDS.findall((before + " " + text[span.end : span.end + settings.around]).lower()))
    score = START[span.kind]
    if near & RAISE[span.kind]:
        score += settings.step
    if near & LOWER.get(span.kind, set()):
        score -= settings.step
    return round(min(max(score, 0.0), 1.0), 3)


def find_spans(text: str | None, settings: Settings = Settings()) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of all spans of a text, by start, then kind as listed in ``KINDS``."""
    if not text:
        return []
    found = [(s, score_of(text, s, settings)) for s in base_spans(text)]
    taken = covered([s for s, _ in found])
    for span in own_spans(text):
        score = score_of(text, span, settings)
        if score >= settings.least and not _touches(span, taken):
            found.append((span, score))
    found.sort(key=lambda f: (f[0].start, _ORDER[f[0].kind], f[0].end))
    return [(*span, score) for span, score in found]


def covered(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans cover, in order."""
    starts: list[int] = []
    ends: list[int] = []
    for _, start, end in sorted(spans, key=lambda s: s.start):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def _touches(span: Span, taken: tuple[list[int], list[int]]) -> bool:
    starts, ends = taken
    last = bisect_left(starts, span.end) - 1
    return last >= 0 and ends[last] > span.start


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
_FIELDS = ("kind", "start", "end", "score")


def find(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with ``spans``: an array of (kind, start, end, score), never null."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = []
        for text in batch.column("text"):
            rows.append([dict(zip(_FIELDS, span, strict=True)) for span in find_spans(text.as_py(), settings)])
        return [pa.array(rows, _SPANS)]

    schema = "spans array<struct<kind: string, start: long, end: long, score: double>>"
    return with_computed(docs, schema, compute, limit=1 << 20)


def mask(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in capitals; of spans that overlap, the first is named."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        out = []
        for value in batch.column("text"):
            text = value.as_py()
            pieces, at = [], 0
            for kind, start, end, _ in find_spans(text, settings):
                if start >= at:
                    pieces += [text[at:start], f"<{kind.upper()}>"]
                at = max(at, end)
            out.append(text if text is None else "".join([*pieces, text[at:]]))
        return [pa.array(out, pa.string())]

    masked = with_computed(docs.drop("masked_text"), "masked_text string", compute, limit=1 << 20)
    return masked.select(*(F.col("masked_text").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns))


def joined(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of what ``find`` returned."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE_KINDS),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.transform("spans", lambda s: s["score"]).alias("scores"),
    )
