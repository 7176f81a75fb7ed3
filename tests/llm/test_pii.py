"""Personal data against the plain patterns, on random texts and the edge cases."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from goldenlake.llm import pii

KINDS = ("email", "ip", "card", "phone")
PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
ALPHABETS = ["ab@.-1", "0123456789", "01.25", "1 -4", "+1 ().-23", "a@b.c +1 2-3é\n_%", "4111111111111111 -", "@.a"]
SCHEMA = "doc_id long, text string, spans string, `n email` int"


def confirmed(kind: str, text: str) -> bool:
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(digits[::-1])]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text: str) -> list[tuple[str, int, int]]:
    found = [(k, m.start(), m.end()) for k in KINDS for m in PLAIN[k].finditer(text) if confirmed(k, m.group())]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def test_base_spans_are_those_of_the_plain_patterns():
    own = random.Random(1)
    seen = set()
    for _ in range(20_000):
        text = "".join(own.choices(own.choice(ALPHABETS), k=own.randint(0, 45)))
        want = brute(text)
        got = sorted(map(tuple, pii.base_spans(text)), key=lambda s: (s[1], KINDS.index(s[0])))
        assert got == want, text
        seen.update(kind for kind, *_ in want)
    assert seen == set(KINDS)


def test_validators():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod_97("GB82WEST12345698765432") and not pii.mod_97("GB83WEST12345698765432")


def test_context_moves_the_score_and_decides_own_kinds():
    bare, told, against = "9 123-45-6789", "her ssn is 123-45-6789", "her ssn, part 123-45-6789"
    assert pii.find_spans(bare) == [] and pii.find_spans(against) == []
    assert pii.find_spans(told) == [("ssn", 11, 22, 0.6)]
    assert [s[0] for s in pii.find_spans("GB82 WEST 1234 5698 7654 32")] == ["iban"]
    near, far = "server 10.0.0.1", "version 10.0.0.1"
    assert pii.find_spans(near)[0][3] == 0.9 and pii.find_spans(far)[0][3] == 0.3  # base spans stay at any score
    # A local number inside an international one is that one's.
    assert [s[0] for s in pii.find_spans("call +1 (275) 555-5927 or 212-555-0199")] == ["phone", "local_phone"]


@pytest.mark.parametrize("unit", ["a", "1", "a@", "1 ", "+1", "AB12", "(123)", "1.", "123-45-6789 "])
def test_long_runs_take_linear_time(unit):
    pii.find_spans(unit * (300_000 // len(unit)))


ODD = [
    (1, None, "x", 1),
    (2, "", None, None),
    (None, "write to a.b@c.example, née x@y", "x", 1),
    (3, "é 4111-1111 1111 1111 é +49 (30) 1234567", "x", 1),
    (3, "é 4111-1111 1111 1111 é +49 (30) 1234567", "x", 1),
    (4, "x" * 200_000 + "@example.org", "x", 1),
]


def test_edges(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    found = pii.find(docs)
    assert found.columns == ["doc_id", "text", "n email", "spans"] and found.count() == len(ODD)
    rows = {r.doc_id: r for r in pii.digests(found).collect()}
    assert pii.digests(found).count() == len(ODD)
    for doc_id, text, *_ in ODD:
        want = ",".join(f"{k}:{s}:{e}" for k, s, e in brute(text or ""))
        assert rows[doc_id].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert rows[doc_id].spans == want and rows[doc_id].n_email == want.count("email")
    masked = {r.doc_id: r for r in pii.mask(docs).collect()}
    assert masked[3].text == "é <CARD> é <PHONE>" and masked[1].text is None and masked[2].text == ""
    assert pii.mask(docs).columns == docs.columns
    assert pii.find(docs.limit(0)).isEmpty() and pii.digests(pii.find(docs.limit(0))).isEmpty()
