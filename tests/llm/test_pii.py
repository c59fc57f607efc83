"""Base patterns against plain regular expressions, disguises, offsets, redaction."""

import hashlib
import random
import re

import pytest
from llm.conftest import AWKWARD

from lakemart.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def by_hand(text):
    found = [(m.start(), "email", m.end()) for m in EMAIL.finditer(text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), "ip", m.end()))
    for kind, pattern, low, high in (
        ("card", r"[0-9]([\x20-]?[0-9])+", 12, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15),
    ):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            doubled = [2 * d - 9 * (d > 4) if i % 2 else d for i, d in enumerate(reversed(digits))]
            if low <= len(digits) <= high and (kind == "phone" or sum(doubled) % 10 == 0):
                found.append((m.start(), kind, m.end()))
    found.sort(key=lambda s: (s[0], pii.KINDS.index(s[1])))
    return ",".join(f"{k}:{a}:{b}" for a, k, b in found)


def test_base_patterns():
    random_ = random.Random(4)
    alphabet = ["a", "b@", "@", ".", ".c", "1", "2", "255", "256", "-", " ", "+", "(", "４", "é", "4111111111111111", "😀"]
    for _ in range(6000):
        text = "".join(random_.choice(alphabet) for _ in range(random_.randint(0, 25)))
        assert pii.digest(pii.base_spans(text)) == by_hand(text), text


def found(text):
    return [(text[a:b], k) for a, b, k in pii.find(text)[1]]


def test_disguises():
    assert found("write bob.x [at] site (dot) example [dot] com now") == [("bob.x [at] site (dot) example [dot] com", "email")]
    assert found("bob at site dot com.") == [("bob at site dot com", "email")]
    assert found("é bоb@exаmple.com é") == [("bоb@exаmple.com", "email")]
    assert found("call plus four nine three zero one two three four five six!") == [
        ("plus four nine three zero one two three four five six", "phone")
    ]
    assert found("x ４１１１１１１１１１１１１１１１ y") == [("４１１１１１１１１１１１１１１１", "card")]
    assert found("Four-one-one-one one one one one one one one one one one one one") == [
        ("Four-one-one-one one one one one one one one one one one one one", "card")
    ]
    assert found("10．0．0．1") == [("10．0．0．1", "ip")]


@pytest.mark.parametrize(
    "hidden, kind",
    [
        ("john [at] example dot com", "email"), ("john@example dot com", "email"), ("john at example [dot] com", "email"),
        ("john at example dot ai", "email"), ("john.x at mail dot example.org", "email"), ("john at mail.example dot travel", "email"),
        ("JOHN AT EXAMPLE DOT COM", "email"), ("john (at) sub dot example (dot) museum", "email"), ("j@sub dot example.info", "email"),
        ("jo\u200bhn@exam\u00adple.com", "email"), ("john@exam\u2060ple dot com", "email"),
        ("192 dot 168 dot 0 dot 1", "ip"), ("192 dot 168.0 (dot) 1", "ip"), ("10.0\u200b.0.1", "ip"),
        ("+44 20 7946 0 nine five eight", "phone"), ("4111 1111 \ufeff1111 1111", "card"),
    ],
)
def test_mixed_disguises(hidden, kind):
    assert (hidden, kind) in found(hidden)
    around = f"Write to {hidden}, or stay."
    assert (hidden, kind) in found(around)
    assert pii.redact(around) == f"Write to [{kind}], or stay."


def test_a_longer_disguise_stands_beside_the_base_span():
    text = "call +44 20 7946 0 nine five eight now"
    assert found(text) == [("+44 20 7946 0", "phone"), ("+44 20 7946 0 nine five eight", "phone")]
    assert pii.redact(text) == "call [phone] now"
    # A find that only overlaps a base span says nothing new of it.
    assert pii.digest(pii.find("a@b.cc")[1]) == "email:0:6"


def test_sentences_with_at_and_dot():
    for text in (
        "look at the dot on one page", "visit us at example.com or at example.org", "we met at noon dot dot dot",
        "at every dot carefully drawn", "stop at this dot and go", "the dot at the end dot", "1 dot 2 dot 3",
        "aim at a dot in it", "soft\u00adhyphen and zero\u200bwidth", "256 dot 300 dot 1 dot 1",
    ):
        assert [s for s in found(text) if s not in [(text[a:b], k) for a, b, k in pii.find(text)[0]]] == [], text


def test_plain_text_has_no_disguises():
    for text in ("look at the dot on one page, one two", "at noon (dot) and [at] night", "Стол и стул", "one two three", ""):
        assert found(text) == []
    text = "a@b.cc and c@d.ee, +1 (988) 555-2485"
    assert pii.find(text)[0] == pii.find(text)[1] and len(found(text)) == 3


def test_rewriting_maps_back():
    random_ = random.Random(6)
    for _ in range(500):
        source = "".join(random_.choice("abc") for _ in range(20))
        new = pii.Rewritten(source)
        for _ in range(3):
            cuts = sorted(random_.sample(range(len(new.text) + 1), min(4, len(new.text) + 1)))
            new.replace([(a, b, "X" * random_.randint(0, 2)) for a, b in zip(cuts[::2], cuts[1::2])])
            if not new.text:
                break
            for i, c in enumerate(new.text):
                a, b = new.span(i, i + 1)
                assert 0 <= a <= b <= len(source) and (c == "X" or source[a:b] == c)


def test_tables(docs):
    rows = [*AWKWARD, (20, "a@b.cc " * 3 + "4111 1111 1111 1111 🙂 1.2.3.4 x [at] y [dot] zz"), (21, "1" * 20_000)]
    out = {str(r["doc_id"]) + str(len(r["spans"])): r for r in pii.detect(docs(*rows, extra="1 AS spans")).collect()}
    assert sum(1 for _ in out) >= 9 and pii.detect(docs()).collect() == []
    row = next(r for r in out.values() if r["doc_id"] == 20)
    assert tuple(row[1:5]) == (3, 1, 1, 0) and row["n_hidden"] == 1
    text = rows[-2][1]
    assert row["base_sha256"] == hashlib.sha256(by_hand(text).encode()).hexdigest()
    clean = pii.redacted(docs(*rows, extra="5 AS clean"))
    assert clean.columns[-1] == "clean" and clean.count() == len(rows)
    assert pii.redacted(docs()).collect() == []
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert texts[20] == "[email] [email] [email] [card] 🙂 [ip] [email]" and texts[1] is None and texts[2] == ""
