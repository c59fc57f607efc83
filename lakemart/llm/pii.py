"""Personal data: base patterns, and offset-preserving deobfuscation that finds disguised identifiers.

A chain of transducers rewrites a text and remembers, for each stretch it changed, where the stretch came from:
invisible characters go, look-alike characters become ASCII, spelled digits become digits, and at/dot disguises become `@`
and `.`. The base patterns then run on the rewritten text, and what they find is mapped back to the characters of the
source. A find counts only if a transducer changed something inside it, and if it overlaps no base span of its kind but
shorter ones that lie inside it, so plain text gives the base spans and nothing else.

An at or a dot can be literal, bracketed or a bare word, in any mixture. Bare words are also plain English, so they count
only within a whole address, and by more rules the less there is besides them: see `bare_addresses`.

Texts are handled whole, one at a time, in Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone")
# The base patterns. The local part of an email is found from its `@` to the left, see `_emails`.
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")

# Look-alikes of ASCII letters and signs. Full-width forms, U+FF01 to U+FF5E, follow by rule.
CYRILLIC = dict(zip("асеіјорѕхуԁһкмтАВСЕНІЈКМОРЅТХ", "aceijopsxydhkmtABCEHIJKMOPSTX"))
GREEK = dict(zip("ονιαρκΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "oviapkABEZHIKMNOPTYX"))
SIGNS = {"﹫": "@", "。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", " ": " ", " ": " ", " ": " "}
FULL_WIDTH = {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
# Digits of other scripts and styles: runs of ten characters, by the code point of their zero.
ZEROS = (0x660, 0x6F0, 0x966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6)
DIGITS = {chr(zero + d): str(d) for zero in ZEROS for d in range(10)}
LOOK_ALIKES = {**CYRILLIC, **GREEK, **SIGNS, **FULL_WIDTH, **DIGITS}
LOOK_ALIKE = re.compile(f"[{re.escape(''.join(LOOK_ALIKES))}]+")

SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9", "plus": "+",
}
_DIGIT_WORD = "(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)"
# Three at least in a row: fewer are ordinary words. A digit may stand among them.
SPELLED_RUN = re.compile(
    rf"(?<![A-Za-z0-9])(?:plus[\x20-]+)?{_DIGIT_WORD}(?:[\x20-]+(?:{_DIGIT_WORD}|[0-9])){{2,}}(?![A-Za-z0-9])", re.I
)
DIGIT_WORD = re.compile(f"{_DIGIT_WORD}|plus", re.I)
SPELLED_GAP = re.compile(r"[\x20-]+")
# A cheap test that must hold before the patterns above can match.
MAYBE_SPELLED = re.compile(r"(?:ero|oh|one|two|hree|our|ive|six|even|ight|ine)[\x20-]+[zotfsenZOTFSEN0-9]", re.I)

_BRACKETED = r"[\x20]*[\[({<][\x20]*(?:%s)[\x20]*[\])}>][\x20]*"
AT_SIGN = re.compile(_BRACKETED % "at|@", re.I)
DOT_SIGN = re.compile(_BRACKETED % r"dot|punkt|punto|point|\.", re.I)
INVISIBLE = re.compile("[\u00ad\u200b-\u200d\u2060\ufeff]+")

_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
# A whole address whose at and dots may be bare words; the brackets are gone by then.
ADDRESS = re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+(\x20at\x20|@)({_LABEL})((?:(?:\x20dot\x20|\.){_LABEL})+)", re.I
)
DOT_LABEL = re.compile(rf"(\x20dot\x20|\.)({_LABEL})", re.I)
BARE_IP = re.compile(r"(?<![A-Za-z0-9.])[0-9]{1,3}(?:(?:\x20dot\x20|\.)[0-9]{1,3}){3}(?![A-Za-z0-9])", re.I)
BARE_DOT = re.compile(r"\x20dot\x20", re.I)
MAYBE_BARE = re.compile(r"\x20(?:at|dot)\x20", re.I)
# Endings of domains that are ordinary words count where they are well known, the others do not.
KNOWN_ENDINGS = frozenset("com org net edu gov info io co eu uk de fr es it nl example".split())
# English words that follow "at" or "dot" in plain sentences, and are no names of domains.
FUNCTION_WORDS = frozenset(
    "a an the this that these those my your his her its our their each every any some no one all both and or but if of "
    "on in at to by for from with as is are was were be been it he she we you they me him us them so not do does did "
    "has had have will would can could may might must here there then than when where which who whom what how dot".split()
)
LONGEST_BARE_ENDING, LONGEST_ENDING = 6, 24

Span = tuple[int, int, str]


class Rewritten:
    """A text with some stretches replaced, and the way back to the source.

    `starts[i]` is where stretch i begins in the new text; it stands for source characters `origins[i][0]` to
    `origins[i][1]`, and `changed[i]` says whether it was replaced. An unchanged stretch maps one to one.
    """

    def __init__(self, text: str):
        self.text, self.starts, self.origins, self.changed = text, [0], [(0, len(text))], [False]

    def _source(self, at: int, end: bool) -> int:
        """The source offset of a place in the new text; `end` asks for the end of the character before it."""
        i = bisect_right(self.starts, at - end) - 1
        low, high = self.origins[i]
        if self.changed[i]:
            return high if end else low
        return low + at - self.starts[i]

    def span(self, begin: int, end: int) -> tuple[int, int]:
        return self._source(begin, False), self._source(end, True)

    def touches_change(self, begin: int, end: int) -> bool:
        """Whether a stretch inside was replaced, or something of the source between two of them deleted."""
        first, last = bisect_right(self.starts, begin) - 1, bisect_right(self.starts, end - 1) - 1
        if any(self.changed[first : last + 1]):
            return True
        return any(self.origins[i][1] != self.origins[i + 1][0] for i in range(first, last))

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply edits (begin, end, new) of the current text, in order and apart from each other."""
        parts, starts, origins, changed = [], [], [], []
        length = at = 0

        def keep(begin: int, end: int) -> None:
            nonlocal length
            i = bisect_right(self.starts, begin) - 1
            while begin < end:
                stop = min(end, self.starts[i + 1] if i + 1 < len(self.starts) else len(self.text))
                low, high = self.origins[i]
                if not self.changed[i]:
                    low, high = low + begin - self.starts[i], low + stop - self.starts[i]
                parts.append(self.text[begin:stop])
                starts.append(length)
                origins.append((low, high))
                changed.append(self.changed[i])
                length += stop - begin
                begin, i = stop, i + 1

        for begin, end, new in edits:
            keep(at, begin)
            if new:
                parts.append(new)
                starts.append(length)
                origins.append(self.span(begin, end))
                changed.append(True)
                length += len(new)
            at = end
        keep(at, len(self.text))
        self.text = "".join(parts)
        self.starts, self.origins, self.changed = (starts, origins, changed) if starts else ([0], [(0, 0)], [False])


def invisible(text: str) -> Iterator[tuple[int, int, str]]:
    if not text.isascii():
        yield from ((m.start(), m.end(), "") for m in INVISIBLE.finditer(text))


def look_alikes(text: str) -> Iterator[tuple[int, int, str]]:
    if not text.isascii():
        for m in LOOK_ALIKE.finditer(text):
            for i in range(m.start(), m.end()):
                yield i, i + 1, LOOK_ALIKES[text[i]]


def spelled_digits(text: str) -> Iterator[tuple[int, int, str]]:
    """Each digit word becomes its digit; what separates the members of a run goes with the word before."""
    if MAYBE_SPELLED.search(text):
        for run in SPELLED_RUN.finditer(text):
            at = run.start()
            while at < run.end():
                word = DIGIT_WORD.match(text, at, run.end())
                end = word.end() if word else at + 1
                new = SPELLED[word[0].lower()] if word else text[at]
                gap = SPELLED_GAP.match(text, end, run.end())
                end = gap.end() if gap else end
                yield at, end, new
                at = end


def at_signs(text: str) -> Iterator[tuple[int, int, str]]:
    if any(c in text for c in "[({<"):
        yield from ((m.start(), m.end(), "@") for m in AT_SIGN.finditer(text))


def dot_signs(text: str) -> Iterator[tuple[int, int, str]]:
    if any(c in text for c in "[({<"):
        yield from ((m.start(), m.end(), ".") for m in DOT_SIGN.finditer(text))


def _ending(label: str, bare: bool) -> bool:
    """Whether a domain can end in this label. Between bare words alone it must be short, too."""
    label = label.lower()
    if label in KNOWN_ENDINGS:
        return True
    return label.isalpha() and 2 <= len(label) <= (LONGEST_BARE_ENDING if bare else LONGEST_ENDING) and label not in FUNCTION_WORDS


def bare_addresses(text: str, changed: Callable[[int, int], bool] = lambda begin, end: False) -> Iterator[tuple[int, int, str]]:
    """Bare ` at ` and ` dot ` of an address: name, at, domain, dot, ending.

    A bare at counts with a dot that is bare or was bracketed, never with literal dots alone ("see us at example.com").
    The domain ends at the last label that can be an ending; without any it is no address. `changed` tells whether a
    place of the text was rewritten before.
    """
    if not MAYBE_BARE.search(text):
        return
    for m in ADDRESS.finditer(text):
        at_is_bare = len(m[1]) > 1
        pairs = list(DOT_LABEL.finditer(text, m.start(3), m.end(3)))
        dots = [(d.start(1), d.end(1), len(d[1]) > 1, d[2]) for d in pairs]
        bare = at_is_bare and all(is_bare or not changed(b, e) for b, e, is_bare, _ in dots)
        while dots and not _ending(dots[-1][3], bare):
            dots.pop()
        if not dots or at_is_bare and m[2].lower() in FUNCTION_WORDS:
            continue
        if at_is_bare:
            if not any(is_bare or changed(b, e) for b, e, is_bare, _ in dots):
                continue
            yield m.start(1), m.end(1), "@"
        yield from ((b, e, ".") for b, e, is_bare, _ in dots if is_bare)


def bare_ips(text: str) -> Iterator[tuple[int, int, str]]:
    if BARE_DOT.search(text):
        for m in BARE_IP.finditer(text):
            yield from ((d.start(), d.end(), ".") for d in BARE_DOT.finditer(text, m.start(), m.end()))


TRANSDUCERS = (invisible, look_alikes, spelled_digits, at_signs, dot_signs, bare_ips)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, `@`, domain. Neither part holds an `@`, so each `@` decides on its own: the
    local part is the longest run to its left that no earlier match has used. Linear, where a search from the left
    would try each letter of each word."""
    used = 0
    for m in AT_DOMAIN.finditer(text):
        begin = at = m.start()
        while begin > used and (text[begin - 1].isascii() and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-")):
            begin -= 1
        if begin < at:
            used = m.end()
            yield begin, used


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def base_spans(text: str) -> list[Span]:
    """Spans (begin, end, kind) of the base patterns, leftmost and not overlapping within a kind."""
    found: list[Span] = []
    if "@" in text:
        found += [(b, e, "email") for b, e in _emails(text)]
    found += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), m.end(), "card"))
    if "+" in text:
        found += [
            (m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15
        ]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def hidden_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans that appear only after deobfuscation, in source offsets."""
    new = Rewritten(text)
    for transducer in TRANSDUCERS:
        edits = list(transducer(new.text))
        if edits:
            new.replace(edits)
    edits = list(bare_addresses(new.text, new.touches_change))
    if edits:
        new.replace(edits)
    if len(new.starts) == 1 and not new.changed[0]:
        return []
    found: list[Span] = []
    taken = {kind: [s for s in base if s[2] == kind] for kind in KINDS}
    for begin, end, kind in base_spans(new.text):
        if new.touches_change(begin, end):
            low, high = new.span(begin, end)
            beside = [b for b in taken[kind] if low < b[1] and b[0] < high]
            if all(low <= b[0] and b[1] <= high and high - low > b[1] - b[0] for b in beside):
                found.append((low, high, kind))
    return found


def digest(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for begin, end, kind in spans)


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans in order of begin and kind. Null counts as empty."""
    if not text:
        return [], []
    base = base_spans(text)
    hidden = hidden_spans(text, base)
    return base, sorted(base + hidden, key=_order) if hidden else base


def redact(text: str | None) -> str | None:
    """The text with each span replaced by its kind in brackets. Overlapping spans become one, named by the first."""
    if not text:
        return text
    parts, at = [], 0
    for begin, end, kind in find(text)[1]:
        if begin >= at:
            parts += [text[at:begin], f"[{kind}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]]) if at else text


SCHEMA = (
    "doc_id {id}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_hidden long"
)


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id, the number of base spans by kind, base_sha256, spans, n_hidden.

    `spans` lists kind:begin:end of all spans, base and disguised, in code points. `n_hidden` counts the disguised
    ones. Null and empty texts have no spans. Repeated rows give repeated results; other columns are ignored.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            for value in batch.column(1):
                base, every = find(value.as_py())
                counts = [sum(s[2] == k for s in base) for k in KINDS]
                sha = hashlib.sha256(digest(base).encode()).hexdigest()
                for column, x in zip(columns, (*counts, sha, digest(every), len(every) - len(base))):
                    column.append(x)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, names=SCHEMA_NAMES)

    return docs.select(doc_id, text).mapInArrow(run, SCHEMA.format(id=kind))


SCHEMA_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the spans of `text` replaced by their kinds; all columns stay, whatever their names.

    Null texts stay null and empty ones empty. Texts are taken whole, of any length, one at a time; repeated rows stay
    and get the same result; an empty table stays empty.
    """
    names, place = docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = pa.array([redact(value.as_py()) for value in batch.column(place)], pa.string())
            columns = [clean if i == place else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)
