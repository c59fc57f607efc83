"""URL filters: rules by host and path, and exact list membership by a Bloom filter cascade.

Level 0 of the cascade encodes the listed keys; level 1 the keys of the corpus that level 0 takes for listed though
they are not; level 2 the listed keys that level 1 takes for those; and so on, until a level makes no mistake. All
keys that the corpus can ask for are known, so every answer is exact, and a URL is judged without a join.

A cascade of at most `MAX_BYTES`, which is reckoned before it is built, goes to all workers at once. A longer list is cut
into slices by key hash, each with a cascade of its own, and the pages are judged slice after slice.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import stored

MAX_BYTES = 32 << 20
# False positive rates: of level 0 it depends on how many keys are listed, see `first_rate`.
# A lower rate of the others means fewer levels, each of which is a round of jobs, and a larger cascade.
RATE = 0.25
# Bits that a task packs together before they are sent.
CHUNK_BITS = 1 << 16
# Bitmaps of all tasks of a level that are sent as they are; if they are more, they are merged on executors first.
SENT_BYTES = 16 << 20


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII letters in lower case) and path; both empty for null and for text without `://`."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, pattern, 1), upper, upper.lower()), F.regexp_extract(url, pattern, 2)


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null if none does."""
    text = verdict = F.when(F.lit(False), F.lit(""))
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        text, verdict = text.when(fits, F.lit(rule.text)), verdict.when(fits, F.lit(rule.verdict))
    return text, verdict


def url_keys(host: Column, path: Column) -> Column:
    """What a list can name: the host and its parents down to two labels, each with `/`, and the page itself."""
    labels = F.split(host, r"\.")
    starts = F.filter(F.sequence(F.lit(1), F.size(labels)), lambda i: i < F.size(labels))
    suffix = F.transform(starts, lambda i: F.concat(F.array_join(F.slice(labels, i, F.size(labels)), "."), F.lit("/")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(suffix, F.array(F.concat(host, path))))
    )


def key_hashes(key: Column) -> Column:
    """128 bits for each key; the cascade stands for these."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("key"), key).alias("b"))


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    content: bytes

    def contains(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        table = np.frombuffer(self.content, dtype=np.uint8)
        found = np.ones(len(a), dtype=bool)
        for at in places(a, b, self.bits, self.hashes):
            found &= (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def places(a: np.ndarray, b: np.ndarray, bits: int, hashes: int) -> Iterator[np.ndarray]:
    a, step = a.astype(np.uint64), b.astype(np.uint64) | np.uint64(1)
    for i in range(hashes):
        mixed = a + np.uint64(i) * step
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        yield (mixed ^ (mixed >> np.uint64(29))) % np.uint64(bits)


def contains(levels: Sequence[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Listed or not: the first level that does not know a key decides."""
    listed = np.full(len(a), len(levels) % 2 == 1)
    open_ = np.arange(len(a))
    for i, level in enumerate(levels):
        known = level.contains(a[open_], b[open_])
        listed[open_[~known]] = i % 2 == 1
        open_ = open_[known]
    return listed


def first_rate(listed: int, others: int) -> float:
    """The rate that leaves about as many false positives as there are listed keys."""
    return min(RATE, math.sqrt(0.5) * max(listed, 1) / max(others, 1))


def shape(n: int, rate: float, level: int) -> tuple[int, int]:
    """Bits and hashes for n keys. Odd sizes that change with the level keep the levels independent."""
    bits = max(64, math.ceil(n * math.log2(1 / rate) / math.log(2)))
    return bits | 1 + 2 * level, max(1, round(math.log2(1 / rate)))


def _partial_bits(bits: int, hashes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps of a task's keys, by chunk."""
    table = np.zeros(bits // 8 + 1, dtype=np.uint8)
    for batch in batches:
        a, b = (batch.column(i).to_numpy() for i in (0, 1))
        for at in places(a, b, bits, hashes):
            np.bitwise_or.at(table, at >> np.uint64(3), np.left_shift(1, at & np.uint64(7)).astype(np.uint8))
    size = CHUNK_BITS // 8
    for i in range(0, len(table), size):
        part = table[i : i + size]
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([i // size]), pa.array([part.tobytes()])], names=["chunk", "content"])


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bitmap for each chunk out of those of all tasks."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(content, dtype=np.uint8)
            found[chunk] = found[chunk] | part if chunk in found else part
    contents = pa.array([c.tobytes() for c in found.values()], pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), contents], names=["chunk", "content"])


def _level(keys: DataFrame, n: int, rate: float, number: int) -> Level:
    bits, hashes = shape(n, rate, number)
    schema = "chunk long, content binary"
    parts = keys.select("a", "b").mapInArrow(partial(_partial_bits, bits, hashes), schema)
    # There is a task for each file at most, or some for a large one. What they send together is bounded: else their
    # bitmaps meet on executors, chunk by chunk, and the level itself is all that reaches the driver.
    if len(keys.inputFiles()) * max(bits, CHUNK_BITS) // 8 > SENT_BYTES:
        parts = parts.repartition("chunk").mapInArrow(_together, schema)
    table = np.zeros(bits // 8 + 1, dtype=np.uint8)
    size = CHUNK_BITS // 8
    for row in parts.toLocalIterator():
        begin = row["chunk"] * size
        part = np.frombuffer(bytes(row["content"]), dtype=np.uint8)
        table[begin : begin + len(part)] |= part
    return Level(bits, hashes, table.tobytes())


def _probe(level: Level, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (batch.column(i).to_numpy() for i in (0, 1))
        yield batch.filter(pa.array(level.contains(a, b)))


def expected_bytes(listed: int, others: int) -> int:
    """All levels together: the first, and then halves of about as many keys at one hash each."""
    first = listed * math.log2(1 / first_rate(listed, others)) / math.log(2)
    return math.ceil((first + 4 * listed * math.log2(1 / RATE) / math.log(2)) / 8)


def cascade(universe: DataFrame) -> list[Level]:
    """Levels for `universe`: a, b (the key's hashes, distinct) and the boolean `listed`. No listed keys: no levels."""
    keys = stored(universe.select("a", "b", "listed"), "keys")
    counts = {r["listed"]: r["n"] for r in keys.groupBy("listed").agg(F.count(F.lit(1)).alias("n")).collect()}
    inside, outside = (keys.where(c).select("a", "b") for c in ("listed", "not listed"))
    n, rate = counts.get(True, 0), first_rate(counts.get(True, 0), counts.get(False, 0))
    levels: list[Level] = []
    while n:
        level = _level(inside, n, rate, len(levels))
        levels.append(level)
        wrong = stored(outside.mapInArrow(partial(_probe, level), "a long, b long"), f"wrong-{len(levels)}")
        n, rate = wrong.count(), RATE
        inside, outside = wrong, inside
    return levels


def _any_listed(
    levels: list[Level], slice_: int, slices: int, names: list[str], batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Sets `found`, the last column, where one of the `keys` of this slice is listed."""
    for batch in batches:
        place = batch.schema.get_field_index("keys")
        keys = batch.column(place)
        a, b = (keys.flatten().field(i).to_numpy() for i in (0, 1))
        listed = np.zeros(len(a), dtype=bool)
        mine = np.flatnonzero(a % slices == slice_)
        listed[mine] = contains(levels, a[mine], b[mine])
        lengths = np.asarray(keys.value_lengths().fill_null(0))
        stops = np.cumsum(lengths)
        total = np.concatenate([[0], np.cumsum(listed)])
        found = (total[stops] > total[stops - lengths]) | batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], names=names)


def judge(
    pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """One row for each page: page_id, host, path, rule, verdict (allow or block).

    The longest rule that fits decides. Else a page is blocked if one of its `url_keys` is in the list: the column `key`
    of `listed`, in which null, repeated and never asked for keys do no harm. Null urls have no keys and are allowed, and so
    are all pages without a rule if the list is empty. Urls are taken whole, of any length; repeated rows give repeated
    results; other columns are ignored; an empty table of pages gives an empty result.
    """
    host, path = host_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    keys = url_keys(F.col("host"), F.col("path"))
    rows = rows.select("*", rule.alias("rule"), verdict.alias("ruled"), keys.alias("keys"))
    asked = rows.select(F.explode("keys").alias("key"), F.lit(False).alias("listed"), F.lit(True).alias("asked"))
    given = listed.where("key IS NOT NULL").select("key", F.lit(True).alias("listed"), F.lit(False).alias("asked"))
    # One row for each key, partly counted before the shuffle; only keys that are asked for go into the cascade.
    universe = asked.unionByName(given).groupBy("key").agg(F.max("listed").alias("listed"), F.max("asked").alias("asked"))
    universe = universe.where("asked").select("listed", key_hashes(F.col("key")).alias("h"))
    universe = stored(universe.select("listed", "h.a", "h.b"), "universe")
    counts = {r["listed"]: r["n"] for r in universe.groupBy("listed").agg(F.count(F.lit(1)).alias("n")).collect()}
    slices = max(1, -(-expected_bytes(counts.get(True, 0), counts.get(False, 0)) // MAX_BYTES))
    names = ["page_id", "host", "path", "rule", "ruled", "keys", "found"]
    found = rows.withColumns({"keys": F.transform("keys", key_hashes), "found": F.lit(False)}).select(*names)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
    for i in range(slices):
        levels = cascade(universe.where(F.pmod("a", F.lit(slices)) == i))
        found = found.mapInArrow(partial(_any_listed, levels, i, slices, names), schema)
        if i < slices - 1:
            found = stored(found, f"judged-{i}")
    own = F.when(F.col("found"), "block").otherwise("allow")
    return found.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"))
