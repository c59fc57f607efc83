"""Substring deduplication over sliding runs of sentences.

A text is cut into sentences, and a sentence of more than `PART_WORDS` words into parts where its words say so: before a
pair of words whose hash is the smallest of the `NEAR` pairs on either side. So a passage that is pasted into the middle
of a sentence is cut alike wherever it stands. From every sentence on, the shortest run of at least `MIN_SENTENCES`
sentences and `MIN_WORDS` words is hashed. Equal runs are joined over all documents; a sentence goes if any run that is
not the first of its kind covers it.

A document sends each of its distinct runs once, with the places where it comes back, so a line repeated thousands
of times in one text is one row. Equal runs meet once, ranked by document, and all but the first go: nothing is stored,
and no pairs of documents are made. A task that sees a run in several documents sends one of them to that meeting, so a run
that very many documents share does not gather there.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import WORD, fresh

MIN_SENTENCES = 2
MIN_WORDS = 12
PART_WORDS = 20
# Pairs of words on either side that a cut is compared with. A part without a cut ends after `PART_WORDS` all the same.
NEAR = 3
# Runs that a worker holds, and among which it finds firsts.
RUNS_AT_ONCE = 100_000
SENTENCE_END = re.compile(r"\n|[.!?][\x20\x09-\x0D]+")
WORDS = re.compile(WORD)
TWO_LONGS = struct.Struct("<qq")


def cuts(words: list[str]) -> list[int]:
    """Where a long sentence is cut: numbers of words that begin a part, from 0 on."""
    crcs = np.array([zlib.crc32(w.encode()) for w in words], dtype=np.uint64)
    mixed = (crcs[:-1] * np.uint64(0x9E3779B1) ^ crcs[1:] * np.uint64(0x85EBCA6B)) * np.uint64(0xC2B2AE35)
    pairs = (mixed >> np.uint64(16) & np.uint64(0xFFFFFFFF)).tolist()
    found, i = [0], 1
    while i < len(words):
        # Most pairs are larger than the one before, which is told first.
        if i < len(pairs) and pairs[i] < pairs[i - 1] and pairs[i] < min(pairs[max(0, i - NEAR) : i]) and pairs[i] == min(pairs[i : i + NEAR + 1]):
            found.append(i)
            i += NEAR  # none of the next few can be the smallest
        elif i - found[-1] >= PART_WORDS:
            found.append(i)
        i += 1
    return found


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """(begin, end, words) of each sentence or part; together they cover all words. Blank stretches go with the
    sentence before."""
    found: list[tuple[int, int, list[str]]] = []
    ends = [m.end() for m in SENTENCE_END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    begin = 0
    for end in ends:
        words = WORDS.findall(text, begin, end)
        if not words:
            if found:
                found[-1] = (found[-1][0], end, found[-1][2])
                begin = end
            continue  # blanks before the first sentence go with it
        if len(words) <= PART_WORDS:
            found.append((begin, end, words))
            begin = end
            continue
        starts, at = [], begin
        for w in words:  # white space alone lies between two words
            starts.append(text.index(w, at))
            at = starts[-1] + len(w)
        first = cuts(words)
        for i, after in zip(first, [*first[1:], len(words)]):
            stop = starts[after] if after < len(words) else end
            found.append((begin, stop, words[i:after]))
            begin = stop
    return found


def runs(parts: list[tuple[int, int, list[str]]]) -> Iterator[tuple[int, int, bytes]]:
    """(first sentence, number of sentences, 128-bit hash of the words) of each run."""
    end = words = 0
    for i in range(len(parts)):
        while end < len(parts) and (end - i < MIN_SENTENCES or words < MIN_WORDS):
            words += len(parts[end][2])
            end += 1
        if end - i < MIN_SENTENCES or words < MIN_WORDS:
            return
        content = " ".join([w for p in parts[i:end] for w in p[2]])
        yield i, end - i, hashlib.blake2b(content.encode(), digest_size=16).digest()
        words -= len(parts[i][2])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct runs of each document: doc_id, t, a, b (the hash), i, n, again (further places in the same document).

    Documents are taken in the order of id and hash, so of a few that share a run the first is known at once: the others
    lose the hash, which need not be compared any more. A document of which a copy precedes it is left out."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32())]
    names = ["doc_id", "t", "a", "b", "i", "n", "again"]
    for batch in batches:
        places: list[int] = []
        columns: list[list] = [[] for _ in kinds]
        known: set[bytes] = set()

        def flush() -> pa.RecordBatch:
            at = pa.array(places, pa.int64())
            arrays = [batch.column(0).take(at), batch.column(1).take(at), *(pa.array(c, k) for c, k in zip(columns, kinds))]
            for held in (places, known, *columns):
                held.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        ids = batch.schema.field(0).type
        ordered = not (pa.types.is_nested(ids) or pa.types.is_floating(ids))  # those that Arrow orders as Spark does
        order = range(batch.num_rows)
        if ordered:
            keys = [(name, "ascending") for name in batch.schema.names[:2]]
            order = pc.sort_indices(batch, sort_keys=keys, null_placement="at_start").to_pylist()
        before = None
        for row in order:
            here = [batch.column(i)[row].as_py() for i in (0, 1)]
            if here == before:
                continue
            before = here
            seen: dict[bytes, int] = {}
            for i, n, key in runs(sentences(batch.column(2)[row].as_py() or "")):
                if key in seen:
                    columns[4][seen[key]].append(i)
                    continue
                seen[key] = len(places)
                places.append(row)
                for column, x in zip(columns, (*((None, None) if key in known else TWO_LONGS.unpack(key)), i, n, [])):
                    column.append(x)
            if ordered:
                known.update(seen)
            if len(places) >= RUNS_AT_ONCE:
                yield flush()
        yield flush()


def repeated_runs(docs: DataFrame) -> DataFrame:
    """doc_id, t, places: the runs (first sentence, number of sentences) to remove from each document that has any.

    `docs`: doc_id, t (a hash of the text), text. The first run of a kind is that of the smallest doc_id (null
    before all), hash and place. Rows that agree in doc_id and text are one document.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, t long, a long, b long, i int, n int, again array<int>"
    rows = docs.select("doc_id", "t", "text").mapInArrow(_rows, schema)
    # Runs known to be later ones have no hash; they are spread by document.
    spread = F.when(F.col("a").isNull(), F.xxhash64("doc_id", "t", "i")).otherwise(F.lit(0))
    rank = F.rank().over(Window.partitionBy("a", "b", "spread").orderBy("doc_id", "t", "i"))
    ranked = rows.withColumn("spread", spread).withColumn("rank", rank)
    later = F.col("a").isNull() | (F.col("rank") > 1)
    starts = F.when(later, F.concat(F.array("i"), "again")).otherwise(F.col("again"))
    places = ranked.select("doc_id", "t", "n", F.explode(starts).alias("i"))
    places = places.select("doc_id", "t", F.struct("i", "n").alias("place"))
    return places.groupBy("doc_id", "t").agg(F.collect_set("place").alias("places"))


def cut(text: str, places: list[dict]) -> tuple[int, list[tuple[int, int]]]:
    """The number of sentences, and the spans of those that the runs cover, neighbours joined."""
    parts = sentences(text)
    covered = sorted({i for p in places for i in range(p["i"], p["i"] + p["n"])})
    spans: list[tuple[int, int]] = []
    for i in covered:
        begin, end = parts[i][:2]
        if spans and spans[-1][1] == begin:
            spans[-1] = (spans[-1][0], end)
        else:
            spans.append((begin, end))
    return len(parts), spans


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of `docs`, the text without repeated sentences, and the column `removed`.

    `removed` lists begin and end of what was cut, in characters of the old text. The column gets a free name if
    `docs` has one like it; it is always the last. Texts without repeated runs stay as they are, and so do null and
    empty texts. Of copies of a whole text the first stays and the others become empty. Repeated rows, equal in
    doc_id and text, are one document and get the same result. An empty table gives an empty result.
    """
    t, f_id, f_t, places, removed = fresh(docs.columns, "t", "f_id", "f_t", "places", "removed")
    known = docs.withColumn(t, F.xxhash64(text))
    found = repeated_runs(known.select(F.col(doc_id).alias("doc_id"), F.col(t).alias("t"), F.col(text).alias("text")))
    found = found.select(F.col("doc_id").alias(f_id), F.col("t").alias(f_t), F.col("places").alias(places))
    joined = known.join(found, known[doc_id].eqNullSafe(found[f_id]) & (known[t] == found[f_t]), "left")
    rows = joined.select(*docs.columns, places)
    names, place = docs.columns, docs.columns.index(text)
    spans = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, cuts = [], []
            for value, found_places in zip(batch.column(place), batch.column(len(names))):
                old, gone = value.as_py(), []
                if found_places.is_valid:
                    gone = cut(old, found_places.as_py())[1]
                    edges = [0, *(x for span in gone for x in span), len(old)]
                    old = "".join(old[a:b] for a, b in zip(edges[::2], edges[1::2]))
                texts.append(old)
                cuts.append([{"begin": a, "end": b} for a, b in gone])
            columns = [pa.array(texts, pa.string()) if i == place else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cuts, spans)], names=[*names, removed])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return rows.mapInArrow(run, f"{schema}, `{removed}` array<struct<begin:bigint,end:bigint>>")
