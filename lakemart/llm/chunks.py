"""Very long texts cut into overlapping chunks, so that many tasks share one document, and put together again.

Chunk k covers the characters from `k * size - overlap` to `(k + 1) * size + overlap`. A caller works on each chunk
by itself and says at which places of the two overlaps its work does not depend on what lies beyond the chunk
(`Marks`). The smallest place that two neighbours share, with equal evidence, is their seam. Documents without a
seam somewhere are cut again with chunks and overlaps four times as large, in the end as one chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import bind, stored

SIZE = 32_768
OVERLAP = 512
WIDEN = 4
# place in the piece -> (32 bits of evidence that must agree, tokens before it in this piece)
Marks = dict[int, tuple[int, int]]
PIECES = "doc_id {id}, sha binary, chunk long, begin long, n_chars long, n_bytes long, piece string"


def is_long(text: Column, size: int) -> Column:
    return F.coalesce(F.length(text), F.lit(0)) > size


def pieces(docs: DataFrame, size: int, overlap: int) -> DataFrame:
    """One row for each chunk of `docs` (doc_id, text): doc_id, sha, chunk, begin, n_chars, n_bytes, piece.

    A document is known by doc_id and a hash of its text; a repeated row gives repeated chunks.
    """
    text = F.col("text")
    last = F.floor((F.length(text) - 1) / size)

    def cut(k: Column) -> Column:
        begin = F.greatest(F.lit(0), k * size - overlap)
        end = F.when(k == last, F.length(text)).otherwise((k + 1) * size + overlap)
        piece = F.substring(text, (begin + 1).cast("int"), (end - begin).cast("int"))
        return F.struct(k.alias("chunk"), begin.alias("begin"), piece.alias("piece"))

    rows = docs.select(
        "doc_id", F.unhex(F.sha2(text, 256)).alias("sha"), F.length(text).cast("long").alias("n_chars"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.explode(F.transform(F.sequence(F.lit(0).cast("long"), last.cast("long")), cut)).alias("cut"),
    )
    rows = rows.select("doc_id", "sha", "cut.chunk", "cut.begin", "n_chars", "n_bytes", "cut.piece")
    return dealt(rows, F.xxhash64("sha", "chunk"))


def dealt(rows: DataFrame, key: Column) -> DataFrame:
    """`rows` by `key` over as many tasks as a shuffle has: the work on a chunk takes far longer than its bytes tell, and
    partitions without a number of their own would be put together by their bytes."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def word_gaps(text: str, low: int, high: int) -> Iterator[int]:
    """Blanks between two ASCII letters. No known splitter or normalizer joins the two words."""
    at = text.find(" ", max(low, 1))
    while 0 <= at < min(high, len(text) - 1):
        before, after = text[at - 1], text[at + 1]
        if before.isascii() and before.isalpha() and after.isascii() and after.isalpha():
            yield at
        at = text.find(" ", at + 1)


def seams(rows: DataFrame, marks: Callable[[str, int, int], tuple[Marks, Marks, int]], size: int, overlap: int) -> DataFrame:
    """Seams of each document of `rows` (from `pieces`).

    `marks(piece, low, high)` gives the marks in the head overlap (before `low`), those in the tail overlap (from
    `high`), both by place in the piece, and the number of tokens of the whole piece.
    Returns doc_id, sha, copies, n_bytes, seams (place of each seam, null if a seam is missing), n_tokens.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    # A mark is its place and 32 bits of evidence in one number, so that marks intersect and sort as numbers.
    sides = ("head", "head_before", "tail", "tail_before")
    arrays = ", ".join(f"{n} array<long>" for n in sides)
    schema = f"doc_id {kind}, sha binary, chunk long, n_bytes long, {arrays}, n_tokens long"
    names = ["doc_id", "sha", "chunk", "n_bytes", *sides, "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {n: batch.column(n) for n in ("doc_id", "sha", "chunk", "n_bytes")}
            columns: list[list] = [[] for _ in range(5)]
            for k, begin, total, piece in zip(*(batch.column(n).to_pylist() for n in ("chunk", "begin", "n_chars", "piece"))):
                low = 2 * overlap if k else 0
                high = len(piece) - 2 * overlap if begin + len(piece) < total else len(piece)
                head, tail, n = marks(piece, low, high)
                for at, side in ((0, head), (2, tail)):
                    places = sorted(side)
                    columns[at].append([(begin + p << 32) | side[p][0] for p in places])
                    columns[at + 1].append([side[p][1] for p in places])
                columns[4].append(n)
            kinds = [pa.list_(pa.int64())] * 4 + [pa.int64()]
            made = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*found.values(), *made], names=names)

    # Repeated rows meet here, before their chunks are listed: `copies` restores them.
    once = rows.mapInArrow(run, schema).groupBy("doc_id", "sha", "chunk").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("n_bytes", "n_tokens", *sides)).alias("c")
    )
    # One entry for each chunk of a document, a few hundred bytes for its 32,768 characters.
    whole = once.groupBy("doc_id", "sha").agg(
        F.max("copies").alias("copies"), F.max("c.n_bytes").alias("n_bytes"),
        F.sort_array(F.collect_list(F.struct("chunk", *[f"c.{n}" for n in sides], "c.n_tokens"))).alias("chunks"),
    )
    chunks = F.col("chunks")

    def seam(i: Column) -> Column:
        left, right = F.get(chunks, i - 1), F.get(chunks, i)

        def joined(mark: Column) -> Column:
            of = lambda side, name: F.get(side[f"{name}_before"], F.array_position(side[name], mark).cast("int") - 1)
            # Tokens up to the seam in the left chunk, without those of the right chunk that come before it.
            return F.struct(F.shiftright(mark, 32).alias("place"), (of(left, "tail") - of(right, "head")).alias("gain"))

        return bind(F.array_min(F.array_intersect(left["tail"], right["head"])), joined)

    numbers = F.filter(F.sequence(F.lit(0), F.size(chunks) - 1), lambda i: i > 0)
    found = stored(whole.withColumn("found", F.transform(numbers, seam)), "chunk-seams")
    last = F.element_at(chunks, -1)["n_tokens"]
    gains = F.aggregate("found", last.cast("long"), lambda n, s: n + s["gain"])
    return found.select("doc_id", "sha", "copies", "n_bytes", F.transform("found", lambda s: s["place"]).alias("seams"), gains.alias("n_tokens"))


def seamed(long_docs: DataFrame, marks, size: int, overlap: int) -> Iterator[tuple[int, int, DataFrame]]:
    """(size, overlap, seams) of the documents that could be put together at this size; the rest goes on wider.

    At most log4 of the longest text rounds; each after the first only over the documents that failed.
    """
    while True:
        found = seams(pieces(long_docs, size, overlap), marks, size, overlap)
        missing = F.exists("seams", lambda s: s.isNull())
        yield size, overlap, found.where(~missing)
        failed = found.where(missing).select(F.col("doc_id").alias("f_id"), F.col("sha").alias("f_sha"))
        if failed.isEmpty():
            return
        same = F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.unhex(F.sha2("text", 256)) == F.col("f_sha"))
        long_docs = long_docs.join(failed, same, "left_semi")
        size, overlap = size * WIDEN, overlap * WIDEN
