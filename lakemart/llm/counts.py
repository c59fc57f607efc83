"""Token counts: huge documents are encoded in overlapping chunks and spliced where both encodings agree."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import chunks
from lakemart.llm.vocab import batches_of, codec

LIMIT = 2048
# Tokens on each side of a seam that must be the same in both encodings.
AGREEING = 4


def marks(path: str, piece: str, low: int, high: int) -> tuple[chunks.Marks, chunks.Marks, int]:
    """Stable places in the overlaps of a piece: a blank between two words at which a token ends and another begins.

    The evidence is a hash of the ids around the place. Places whose neighbours touch the ends of the piece, where
    the cut may have changed them, are left out.
    """
    ids, begins, ends = codec(path).with_offsets(piece)
    sides: tuple[chunks.Marks, chunks.Marks] = ({}, {})
    # The furthest character that the tokens up to each one reach: none may reach over a seam.
    reach = np.maximum.accumulate(ends) if len(ends) else ends
    for side, (a, b) in zip(sides, ((0, low), (high, len(piece)))):
        for place in chunks.word_gaps(piece, a, b):
            n = int(np.searchsorted(begins, place))
            if n >= AGREEING and n + AGREEING < len(ids) and reach[n - 1] <= place + 1 and begins[n] <= place + 1:
                side[place] = (zlib.crc32(ids[n - AGREEING : n + AGREEING].tobytes()), n)
    return *sides, len(ids)


def _short(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encode, width = codec(path).encode, 4
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        counts = [len(ids) // width for run in batches_of(texts) for ids in encode(run)]
        sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])


def count_tokens(
    docs: DataFrame,
    path: str,
    limit: int = LIMIT,
    size: int = chunks.SIZE,
    overlap: int = chunks.OVERLAP,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than `limit` tokens).

    `path` is a tokenizers file (.json) or a sentencepiece model (.model), which all executors can read; special
    strings in a text are treated as the library does by default. Texts up to `size` characters are encoded as
    they are; longer ones in chunks, by many tasks. Null counts as empty. Repeated rows give repeated results;
    other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    long = chunks.is_long(F.col("text"), size)
    counted = rows.where(~long).mapInArrow(partial(_short, path), f"doc_id {kind}, n_bytes long, n_tokens long")
    parts = [counted]
    for _, _, found in chunks.seamed(rows.where(long), partial(marks, path), size, overlap):
        copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
        parts.append(found.select("doc_id", "n_bytes", "n_tokens", copies.alias("copy")).drop("copy"))
    return reduce(DataFrame.union, parts).withColumn("over_limit", F.col("n_tokens") > limit)
