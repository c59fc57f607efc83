"""Byte-level BPE: long texts are pre-tokenised in overlapping chunks, stitched, and encoded piece by piece."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm import chunks
from lakemart.llm.common import fresh

UINT32 = np.dtype("<u4")
AT_ONCE = 256


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    """The encoding of a rank file, without special tokens; loaded once in a Python worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def splitter(pattern: str):
    """The pattern for Python, whose `\\s` holds four separators, U+001C to U+001F, that are no white space in Unicode."""
    import regex

    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few hundred rows at a time, so that a worker holds little besides its input."""
    for batch in batches:
        for i in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(i, AT_ONCE)


def marks(pattern: str, piece: str, low: int, high: int) -> tuple[chunks.Marks, chunks.Marks, int]:
    """Places in the overlaps where a pre-token begins.

    A pre-token depends only on where it begins and on the text from there to one character past its end: the
    pattern never looks back. So if both chunks begin a pre-token at a place, they agree from there on, up to the
    last two characters of the left chunk, which are no marks. Nor are places after white space, whose splitting
    depends on what follows it: the piece before a seam must come out the same without the text behind.
    """
    sides: tuple[chunks.Marks, chunks.Marks] = ({}, {})
    for m in splitter(pattern).finditer(piece):
        at = m.start()
        if not at or piece[at - 1].isspace():
            continue
        if at < low:
            sides[0][at] = (0, 0)
        elif high <= at < len(piece) - 1:
            sides[1][at] = (0, 0)
    return *sides, 0


def _encode(path: str, pattern: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Encode the last column, a text, and pass the others on."""
    encode = encoding(path, pattern).encode_ordinary
    for batch in _slices(batches):
        *others, texts = batch.columns
        ids = [np.array(encode(t.as_py() or ""), dtype=UINT32).tobytes() for t in texts]
        yield pa.RecordBatch.from_arrays([*others, pa.array(ids, pa.binary())], names=[*batch.schema.names[:-1], "ids"])


def _cut(text: str, seams: str) -> Column:
    """The pieces of a text between its seams, numbered from 0."""
    begins = F.concat(F.array(F.lit(0).cast("long")), F.col(seams))
    ends = F.concat(F.col(seams), F.array(F.length(text).cast("long")))

    def cut(begin: Column, i: Column) -> Column:
        piece = F.substring(F.col(text), (begin + 1).cast("int"), (F.get(ends, i) - begin).cast("int"))
        return F.struct(i.alias("i"), piece.alias("piece"))

    return F.transform(begins, cut)


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    size: int = chunks.SIZE,
    overlap: int = chunks.OVERLAP,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each document: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers, one after another).

    Texts up to `size` characters are one chunk. Longer ones are pre-tokenised in overlapping chunks by many tasks;
    the pieces between the seams are then encoded, again by many tasks, and their ids put in a row. Null counts as
    empty and has no ids. Repeated rows give repeated results; other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    long = chunks.is_long(F.col("text"), size)
    short = rows.where(~long).mapInArrow(partial(_encode, path, pattern), f"doc_id {kind}, ids binary")
    every = reduce(DataFrame.union, _encoded_in_pieces(rows.where(long), path, pattern, size, overlap), short)
    return every.select("doc_id", _n_tokens(), "ids")


def _n_tokens() -> Column:
    return (F.octet_length("ids") / 4).cast("long").alias("n_tokens")


def _encoded_in_pieces(long_docs: DataFrame, path: str, pattern: str, size: int, overlap: int) -> list[DataFrame]:
    """doc_id, ids of long documents (doc_id, text), by many tasks each."""
    kind, parts = long_docs.schema["doc_id"].dataType.simpleString(), []
    run = partial(_encode, path, pattern)
    for _, _, found in chunks.seamed(long_docs, partial(marks, pattern), size, overlap):
        of = found.select(F.col("doc_id").alias("f_id"), F.col("sha").alias("f_sha"), "seams", "copies")
        same = F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.unhex(F.sha2("text", 256)) == F.col("f_sha"))
        # By shuffle at every size: the seams grow with the documents.
        pieces = long_docs.join(of.hint("merge"), same).select(
            "doc_id", F.col("f_sha").alias("sha"), "copies", F.explode(_cut("text", "seams")).alias("cut")
        )
        pieces = pieces.select("doc_id", "sha", "copies", F.col("cut")["i"].alias("i"), F.col("cut")["piece"].alias("piece"))
        pieces = chunks.dealt(pieces, F.xxhash64("sha", "i"))
        encoded = pieces.mapInArrow(run, f"doc_id {kind}, sha binary, copies long, i int, ids binary")
        # Repeated rows meet here; `copies` restores them. Then one row for each document, as long as its ids.
        once = encoded.groupBy("doc_id", "sha", "copies", "i").agg(F.first("ids").alias("ids"))
        whole = once.groupBy("doc_id", "sha", "copies").agg(F.sort_array(F.collect_list(F.struct("i", "ids"))).alias("parts"))
        ids = F.aggregate("parts", F.lit(b""), lambda all_ids, part: F.concat(all_ids, part["ids"]))
        copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
        parts.append(whole.select("doc_id", ids.alias("ids"), copies.alias("copy")).drop("copy"))
    return parts


def _decode(path: str, pattern: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    decode = encoding(path, pattern).decode_bytes
    for batch in _slices(batches):
        raw = [decode(np.frombuffer(i.as_py() or b"", dtype=UINT32).tolist()) for i in batch.columns[-1]]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=[*batch.schema.names, "raw"])


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Add the bytes that the ids stand for, one token after another. Null ids give no bytes."""
    raw = fresh(encoded.columns, "raw")[0]
    rows = encoded.select(*[c for c in encoded.columns if c != ids], ids)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(partial(_decode, path, pattern), f"{schema}, `{raw}` binary")


def _digests(path: str, pattern: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _decode(path, pattern, batches):
        of_ids, of_raw = [], []
        for ids, raw in zip(batch.column("ids"), batch.column("raw")):
            decimal = ",".join(map(str, np.frombuffer(ids.as_py(), dtype=UINT32).tolist()))
            of_ids.append(hashlib.sha256(decimal.encode()).hexdigest())
            of_raw.append(hashlib.sha256(raw.as_py()).hexdigest())
        columns = [batch.column("doc_id"), batch.column("n_tokens"), pa.array(of_ids, pa.string()), pa.array(of_raw, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def round_trip(
    docs: DataFrame, path: str, pattern: str, size: int = chunks.SIZE, overlap: int = chunks.OVERLAP
) -> DataFrame:
    """Encode and decode `docs` (doc_id, text): doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas),
    decoded_sha256 (of the decoded bytes). Texts of one chunk go through both in one worker; see `encode`."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    long, run = chunks.is_long(F.col("text"), size), partial(_digests, path, pattern)
    short = rows.where(~long).mapInArrow(partial(_encoded_digests, path, pattern), schema)
    parts = _encoded_in_pieces(rows.where(long), path, pattern, size, overlap)
    return reduce(DataFrame.union, [p.select("doc_id", _n_tokens(), "ids").mapInArrow(run, schema) for p in parts], short)


def _encoded_digests(path: str, pattern: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted() -> Iterator[pa.RecordBatch]:
        for batch in _encode(path, pattern, batches):
            counts = [len(i.as_py()) // UINT32.itemsize for i in batch.column("ids")]
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), batch.column("ids")]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids"])

    yield from _digests(path, pattern, counted())
