"""Token ids in binary blocks: one zstandard frame for each document, a shared dictionary, and an offset index.

A store is a folder of Parquet files with one row for each block of up to `BLOCK_BYTES` of ids:

* `part`, `block`: the place of the block; documents ascend by doc_id through parts, blocks and places in a block;
* `low`, `high`: the smallest and largest doc_id, so that Parquet's statistics find a document's block;
* `doc_ids`, `n_tokens`, `offsets`: for each document its id, its number of ids, and where its frame begins in
  `payload` (one more entry gives the end);
* `payload`: the frames. Ids are little-endian unsigned integers of `width` bytes;
* `dictionary`: the SHA-256 of the dictionary that the frames need.

The dictionary lies beside the blocks, in `dictionary/`, with its hash. A reader that finds another hash stops.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.llm.vocab import UINT32, batches_of, codec

BLOCK_BYTES = 4 << 20
# The dictionary is trained on the first ids of so many documents, chosen by hash.
SAMPLE_DOCS = 1_000
SAMPLE_BYTES = 8 << 10
# Characters that hold so many bytes of ids in any ordinary text.
SAMPLE_CHARS = 8 * SAMPLE_BYTES
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
BLOCK = (
    "block long, low {id}, high {id}, doc_ids array<{id}>, n_tokens array<long>, offsets array<long>, "
    "width int, dictionary string, payload binary"
)
NAMES = ["block", "low", "high", "doc_ids", "n_tokens", "offsets", "width", "dictionary", "payload"]


def _ids(path: str, end_id: int, texts: list[str]) -> Iterator[bytes]:
    end = np.array([end_id], dtype=UINT32).tobytes()
    for run in batches_of(texts):
        for ids in codec(path).encode(run):
            yield ids + end


def _narrow(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, dtype=UINT32).astype(f"<u{width}").tobytes() if width < 4 else ids


def _width(path: str, end_id: int) -> int:
    """Two bytes if every id of the vocabulary fits."""
    made = codec(path)
    size = made.tokenizer.get_vocab_size() if hasattr(made, "tokenizer") else made.model.get_piece_size()
    return 2 if max(size - 1, end_id) < 1 << 16 else 4


def train(docs: DataFrame, path: str, end_id: int, width: int) -> bytes:
    """A dictionary from a bounded sample: the first `SAMPLE_BYTES` of ids of `SAMPLE_DOCS` documents.

    The sample is those of smallest hash. Only hashes are gathered to find it; then each task cuts and encodes the
    beginnings of its own documents, and nothing longer than `SAMPLE_BYTES` leaves it.

    Fewer than a few documents cannot train one; their ids are then the dictionary, and no documents give none.
    """
    import zstandard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _ids(path, end_id, [t or "" for t in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array([_narrow(i, width)[:SAMPLE_BYTES] for i in found], pa.binary())], names=["ids"])

    hashed = docs.select(F.xxhash64("doc_id", "text").alias("hash"), F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    cutoff = hashed.select("hash").orderBy("hash").limit(SAMPLE_DOCS).agg(F.max("hash").alias("hash")).first()["hash"]
    if cutoff is None:
        return b""
    # Repeated rows share a hash, so there may be a few more of them.
    chosen = hashed.where(F.col("hash") <= cutoff).select("text").mapInArrow(run, "ids binary")
    samples = [bytes(r["ids"]) for r in chosen.orderBy("ids").limit(SAMPLE_DOCS).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES]


@lru_cache(maxsize=4)
def _coders(dictionary: bytes):
    import zstandard

    shared = zstandard.ZstdCompressionDict(dictionary) if len(dictionary) >= 8 else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared), zstandard.ZstdDecompressor(dict_data=shared)


def _blocks(
    path: str,
    end_id: int,
    width: int,
    dictionary: bytes,
    kind: pa.DataType,
    block_bytes: int,
    batches: Iterator[pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    press, sha = _coders(dictionary)[0], hashlib.sha256(dictionary).hexdigest()
    block = 0
    doc_ids, counts, frames, size = [], [], [], 0

    def flush() -> pa.RecordBatch:
        values = [doc_ids[0], doc_ids[-1], doc_ids, counts, np.cumsum([0, *map(len, frames)]).tolist()]
        whole = pa.list_(pa.int64())
        kinds = [kind, kind, pa.list_(kind), whole, whole, pa.int32(), pa.string(), pa.binary()]
        row = [block, *values, width, sha, b"".join(frames)]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, [pa.int64(), *kinds])], names=NAMES)

    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), _ids(path, end_id, texts)):
            raw = _narrow(ids, width)
            doc_ids.append(doc_id)
            counts.append(len(raw) // width)
            frames.append(press.compress(raw))
            size += len(raw)
            if size >= block_bytes:
                yield flush()
                block += 1
                doc_ids, counts, frames, size = [], [], [], 0
    if doc_ids:
        yield flush()


def write(
    docs: DataFrame,
    folder: str,
    path: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> None:
    """Encode every text with the tokenizer at `path`, add `end_id`, and write a store to `folder`, by doc_id.

    Null doc_ids come first; equal ones are ordered by a hash of the text. A null text counts as empty: its only id
    is `end_id`. Repeated rows are stored once each. Other columns are ignored. No rows give a store without blocks.
    """
    import pyspark.sql.pandas.types as arrow_types

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    width = _width(path, end_id)
    dictionary = train(rows, path, end_id, width)
    spark = docs.sparkSession
    sha = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(sha, bytearray(dictionary))], "dictionary string, content binary").write.parquet(f"{folder}/dictionary")
    kind = rows.schema["doc_id"].dataType
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    run = partial(_blocks, path, end_id, width, dictionary, arrow_types.to_arrow_type(kind), block_bytes)
    blocks = ranged.mapInArrow(run, BLOCK.format(id=kind.simpleString()))
    blocks.select(F.spark_partition_id().alias("part"), "*").write.parquet(f"{folder}/blocks")


def _documents(dictionary: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand, sha = _coders(dictionary)[1], hashlib.sha256(dictionary).hexdigest()
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i] for n in batch.schema.names}
            if row["dictionary"].as_py() != sha:
                raise ValueError(f"block needs dictionary {row['dictionary']}, not {sha}")
            counts, offsets, width = row["n_tokens"].as_py(), row["offsets"].as_py(), row["width"].as_py()
            payload = row["payload"].as_py()
            ids = []
            for a, b in zip(offsets, offsets[1:]):
                raw = np.frombuffer(expand.decompress(payload[a:b]), dtype=f"<u{width}")
                ids.append(raw.astype(UINT32).tobytes())
            begin = row["begin"].as_py()
            starts = (begin + np.cumsum([0, *counts[:-1]])).tolist()
            yield pa.RecordBatch.from_arrays(
                [row["doc_ids"].values, pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "start", "n_tokens", "ids"],
            )


def read(spark: SparkSession, folder: str, doc_id: object = None) -> DataFrame:
    """The documents of a store: doc_id, start (ids of all documents before it), n_tokens, ids (32-bit).

    With `doc_id`, only the blocks that can hold it are opened. `start` needs the token counts of all blocks before,
    but neither their payload nor, within a part, more than one row for each block.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first()["content"])
    total = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda n, x: n + x)
    sizes = blocks.select("part", "block", total.alias("total"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("total").alias("total"))
    parts = parts.select("part", F.coalesce(F.sum("total").over(before(Window.orderBy("part"))), F.lit(0)).alias("part_begin"))
    inside = F.coalesce(F.sum("total").over(before(Window.partitionBy("part").orderBy("block"))), F.lit(0))
    begins = sizes.withColumn("inside", inside).join(parts, "part").select("part", "block", (F.col("part_begin") + F.col("inside")).alias("begin"))
    if doc_id is not None:
        blocks = blocks.where((F.col("low") <= F.lit(doc_id)) & (F.col("high") >= F.lit(doc_id)))
    kind = blocks.schema["low"].dataType.simpleString()
    found = blocks.join(begins, ["part", "block"]).mapInArrow(
        partial(_documents, dictionary), f"doc_id {kind}, start long, n_tokens long, ids binary"
    )
    return found if doc_id is None else found.where(F.col("doc_id") == F.lit(doc_id))
