"""Token store, token counts and byte-level BPE against the libraries themselves."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from llm.conftest import AWKWARD, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakemart.llm import bpe, chunks, counts, token_store
from lakemart.llm.vocab import JsonCodec

WORD, BYTES, PIECE = (
    public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model")
)
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
TRICKY = [
    *"ab  \n\tcZé́ß \x1c\x85'stΣİ가̈ .1", "<|endoftext|>", "<|startoftext|>", "don't ", "😀", "word. ", "Word, ",
]


def noise(seed, n):
    random_ = random.Random(seed)
    return "".join(random_.choice(TRICKY) for _ in range(n))


def library(path, text):
    if path.endswith(".model"):
        return sentencepiece.SentencePieceProcessor(model_file=path).encode(text)
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_words_encoded_apart_give_the_ids_of_the_whole():
    codec = JsonCodec(WORD)
    assert codec.by_word and not JsonCodec(BYTES).by_word
    texts = [noise(i, i % 40) for i in range(600)] + [prose(1, 200)]
    for text, ids in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library_ids(codec, text)


def library_ids(codec, text):
    return codec.tokenizer.encode(text, add_special_tokens=False).ids


def test_store_round_trip(spark, docs, tmp_path):
    rows = [*AWKWARD, *[(100 + i, noise(i, 200)) for i in range(60)]]
    folder = str(tmp_path / "store")
    token_store.write(docs(*rows, extra="1 AS part"), folder, WORD, end_id=2, block_bytes=2000)
    found = token_store.read(spark, folder).orderBy("start").collect()
    assert len(found) == len(rows)
    begin = 0
    for row in found:
        assert row["start"] == begin
        begin += row["n_tokens"]
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    want = sorted((i is not None, i, [*library(WORD, t or ""), 2]) for i, t in rows if i not in (None, 4))
    got = [(True, r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in found if r["doc_id"] not in (None, 4)]
    assert sorted(got) == want
    assert spark.read.parquet(f"{folder}/blocks").count() > 3
    one = token_store.read(spark, folder, doc_id=120).collect()
    assert [(r["doc_id"], r["start"]) for r in one] == [(r["doc_id"], r["start"]) for r in found if r["doc_id"] == 120]


def test_store_of_nothing_and_of_little(spark, docs, tmp_path):
    for rows in ([], [(1, "hello")]):
        folder = str(tmp_path / str(len(rows)))
        token_store.write(docs(*rows), folder, WORD, end_id=2)
        assert token_store.read(spark, folder).count() == len(rows)


def test_store_with_another_dictionary_is_refused(spark, docs, tmp_path):
    token_store.write(docs((1, "hello")), str(tmp_path / "s"), WORD, end_id=2)
    other = spark.createDataFrame([("x", bytearray(b"no dictionary at all"))], "dictionary string, content binary")
    other.write.mode("overwrite").parquet(str(tmp_path / "s" / "dictionary"))
    with pytest.raises(Exception, match="block needs dictionary"):
        token_store.read(spark, str(tmp_path / "s")).collect()


@pytest.mark.parametrize("path", [WORD, BYTES, PIECE])
@pytest.mark.parametrize("size, overlap", [(300, 30), (1000, 100), (chunks.SIZE, chunks.OVERLAP)])
def test_counts(docs, path, size, overlap):
    rows = [*AWKWARD, (20, prose(5, 3000).replace("w1", "ab").replace("3", "x")), (21, noise(9, 3000))]
    found = counts.count_tokens(docs(*rows, extra="1 AS n_tokens"), path, size=size, overlap=overlap).collect()
    want = sorted((str(i), len((t or "").encode()), n := len(library(path, t or "")), n > 2048) for i, t in rows)
    assert sorted((str(r[0]), *r[1:]) for r in found) == want


def test_counts_of_nothing(docs):
    assert counts.count_tokens(docs(), WORD).collect() == []


def test_overlaps_widen_until_they_align(docs, monkeypatch):
    rounds = []
    seams = chunks.seams
    monkeypatch.setattr(chunks, "seams", lambda *a: rounds.append(a[2:]) or seams(*a))
    text = "ab cd " + "x" * 5000 + " ef gh"  # no blank for many chunks
    assert counts.count_tokens(docs((1, text)), WORD, size=200, overlap=20).first()["n_tokens"] == len(library(WORD, text))
    assert [size for size, _ in rounds][:3] == [200, 800, 3200]


@pytest.mark.parametrize("size, overlap", [(50, 5), (700, 40), (chunks.SIZE, chunks.OVERLAP)])
def test_byte_bpe(docs, size, overlap):
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [*AWKWARD[:6], (7, "é" * 300), (8, prose(3, 300)), *[(100 + i, noise(i, 150)) for i in range(40)]]
    encoded = bpe.encode(docs(*rows, extra="1 AS ids"), RANKS, PATTERN, size=size, overlap=overlap)
    found = bpe.round_trip(docs(*rows, extra="1 AS ids"), RANKS, PATTERN, size=size, overlap=overlap).collect()
    want = []
    for i, text in rows:
        ids = encoding.encode_ordinary(text or "")
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((str(i), len(ids), sha, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted((str(r[0]), *r[1:]) for r in found) == sorted(want)
    raw = bpe.decode(encoded, RANKS, PATTERN)
    assert raw.columns[-1] == "raw"
    assert sorted(bytes(r["raw"]) for r in raw.collect()) == sorted((t or "").encode() for _, t in rows)
    assert bpe.encode(docs(), RANKS, PATTERN).collect() == []


def test_crc_of_ids(spark, docs, tmp_path):
    token_store.write(docs((1, "hello there")), str(tmp_path / "s"), WORD, end_id=2)
    row = token_store.read(spark, str(tmp_path / "s")).select(F.crc32("ids").alias("crc")).first()
    assert row["crc"] == zlib.crc32(np.array([*library(WORD, "hello there"), 2], dtype="<u4").tobytes())
