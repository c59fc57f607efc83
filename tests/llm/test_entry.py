"""The registered queries and the pipeline on the smallest tables."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from compare import connect, differences
from llm.conftest import AWKWARD, SF, prose

import __spark_entry__ as entry
import corpus_pipeline
from lakemart.llm import mixing, neardup, pii, quality
from lakemart.llm.common import read
from lakemart.llm.queries import QUERIES
from lakemart.llm.sql import ORACLE


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"op13_whitening"}))
def test_query_covers_its_table(spark, name):
    found = QUERIES[name](spark, SF)
    assert found.count() == read(spark, SF, "documents").count()
    assert found.columns[0] == "doc_id" and found.select("doc_id").distinct().count() == found.count()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_awkward_documents(spark, docs, name, stage):
    """Nulls in any column, empty and long texts, repeated rows, an empty table, and columns named like helpers."""
    rows = docs(*AWKWARD, (20, "a@b.cc " + prose(9, 40), None), extra="1 AS node")
    rows = rows.selectExpr("*", "'x' AS size", "CAST(NULL AS STRING) AS words", "2 AS rank")
    found = stage(spark, rows, SF)
    assert name == "encode_bytes" or found.columns == rows.columns
    counts = {"near_dedup": 9, "redact_pii": 13, "encode_bytes": 13}
    if name in counts:
        assert found.count() == counts[name]
    elif name == "quality_rules":
        kept = {r["doc_id"] for r in found.collect()}
        assert 4 in kept and not kept & {1, 2, 3, 9}
    else:
        texts = [r["text"] for r in found.collect()]
        assert texts and all(t and t.split() for t in texts)
    empty = stage(spark, rows.limit(0), SF)
    assert empty.columns == found.columns and empty.count() == 0


def test_pipeline_stages(spark):
    """Each stage against the operator it stands for, on what the stage before has kept."""
    docs, kept = read(spark, SF, "documents"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        kept[name] = (before, docs)
        assert name == "encode_bytes" or docs.columns == columns
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    before, after = kept["quality_rules"]
    assert ids(after) == ids(quality.rate(before, read(spark, SF, "labels")).where("kept"))
    before, after = kept["near_dedup"]
    assert ids(after) == ids(neardup.classes(before).where("doc_id = class_id"))
    before, after = kept["redact_pii"]
    assert {r["doc_id"]: r["text"] for r in after.collect()} == {r["doc_id"]: pii.redact(r["text"]) for r in before.collect()}
    before, after = kept["mix_sources"]
    words = {}
    for r in after.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
    assert words == {r["doc_id"]: r["taken"] for r in mixing.mix(before).collect() if r["taken"]}
    before, after = kept["encode_bytes"]
    with open(corpus_pipeline.BYTE_BPE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    want = [
        (r["doc_id"], len(i := encoding.encode_ordinary(r["text"])), sha(",".join(map(str, i)).encode()), sha(r["text"].encode()))
        for r in before.collect()
    ]
    assert sorted(map(tuple, after.collect())) == sorted(want)
