"""From raw documents to a training set: five stages, each over all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import bpe, mixing, neardup, pii, quality
from lakemart.llm.common import read, ship_package, stored

BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned ones reject.

    Texts that are null, empty or of few words fail the base rules. Without labels of both classes only these rules
    decide. Null ids and repeated rows are judged like others; an empty table stays empty; further columns stay.
    """
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id.

    Null and empty texts are one group. Of repeated rows one stays; a group without ids keeps one of its rows. An empty
    table stays empty; further columns stay, whatever their names.
    """
    ship_package(spark)
    return neardup.one_of_each(docs, exhaustive=True)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind.

    Null texts stay null. Repeated rows and further columns stay; an empty table stays empty.
    """
    ship_package(spark)
    return pii.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, once for each pass of the mix.

    Null and empty texts take no part in the mix; a null source is a source of its own. Repeated rows are documents like
    others. An empty table stays empty; further columns stay.
    """
    ship_package(spark)
    return mixing.mixed_texts(docs)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null and empty texts have no tokens. Repeated rows give repeated results; further columns are left out; an empty
    table gives an empty result.
    """
    ship_package(spark)
    return bpe.round_trip(docs, BYTE_BPE, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("redact_pii", redact_pii),
    ("mix_sources", mix_sources),
    ("encode_bytes", encode_bytes),
]

# Learned rules, sampled signatures and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
