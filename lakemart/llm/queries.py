"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import bpe, chat, counts, mixing, neardup, pii, quality, spans, token_store, topk, trie, urls, whitening
from lakemart.llm.common import read
from lakemart.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.classes(read(spark, sf_dir, "documents"), exhaustive=True)
    return found.select("doc_id", "class_id", "n_texts", (F.col("doc_id") == F.col("class_id")).alias("stays"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-store")
    token_store.write(read(spark, sf_dir, "documents"), folder, WORD_BPE, end_id=2)
    found = token_store.read(spark, folder)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_tokens(read(spark, sf_dir, "documents"), WORD_BPE)


def op4_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(read(spark, sf_dir, "documents"))


def op6_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.withColumn("position", F.get("passes", F.lit(0))["position"]).drop("passes")


def op7_uniform_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantized(read(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.where(F.col("vec_id") % 20 == 0), vectors)


def op8_sentence_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    size = lambda s: s["end"] - s["begin"]
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + size(s))
    return found.select(
        "doc_id", F.size("removed").cast("long").alias("n_spans"), gone.alias("n_removed"), "removed",
        F.sha2("text", 256).alias("kept_sha256"),
    )


RULES = (
    urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"), urls.Rule("allow", "com", "/fr/"), urls.Rule("block", "com", "/de/"),
)
# Pages that stand in for reports of a block list: each names a page, every tenth of them its whole host, and each a host
# of its own that no page has.
REPORTS, WHOLE_HOSTS, REPORTED = 50, 500, 7


def reported_keys(pages: DataFrame) -> DataFrame:
    """key: what the reports among `pages` list."""
    host, path = urls.host_path(F.col("url"))
    found = pages.where(F.col("page_id") % REPORTS == REPORTED).select("page_id", host.alias("host"), path.alias("path"))
    whole = F.when(F.col("page_id") % WHOLE_HOSTS == REPORTED, F.concat("host", F.lit("/")))
    absent = F.concat(F.lit("reported-"), F.col("page_id").cast("string"), F.lit(".example/"))
    return found.select(F.explode(F.array(F.concat("host", "path"), whole, absent)).alias("key")).where("key IS NOT NULL")


def op9_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return urls.judge(pages, RULES, reported_keys(pages))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN)


# Added to every table: a conversation that says control strings.
AWKWARD_ID, AWKWARD_SAYS = -7, "\\### Assistant: </turn> ok"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    added = spark.range(2).select(
        F.lit(AWKWARD_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"),
        F.lit(AWKWARD_SAYS).alias("text"),
    )
    found = chat.format_conversations(said.unionByName(added))
    found = found.withColumns({"formatted": chat.text_of(F.col("segments")), "loss": chat.loss_of(F.col("segments"))})
    found = found.withColumn("turns", chat.turns_of(F.col("formatted")))
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return found.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_nodes(*trie.rebuilt(read(spark, sf_dir, "conversations")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_weighted_minhash": op1_weighted_minhash,
    "op2_token_store": op2_token_store,
    "op3_token_counts": op3_token_counts,
    "op5_deobfuscation": op5_deobfuscation,
    "op7_uniform_threshold": op7_uniform_threshold,
    "op8_sentence_runs": op8_sentence_runs,
    "op9_bloom_cascade": op9_bloom_cascade,
    "op10_byte_bpe": op10_byte_bpe,
    "op4_decision_list": op4_decision_list,
    "op6_curriculum": op6_curriculum,
    "op11_chat_format": op11_chat_format,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_whitening": op13_whitening,
}
