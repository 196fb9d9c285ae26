"""The registered queries of this folder, over the whole given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, decontaminate, embedding_dedup, lexical_search, ngram_join, prefix_trie, quality, sharding,
               substring_dedup, token_shards, toxicity, url_filter)
from . import oracles
from .scratch import Scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents' token shards, read every record back."""
    path = Scratch(spark, "token-shards").path("shards")
    if not token_shards.write_shards(table(spark, sf_dir, "documents"), path):
        return spark.createDataFrame([], "slot long, shard int, offset long, doc_id long, seq int, n_ids int, ids_sha256 string")
    return token_shards.read_shards(spark, path).withColumn("ids_sha256", F.sha2("ids", 256)).drop("ids")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleaved_shards(table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.cosine_components(table(spark, sf_dir, "embeddings"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
    return docs.select("doc_id", F.round("quality_p", 6).alias("quality_p"), F.round("toxic_p", 6).alias("toxic_p"), "accepted")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.bpe_digest(bpe.bpe_encode(docs, ranks=ranks), ranks)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat.chat_digest(chat.format_chats(turns.union(own)))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each begun anew: the first turns of
    conversation c - c % 20 (crc32(c) % 4 of them), then c's own after as many."""
    own = Scratch(spark, "rebuilt").save(prefix_trie.conversation_paths(table(spark, sf_dir, "conversations")), "paths")
    base = own.where("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), prefix_trie.turns_between("path", 0, 3).alias("head"))
    own = own.join(base, F.col("base") == F.col("conv_id") - F.col("conv_id") % 20, "left")
    h = (F.crc32(F.col("conv_id").cast("string")) % 4).cast("int")
    head = prefix_trie.turns_between(F.coalesce("head", F.array().cast("array<bigint>")), 0, h)
    return prefix_trie.prefix_trie(own.select("conv_id", F.concat(head, prefix_trie.turns_between("path", h)).alias("path")))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    labels = table(spark, sf_dir, "labels").where(~held_out)
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted",
                         F.size("passages").cast("long").alias("n_passages"))


QUERIES = {f.__name__: f for f in (
    op1_token_shards, op2_sharding, op3_embedding_dedup, op4_decontamination, op5_quality, op6_bpe, op7_chat,
    op8_ngram_join, op9_substring_dedup, op10_url_filter, op11_lexical_search, op12_prefix_trie, op13_toxicity)}
ORACLE: dict[str, str] = oracles.ORACLE
