"""Raw documents to training tokens: five stages of ``revspark.llm``.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written
as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revspark.llm import bpe, decontaminate, ngram_join, quality, substring_dedup
from revspark.llm.scratch import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents (bad or toxic) go."""
    return quality.classify(docs, _table(spark, sf_dir, "labels")).where("accepted").select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (5-word shingles, 0.8)."""
    return ngram_join.keep_one_per_group(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages stay in one document only."""
    return substring_dedup.substring_dedup(docs).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    found = decontaminate.contamination(docs, _table(spark, sf_dir, "benchmark"))
    return found.where("not contaminated").select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (32-bit little-endian) and digests of what is left."""
    ranks = bpe.read_ranks()
    return bpe.bpe_digest(bpe.bpe_encode(docs.select("doc_id", "lang", "source", "text"), ranks=ranks), ranks,
                          keep=("doc_id", "lang", "source", "ids"))


STAGES = [("quality classifier", quality_classifier), ("n-gram Jaccard join", ngram_jaccard_join),
          ("substring dedup", substring_dedup_stage), ("benchmark decontamination", benchmark_decontamination),
          ("byte-level BPE", byte_bpe)]

#: SQL can express neither the classifier nor the merges; tests check counts and the BPE round trip.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = _table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.save(docs, f"stage-{i}")
            scratch.drop(f"stage-{i - 1}")      # nothing reads it any more
    return docs
