"""Vectorizer features: per-document term counts, vocabulary fitting and
TF-IDF weights, as DataFrame operations.

Term counts are computed *inside* each row (sort the token array, count
runs), so neither the per-document counts nor the TF-IDF transform needs a
shuffle.  Fitting a vocabulary is one aggregate over terms with map-side
combining; its output is bounded by ``max_features`` and is the only thing
brought to the driver (to build the model and the idf literal).

TF-IDF follows the smooth-idf convention of the reviewed pipeline:
``idf = ln((1 + n) / (1 + df)) + 1``, raw term counts, rows L2-normalized,
vocabulary = the ``max_features`` most frequent terms of the fitting corpus
(ties: term ascending).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import explode_rows


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_term_counts(df: DataFrame, tokens_col: str, out: str = "_tc") -> DataFrame:
    """Adds array<struct<term, tf>> of a token array, O(L log L) per row.

    The sorted array is projected as its own column first: an expression
    captured inside a lambda is re-evaluated per element, a column is not."""
    # ``array_sort`` would call a comparator lambda per pair of tokens
    sorted_df = df.withColumn("_sorted", F.sort_array(F.col(tokens_col)))
    s = F.col("_sorted")
    n = F.size(s)
    starts = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                      lambda i: (i == 1) | (F.try_element_at(s, i) != F.try_element_at(s, i - 1)))
    with_starts = sorted_df.withColumn("_starts", F.when(n > 0, starts).otherwise(
        F.array().cast("array<int>")))
    st = F.col("_starts")
    counted = F.transform(st, lambda p, k: F.struct(
        F.try_element_at(s, p).alias("term"),
        (F.coalesce(F.try_element_at(st, k + 2), n + 1) - p).cast("long").alias("tf")))
    return with_starts.withColumn(out, counted).drop("_sorted", "_starts")


@dataclass(frozen=True)
class Vocabulary:
    terms: list[str]          # index order
    doc_freq: list[int]
    n_docs: int

    def idf(self) -> list[float]:
        return [math.log((1 + self.n_docs) / (1 + d)) + 1.0 for d in self.doc_freq]

    def to_frame(self, spark) -> DataFrame:
        """(term, idx, idf) as a small local relation (<= max_features rows)."""
        rows = list(zip(self.terms, range(len(self.terms)), self.idf()))
        return spark.createDataFrame(rows, "term string, idx int, idf double")


def _term_stats(df: DataFrame, tokens_col: str) -> DataFrame:
    """(term, total, df) over all terms, plus one row with a null term whose
    ``df`` is the number of documents (a sentinel every row contributes)."""
    # the lists repeat, so that no lambda runs per token: all terms, the distinct ones, the sentinel
    terms = F.array(F.col(tokens_col), F.array_distinct(tokens_col), F.array(F.lit(None).cast("string")))
    lists = df.select(tokens_col).select(F.posexplode_outer(terms).alias("k", "list"))
    return (lists.select("k", F.explode_outer("list").alias("term"))
            .filter(F.col("term").isNotNull() | (F.col("k") == 2))        # an empty list's row is none
            .groupBy("term")
            .agg(F.count_if(F.col("k") == 0).alias("total"), F.count_if(F.col("k") > 0).alias("df")))


def fit_vocabulary(df: DataFrame, tokens_col: str, max_features: int = 5000) -> Vocabulary:
    """Driver copy of the vocabulary; bounded by ``max_features`` (the
    model needs it to build its count vectorizer).  The document count
    comes from the sentinel group of the same aggregate."""
    if not max_features or max_features <= 0:
        raise ValueError("max_features bounds what reaches the driver; it must be positive")
    # the sentinel sorts first: one top-k over one pass of the corpus
    rows = (_term_stats(df, tokens_col).orderBy(F.col("term").isNotNull(), F.col("total").desc(), F.col("term").asc())
            .limit(max_features + 1).collect())
    n_docs = sum(int(r["df"]) for r in rows if r["term"] is None)
    ordered = sorted((r for r in rows if r["term"] is not None), key=lambda r: (-r["total"], r["term"]))
    ordered = ordered[:max_features]          # one row too many when there is no sentinel
    return Vocabulary([r["term"] for r in ordered], [int(r["df"]) for r in ordered], n_docs)


def tfidf_weights(df: DataFrame, tokens_col: str, vocab: Vocabulary,
                  id_col: str = "doc_id") -> DataFrame:
    """Relational TF-IDF: (id, term, tfidf) for in-vocabulary terms.

    Per-document counts come from the row itself; idf is a hash join
    against the vocabulary (broadcast: bounded by ``max_features``); the
    L2 norm is a window over one document's terms."""
    tc = explode_rows(with_term_counts(df.select(id_col, tokens_col), tokens_col),
                      "_tc", "e", id_col)
    idf = F.broadcast(vocab.to_frame(df.sparkSession).select("term", "idf"))
    w = (tc.select(id_col, F.col("e.term").alias("term"), F.col("e.tf").alias("tf"))
         .join(idf, "term", "inner")
         .select(id_col, "term", (F.col("tf") * F.col("idf")).alias("w")))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", (F.col("w") / norm).alias("tfidf"))
