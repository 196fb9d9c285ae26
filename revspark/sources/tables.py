"""The driver's tables, seen as review data.

* ``documents`` is the review corpus (text; a rating string derived from
  the id, including malformed and missing ratings).
* ``labels`` gives sentiment (quality 1 -> POSITIVE, 0 -> NEGATIVE) and a
  fixed predicted/probability pair for the metric operators.
* ``events`` is the review feed: event_id -> review_id, ts -> at,
  value -> star rating 1..5.

Every view reads the whole table; nothing is sub-sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as LB

# Parameter sets that hit the invented multilingual corpus (the reviewed
# pipeline's own keyword sets never occur in it; they are exercised on
# literal fixture rows in the tests).
CORPUS_SCRIPT = ("À", "ɏ")            # Latin-1 letters + Latin Extended-A/B
CORPUS_KEYWORDS = ("sch", "ñ", "zz", "ouè")
CORPUS_PHRASES = ("of the", "und", "et", "der")

# rating string by doc_id % 8: five clean stars, a padded '4', a
# fractional '4.7' (unparseable as int) and a missing rating.
_RATINGS = ["1", "2", "3", "4", "5", " 4 ", "4.7", None]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rating_string(id_col: str = "doc_id"):
    r = F.col(id_col) % F.lit(len(_RATINGS))
    out = F.lit(None).cast("string")
    for i, v in reversed(list(enumerate(_RATINGS))):
        out = F.when(r == i, F.lit(v)).otherwise(out)
    return out


def rating_sql(id_col: str = "doc_id") -> str:
    parts = " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'")
                     for i, v in enumerate(_RATINGS))
    return f"(CASE {id_col} % {len(_RATINGS)} {parts} END)"


def review_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as raw reviews: (doc_id, review_text, rating, lang, source)."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("text").alias("review_text"),
                    rating_string("doc_id").alias("rating"), "lang", "source")


def sentiment_of_quality(col: str = "quality"):
    return F.when(F.col(col) == 1, F.lit("POSITIVE")).otherwise(F.lit("NEGATIVE"))


def labelled_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with a label: (doc_id, review_text, sentiment).

    ``labels`` is the small side only by construction of the test data;
    the join is left to AQE (broadcast when it is measured small)."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("review_text"))
    lab = table(spark, sf_dir, "labels").select("doc_id", sentiment_of_quality().alias("sentiment"))
    return d.join(lab, "doc_id", "inner")


def p_positive(id_col: str = "doc_id"):
    """Deterministic P(POSITIVE) in [0.05, 0.95] for metric fixtures."""
    return F.lit(0.05) + F.lit(0.9) * ((F.col(id_col) * 37) % 101).cast("double") / F.lit(100.0)


P_POSITIVE_SQL = "(0.05 + 0.9 * CAST((doc_id * 37) % 101 AS DOUBLE) / 100.0)"


def metric_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels as (doc_id, actual = quality, predicted = toxic, p1, p0)."""
    lab = table(spark, sf_dir, "labels")
    p1 = p_positive()
    return lab.select("doc_id", F.col("quality").alias("actual"), F.col("toxic").alias("predicted"),
                      p1.alias("p1"), (F.lit(1.0) - p1).alias("p0"))


def review_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a review feed: (review_id, at, user_id, rating, label)."""
    e = table(spark, sf_dir, "events")
    rating = (F.lit(1) + F.floor("value").cast("int") % 5).cast("int")
    return e.select(F.col("event_id").alias("review_id"), F.col("ts").alias("at"), "user_id",
                    rating.alias("rating")).withColumn("label", LB.label_review("rating"))


FEED_RATING_SQL = "CAST(1 + CAST(floor(value) AS INTEGER) % 5 AS INTEGER)"
