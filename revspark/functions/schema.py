"""Schema-level operators: pure functions over ``df.columns`` / ``df.schema``.

None of these starts a job; they fail fast, before any work is scheduled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

ID_MARKERS = ("id", "uuid")
TEXT_MARKERS = ("review", "text", "content")


class SchemaMismatch(ValueError):
    pass


def infer_text_column(columns: Sequence[str]) -> str:
    """Pick the review-text column by name.

    ID columns are those whose name contains ``id``/``uuid`` (a substring
    test, case-insensitive: ``video_text`` counts as an ID column).  The
    first non-ID column naming review/text/content wins; otherwise the
    second column; otherwise the only column."""
    cols = list(columns)
    ids = {c for c in cols if any(m in c.lower() for m in ID_MARKERS)}
    named = [c for c in cols if c not in ids and any(m in c.lower() for m in TEXT_MARKERS)]
    if named:
        return named[0]
    if len(cols) >= 2:
        return cols[1]
    if len(cols) == 1:
        return cols[0]
    raise SchemaMismatch("no column to read review text from")


def with_raw_review(df: DataFrame, text_col: str | None = None) -> DataFrame:
    """P1 + P4: rename the (inferred or given) text column to ``raw_review``."""
    col = text_col or infer_text_column(df.columns)
    return df if col == "raw_review" else df.withColumnRenamed(col, "raw_review")


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Raise, listing what was found, when a required column is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SchemaMismatch(f"missing columns {missing}; found {df.columns}")
    return df


def filter_columns(df: DataFrame, wanted: Sequence[str] = ("review_text", "cleaned_text",
                                                           "sentiment")) -> DataFrame:
    """Keep those of ``wanted`` that exist, in that order."""
    return df.select(*[c for c in wanted if c in df.columns])


def label_column(columns: Sequence[str]) -> str | None:
    """First *source* column naming a sentiment/label (resolved before any
    prediction column exists, so a prediction can never be its own truth)."""
    for c in columns:
        low = c.lower()
        if "sentiment" in low or "label" in low:
            return c
    return None


def validate_schema(df: DataFrame, expected: T.StructType, check_types: bool = True) -> DataFrame:
    """Compare a frame to a declared schema before writing it."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in expected.fields}
    missing = sorted(set(want) - set(have))
    extra = sorted(set(have) - set(want))
    wrong = sorted(n for n in set(want) & set(have)
                   if check_types and have[n] != want[n])
    if missing or extra or wrong:
        raise SchemaMismatch(f"schema mismatch: missing={missing} extra={extra} "
                             f"wrong_type={wrong}")
    return df.select(*[f.name for f in expected.fields])


# Declared table schemas.
REVIEW_FEED = T.StructType([
    T.StructField("reviewId", T.StringType()),
    T.StructField("userName", T.StringType()),
    T.StructField("score", T.IntegerType()),
    T.StructField("at", T.TimestampType()),
    T.StructField("content", T.StringType()),
    T.StructField("replyContent", T.StringType()),
])

RAW_REVIEWS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("review_id", T.StringType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("date", T.TimestampType()),
])

CLEANED_REVIEWS = T.StructType(RAW_REVIEWS.fields + [
    T.StructField("cleaned_review", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("is_suggestion", T.IntegerType()),
    T.StructField("suggestion_text", T.StringType()),
])

TRAINING = T.StructType([
    T.StructField("cleaned_text", T.StringType()),
    T.StructField("sentiment", T.StringType()),
])
