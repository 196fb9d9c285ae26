"""Batch preparation operators (DataFrame -> DataFrame).

All of these are narrow (no shuffle) except ``dedupe_latest`` and
``join_back``; they add columns with ``withColumn`` instead of splitting a
frame and joining it back, so the raw columns travel with the derived ones.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as LB
from ..functions import lexicon as L
from ..functions import text as TX
from .rows import keep_where

DROP_SCRIPT, DROP_BLANK, KEPT = "script", "blank", "kept"


def script_filter(df: DataFrame, text_col: str,
                  script: tuple[str, str] = L.DEVANAGARI) -> DataFrame:
    """drop rows with any character in the script range (null kept)."""
    return df.filter(~TX.in_script(text_col, script))


def with_clean_text(df: DataFrame, text_col: str, out: str = "cleaned_text",
                    stopwords: Iterable[str] = L.NLTK_ENGLISH) -> DataFrame:
    return df.withColumn(out, TX.clean_text(text_col, stopwords))


def blank_filter(df: DataFrame, cleaned_col: str = "cleaned_text") -> DataFrame:
    """drop rows whose cleaned text is blank (tested on the
    materialized column, so cleaning is not redone inside the filter)."""
    return keep_where(df, ~TX.is_blank(cleaned_col))


def clean_corpus(df: DataFrame, text_col: str, out: str = "cleaned_text",
                 script: tuple[str, str] = L.DEVANAGARI) -> DataFrame:
    """F1 -> F7 -> F2: the shared cleaning path of training and scoring.

    The script filter reads the raw text, so it runs before the costly
    cleaning expression and prunes rows early."""
    return blank_filter(with_clean_text(script_filter(df, text_col, script), text_col, out), out)


def preprocess_reviews(df: DataFrame, text_col: str = "review_text", rating_col: str = "rating",
                       script: tuple[str, str] = L.DEVANAGARI,
                       keywords: Iterable[str] = L.SUGGESTION_SUBSTRINGS,
                       phrases: Iterable[str] = L.SUGGESTION_PHRASES) -> DataFrame:
    """Batch preprocess: F1, then F7/F8/F9/F10 as columns, then F2.

    Output = input columns + cleaned_review, label, is_suggestion,
    suggestion_text.  The suggestion extractor reads the *raw* text."""
    kept = script_filter(df, text_col, script)
    out = kept.select(
        "*",
        TX.clean_text(text_col).alias("cleaned_review"),
        LB.label_review(rating_col).alias("label"),
        TX.detect_suggestion(text_col, keywords).alias("is_suggestion"),
        TX.extract_suggestions(text_col, phrases).alias("suggestion_text"),
    )
    return blank_filter(out, "cleaned_review")


def drop_reason(text_col: str, script: tuple[str, str] = L.DEVANAGARI) -> Column:
    """Why a row leaves the cleaning path (first failing step), else kept."""
    return (F.when(TX.in_script(text_col, script), F.lit(DROP_SCRIPT))
            .when(TX.is_blank(TX.clean_text(text_col)), F.lit(DROP_BLANK))
            .otherwise(F.lit(KEPT)))


def drop_reasons(df: DataFrame, text_col: str,
                 script: tuple[str, str] = L.DEVANAGARI) -> DataFrame:
    """G5 extended: row count per reason (script, blank, kept); one pass,
    partial aggregation, so ``count = kept + sum(dropped)`` by construction."""
    return (df.select(drop_reason(text_col, script).alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


def stage_counts(df: DataFrame, text_col: str,
                 script: tuple[str, str] = L.DEVANAGARI) -> DataFrame:
    """(stage, rows) at the cleaning path's boundaries -- loaded, after
    the script filter, final (non-blank) -- from one aggregate over the
    input (partial counts per task, one row to merge), not one job per
    stage."""
    reason = drop_reason(text_col, script)
    counts = df.select(reason.alias("r")).agg(
        F.count(F.lit(1)).alias("loaded"),
        F.count_if(F.col("r") != DROP_SCRIPT).alias("script_filtered"),
        F.count_if(F.col("r") == KEPT).alias("final"))
    return counts.unpivot([], ["loaded", "script_filtered", "final"], "stage", "rows")


def training_extract(cleaned: DataFrame, cleaned_col: str = "cleaned_review",
                     label_col: str = "label") -> DataFrame:
    """F5 + P4: positive/negative rows as (cleaned_text, SENTIMENT)."""
    return (cleaned.filter(F.col(label_col).isin(LB.POSITIVE, LB.NEGATIVE))
            .withColumn("sentiment", F.upper(F.col(label_col)))
            .withColumnRenamed(cleaned_col, "cleaned_text"))


def prepare_training(df: DataFrame, text_col: str = "cleaned_text",
                     label_col: str = "sentiment") -> DataFrame:
    """S8/F3/F4/F2 on a training table: drop nulls, cast to string, drop blanks.

    The text is usually a cleaned-text column computed just before; the
    filter is evaluated on its materialized value (``keep_where``), since a
    plain filter would be pushed below that projection and rerun the
    cleaning pipeline once per predicate."""
    text = F.col(text_col).cast("string")
    keep = F.col(text_col).isNotNull() & F.col(label_col).isNotNull() & ~TX.is_blank(text)
    return keep_where(df, keep).withColumn(text_col, text)


def join_back(raw: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Re-attach every source column to separately stored results.

    Inner equi-join on a stable key (never a positional index).  Processed
    columns that clash with raw ones keep the processed value.  When both
    sides are written bucketed on ``key`` the join needs no shuffle."""
    clash = [c for c in processed.columns if c in raw.columns and c != key]
    return raw.drop(*clash).join(processed, on=key, how="inner")


def dedupe_latest(df: DataFrame, key: str, ts: str) -> DataFrame:
    """A1 (batch): one row per key, the latest by ``ts`` (ties: greatest row).

    ``max_by`` over a struct is a partial aggregate, so a key repeated
    millions of times is combined map-side instead of landing whole in one
    task (a window ``row_number`` would sort the hot key in one task)."""
    others = [c for c in df.columns if c != key]
    packed = F.struct(*[F.col(c) for c in others])
    order = F.struct(F.col(ts), packed)
    return (df.groupBy(key).agg(F.max_by(packed, order).alias("_row"))
            .select(key, *[F.col(f"_row.{c}").alias(c) for c in others]))


def latest_n(df: DataFrame, n: int, ts: str, key: str) -> DataFrame:
    """Newest-n rows, total order (ts desc, key asc) -> TakeOrderedAndProject."""
    return df.orderBy(F.col(ts).desc(), F.col(key).asc()).limit(n)


def head_k(df: DataFrame, k: int, *order: str) -> DataFrame:
    """Deterministic preview."""
    return df.orderBy(*order).limit(k)
