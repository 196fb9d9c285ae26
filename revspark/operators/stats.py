"""Aggregations: class counts and shares, suggestion counts, text profile,
classification metrics and time-bucketed sentiment.

Every aggregate here is a single partial + final hash aggregate, so hot
groups (one class holding most rows) are combined map-side.  Windows run
only over already-aggregated tables whose size is bounded by the number of
classes or periods, never over raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as TX
from ..session import scratch_path
from ..sources.ledger import fresh_name
from . import selection as SE


def class_counts(df: DataFrame, col: str = "sentiment") -> DataFrame:
    """G1: rows per class."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def class_proportions(df: DataFrame, col: str = "sentiment") -> DataFrame:
    """Share of each non-null class, largest first."""
    counts = class_counts(df.filter(F.col(col).isNotNull()), col)
    # The window spans the tiny per-class table, not the data.
    total = F.sum("n").over(Window.partitionBy())
    return (counts.select(col, (F.col("n") / total).alias("share"))
            .orderBy(F.col("share").desc(), F.col(col)))


def suggestion_count(df: DataFrame, flag_col: str = "has_suggestion") -> DataFrame:
    """Rows with a suggestion and total rows, one pass."""
    return df.agg(F.sum(F.col(flag_col).cast("long")).alias("n_with_suggestion"),
                  F.count(F.lit(1)).alias("n_total"))


def observe_counts(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Stage row count collected as a side metric of the next action
    (no extra job).  Spark 4.1: once a session has used ``observe``, a
    logistic-regression model *trained* in that session no longer
    serializes (its training summary holds the session); the model jobs
    here therefore never observe."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


VOCABULARY_ROWS = 100_000       # terms of at most 64 characters or so: some 8 MB


def oov_counts(tokens_df: DataFrame, tokens_col: str, vocab_terms: list[str] | None = None) -> DataFrame:
    """``(len, n_oov)`` per document.  A document's distinct tokens meet the
    vocabulary in a join; its terms are a table, broadcast only up to
    ``VOCABULARY_ROWS``.  Its token rows are added up where they were made, so
    one narrow row a document is shuffled.  Without a vocabulary ``n_oov`` is null."""
    spark, toks = tokens_df.sparkSession, F.col(tokens_col)
    if vocab_terms is None:
        return tokens_df.select(F.size(toks).alias("len"), F.lit(None).cast("long").alias("n_oov"))
    vocab = spark.createDataFrame([(t,) for t in vocab_terms], "_term string")
    if len(vocab_terms) <= VOCABULARY_ROWS:
        vocab = F.broadcast(vocab)
    # the id first: made beside the generator, it would number tokens
    docs = tokens_df.select(F.monotonically_increasing_id().alias("_doc"), toks.alias("_tokens"))
    rows = docs.select("_doc", F.explode_outer("_tokens").alias("_token"))
    rows = rows.groupBy("_doc", "_token").agg(F.count("_token").alias("n"))
    rows = rows.join(vocab, F.col("_token") == F.col("_term"), "left")
    return rows.groupBy("_doc").agg(F.sum("n").alias("len"), F.sum(F.when(F.col("_term").isNull(), F.col("n")).otherwise(0)).alias("n_oov")).drop("_doc")


def text_profile(tokens_df: DataFrame, tokens_col: str,
                 vocab_terms: list[str] | None = None) -> DataFrame:
    """doc_count, len_mean, len_p50, len_p95, oov_mean, oov_p95, empty_docs.

    Length is tokens per document; OOV is the share of a document's tokens
    outside the model vocabulary (documents without tokens have no share).
    The per-document numbers are written once; means come from one aggregate
    and percentiles, exact and interpolated, by distributed selection."""
    spark = tokens_df.sparkSession
    path = scratch_path(spark, fresh_name("profile"))
    oov_counts(tokens_df, tokens_col, vocab_terms).select(
        "len", F.when(F.col("len") > 0, F.col("n_oov") / F.col("len")).alias("oov")).write.parquet(path)
    per_doc = spark.read.schema("len long, oov double").parquet(path)
    len_p50, len_p95 = SE.quantiles(per_doc, "len", [0.5, 0.95])
    oov_p95, = SE.quantiles(per_doc, "oov", [0.95])
    return per_doc.agg(
        F.count(F.lit(1)).alias("doc_count"),
        F.avg("len").alias("len_mean"),
        F.lit(len_p50).cast("double").alias("len_p50"),
        F.lit(len_p95).cast("double").alias("len_p95"),
        F.avg("oov").alias("oov_mean"),
        F.lit(oov_p95).cast("double").alias("oov_p95"),
        F.count_if(F.col("len") == 0).alias("empty_docs"),
    )


def classification_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
                           p_positive: str | None = None, eps: float = 1e-15) -> DataFrame:
    """G8/G9 (+ precision, recall, F1 for the positive class) in one pass.

    ``actual``/``predicted`` are 0/1; log loss needs P(class 1)."""
    a, p = F.col(actual), F.col(predicted)
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.avg((a == p).cast("double")).alias("accuracy"),
        F.count_if((a == 1) & (p == 1)).alias("tp"),
        F.count_if((a == 0) & (p == 1)).alias("fp"),
        F.count_if((a == 1) & (p == 0)).alias("fn"),
        F.count_if((a == 0) & (p == 0)).alias("tn"),
    ]
    if p_positive is not None:
        pa = F.when(a == 1, F.col(p_positive)).otherwise(1 - F.col(p_positive))
        pa = F.least(F.greatest(pa, F.lit(eps)), F.lit(1 - eps))
        aggs.append(F.avg(-F.log(pa)).alias("log_loss"))
    m = df.agg(*aggs)
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    rec = F.col("tp") / (F.col("tp") + F.col("fn"))
    return (m.withColumn("precision", prec).withColumn("recall", rec)
            .withColumn("f1", 2 * F.col("precision") * F.col("recall")
                        / (F.col("precision") + F.col("recall"))))


def accuracy(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """mean(pred = actual); 0.0 when there are no labelled rows."""
    return df.agg(F.coalesce(F.avg((F.col(actual) == F.col(predicted)).cast("double")),
                             F.lit(0.0)).alias("accuracy"))


def log_loss(df: DataFrame, actual: str = "actual", p_positive: str = "p1",
             eps: float = 1e-15) -> DataFrame:
    """-mean(ln p(actual class)), probabilities clipped to [eps, 1-eps]."""
    pa = F.when(F.col(actual) == 1, F.col(p_positive)).otherwise(1 - F.col(p_positive))
    pa = F.least(F.greatest(pa, F.lit(eps)), F.lit(1 - eps))
    return df.agg(F.avg(-F.log(pa)).alias("log_loss"))


def confusion_matrix(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """2x2 cells (actual, predicted, n) with zero cells present.

    One aggregate row of four counts, unpivoted with ``stack``."""
    a, p = F.col(actual), F.col(predicted)
    cells = df.agg(*[F.count_if((a == i) & (p == j)).alias(f"c{i}{j}")
                     for i in (0, 1) for j in (0, 1)])
    return cells.selectExpr(
        "stack(4, 0, 0, c00, 0, 1, c01, 1, 0, c10, 1, 1, c11) AS (actual, predicted, n)")


def sentiment_by_period(df: DataFrame, ts: str, label: str, unit: str = "day") -> DataFrame:
    """Counts and within-period shares per (period, label)."""
    counts = (df.groupBy(F.date_trunc(unit, F.col(ts)).alias("period"), F.col(label).alias("label"))
              .agg(F.count(F.lit(1)).alias("n")))
    # Partitioned by period over the aggregated table: <= #labels rows each.
    share = F.col("n") / F.sum("n").over(Window.partitionBy("period"))
    return counts.withColumn("share", share)


PANE = ("n", "n_labelled", "n_negative", "n_positive", "n_flagged", "n_flags")


def pane_counts(df: DataFrame, ts: str, label: str, flag: str | None = None, step: str = "1 day") -> DataFrame:
    """A4: the sums of each pane of ``step``; every row is added up once."""
    lab = F.col(label)
    flag_ = F.col(flag) if flag is not None else F.lit(None).cast("int")
    sums = (F.count(F.lit(1)), F.count(lab), F.count_if(lab == "negative"), F.count_if(lab == "positive"),
            F.coalesce(F.sum(flag_.cast("double")), F.lit(0.0)), F.count(flag_))
    return (df.groupBy(F.window(F.col(ts), step).alias("w")).agg(*(x.alias(c) for x, c in zip(sums, PANE)))
            .select(F.col("w.start").alias("pane"), F.col("w.end").alias("pane_end"), *PANE))


def rates_of_panes(panes: DataFrame, length: str = "7 days", step: str = "1 day", flag: bool = False) -> DataFrame:
    """A4: windows of ``length`` every ``step`` (panes of ``step``; the length a
    multiple of it) as sums of panes: only panes are repeated, not rows."""
    sums = panes.groupBy(F.window("pane", length, step).alias("w")).agg(*(F.sum(c).alias(c) for c in PANE))
    rate = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))         # noqa: E731
    return sums.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n",
                       rate("n_negative", "n_labelled").alias("negative_rate"),
                       rate("n_positive", "n_labelled").alias("positive_rate"),
                       *([rate("n_flagged", "n_flags").alias("suggestion_rate")] if flag else []))


def rolling_rates(df: DataFrame, ts: str, label: str, flag: str | None = None,
                  length: str = "7 days", step: str = "1 day") -> DataFrame:
    """A4 (batch form): per sliding window, review count, negative and
    positive rate, and the suggestion rate when a 0/1 flag is given."""
    return rates_of_panes(pane_counts(df, ts, label, flag, step), length, step, flag is not None)


def non_blank_share(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.avg((~TX.is_blank(col)).cast("double")).alias("share"))
