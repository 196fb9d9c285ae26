"""Scoring flow: load model -> infer text column ->
script filter, clean, drop blanks -> score -> labels/confidence ->
evaluate against the *source's* own label column, if it has one.

Label leakage fix: the actual-label column is resolved from the source
schema before any prediction column exists; with no label column in the
source there is no ``actual_sentiment`` and no accuracy.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as LB
from ..functions import schema as SC
from ..operators import models as MD
from ..operators import prep as PR
from ..operators import stats as ST


@dataclass
class ScoringResult:
    predictions: DataFrame              # raw_review, predicted_label, confidence[, actual_sentiment]
    accuracy: DataFrame | None          # one row, only when the source is labelled
    scored: DataFrame | None = None     # persisted for the two above; unpersist it when both are read


def score_reviews(source: DataFrame, model: PipelineModel | str, text_col: str | None = None,
                  keep: tuple[str, ...] = ()) -> ScoringResult | None:
    """Returns ``None`` when no model is available (nothing is scored)."""
    if isinstance(model, str):
        model = MD.load_model(model)
    if model is None:
        return None
    text = text_col or SC.infer_text_column(source.columns)
    label = SC.label_column([c for c in source.columns if c != text])
    df = SC.with_raw_review(source, text)
    cleaned = PR.clean_corpus(df, "raw_review", "cleaned_text")
    scored = MD.score(model, cleaned)
    cols = list(keep) + ["raw_review", "predicted_label", "confidence"]
    if label is None:
        return ScoringResult(scored.select(*cols), None)
    # predictions and accuracy read the same rows: left lazy, each would clean and score the whole source
    scored = scored.withColumn("actual_sentiment", LB.normalize_label(label)).select(
        *cols, "actual_sentiment", "predicted").persist()
    evaluable = (scored.filter(F.col("actual_sentiment").isin(*LB.CLASSES))
                 .select(LB.encode_label("actual_sentiment").alias("actual"), "predicted"))
    return ScoringResult(scored.select(*cols, "actual_sentiment"), ST.accuracy(evaluable), scored)
