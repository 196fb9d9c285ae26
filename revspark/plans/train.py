"""Training flow: training table -> prepare -> encode ->
exact stratified split -> TF-IDF + logistic regression -> held-out
predictions and metrics -> one saved model artifact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as LB
from ..functions import schema as SC
from ..operators import models as MD
from ..operators import prep as PR
from ..operators import split as SP
from ..operators.features import Vocabulary


@dataclass
class TrainResult:
    model: PipelineModel
    vocabulary: Vocabulary
    test_predictions: DataFrame
    metrics: DataFrame
    split: DataFrame


def train_sentiment(training: DataFrame, key_col: str, text_col: str = "cleaned_text",
                    label_col: str = "sentiment", test_size: float = 0.2, seed: int = 42,
                    c: float = 2.0, max_features: int = 5000, unknown: str = "negative",
                    model_path: str | None = None) -> TrainResult:
    """Train on a (key, text, sentiment) table; ``key_col`` tells rows apart.

    ``unknown``: what to do with sentiments other than POSITIVE/NEGATIVE:
    ``"negative"`` encodes them as 0 (the reviewed pipeline's behaviour),
    ``"drop"`` removes them."""
    SC.require_columns(training, [text_col, label_col])
    df = PR.prepare_training(training, text_col, label_col)
    if unknown == "drop":
        df = df.filter(F.col(label_col).isin(*LB.CLASSES))
    df = df.withColumn("label", LB.encode_label(label_col))
    df = df.persist()       # the cleaned rows are read by the split, the vocabulary, the fit and the test
    split = SP.stratified_split(df, "label", key_col, test_size, seed)
    train = split.filter(~F.col("is_test"))
    test = split.filter(F.col("is_test"))
    model, vocab = MD.train_logistic(train, text_col, "label", c=c,
                                     spec=MD.TfidfSpec(max_features, None))
    scored = MD.score(model, test)
    metrics = MD.evaluate(scored, "label")
    if model_path:
        MD.save_model(model, model_path)
    return TrainResult(model, vocab, scored, metrics, split)
