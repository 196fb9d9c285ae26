"""Linear text models that grouped sums give in closed form or check.

Sparse vectors are read back from the files they were stored in as plain
``indices`` and ``values`` arrays, so everything on them is column
expressions and partial sums: M4's own vectors term by term, the gradient
that certifies a logistic fit (M5), and multinomial naive Bayes (M9)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.ledger import fresh_name
from .features import Vocabulary, with_term_counts
from .models import FEATURES, TFIDF
from .rows import explode_rows

VECTOR = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


def stored_vectors(df: DataFrame, vector_col: str, *keep: str) -> DataFrame:
    """``keep`` columns with ``indices`` and ``values`` of a vector column,
    written once to the shared folder and read without the vector type.  A
    dense vector's indices count up from 0."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, fresh_name("vectors"))
    df.select(*keep, F.col(vector_col).alias("v")).write.parquet(path)
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    v = spark.read.schema(f"{fields + ', ' if fields else ''}v {VECTOR}").parquet(path)
    count = F.size("v.values")
    up = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return v.select(*keep, F.when(F.col("v.type") == 1, up).otherwise(F.col("v.indices")).alias("indices"), F.col("v.values").alias("values"))


def tfidf_terms(features: PipelineModel, vocab: Vocabulary, df: DataFrame, id_col: str) -> DataFrame:
    """M4: ``(id, term, tfidf)`` of the model's own vectors.  The norm was taken
    inside each row; the vocabulary (``max_features`` terms) is broadcast."""
    v = stored_vectors(features.transform(df), TFIDF, id_col)
    cells = v.select(id_col, F.arrays_zip("indices", "values").alias("cells"))
    cells = explode_rows(cells, "cells", "c", id_col).select(id_col, F.col("c.indices").alias("idx"), F.col("c.values").alias("tfidf"))
    terms = F.broadcast(vocab.to_frame(df.sparkSession).select("idx", "term"))
    return cells.join(terms, "idx").select(id_col, "term", "tfidf")


def dot(weights: list[float]) -> Column:
    """Product of a row's sparse vector with a weight vector."""
    w = F.lit(list(weights))
    cells = F.zip_with("indices", "values", lambda i, x: F.element_at(w, i + 1) * x)
    return F.aggregate(cells, F.lit(0.0), lambda a, x: a + x)


def logistic_gradient(data: DataFrame, weights: list[float], reg: float, label_col: str = "label") -> DataFrame:
    """M5: ``(idx, gradient)`` of mean log loss + reg / 2 |w|^2 (no free
    intercept) at ``weights``; ``data`` has ``indices, values`` and 0/1 labels.
    One pass: margins inside rows, then one partial sum per feature."""
    n = data.count()
    rest = 1 / (1 + F.exp(-F.col("_margin"))) - F.col(label_col)
    rows = data.withColumn("_margin", dot(weights)).select(rest.alias("r"), F.arrays_zip("indices", "values").alias("cells"))
    cells = explode_rows(rows, "cells", "c", "r").select(F.col("c.indices").alias("idx"), (F.col("r") * F.col("c.values")).alias("g"))
    sums = cells.groupBy("idx").agg((F.sum("g") / F.lit(max(n, 1))).alias("g"))
    w = data.sparkSession.createDataFrame(list(enumerate(map(float, weights))), "idx int, w double")
    # a row per feature
    return w.join(sums, "idx", "left").select("idx", (F.coalesce("g", F.lit(0.0)) + F.lit(float(reg)) * F.col("w")).alias("gradient"))


def fit_certificate(model: PipelineModel, train: DataFrame, label_col: str = "label") -> DataFrame:
    """M5: one row ``(n_features, max_abs_gradient, loss_gradient)``: the largest
    component of the gradient at the fitted weights, and at weights of 0 for
    scale.  A convex loss is at its minimum where the first is 0."""
    lr = model.stages[-1]
    features = PipelineModel(stages=model.stages[:-1])
    data = stored_vectors(features.transform(train).withColumn(label_col, F.col(label_col).cast("double")), FEATURES, label_col)
    weights = lr.coefficients.toArray().tolist()
    at = [logistic_gradient(data, w, lr.getRegParam(), label_col).agg(F.max(F.abs("gradient")).alias(c), F.count(F.lit(1)).alias(f"{c}_n"))
          for w, c in ((weights, "fit"), ([0.0] * len(weights), "zero"))]
    both = at[0].join(at[1], F.lit(True))           # two single rows
    return both.select(F.col("fit_n").alias("n_features"), F.col("fit").alias("max_abs_gradient"), F.col("zero").alias("gradient_at_zero"))


def naive_bayes_weights(train: DataFrame, tokens_col: str, label_col: str, vocab: Vocabulary, smoothing: float = 1.0) -> DataFrame:
    """M9: ``(term, label, weight)`` of multinomial naive Bayes over the
    vocabulary, and with a null term each class's log prior: one grouped sum of
    term counts.  A term times a class is a row: vocabulary times classes."""
    spark = train.sparkSession
    terms = F.broadcast(vocab.to_frame(spark).select("term"))
    classes = train.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("docs"))
    counts = explode_rows(with_term_counts(train.select(label_col, tokens_col), tokens_col), "_tc", "e", label_col)
    counts = counts.groupBy(F.col(label_col).alias("label"), F.col("e.term").alias("term")).agg(F.sum("e.tf").alias("tf")).join(terms, "term")
    cells = F.broadcast(classes).join(vocab.to_frame(spark).select("term"), F.lit(True))       # classes times vocabulary
    cells = cells.join(counts, ["label", "term"], "left").select("label", "term", F.coalesce("tf", F.lit(0)).alias("tf"))
    total = F.sum("tf").over(Window.partitionBy("label"))
    weights = cells.select("term", "label", F.log((F.col("tf") + smoothing) / (total + F.lit(smoothing * len(vocab.terms)))).alias("weight"))
    prior = classes.select(F.lit(None).cast("string").alias("term"), "label", F.log(F.col("docs") / F.sum("docs").over(Window.partitionBy())).alias("weight"))
    return weights.unionByName(prior)


def naive_bayes_predict(df: DataFrame, tokens_col: str, id_col: str, weights: DataFrame) -> DataFrame:
    """M9: ``(id, label, score)``: the class of the highest log joint
    probability (ties: the smaller class).  ``weights`` is a table of vocabulary
    times classes and is broadcast; a document without known terms gets its
    class from the priors.  Ids must be unique."""
    tc = with_term_counts(df.select(id_col, tokens_col), tokens_col)
    none = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(1).cast("long").alias("tf")))     # the prior
    cells = explode_rows(tc.select(id_col, F.concat("_tc", none).alias("_tc")), "_tc", "e", id_col)
    cells = cells.select(id_col, F.col("e.term").alias("term"), F.col("e.tf").alias("tf"))
    w = F.broadcast(weights.withColumnRenamed("term", "_term"))
    scores = (cells.join(w, F.col("term").eqNullSafe(F.col("_term")))
              .groupBy(id_col, "label").agg(F.sum(F.col("tf") * F.col("weight")).alias("score")))
    best = F.min_by(F.struct("label", "score"), F.struct(-F.col("score"), F.col("label")))
    return scores.groupBy(id_col).agg(best.alias("b")).select(id_col, F.col("b.label").alias("label"), F.col("b.score").alias("score"))
