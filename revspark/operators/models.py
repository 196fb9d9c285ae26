"""Distributed model jobs with ``spark.ml``: TF-IDF + logistic regression
(M4-M7), model comparison (M9), text clustering (M8), persistence (S9).

The feature stages are a ``PipelineModel`` built from a vocabulary fitted
by ``features.fit_vocabulary`` (bounded by ``max_features``), so the very
same analyzer, vocabulary and idf are used in training, batch scoring and
streaming scoring, and the whole thing saves and loads as one unit.

Logistic regression matches the reviewed pipeline's objective
(L2, C=2, intercept penalized like liblinear): ``regParam = 1/(C*n_train)``,
no standardization, a constant-1 feature in place of a free intercept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (LinearSVC, LogisticRegression, NaiveBayes,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, Interaction, Normalizer, PCA,
                                SQLTransformer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as LB
from ..functions import lexicon as L
from ..functions import text as TX
from ..sources.ledger import path_exists
from . import features as FT
from . import stats as ST

TOKENS, COUNTS, TFIDF, FEATURES = "_tokens", "_tf", "_tfidf", "features"


@dataclass(frozen=True)
class TfidfSpec:
    max_features: int = 5000
    stopwords: tuple[str, ...] | None = None  # None: no stopword removal


def _analyzer_sql(text_col: str, stopwords) -> str:
    """SQL of the vectorizer analyzer (kept as SQL so it saves with the model)."""
    stop = ""
    if stopwords:
        lits = ", ".join("'" + w.replace("'", "''") + "'" for w in stopwords)
        stop = f" AND NOT w IN ({lits})"
    word = TX.WORD.replace("\\", "\\\\")
    return (f"SELECT *, 1.0D AS _bias, filter(split(lower(coalesce(CAST({text_col} AS STRING), '')), "
            f"'[^{word}]+'), w -> length(w) >= 2{stop}) AS {TOKENS} FROM __THIS__")


def fit_tfidf(train: DataFrame, text_col: str, spec: TfidfSpec = TfidfSpec()) -> tuple[PipelineModel, FT.Vocabulary]:
    """M4: fit the vocabulary and idf on the training rows only."""
    analyzer = SQLTransformer(statement=_analyzer_sql(text_col, spec.stopwords))
    tokens = analyzer.transform(train)
    vocab = FT.fit_vocabulary(tokens, TOKENS, spec.max_features)
    cv = CountVectorizerModel.from_vocabulary(vocab.terms, inputCol=TOKENS, outputCol=COUNTS)
    idf = ElementwiseProduct(scalingVec=Vectors.dense(vocab.idf()), inputCol=COUNTS,
                             outputCol="_tfidf_raw")
    norm = Normalizer(p=2.0, inputCol="_tfidf_raw", outputCol=TFIDF)
    return PipelineModel(stages=[analyzer, cv, idf, norm]), vocab


def with_bias(features_model: PipelineModel) -> PipelineModel:
    assembler = VectorAssembler(inputCols=[TFIDF, "_bias"], outputCol=FEATURES)
    return PipelineModel(stages=list(features_model.stages) + [assembler])


ROWS_PER_TASK = 10_000          # sparse rows of one task of an iterative fit: some 10 MB


def iteration_frame(data: DataFrame) -> tuple[DataFrame, int]:
    """The features an iterative learner scans many times, persisted, and their
    number, which the penalty needs anyway (the count fills the cache).  Scans
    of small partitions are merged, without a shuffle, to ``ROWS_PER_TASK`` rows."""
    data = data.persist()
    n = data.count()
    merged = data.coalesce(max(1, -(-n // ROWS_PER_TASK))).persist()
    merged.count()
    data.unpersist()
    return merged, n


def fit_logistic(data: DataFrame, n_rows: int, c: float = 2.0, max_iter: int = 1000, tol: float = 1e-4):
    """L2-penalized logistic regression of ``FEATURES`` on a 0/1 ``label`` with
    the constant feature penalized like the others and no free intercept.

    Spark's solver fixes the weight of a feature that never varies at 0.  A row
    and its negation with the other label have the same loss, so every second
    row is negated: the constant becomes +1 and -1, and the minimum is the same."""
    sign = F.when(F.monotonically_increasing_id() % 2 == 0, 1.0).otherwise(-1.0)
    data = data.withColumn("_sign", sign)
    data = data.withColumn("label", F.when(F.col("_sign") > 0, F.col("label")).otherwise(1 - F.col("label")))
    data = Interaction(inputCols=["_sign", FEATURES], outputCol="_signed").transform(data).select(
        F.col("_signed").alias(FEATURES), "label").persist()
    model = LogisticRegression(featuresCol=FEATURES, labelCol="label", regParam=1.0 / (c * max(n_rows, 1)),
                               elasticNetParam=0.0, standardization=False, fitIntercept=False,
                               maxIter=max_iter, tol=tol).fit(data)
    data.unpersist()
    return model


def train_logistic(train: DataFrame, text_col: str, label_col: str = "label",
                   c: float = 2.0, spec: TfidfSpec = TfidfSpec()) -> tuple[PipelineModel, FT.Vocabulary]:
    """M4 + M5: returns the full scoring model (features + classifier)."""
    feats, vocab = fit_tfidf(train, text_col, spec)
    feats = with_bias(feats)
    data, n_train = iteration_frame(
        feats.transform(train).select(FEATURES, F.col(label_col).cast("double").alias("label")))
    model = fit_logistic(data, n_train, c)
    data.unpersist()
    return PipelineModel(stages=list(feats.stages) + [model]), vocab


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M6 + F15 + F16: adds p0, p1, predicted (0/1), predicted_label, confidence."""
    out = model.transform(df)
    prob = vector_to_array(F.col("probability"))
    out = out.withColumn("p0", prob[0]).withColumn("p1", prob[1])
    keep = [c for c in df.columns]
    return out.select(*keep, "p0", "p1",
                      (F.col("p1") > F.col("p0")).cast("int").alias("predicted"),
                      LB.predicted_label("p0", "p1").alias("predicted_label"),
                      LB.confidence("p0", "p1").alias("confidence"))


def evaluate(scored: DataFrame, actual_col: str = "label") -> DataFrame:
    """G8-G10 in one pass: accuracy, log loss, precision/recall/F1, cells."""
    return ST.classification_metrics(scored.withColumn("_a", F.col(actual_col).cast("int")),
                                     actual="_a", predicted="predicted", p_positive="p1")


def save_model(model: PipelineModel, path: str) -> None:
    """One artifact (analyzer, vocabulary, idf, classifier)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | None:
    """``None`` when nothing is saved there (scoring then stops); a model
    that can't be read is an error."""
    if not path_exists(SparkSession.getActiveSession(), path):
        return None
    return PipelineModel.load(path)


# --- M9 ----------------------------------------------------------------------

def compare_models(train: DataFrame, test: DataFrame, text_col: str, label_col: str = "label",
                   spec: TfidfSpec = TfidfSpec(), seed: int = 42, max_iter: int = 100, trees: int = 20,
                   depth: int = 8, save_best_to: str | None = None) -> DataFrame:
    """M9: LR, naive Bayes, linear SVM and random forest on the same TF-IDF
    features; one metrics row per model, best accuracy first (ties by name).
    The constant feature is for LR only.  With ``save_best_to`` the best
    model is kept there with its feature stages, for ``load_model``."""
    spark = train.sparkSession
    feats, _ = fit_tfidf(train, text_col, spec)
    feats = with_bias(feats)
    prep = lambda d: feats.transform(d).select(
        TFIDF, FEATURES, F.col(label_col).cast("double").alias("label"))
    tr, n_train = iteration_frame(prep(train))
    te = prep(test).persist()
    candidates = {
        "logistic_regression": None,
        "naive_bayes": NaiveBayes(featuresCol=TFIDF, modelType="multinomial", smoothing=1.0),
        "linear_svc": LinearSVC(featuresCol=TFIDF, regParam=1.0 / max(n_train, 1), maxIter=max_iter,
                                tol=1e-4),
        "random_forest": RandomForestClassifier(featuresCol=TFIDF, numTrees=trees, maxDepth=depth,
                                                seed=seed),
    }
    rows, fitted = [], {}
    for name, est in candidates.items():
        fitted[name] = est.fit(tr) if est is not None else fit_logistic(tr.select(FEATURES, "label"), n_train)
        m = ST.classification_metrics(fitted[name].transform(te).select(
            F.col("label").cast("int").alias("a"), F.col("prediction").cast("int").alias("p")),
            actual="a", predicted="p").first()
        rows.append((name, float(m["accuracy"] or 0.0), _f(m["precision"]), _f(m["recall"]),
                     _f(m["f1"]), int(m["n"])))
    for cached in (tr, te):
        cached.unpersist()
    if save_best_to:
        best = min(rows, key=lambda r: (-r[1], r[0]))[0]
        save_model(PipelineModel(stages=list(feats.stages) + [fitted[best]]), save_best_to)
    out = spark.createDataFrame(rows, "model string, accuracy double, precision double, "
                                      "recall double, f1 double, n_test bigint")
    return out.orderBy(F.col("accuracy").desc(), F.col("model"))


def _f(x):
    return None if x is None else float(x)


# --- M8 ----------------------------------------------------------------------

def fit_clusters(df: DataFrame, text_col: str, id_col: str, k: int = 2, max_features: int = 500,
                 seed: int = 42) -> tuple[DataFrame, list[list[float]]]:
    """M8: TF-IDF (500 terms, English stopwords) -> PCA(2) -> KMeans(k); the
    rows (id, cluster, pc1, pc2) and the k centres.

    Features are computed once.  PCA sums outer products of the sparse rows
    (features x features on the driver, independent of row count); then only
    the two coordinates of a row are kept, as a reliable checkpoint that
    KMeans scans.  Spark's PCA does not centre on transform, a constant
    shift that leaves KMeans distances unchanged."""
    feats, _ = fit_tfidf(df, text_col, TfidfSpec(max_features, tuple(L.SKLEARN_ENGLISH)))
    x = feats.transform(df).select(id_col, TFIDF).persist()
    pca = PCA(k=2, inputCol=TFIDF, outputCol="pca").fit(x)
    points = pca.transform(x).select(id_col, "pca").checkpoint()
    x.unpersist()
    model = KMeans(k=k, seed=seed, featuresCol="pca", predictionCol="cluster").fit(points)
    pc = vector_to_array(F.col("pca"))
    rows = model.transform(points).select(id_col, F.col("cluster").cast("int").alias("cluster"),
                                          pc[0].alias("pc1"), pc[1].alias("pc2"))
    return rows, [[float(v) for v in c] for c in model.clusterCenters()]


def cluster_text(df: DataFrame, text_col: str, id_col: str, k: int = 2, max_features: int = 500,
                 seed: int = 42) -> DataFrame:
    """M8: the rows of ``fit_clusters``."""
    return fit_clusters(df, text_col, id_col, k, max_features, seed)[0]
