"""Model jobs: schema, ranges, determinism, persistence, label-leakage fix."""

import pytest
from pyspark.sql import functions as F

from revspark.operators import features as FT
from revspark.operators import models as MD
from revspark.plans import catalog as C
from revspark.plans.score import score_reviews
from revspark.plans.train import train_sentiment
from revspark.session import scratch_path
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def trained(spark):
    path = scratch_path(spark, "test-models/sentiment")
    res = train_sentiment(C.training_table(spark, SF_SMALL), key_col="doc_id", model_path=path)
    return res, path


def test_metrics_ranges(trained):
    res, _ = trained
    m = res.metrics.first()
    assert m["n"] == m["tp"] + m["fp"] + m["fn"] + m["tn"] > 0
    assert 0.0 <= m["accuracy"] <= 1.0 and m["log_loss"] > 0
    preds = res.test_predictions
    assert preds.filter((F.col("confidence") < 0.5) | (F.col("confidence") > 1.0)).count() == 0
    assert preds.filter(F.round("confidence", 4) != F.col("confidence")).count() == 0


def test_saved_model_scores_identically(spark, trained):
    res, path = trained
    loaded = MD.load_model(path)
    docs = C.training_table(spark, SF_SMALL)
    a = MD.score(res.model, docs).select("doc_id", "p1")
    b = MD.score(loaded, docs).select("doc_id", F.col("p1").alias("q1"))
    assert a.join(b, "doc_id").filter(F.abs(F.col("p1") - F.col("q1")) > 1e-12).count() == 0


def test_missing_model_stops_scoring(spark):
    assert score_reviews(spark.read.parquet(f"{SF_SMALL}/documents.parquet"),
                         "/nonexistent/model/path") is None


def test_no_label_column_means_no_accuracy(spark, trained):
    _, path = trained
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = score_reviews(docs, path)
    assert out.accuracy is None
    assert "actual_sentiment" not in out.predictions.columns
    assert out.predictions.columns == ["raw_review", "predicted_label", "confidence"]


def test_label_column_of_source_is_evaluated(spark, trained):
    _, path = trained
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").select(
        "doc_id", F.when(F.col("quality") == 1, "pos").otherwise("NEG").alias("label"))
    out = score_reviews(docs.join(labels, "doc_id"), path)
    acc = out.accuracy.first()["accuracy"]
    assert 0.0 <= acc <= 1.0
    assert set(r[0] for r in out.predictions.select("actual_sentiment").distinct().collect()) <= {
        "POSITIVE", "NEGATIVE"}


def test_cluster_text_is_deterministic(spark):
    a = C.QUERIES["cluster_text"](spark, SF_SMALL).select("doc_id", "cluster")
    b = C.QUERIES["cluster_text"](spark, SF_SMALL).select("doc_id", F.col("cluster").alias("c2"))
    assert a.join(b, "doc_id").filter(F.col("cluster") != F.col("c2")).count() == 0
    assert a.select("cluster").distinct().count() <= 2


def test_unreadable_model_is_an_error(spark, tmp_dir):
    spark.createDataFrame([("no model",)], "v string").write.text(f"{tmp_dir}/model/metadata")
    with pytest.raises(Exception):
        MD.load_model(f"{tmp_dir}/model")
    assert MD.load_model(f"{tmp_dir}/none") is None


def test_fit_certificate(spark, trained):
    from revspark.operators import linear as LN
    res, _ = trained
    r = LN.fit_certificate(res.model, res.split.where("not is_test")).first()
    # the constant feature is fitted too: the solver alone would leave its weight at 0
    assert abs(res.model.stages[-1].coefficients[r.n_features - 1]) > 0.1
    assert r.n_features == len(res.vocabulary.terms) + 1
    assert r.max_abs_gradient < 1e-2 * r.gradient_at_zero


def test_logistic_gradient_brute_force(spark):
    import numpy as np
    from pyspark.ml.linalg import Vectors
    from revspark.operators import linear as LN
    rng = np.random.default_rng(1)
    x = rng.normal(size=(30, 5)) * (rng.random((30, 5)) < 0.6)
    y, w = rng.integers(0, 2, 30).astype(float), rng.normal(size=5)
    rows = [(float(b), Vectors.dense(a) if i % 2 else Vectors.sparse(5, [(j, v) for j, v in enumerate(a.tolist()) if v]))
            for i, (a, b) in enumerate(zip(x, y))]
    data = LN.stored_vectors(spark.createDataFrame(rows, ["label", "f"]), "f", "label")
    got = {r.idx: r.gradient for r in LN.logistic_gradient(data, w.tolist(), 0.3).collect()}
    want = x.T @ (1 / (1 + np.exp(-x @ w)) - y) / 30 + 0.3 * w
    assert [got[i] for i in range(5)] == pytest.approx(want.tolist())


def test_naive_bayes_equals_the_library(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizerModel
    from revspark.functions import text as TX
    from revspark.operators import features as FT
    from revspark.operators import linear as LN
    t = C.training_table(spark, SF_SMALL).select("doc_id", "sentiment", TX.vector_tokens("cleaned_text").alias("t"))
    t = t.unionByName(spark.createDataFrame([(-1, "POSITIVE", ["nowhere"]), (-2, "NEGATIVE", [])], t.schema)).persist()
    train = t.where("doc_id > 20")
    vocab = FT.fit_vocabulary(train, "t", 300)
    got = {r.doc_id: r.label for r in LN.naive_bayes_predict(t, "t", "doc_id", LN.naive_bayes_weights(train, "t", "sentiment", vocab)).collect()}
    cv = CountVectorizerModel.from_vocabulary(vocab.terms, inputCol="t", outputCol="features")
    y = F.when(F.col("sentiment") == "POSITIVE", 1.0).otherwise(0.0)
    model = NaiveBayes(smoothing=1.0).fit(cv.transform(train).withColumn("label", y))
    want = {r.doc_id: "POSITIVE" if r.prediction else "NEGATIVE" for r in model.transform(cv.transform(t)).collect()}
    assert got == want and len(got) == t.count()


def test_best_compared_model_is_kept(spark, tmp_dir):
    rows = [(i, ("fine solid screen " if i % 2 else "weak broken cable ") + f"unit{i % 5}", i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, text string, label int")
    path = f"{tmp_dir}/best"
    got = MD.compare_models(df.where("id < 40"), df.where("id >= 40"), "text", save_best_to=path).collect()
    assert [r.model for r in got] == sorted((r.model for r in got), key=lambda m: next(
        (-r.accuracy, m) for r in got if r.model == m))
    kept = MD.load_model(path)
    pred = kept.transform(df.where("id >= 40")).select("label", "prediction").collect()
    assert sum(r.label == r.prediction for r in pred) / len(pred) == got[0].accuracy


def test_clusters_are_of_the_nearest_centre(spark):
    import duckdb
    from revspark.operators import prep as PR
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows, centres = MD.fit_clusters(PR.clean_corpus(docs, "text"), "cleaned_text", "doc_id", k=3, max_features=100)
    con = duckdb.connect()
    con.execute("CREATE TABLE p(id BIGINT, cluster INT, x DOUBLE, y DOUBLE); CREATE TABLE c(k INT, x DOUBLE, y DOUBLE)")
    con.executemany("INSERT INTO p VALUES (?, ?, ?, ?)", [tuple(r) for r in rows.collect()])
    con.executemany("INSERT INTO c VALUES (?, ?, ?)", [(i, *c) for i, c in enumerate(centres)])
    n, far = con.execute("""SELECT count(*), count(*) FILTER (d > best + 1e-12) FROM (
        SELECT (SELECT (p.x - c.x) ** 2 + (p.y - c.y) ** 2 FROM c WHERE c.k = p.cluster) AS d,
               (SELECT min((p.x - c.x) ** 2 + (p.y - c.y) ** 2) FROM c) AS best FROM p)""").fetchone()
    assert n == PR.clean_corpus(docs, "text").count() and far == 0


def test_labelled_scoring_cleans_the_source_once(spark, trained):
    """Predictions and accuracy read the same scored rows (twice before)."""
    calls = spark.sparkContext.accumulator(0)

    def seen(t):
        calls.add(1)
        return t

    docs = spark.createDataFrame([(i, "good fine text", "positive") for i in range(10)], "doc_id int, t string, sentiment string")
    source = docs.select("doc_id", F.udf(seen)("t").alias("review_text"), "sentiment")
    out = score_reviews(source, trained[0].model, text_col="review_text", keep=("doc_id",))
    assert out.predictions.agg(F.count("confidence")).first()[0] == 10
    once = calls.value
    assert out.accuracy.first()["accuracy"] is not None
    assert calls.value == once
    out.scored.unpersist()


def test_term_counts_run_no_lambda_per_token(spark):
    rows = spark.createDataFrame([(["b", "a", "b"],), (["a"],), ([],), (None,)], "t array<string>")
    got = FT._term_stats(rows, "t")
    assert {(r.term, r.total, r.df) for r in got.collect()} == {("a", 2, 2), ("b", 2, 1), (None, 0, 4)}
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
