"""Distributed selection against sorting everything."""

import random

import numpy as np
import pytest

from revspark.operators import selection as SE
from revspark.operators import split as SP
from revspark.operators import stats as ST

RND = random.Random(3)


@pytest.mark.parametrize("values", [
    [5.0], [1, 2], [3.5] * 100 + [4.5], [None, None], [], list(range(1000)), [None, 7, -2.5, 1e300, -1e-300],
    [RND.choice([0.1, 0.25, 1 / 3]) for _ in range(500)], [RND.gauss(0, 50) for _ in range(3000)]])
def test_quantiles(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double").repartition(3)
    shares = [0.0, 0.05, 0.5, 0.95, 1.0]
    have = [v for v in values if v is not None]
    got = SE.quantiles(df, "v", shares)
    assert got == ([None] * 5 if not have else pytest.approx(np.quantile(np.array(have, float), shares).tolist(), rel=1e-12))


@pytest.mark.parametrize("limit", [1, 10, 20_000])
def test_smallest_per_group(spark, monkeypatch, limit):
    """Few ranked rows: the selection goes through all rounds of bits."""
    monkeypatch.setattr(SE, "RANKED_ROWS", limit)
    rows = [("a" if i % 10 else "b", RND.randrange(2**60), i) for i in range(3000)]
    rows += [("c", 77, i) for i in range(40)] + [("d", RND.randrange(50), i) for i in range(300)]       # hashes that collide
    slim = spark.createDataFrame(rows, "c string, u long, k long")
    quotas = {"a": 540, "b": 60, "c": 13, "d": 1}
    got = SE.smallest_per_group(slim, "c", "u", "k", quotas)
    for g, q in quotas.items():
        assert got[g] == sorted((u, k) for c, u, k in rows if c == g)[q - 1]
    assert SE.smallest_per_group(slim, "c", "u", "k", {"a": 0, "b": 300}) == {
        "a": None, "b": max((u, k) for c, u, k in rows if c == "b")}


def test_split_needs_classes_and_keys(spark):
    with pytest.raises(ValueError, match="label"):
        SP.stratified_split(spark.createDataFrame([(1, None), (2, 1)], "k long, label int"), "label", "k")
    with pytest.raises(ValueError, match="null in k"):
        SP.stratified_split(spark.createDataFrame([(None, 1), (2, 1)], "k long, label int"), "label", "k")
    with pytest.raises(ValueError, match="not unique"):
        SP.stratified_split(spark.createDataFrame([(7, 1)] * 10, "k long, label int"), "label", "k")
    none = SP.stratified_split(spark.createDataFrame([], "k long, label int"), "label", "k")
    assert none.columns == ["k", "label", "is_test"] and none.count() == 0


def test_split_moves_no_rows(spark):
    df = spark.createDataFrame([(f"k{i}", i % 3, "text " * 50) for i in range(200)], "k string, label int, text string")
    split = SP.stratified_split(df, "label", "k")
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    sizes = {r["label"]: (r["n_train"], r["n_test"]) for r in SP.split_sizes(split, "label").collect()}
    assert sizes == SP.allocate({0: 67, 1: 67, 2: 66})


def test_text_profile_brute_force(spark):
    vocab = ["great", "app", "slow"]
    texts = ["great app", "slow slow net", "", "unknown words here app", "great", "  ", "crash"] * 9
    toks = spark.createDataFrame([(t.split(),) for t in texts], "t array<string>").repartition(4)
    r = ST.text_profile(toks, "t", vocab).first()
    lens = np.array([len(t.split()) for t in texts])
    oov = np.array([sum(w not in vocab for w in t.split()) / len(t.split()) for t in texts if t.split()])
    assert (r.doc_count, r.empty_docs) == (63, 18)
    assert [r.len_mean, r.len_p50, r.len_p95] == pytest.approx([lens.mean(), *np.quantile(lens, [0.5, 0.95])])
    assert [r.oov_mean, r.oov_p95] == pytest.approx([oov.mean(), np.quantile(oov, 0.95)])
    empty = ST.text_profile(toks.limit(0), "t", vocab).first()
    assert empty.doc_count == 0 and empty.len_p50 is None and empty.oov_p95 is None
    plan = ST.text_profile(toks, "t", vocab)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan
    assert ST.text_profile(toks, "t").first().oov_mean is None


def test_rolling_rates_brute_force(spark):
    import datetime as dt
    from collections import defaultdict
    day = dt.datetime(2024, 2, 27)
    rows = [(day + dt.timedelta(days=RND.choice([0, 1, 2, 5, 30]), seconds=RND.randrange(86_400)),
             RND.choice(["negative", "positive", "neutral", None]), RND.choice([0, 1, None])) for _ in range(400)]
    got = ST.rolling_rates(spark.createDataFrame(rows, "at timestamp, label string, flag int"), "at", "label", "flag", "3 days", "1 day").collect()
    want = defaultdict(list)
    for at, label, flag in rows:
        for k in range(3):
            want[dt.datetime(at.year, at.month, at.day) - dt.timedelta(days=k)].append((label, flag))
    assert len(got) == len(want)
    for r in got:
        own = want[r.window_start]
        labels, flags = [x for x, _ in own if x], [f for _, f in own if f is not None]
        assert r.n == len(own) and r.window_end - r.window_start == dt.timedelta(days=3)
        assert r.negative_rate == pytest.approx(labels.count("negative") / len(labels))
        assert r.positive_rate == pytest.approx(labels.count("positive") / len(labels))
        assert r.suggestion_rate == pytest.approx(sum(flags) / len(flags))


def test_seeded_hash_is_plain_md5(spark):
    import hashlib
    got = spark.range(20).select("id", SE.seeded_hash(9, "id").alias("u")).collect()
    assert all(r.u == int(hashlib.md5(f"9:{r.id}".encode()).hexdigest()[:15], 16) for r in got)
