from pyspark.sql import functions as F

from revspark.operators import split as SP


def test_allocation_matches_stratified_rule():
    assert SP.allocate({"a": 123, "b": 60}) == {"a": (98, 25), "b": (48, 12)}
    alloc = SP.allocate({0: 1000, 1: 7})
    assert sum(t for _, t in alloc.values()) == -(-1007 * 2 // 10)


def test_exact_sizes_with_a_dominant_class(spark):
    rows = [(i, 0 if i % 10 else 1) for i in range(5000)]  # class 0 holds 90%
    df = spark.createDataFrame(rows, "k long, label int")
    split = SP.stratified_split(df, "label", "k", 0.2, 42)
    got = {r["label"]: (r["n_train"], r["n_test"]) for r in SP.split_sizes(split, "label").collect()}
    assert got == SP.allocate({0: 4500, 1: 500})
    # deterministic membership for a fixed seed
    again = SP.stratified_split(df, "label", "k", 0.2, 42)
    a = {r[0] for r in split.filter("is_test").select("k").collect()}
    b = {r[0] for r in again.filter("is_test").select("k").collect()}
    assert a == b
    assert split.filter(F.col("is_test").isNull()).count() == 0
