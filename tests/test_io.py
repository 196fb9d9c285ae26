import datetime as dt

import pytest
from pyspark.sql import types as T

from revspark.functions import schema as SC
from revspark.sources import io as IO


def _feed(spark):
    rows = [("r1", "ann", 5, dt.datetime(2024, 1, 2), "Great app", ""),
            ("r2", "bob", 1, dt.datetime(2024, 1, 3), 'slow\nnet, "quoted"', ""),
            ("r3", "cy", 3, dt.datetime(2024, 1, 1), None, "")]
    return spark.createDataFrame(rows, SC.REVIEW_FEED)


def test_csv_multiline_round_trip(spark, tmp_dir):
    feed = _feed(spark)
    IO.write_csv(feed.coalesce(1), f"{tmp_dir}/feed")
    back = IO.read_csv(spark, f"{tmp_dir}/feed", SC.REVIEW_FEED)
    assert back.count() == 3
    assert back.filter("reviewId = 'r2'").first()["content"] == 'slow\nnet, "quoted"'


def test_csv_keeps_cells(spark, tmp_dir):
    rows = [(1, " padded "), (2, "\ttab\t"), (3, ""), (4, None), (5, 'a "b"\nc, d'), (6, "\\ back")]
    df = spark.createDataFrame(rows, "id long, review_text string")
    IO.write_csv(df, f"{tmp_dir}/cells")
    back = IO.read_csv(spark, f"{tmp_dir}/cells", df.schema, null_value=IO.CSV_NULL)
    assert sorted(map(tuple, back.collect())) == rows


def test_append_reviews_dedupes_reingest(spark, tmp_dir):
    path = f"{tmp_dir}/raw"
    IO.append_reviews(_feed(spark), path)
    IO.append_reviews(_feed(spark), path)
    raw = spark.read.parquet(path)
    assert raw.count() == 3
    assert raw.filter("review_id = 'r3'").first()["review_text"] == ""
    assert IO.read_raw_reviews(spark, path).columns == ["id", "review_text", "rating", "date"]


def test_read_raw_reviews_missing_table(spark, tmp_dir):
    assert IO.read_raw_reviews(spark, f"{tmp_dir}/nothing") is None


def test_validate_schema_lists_problems(spark):
    df = spark.createDataFrame([(1, "x")], "id long, other string")
    with pytest.raises(SC.SchemaMismatch, match="missing"):
        SC.validate_schema(df, SC.RAW_REVIEWS)


def test_prepare_training_falls_back_to_empty(spark, tmp_dir):
    df = IO.prepare_clean_reviews_for_model(spark, f"{tmp_dir}/none", f"{tmp_dir}/none.csv")
    assert df.count() == 0 and df.columns == ["cleaned_text", "sentiment"]


def test_newest_feed_slice(spark, tmp_dir):
    _feed(spark).write.json(f"{tmp_dir}/j")
    got = IO.read_review_feed(spark, f"{tmp_dir}/j", "json", newest=2)
    assert [r["reviewId"] for r in got.collect()] == ["r2", "r1"]


def test_text_csv_is_lossless(spark, tmp_dir):
    at = dt.datetime(2024, 2, 29, 23, 59, 59, 123456)
    texts = [" padded\t", "", None, "\\N", "N", "\\", "\\n", "a\r\nb\nc\rd", 'say "x", y', "\\\\sn\\", "é 🙂  ", ",", '"', "#x", "\x00"]
    rows = [(i, t, at if i % 2 else None, i / 3, i % 3 == 0, bytes([0, i, 255]), dt.date(2024, 1, 1 + i)) for i, t in enumerate(texts)]
    rows += [(None, None, None, None, None, None, None), (99, "x", dt.datetime(1969, 12, 31), float("inf"), True, b"", None)]
    df = spark.createDataFrame(rows, "id long, text string, at timestamp, x double, b boolean, raw binary, day date")
    IO.write_text_csv(df.repartition(3), f"{tmp_dir}/t")
    back = IO.read_text_csv(spark, f"{tmp_dir}/t", df.schema)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    with pytest.raises(SC.SchemaMismatch):
        IO.as_text(spark.createDataFrame([([1],)], "a array<int>"))
    # a row is a line, whatever its text holds
    import glob
    lines = sum(len(open(f, encoding="utf-8", newline="").read().split("\n")) - 2 for f in glob.glob(f"{tmp_dir}/t/part*"))
    assert lines == len(rows)


def test_append_reviews_without_ids(spark, tmp_dir):
    feed = _feed(spark).unionByName(spark.createDataFrame([(None, "x", 1, None, "no id", "")], SC.REVIEW_FEED))
    for _ in range(2):
        IO.append_reviews(feed, f"{tmp_dir}/raw")
    assert IO.read_table(spark, f"{tmp_dir}/raw").count() == 3
