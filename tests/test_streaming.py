"""Streams: duplicates removed, restart adds nothing, stream = batch."""

from pyspark.sql import functions as F

from revspark.operators import stats as ST
from revspark.sources import tables as TB
from revspark.streaming import feed as SF
from tests.conftest import SF_SMALL

EVENTS = f"{SF_SMALL}/events.parquet"


def _feed(spark):
    return SF.events_as_feed(SF.read_stream(spark, SF.stream_path(EVENTS), SF.EVENTS_SCHEMA))


def test_dedupe_twice_ingested_feed(spark):
    twice = _feed(spark).unionByName(_feed(spark))
    out = SF.run_sink(SF.dedupe_feed(twice), spark, "t-dedupe")
    n = spark.read.parquet(EVENTS).count()
    assert out.count() == n == out.select("review_id").distinct().count()


def test_exact_ingest_restart_adds_nothing(spark):
    base = SF.stream_dir(spark, "t-exact")
    SF.run_to_completion(SF.ingest_exact(_feed(spark), f"{base}/out", f"{base}/ckpt"))
    first = spark.read.parquet(f"{base}/out").count()
    # same checkpoint: nothing new to process
    SF.run_to_completion(SF.ingest_exact(_feed(spark), f"{base}/out", f"{base}/ckpt"))
    # fresh checkpoint, same target: the anti-join keeps it unique
    SF.run_to_completion(SF.ingest_exact(_feed(spark), f"{base}/out", f"{base}/ckpt2"))
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == first == out.select("review_id").distinct().count()


def test_stream_window_counts_equal_batch(spark):
    stream = SF.run_upserts(SF.window_counts(_feed(spark)), spark, "t-window", ["window_start", "window_end", "label"])
    batch = ST.sentiment_by_period(TB.review_feed(spark, SF_SMALL), "at", "label", "day")
    joined = stream.join(batch, (stream.window_start == batch.period) & (stream.label == batch.label))
    assert stream.count() > 0
    assert joined.filter(stream.n != batch.n).count() == 0
    assert joined.count() == stream.count() == batch.count()
    assert stream.agg(F.sum("n")).first()[0] == spark.read.parquet(EVENTS).count()      # open windows count too


def test_other_rows_under_a_new_checkpoint_arrive(spark):
    base = SF.stream_dir(spark, "t-second")
    feed = spark.read.parquet(EVENTS)
    feed.where("event_id < 5").write.parquet(f"{base}/one")
    feed.where("event_id between 5 and 11").write.parquet(f"{base}/two")
    for part in ("one", "two", "two"):
        rows = SF.events_as_feed(SF.read_stream(spark, f"{base}/{part}", SF.EVENTS_SCHEMA))
        SF.run_to_completion(SF.ingest_exact(rows, f"{base}/out", SF.stream_dir(spark, "t-ckpt")))
    assert sorted(r.review_id for r in SF.read_ingested(spark, f"{base}/out").collect()) == [
        r.event_id for r in feed.where("event_id < 12").orderBy("event_id").collect()]


def test_unreadable_target_raises(spark):
    import pytest
    base = SF.stream_dir(spark, "t-broken")
    spark.createDataFrame([("no parquet",)], "v string").write.text(f"{base}/out")
    with pytest.raises(Exception):
        SF.run_to_completion(SF.ingest_exact(_feed(spark), f"{base}/out", f"{base}/ckpt"))


def test_profile_batches_idempotent(spark):
    base = SF.stream_dir(spark, "t-profile")
    docs = SF.read_stream(spark, SF.stream_path(f"{SF_SMALL}/documents.parquet"), SF.DOCUMENTS_SCHEMA)
    SF.run_to_completion(SF.profile_batches(docs, f"{base}/out", f"{base}/ckpt"))
    rows = spark.read.parquet(f"{base}/out").collect()
    assert len(rows) == 1 and rows[0]["doc_count"] == spark.read.parquet(
        f"{SF_SMALL}/documents.parquet").count()
