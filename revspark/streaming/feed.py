"""Structured Streaming jobs over a review feed.

Each job reuses the batch column expressions unchanged, checkpoints its
state to the shared checkpoint folder (so a restarted or relocated driver
resumes exactly where it stopped), and writes a file sink whose commit log
makes output exactly-once.  ``availableNow`` triggers process what is there
and stop, which is how tests and scheduled runs drive them.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import labels as LB
from ..functions import text as TX
from ..operators import models as MD
from ..operators import prep as PR
from ..operators import stats as ST
from ..session import scratch_path
from ..sources import io as IO
from ..sources.ledger import ATTEMPTS, Ledger, compact

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

DOCUMENTS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def stream_dir(spark: SparkSession, name: str) -> str:
    """Fresh folder under the shared checkpoint folder for one stream run."""
    return scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex[:12]}")


def stream_path(path: str) -> str:
    """The file stream source lists a *directory*; a single file is read
    through a one-file glob of its name."""
    head, _, name = path.rstrip("/").rpartition("/")
    return f"{head}/{name[:-1]}[{name[-1]}]" if name else path


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def events_as_feed(events: DataFrame) -> DataFrame:
    """The feed shape of ``events`` (works on batch and streaming frames)."""
    rating = (F.lit(1) + F.floor("value").cast("int") % 5).cast("int")
    return events.select(F.col("event_id").alias("review_id"), F.col("ts").alias("at"), "user_id",
                         rating.alias("rating")).withColumn("label", LB.label_review("rating"))


def _run(df: DataFrame, out: str, ckpt: str, mode: str = "append", fmt: str = "parquet") -> StreamingQuery:
    return (df.writeStream.format(fmt).outputMode(mode).option("path", out)
            .option("checkpointLocation", ckpt).trigger(availableNow=True).start())


def run_to_completion(q: StreamingQuery) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


# --- A1 ----------------------------------------------------------------------

def dedupe_feed(feed: DataFrame, key: str = "review_id", event_time: str = "at",
                delay: str = "2 days") -> DataFrame:
    """A1: drop re-ingested copies of a review within the watermark delay.
    State holds only keys whose event time is within ``delay``."""
    return feed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


INGEST_BUCKETS = 256


def ingest_exact(feed: DataFrame, target: str, ckpt: str, key: str = "review_id",
                 event_time: str = "at", stream: str | None = None) -> StreamingQuery:
    """A1, unbounded horizon: of each micro-batch the latest copy of a review
    is appended unless the target holds that review already (a stored review
    is never updated).

    The target is a ``Ledger``: a version names its data folders and the last
    batch of each ``stream`` (by default the checkpoint, which numbers the
    batches), so a replayed batch is skipped, a batch that died half-way was
    never there, and no folder is listed.  The anti-join keeps reviews single
    for several streams, or one with a new checkpoint: a batch that another
    writer overtakes is joined again.  Data is laid out by a hash bucket of the
    key, and a batch reads only the buckets of its own keys.  Rows without a key
    can't be told apart: they go to ``read_rejected`` instead, once a batch."""
    spark, stream = feed.sparkSession, stream or ckpt
    bucket = F.pmod(F.xxhash64(key), F.lit(INGEST_BUCKETS)).cast("int")
    schema = T.StructType([*feed.schema.fields, T.StructField("_bucket", T.IntegerType())])
    ledger = Ledger(spark, target)
    ledger.create(schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        bad = batch.where(F.col(key).isNull())
        fresh = PR.dedupe_latest(batch.where(F.col(key).isNotNull()), key, event_time).select(*batch.columns).withColumn("_bucket", bucket)
        for attempt in range(ATTEMPTS):
            state = ledger.state()
            if state["streams"].get(stream, -1) >= batch_id:
                return
            if not attempt and not bad.isEmpty():
                bad.write.mode("overwrite").parquet(f"{target}/_rejected/{_stream_name(stream)}-{batch_id}")
            rows = fresh
            if state["dirs"]:
                mine = [r[0] for r in fresh.select("_bucket").distinct().collect()]     # at most INGEST_BUCKETS
                rows = fresh.join(ledger.read(state).where(F.col("_bucket").isin(mine)).select(key), key, "left_anti").select(*schema.names)
            name = ledger.write(rows, "_bucket")
            n = ledger.read(state, [name]).count()
            dirs = {**state["dirs"], **({name: n} if n else {})}
            if ledger.commit({**state, "dirs": dirs, "streams": {**state["streams"], stream: batch_id}}):
                return
            ledger.drop_dir(name)
        raise RuntimeError(f"{target}: other writers were faster {ATTEMPTS} times")

    return (feed.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())


def _stream_name(stream: str) -> str:
    return hashlib.sha256(stream.encode()).hexdigest()[:16]


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    """The reviews of the newest version; of a stream without data no rows."""
    return Ledger(spark, target).read().drop("_bucket")


def read_rejected(spark: SparkSession, target: str) -> DataFrame:
    """Rows that came without a key."""
    schema = T.StructType([f for f in T.StructType.fromJson(Ledger(spark, target).state()["schema"]) if f.name != "_bucket"])
    if not IO.path_exists(spark, f"{target}/_rejected"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{target}/_rejected/*")


def compact_ingested(spark: SparkSession, target: str, small_rows: int = 1_000_000) -> int:
    """Merge the small folders that batches leave behind, a file a bucket."""
    return compact(spark, target, small_rows, ("_bucket",))


# --- update-mode sink ----------------------------------------------------------

def upsert_sink(df: DataFrame, target: str, ckpt: str) -> StreamingQuery:
    """Write a stateful aggregate in update mode: every micro-batch leaves its
    changed rows in a partition of its own (a replay overwrites it), so no
    window waits for a watermark that never comes.  One checkpoint per target;
    read it with ``read_upserts``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/_batch={batch_id}")

    return (df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())


def read_upserts(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """The last written row of each key."""
    rows = spark.read.parquet(target)
    rest = [c for c in rows.columns if c not in (*keys, "_batch")]
    last = F.max_by(F.struct(*rest), F.col("_batch")).alias("_row")
    return rows.groupBy(*keys).agg(last).select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest))


def run_upserts(df: DataFrame, spark: SparkSession, name: str, keys: list[str]) -> DataFrame:
    base = stream_dir(spark, name)
    run_to_completion(upsert_sink(df, f"{base}/out", f"{base}/ckpt"))
    return read_upserts(spark, f"{base}/out", keys).select(*df.columns)


# --- A2 ----------------------------------------------------------------------

def score_stream(docs: DataFrame, model: PipelineModel, text_col: str = "text",
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A2: the batch cleaning path + the saved model on a stream (stateless)."""
    cleaned = PR.clean_corpus(docs, text_col, "cleaned_text")
    scored = MD.score(model, cleaned)
    return scored.select(*keep, "predicted_label", "confidence")


# --- A3 / A4 -------------------------------------------------------------------

def window_counts(feed: DataFrame, length: str = "1 day", delay: str = "1 day",
                  event_time: str = "at") -> DataFrame:
    """A3: sentiment counts per tumbling window.  The watermark bounds the
    state; run it with ``run_upserts`` so that open windows count too."""
    w = F.window(F.col(event_time), length)
    return (feed.withWatermark(event_time, delay)
            .groupBy(w.alias("w"), "label").agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "label", "n"))


def pane_counts(feed: DataFrame, step: str = "1 day", delay: str = "1 day", event_time: str = "at") -> DataFrame:
    """A4: running sums per pane; state holds a row per open pane, not seven
    per event.  ``ST.rates_of_panes`` makes sliding windows of the sink's panes."""
    return ST.pane_counts(feed.withWatermark(event_time, delay), event_time, "label", None, step)


def rolling_rates(feed: DataFrame, spark: SparkSession, length: str = "7 days", step: str = "1 day") -> DataFrame:
    """A4: run the pane stream to its end; negative and positive rate per
    sliding window of the panes so far."""
    return ST.rates_of_panes(run_upserts(pane_counts(feed, step), spark, "panes", ["pane", "pane_end"]), length, step)


# --- A5 ----------------------------------------------------------------------

def profile_batches(docs: DataFrame, target: str, ckpt: str, text_col: str = "text",
                    vocab_terms: list[str] | None = None, stream: str | None = None) -> StreamingQuery:
    """A5: one text-profile row per micro-batch appended to a metrics table.
    A batch id counts within its ``stream`` (by default the checkpoint, whose
    ids it numbers), so a replayed batch is skipped and another stream's is not."""
    spark, stream = docs.sparkSession, stream or ckpt

    def write(batch: DataFrame, batch_id: int) -> None:
        have = IO.read_if_exists(spark, target)
        if have is not None and not have.where((F.col("stream") == stream) & (F.col("batch_id") == batch_id)).isEmpty():
            return
        toks = batch.select(TX.vector_tokens(TX.clean_text(text_col)).alias("t"))
        prof = ST.text_profile(toks, "t", vocab_terms).withColumn("batch_id", F.lit(batch_id)).withColumn("stream", F.lit(stream))
        prof.write.mode("append").parquet(target)

    return (docs.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())


def run_sink(df: DataFrame, spark: SparkSession, name: str, mode: str = "append") -> DataFrame:
    """Run a streaming frame to completion into a parquet sink; return the sink."""
    base = stream_dir(spark, name)
    run_to_completion(_run(df, f"{base}/out", f"{base}/ckpt", mode))
    return spark.read.parquet(f"{base}/out")
