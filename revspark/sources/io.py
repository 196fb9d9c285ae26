"""Sources and sinks.

Feeds are read with a declared schema (never inferred on a hot path),
tables go through the Spark catalog or Parquet paths, CSV is read
multi-line with RFC-4180 quoting, and every write is one distributed job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import schema as SC
from ..functions import text as TX
from ..operators import prep as PR
from .ledger import Ledger, path_exists, publish


def read_review_feed(spark: SparkSession, path: str, fmt: str = "json",
                     schema: T.StructType = SC.REVIEW_FEED, newest: int | None = None) -> DataFrame:
    """A landed review feed (json/csv/parquet) with the declared feed
    schema; ``newest`` keeps the newest-n reviews (T1), the feed's own
    NEWEST + count request."""
    r = spark.read.schema(schema)
    if fmt == "csv":
        r = r.option("header", True).option("multiLine", True).option("escape", '"')
    df = r.format(fmt).load(path)
    if newest:
        df = PR.latest_n(df, newest, "at", "reviewId")
    return df


def feed_to_raw(feed: DataFrame) -> DataFrame:
    """S2 shape: feed record -> raw review row.  Missing content becomes
    ''; the surrogate id is a hash of the feed's review id (stable across
    re-ingests, unlike an autoincrement)."""
    return feed.select(
        F.xxhash64("reviewId").alias("id"),
        F.col("reviewId").alias("review_id"),
        F.coalesce(F.col("content"), F.lit("")).alias("review_text"),
        F.col("score").cast("int").alias("rating"),
        F.col("at").alias("date"),
    )


def append_reviews(feed: DataFrame, path: str, dedupe: bool = True) -> None:
    """S2 + S10: append raw reviews to a published table, keeping earlier
    data; with ``dedupe`` reviews already present (by review id) are
    skipped via an anti-join with the table, so re-ingesting a feed adds
    nothing.  The schema is validated before and the rows after writing (S11)."""
    spark = feed.sparkSession

    def rows(have: DataFrame) -> DataFrame:
        raw = feed_to_raw(feed)
        if dedupe:
            raw = PR.dedupe_latest(raw.where("review_id is not null"), "review_id", "date").join(
                have.select("review_id"), "review_id", "left_anti")
        return raw.select(*SC.RAW_REVIEWS.names)

    publish(spark, path, rows, SC.RAW_REVIEWS, {"review_text": F.col("review_text").isNotNull()}, append=True)


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """A published or plain Parquet table, or ``None`` when there is nothing at
    ``path``.  Any other failure raises: an unreadable target is not an empty one."""
    if not path_exists(spark, path):
        return None
    ledger = Ledger(spark, path)
    return ledger.read() if ledger.exists() else spark.read.parquet(path)


def read_raw_reviews(spark: SparkSession, table_or_path: str) -> DataFrame | None:
    """S3: the four raw columns (column-pruned); ``None`` when the table is
    missing or empty (the caller stops, as the reviewed pipeline does)."""
    df = read_table(spark, table_or_path)
    if df is None:
        return None
    df = df.select("id", "review_text", "rating", "date")
    return None if df.isEmpty() else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             null_value: str = "") -> DataFrame:
    """Header CSV with quoted multi-line cells.  A schema avoids the
    inference pass; without one, types are inferred (small files only).
    ``null_value`` is the cell that means null; files of ``write_csv`` use
    ``CSV_NULL``, which keeps empty text apart from null."""
    r = (spark.read.option("header", True).option("multiLine", True)
         .option("escape", '"').option("quote", '"').option("nullValue", null_value))
    if null_value:
        r = r.option("emptyValue", "")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


CSV_NULL = "\\N"


def write_csv(df: DataFrame, path: str, null_value: str = CSV_NULL) -> None:
    """Overwrite, header, UTF-8 (one part file per task).  Cells keep their
    padding; an empty cell is empty text and ``null_value`` is null, so
    ``read_csv(..., null_value=CSV_NULL)`` gives back what was written."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("nullValue", null_value).option("emptyValue", '""').csv(path))


def replace_table(df: DataFrame, path: str, checks: dict | None = None, min_rows: int = 0) -> DataFrame:
    """Full replace by write, audit, publish; readers see the old rows until
    the new ones passed."""
    return publish(df.sparkSession, path, df, df.schema, checks, min_rows=min_rows)


TEXT_NULL = "\\N"
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_ESCAPES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))


def as_text(df: DataFrame) -> DataFrame:
    """every column as text that ``from_text`` turns back: timestamps by
    ``TIMESTAMP_TEXT`` (session time zone), binary in base64, other values as
    Spark prints them; line ends and backslashes of text are escaped, so a row
    is a line; null is ``TEXT_NULL``, which no text is."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TIMESTAMP_TEXT)
        elif isinstance(f.dataType, T.BinaryType):
            c = F.base64(c)
        elif isinstance(f.dataType, T.StringType):
            for plain, escaped in _ESCAPES:
                c = F.replace(c, F.lit(plain), F.lit(escaped))
        elif not isinstance(f.dataType, T.AtomicType):
            raise SC.SchemaMismatch(f"{f.name}: {f.dataType.simpleString()} has no text form")
        out.append(F.coalesce(c.cast("string"), F.lit(TEXT_NULL)).alias(f.name))
    return df.select(*out)


def from_text(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The typed rows of ``as_text`` cells (nulls read as such already); a cell
    that isn't of its type is an error."""
    out = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = F.to_timestamp(c, TIMESTAMP_TEXT)
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = F.to_timestamp_ntz(c, F.lit(TIMESTAMP_TEXT))
        elif isinstance(f.dataType, T.BinaryType):
            c = F.unbase64(c)
        elif isinstance(f.dataType, T.StringType):
            for plain, escaped in reversed(_ESCAPES):
                c = F.replace(c, F.lit(escaped), F.lit(plain))
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)


def write_text_csv(df: DataFrame, path: str) -> None:
    """S5 + F17: a lossless CSV: typed cells as text, one line a row, so that
    files of any size are read by many tasks."""
    write_csv(as_text(df), path)


def read_text_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of ``write_text_csv``."""
    cells = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = (spark.read.option("header", True).option("escape", '"').option("quote", '"').option("emptyValue", "")
            .option("nullValue", TEXT_NULL).schema(cells).csv(path))
    return from_text(rows, schema)


def read_table(spark: SparkSession, table_or_path: str) -> DataFrame | None:
    """Full-table scan from the catalog or a Parquet path."""
    if "/" not in table_or_path and spark.catalog.tableExists(table_or_path):
        return spark.table(table_or_path)
    return read_if_exists(spark, table_or_path)


def prepare_clean_reviews_for_model(spark: SparkSession, table_or_path: str | None = None,
                                    csv_path: str | None = None) -> DataFrame:
    """The training table, else the CSV, else an empty frame of the
    right schema; then drop nulls, cast to string, drop blank text."""
    df = read_table(spark, table_or_path) if table_or_path else None
    if df is None and csv_path and path_exists(spark, csv_path):
        df = read_csv(spark, csv_path, SC.TRAINING)
    if df is None:
        df = spark.createDataFrame([], SC.TRAINING)
    return PR.prepare_training(SC.require_columns(df, ["cleaned_text", "sentiment"]))


def has_text(df: DataFrame, col: str) -> DataFrame:
    return df.filter(~TX.is_blank(col))
