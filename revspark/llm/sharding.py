"""Operator 2: proportional stratified interleaving into shards.

Within each source, rows are ranked in a seeded shuffle; rank ``r`` of ``n``
stands at the fraction ``(r - 1/2) / n``.  Sorted by that fraction, the
sources interleave in proportion, and cutting the order into equal pieces
gives shards that all match the mixture, with row counts at most one apart.

No window spans a source or the whole table: both ranks are counts of
earlier hash (or fraction) buckets plus a rank inside one bucket of about
``bucket_rows`` rows, so a source that holds a third of all rows is dealt to
as many tasks as any other rows.  Only narrow rows shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .scratch import Scratch

HASH_BUCKETS = 1 << 16


def interleaved_shards(docs: DataFrame, shards: int = 16, seed: str = "mix", bucket_rows: int = 2_000,
                       id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size`` (UTF-8 bytes + 1),
    ``text_crc32, law`` ('rows'), ``shard, slot`` (gapless in the shard, in
    training order), ``grown_shard`` (null) and ``source``.

    A null source is a source of its own; a null text has size 1 and the CRC
    of nothing.  Rows that tie in the shuffle go by id, CRC and size; wholly
    equal rows are interchangeable.  A null id counts as an empty one in the
    shuffle.  Other columns are ignored.  An empty table gives no rows."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "sharding")
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("src"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"), key.alias("h"),
        F.when(F.col(source_col).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source_col))).alias("stratum"))
    total = docs.count()
    buckets = min(HASH_BUCKETS, max(1, -(-total // bucket_rows)))
    place = F.conv(F.substring("h", 1, 4), 16, 10).cast("long")
    rows = rows.withColumn("bucket", F.floor(place * buckets / HASH_BUCKETS).cast("int"))

    # rank in the source = rows in earlier buckets + rank in the bucket
    counts = rows.groupBy("stratum", "bucket").agg(F.count(F.lit(1)).alias("n"))
    upto = W.partitionBy("stratum").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("stratum", "bucket", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"),
                           F.sum("n").over(W.partitionBy("stratum")).alias("of"))
    rank = F.row_number().over(W.partitionBy("stratum", "bucket").orderBy("h", "id", "crc", "size"))
    ranked = rows.withColumn("r", rank).join(counts, ["stratum", "bucket"])
    ranked = scratch.save(ranked.withColumn("fraction", (2 * (F.col("before") + F.col("r")) - 1) / (2 * F.col("of")))
                          .select("id", "src", "size", "crc", "h", "stratum", "fraction",
                                  F.floor((2 * (F.col("before") + F.col("r")) - 1) / (2 * F.col("of")) * buckets)
                                  .cast("int").alias("part")), "ranked")

    # the same way for the place in the whole order
    parts = ranked.groupBy("part").agg(F.count(F.lit(1)).alias("n"))      # at most `buckets` rows
    parts = parts.select("part", F.coalesce(F.sum("n").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rank = F.row_number().over(W.partitionBy("part").orderBy("fraction", "stratum", "h", "id", "crc", "size"))
    at = F.col("before") + F.col("r") - 1
    shard = F.expr(f"(before + r - 1) * {shards} div {max(1, total)}")
    return ranked.withColumn("r", rank).join(parts, "part").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
        shard.cast("int").alias("shard"),
        (at - F.expr(f"((before + r - 1) * {shards} div {max(1, total)} * {total} + {shards - 1}) div {shards}"))
        .cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("src").alias("source"))
