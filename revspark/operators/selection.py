"""Distributed selection: exact order statistics and quotas without sorting
a group in one task and without moving the rows they are taken from.

``quantiles`` counts distinct values, ranges them, and reads the two
neighbours of each wanted rank from the one range that holds them.
``smallest_per_group`` finds, for each group, the value up to which exactly
its quota of rows lies: a histogram of the leading bits of a uniform hash
names the bucket that crosses the quota, and only that bucket is looked at
again, with the next bits, until it is small enough to be ranked.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.ledger import fresh_name

HASH_BITS = 60          # of ``seeded_hash``
ROUND_BITS = 12         # of one histogram: 4,096 buckets a group
RANKED_ROWS = 20_000    # rows of a crossing bucket (all groups') that are ranked on the driver


def seeded_hash(seed: int, *cols: str) -> Column:
    """Uniform non-negative 60-bit hash: the leading 15 hex digits of an md5,
    which any SQL engine can recompute."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.col(c).cast("string") for c in cols))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def quantiles(df: DataFrame, col: str, shares: list[float]) -> list[float | None]:
    """Exact interpolated quantiles of a numeric column, nulls left out (all
    ``None`` without values): value at ``share * (n - 1)`` between its two
    neighbours.  Values travel as one row per distinct value, dealt by range;
    the driver gets a count per range, then two rows a quantile."""
    spark = df.sparkSession
    value = F.col(col).cast("double")
    counts = df.select(value.alias("v")).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, fresh_name("quantiles"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts.repartitionByRange(parts, "v").withColumn("p", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.schema("v double, n long, p int").parquet(path)
    blocks = sorted((r["p"], r["n"]) for r in ranged.groupBy("p").agg(F.sum("n").alias("n")).collect())   # a row per range
    total = sum(n for _, n in blocks)
    if not total:
        return [None] * len(shares)
    ranks = sorted({r for s in shares for r in (math.floor(s * (total - 1)), math.ceil(s * (total - 1)))})
    before, wanted = 0, []                              # (range, rows before it, rank)
    for p, n in blocks:
        wanted += [(p, before, r) for r in ranks if before <= r < before + n]
        before += n
    at = {}
    upto = F.sum("n").over(Window.partitionBy("p").orderBy("v"))
    for p in {p for p, _, _ in wanted}:
        mine = [(b, r) for q, b, r in wanted if q == p]
        inside = ranged.where(F.col("p") == p).withColumn("upto", upto).withColumn("from", F.col("upto") - F.col("n"))
        hit = F.lit(False)
        for b, r in mine:
            hit = hit | ((F.col("from") <= r - b) & (F.col("upto") > r - b))
        for row in inside.where(hit).collect():         # two rows a quantile
            at |= {r: row["v"] for b, r in mine if row["from"] <= r - b < row["upto"]}
    out = []
    for s in shares:
        pos = s * (total - 1)
        low, high = at[math.floor(pos)], at[math.ceil(pos)]
        out.append(low + (high - low) * (pos - math.floor(pos)))
    return out


def smallest_per_group(slim: DataFrame, group: str, value: str, key: str, quotas: dict) -> dict:
    """``group -> (value, key)``: the last row, by (value, key), of the group's
    ``quotas[group]`` smallest; ``None`` for a quota of 0.  ``value`` is a
    non-negative 60-bit number.  ``slim`` is read once a round: at most
    ``HASH_BITS / ROUND_BITS`` rounds of 4,096 counts a group, usually one or
    two, then the rows of the crossing buckets, ``RANKED_ROWS`` in all.  Two
    rows alike in value and key at a quota's end can't be told apart: an error."""
    bound: dict = {g: None for g, q in quotas.items() if not q}
    open_ = {g: (0, q) for g, q in quotas.items() if q}          # prefix of the crossing bucket, rows wanted in it
    shift, sizes = HASH_BITS, {}
    while open_:
        same = F.lit(False)
        for g, (prefix, _) in open_.items():
            same = same | ((F.col(group) == F.lit(g)) & (F.shiftright(value, shift) == prefix) if shift < HASH_BITS else F.col(group) == F.lit(g))
        rows = slim.where(same)
        if shift < HASH_BITS and (sum(sizes.values()) <= RANKED_ROWS or shift == 0):
            if shift == 0:                                        # equal hashes: only the first keys matter
                rank = F.row_number().over(Window.partitionBy(group).orderBy(key))
                rows = rows.withColumn("_rank", rank).where(F.col("_rank") <= max(q for _, q in open_.values()) + 1)
            got: dict = {}
            for r in rows.select(group, value, key).collect():
                got.setdefault(r[0], []).append((r[1], r[2]))
            for g, (_, q) in open_.items():
                ranked = sorted(got[g])
                if q < len(ranked) and ranked[q] == ranked[q - 1]:
                    raise ValueError(f"the key is not unique: {ranked[q][1]!r} of class {g!r}")
                bound[g] = ranked[q - 1]
            break
        shift -= ROUND_BITS
        bars: dict = {}
        for r in rows.groupBy(group, F.shiftright(value, shift).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect():
            bars.setdefault(r[0], []).append((r["b"], r["n"]))
        for g, (_, q) in list(open_.items()):
            for b, n in sorted(bars[g]):
                if q <= n:
                    open_[g], sizes[g] = (b, q), n
                    break
                q -= n
    return bound
