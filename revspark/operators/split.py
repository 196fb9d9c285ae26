"""M3: exact stratified train/test split that scales.

Allocation follows the reviewed pipeline's splitter: ``n_test =
ceil(test_size * n)``, each class gets ``floor(n_c * n_train / n)`` train
rows, and the rows still missing go to the classes with the largest
fractional remainders (ties: class order, where the original draws at
random).  The test rows of a class are its ``n_c - train_c`` rows with the
smallest seeded hash.

Which hash is the last of a class's test rows is found by distributed
selection (``selection.smallest_per_group``) on a narrow table of class,
hash and key; the split is then a comparison within each row.  No row is
ranked or shuffled, no text is written, and a class that holds most rows
costs what its counts cost.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.ledger import fresh_name
from . import selection as SE


def allocate(class_counts: dict, test_size: float = 0.2) -> dict:
    """Per-class (n_train, n_test) of a stratified split."""
    n = sum(class_counts.values())
    if n == 0:
        return {}
    n_test = math.ceil(test_size * n)
    n_train = n - n_test
    classes = sorted(class_counts)
    cont = {c: class_counts[c] * n_train / n for c in classes}
    train = {c: math.floor(cont[c]) for c in classes}
    need = n_train - sum(train.values())
    for c in sorted(classes, key=lambda c: (-(cont[c] - train[c]), classes.index(c)))[:need]:
        train[c] += 1
    return {c: (train[c], class_counts[c] - train[c]) for c in classes}


def stratified_split(df: DataFrame, label_col: str, key_col: str,
                     test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds boolean ``is_test``; exactly the allocated rows per class: those
    with the smallest ``(seeded_hash(seed, key), key)``.

    ``key_col`` must tell rows apart; a null class or key, and a repeated key
    at the end of a class's test rows, is a ``ValueError``."""
    spark = df.sparkSession
    path = scratch_path(spark, fresh_name("split"))
    hashed = SE.seeded_hash(seed, key_col)
    df.select(F.col(label_col).alias("c"), F.col(key_col).alias("k"), hashed.alias("u")).write.parquet(path)
    slim = spark.read.parquet(path)
    counts = {}
    for c, n, keys in slim.groupBy("c").agg(F.count(F.lit(1)), F.count("k")).collect():     # a row per class
        if c is None or keys < n:
            raise ValueError(f"a null in {label_col if c is None else key_col}: every row of a split has a class and a key")
        counts[c] = n
    ends = SE.smallest_per_group(slim, "c", "u", "k", {c: n for c, (_, n) in allocate(counts, test_size).items()})
    label, key = (df.schema[x].dataType.simpleString() for x in (label_col, key_col))
    ends = spark.createDataFrame([(c, *(e or (-1, None))) for c, e in ends.items()], f"_c {label}, _u long, _k {key}")
    # a row per class: broadcast
    joined = df.join(F.broadcast(ends), F.col(label_col) == F.col("_c"), "left")
    test = (hashed < F.col("_u")) | ((hashed == F.col("_u")) & (F.col(key_col) <= F.col("_k")))
    return joined.withColumn("is_test", F.coalesce(test, F.lit(False))).drop("_c", "_u", "_k")


def split_sizes(split: DataFrame, label_col: str) -> DataFrame:
    return (split.groupBy(label_col)
            .agg(F.count_if(~F.col("is_test")).alias("n_train"),
                 F.count_if(F.col("is_test")).alias("n_test")))
