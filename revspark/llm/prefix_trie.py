"""Operator 12: conversation prefix trie by truncation peeling.

A conversation is the path of its turns.  Peeling starts at the deepest
conversations and goes up one depth at a time: the nodes that survive from
the depth below lose their last turn, the conversations that end here join
them, and one grouped sum over equal paths both discovers the nodes of this
depth and adds up their subtrees.  Every depth is written to the shared
folder, so the next one starts from a table, and the tables are the result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

ENTRY = 3                       # longs of a turn in a path: two hashes and its words
STRIDE = 64                     # depths that are peeled at once where no paths meet
CHUNK = 4096                    # ids that travel as one string to their node's digest
WORDS = r"[^\x20\x09-\x0D]+"


def conversation_paths(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                       text_col: str = "text") -> DataFrame:
    """``(conv_id, path)``: a row per conversation, its turns in order (null
    first) as an array of ``ENTRY`` longs each: 128 bits of hash of role and
    text, and the words of the text.

    A null role or text counts as empty.  Turns with equal numbers are ordered
    by hash; repeated rows are turns of their own.  Rows without a ``conv_id``
    belong to no conversation.  Other columns are ignored; an empty table gives
    no rows.  Texts stay where they are: 32 bytes a turn move, so the path of
    one conversation must fit a row (some 10 million turns)."""
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).alias("t"), F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), text, role).alias("b"),
                 F.regexp_count(text, F.lit(WORDS)).cast("long").alias("w")).alias("turn"))
    paths = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return paths.select("conv_id", F.flatten(F.transform("turns", lambda t: F.array(t["a"], t["b"], t["w"]))).alias("path"))


def turns_between(path: Column | str, first: Column | int, n: Column | int | None = None) -> Column:
    """Turns ``first`` (from 0) and later of a path, ``n`` at most."""
    path = F.col(path) if isinstance(path, str) else path
    length = F.size(path) if n is None else F.lit(ENTRY) * n
    return F.slice(path, F.lit(ENTRY) * first + 1, length)


def _key(path: Column) -> list[Column]:
    return [F.xxhash64(path).alias("k1"), F.xxhash64(F.lit(1), path).alias("k2")]


def _chunks(batches):
    """Sorted ``k1, k2, conv`` -> ``k1, k2, first, ids``: runs of ids as comma-joined strings."""
    key, first, ids, out = None, None, [], []

    def batch():
        k = [r[0] for r in out]
        return pa.record_batch([pa.array([x[0] for x in k], pa.int64()), pa.array([x[1] for x in k], pa.int64()),
                                pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.string())],
                               ["k1", "k2", "first", "ids"])
    for b in batches:
        for k1, k2, conv in zip(*(b.column(i).to_pylist() for i in range(3))):
            if (k1, k2) != key or len(ids) >= CHUNK:
                if ids:
                    out.append((key, first, ",".join(ids)))
                key, first, ids = (k1, k2), conv, []
            ids.append(str(conv))
        if len(out) > 1000:
            yield batch()
            out = []
    if ids:
        out.append((key, first, ",".join(ids)))
    yield batch()


def _digests(batches):
    """Sorted ``k1, k2, first, ids`` -> ``k1, k2, digest``; one running hash at a time."""
    key, running, out = None, None, []

    def batch():
        return pa.record_batch([pa.array([r[0][0] for r in out], pa.int64()), pa.array([r[0][1] for r in out], pa.int64()),
                                pa.array([r[1] for r in out], pa.string())], ["k1", "k2", "digest"])
    for b in batches:
        for k1, k2, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()):
            if (k1, k2) == key:
                running.update(b",")
            else:
                if key:
                    out.append((key, running.hexdigest()))
                key, running = (k1, k2), hashlib.sha256()
            running.update(ids.encode())
        if len(out) > 10_000:
            yield batch()
            out = []
    if key:
        out.append((key, running.hexdigest()))
    yield batch()


def end_digests(paths: DataFrame) -> DataFrame:
    """``(k1, k2, digest)``: SHA-256 of the ids of the conversations that end at
    a path, ascending, comma-joined.  Ids are dealt by range of (path, id), so
    the copies of one conversation spread over tasks and meet as long strings."""
    ids = paths.select(*_key(F.col("path")), F.col("conv_id").alias("conv"))
    runs = ids.repartitionByRange("k1", "k2", "conv").sortWithinPartitions("k1", "k2", "conv").mapInArrow(
        _chunks, "k1 long, k2 long, first long, ids string")
    return runs.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(
        _digests, "k1 long, k2 long, digest string")


def _shared_depth(rows: DataFrame, low: int) -> int | None:
    """Greatest depth above ``low`` at which two of the paths are equal so far."""
    depth = (F.size("path") / ENTRY).cast("int")
    starts = rows.where(depth > low).select(F.explode(F.sequence(F.lit(low + 1), depth)).alias("d"), "path").select(
        "d", *_key(turns_between("path", 0, F.col("d"))))
    return starts.groupBy("d", "k1", "k2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.max("d")).first()[0]


def _node(depth: Column, path: Column) -> list[Column]:
    """Depth, key and parent's key of a node."""
    up = turns_between(path, 0, F.greatest(depth - 1, F.lit(0)))
    return [depth.cast("int").alias("depth"), *_key(path), F.xxhash64(up).alias("p1"), F.xxhash64(F.lit(1), up).alias("p2")]


def prefix_trie(paths: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns of ``paths (conv_id, path)``
    (unique ids), from the root (depth 0, no turn) down:

    ``conv_id`` smallest conversation that starts so; ``depth``;
    ``parent_conv_id`` (null for the root); ``n_convs`` that start so;
    ``n_children``; ``n_leaves`` childless nodes of the subtree; ``saved_tokens``
    summed over the subtree, words of a node's last text times (n_convs - 1);
    ``ends_sha256`` of the ids that end there (of nothing, if none).

    An empty path is a conversation without turns and ends at the root.
    Without conversations there is no row.  Copies of a conversation fold into
    one row first.  A depth costs its own nodes and a job; depths at which no
    two paths meet (deep single conversations) are peeled up to ``STRIDE`` at a
    time.  The hashes of one conversation's prefixes take the square of its
    turns."""
    spark, scratch = paths.sparkSession, Scratch(paths.sparkSession, "prefix-trie")
    paths = scratch.save(paths.select("conv_id", "path"), "paths")
    ended = (paths.groupBy("path").agg(F.min("conv_id").alias("conv"), F.count(F.lit(1)).alias("n"))
             .withColumn("depth", (F.size("path") / ENTRY).cast("int")))
    ended.repartitionByRange("depth", "conv").write.partitionBy("depth").parquet(scratch.path("ended"))
    ended = spark.read.schema("path array<bigint>, conv bigint, n bigint, depth int").parquet(scratch.path("ended"))
    ending = {r["depth"]: r["count"] for r in ended.groupBy("depth").count().collect()}        # a row per length
    sums, tables, frame, below, quiet = ["n", "children", "leaves", "saved"], [], None, 0, True
    nought = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")]

    def written(df: DataFrame, name: str) -> DataFrame:
        tables.append(scratch.path(name))
        return scratch.save(df, name)

    d = max(ending, default=-1)
    while d >= 0:
        low = max(d - STRIDE, 0)
        if quiet and d - low > 1:
            new = ended.where(F.col("depth").between(low + 1, d)).select(
                "path", "conv", "n", *nought, F.col("depth").alias("top"), F.lit(True).alias("ends"))
            if frame is not None:
                new = new.unionByName(frame.select(turns_between("path", 0, d).alias("path"), "conv", *sums,
                                                   F.lit(d).alias("top"), F.lit(False).alias("ends")))
            new = scratch.save(new, f"run-{d}")
            shared = _shared_depth(new, low)
            down = (low if shared is None else shared) + 1            # the last depth of lone paths
            quiet = shared is None
            if down <= d:
                # a row per path and depth; its last turns' words add up on the way
                words = F.aggregate(F.sequence(F.col("k"), F.col("top")), F.lit(0).cast("long"),
                                    lambda x, i: x + F.element_at("path", i * ENTRY))
                last = F.col("ends") & (F.col("k") == F.col("top"))
                lone = new.where(F.col("top") >= down).select("*", F.explode(F.sequence(F.lit(down), F.col("top"))).alias("k"))
                # (an alias named like the path would be what the lambda sees)
                lone = lone.select(turns_between("path", 0, F.col("k")).alias("start"), "conv", "n", F.when(last, 0).otherwise(1).cast("long").alias("children"),
                                   F.when(F.col("ends"), 1).otherwise(F.col("leaves")).cast("long").alias("leaves"),
                                   (F.col("saved") + (F.col("n") - 1) * words).alias("saved"), "k")
                lone = written(lone.select(F.when(F.col("k") == down, F.col("start")).alias("path"), "conv", *sums,
                                           *_node(F.col("k"), F.col("start"))), f"nodes-{down}")
                frame = lone.where(F.col("depth") == down)
                below, d = frame.count(), down - 1
                continue
        rows = ended.where(F.col("depth") == d).select("path", "conv", "n", *nought)
        if frame is not None:
            rows = rows.unionByName(frame.select(turns_between("path", 0, d).alias("path"), "conv", "n",
                                                 F.lit(1).cast("long").alias("children"), "leaves", "saved"))
        rows = rows.groupBy("path").agg(F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in sums))
        words = F.element_at("path", -1) if d else F.lit(0)
        frame = written(rows.select("path", "conv", "n", "children", F.when(F.col("children") == 0, 1).otherwise(F.col("leaves")).alias("leaves"),
                                    (F.col("saved") + (F.col("n") - 1) * words).alias("saved"), *_node(F.lit(d), F.col("path"))), f"nodes-{d}")
        count = frame.count()
        quiet, below, d = count == below + ending.get(d, 0), count, d - 1
    schema = ("path array<bigint>, conv bigint, n bigint, children bigint, leaves bigint, saved bigint, "
              "depth int, k1 bigint, k2 bigint, p1 bigint, p2 bigint")
    nodes = spark.read.schema(schema).parquet(*tables) if tables else spark.createDataFrame([], schema)
    nodes = nodes.drop("path")
    parents = nodes.where("children > 0").select(*(F.col(c).alias(f"up_{c}") for c in ("k1", "k2", "depth")),
                                                 F.col("conv").alias("parent_conv_id"))
    digests = scratch.save(end_digests(paths), "digests")
    out = nodes.join(parents, (F.col("depth") - 1 == F.col("up_depth")) & (F.col("p1") == F.col("up_k1"))
                     & (F.col("p2") == F.col("up_k2")), "left").join(digests, ["k1", "k2"], "left")
    return out.select(F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id",
                      F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").cast("long").alias("n_leaves"),
                      F.col("saved").alias("saved_tokens"),
                      F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
