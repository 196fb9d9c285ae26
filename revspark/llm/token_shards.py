"""Operator 1: token-ID output in training order.

Documents become sequences of ``seq_len`` token ids (an end mark after each
document, padding in its last sequence).  Sequence ``i`` of ``n`` gets the
global slot ``p(i)``, where ``p`` is a keyed Feistel permutation of the next
power of four, walked along its cycles until it lands below ``n``.  Slots
are cut into ranges, one file each, of records of one fixed size: a trainer
reads forward, and resumes at slot ``s`` by seeking to ``(s % per_shard) *
stride`` of file ``s // per_shard``.  Files are written by Spark's committer.
"""

from __future__ import annotations

from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import let, read_ranks
from .shingles import mix

HEADER = 16          # doc id (8), sequence of the document (4), ids before the padding (4); big-endian
END, PAD = 50256, 50257
NO_ID = -(2**63)     # a null doc id

#: The same matches by a pattern that is searched faster: the commonest case first, no way back into a run.
FASTER = {r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""":
          r""" ?\p{L}++| ?\p{N}++|'(?:[sdmt]|ll|ve|re)| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""}


def stride_of(seq_len: int) -> int:
    return HEADER + 2 * seq_len + 1      # 16-bit ids, little-endian, and the line end that Spark's writer adds


def feistel(x: np.ndarray, n: int, key: int, rounds: int = 4) -> np.ndarray:
    """Keyed permutation of 0..n-1 (as uint64)."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    low = (np.uint64(1) << half) - np.uint64(1)
    keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) + np.uint64(key % 2**64) * np.uint64(2**32 + 1)) if rounds else []

    def once(v):
        left, right = v >> half, v & low
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & low)
        return left << half | right

    out = once(x.astype(np.uint64))
    out_of = np.flatnonzero(out >= n)
    while len(out_of):                   # the domain is below 4 n: about four steps at most on average
        out[out_of] = once(out[out_of])
        out_of = out_of[out[out_of] >= n]
    return out


def _encoding(shared: dict):
    """The tokenizer, built once per worker."""
    if shared["encoding"] is None:
        import tiktoken
        pattern = FASTER.get(shared["pattern"], shared["pattern"])
        shared["encoding"] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=shared["ranks"], special_tokens={})
    return shared["encoding"]


def _records(docs: list[int], ids: list[array], seq_len: int) -> np.ndarray:
    """One row of bytes per sequence: header, then ids."""
    used = np.array([len(x) + 1 for x in ids])
    seqs = -(-used // seq_len)
    first = np.cumsum(seqs) - seqs
    out = np.full((int(seqs.sum()), seq_len), PAD, "<u2")
    flat = out.reshape(-1)
    for at, x in zip((first * seq_len).tolist(), ids):
        flat[at:at + len(x)] = x
    flat[first * seq_len + used - 1] = END
    nth = np.arange(len(out)) - np.repeat(first, seqs)
    rec = np.empty((len(out), HEADER + 2 * seq_len), np.uint8)
    rec[:, :8] = np.repeat(np.array(docs, ">i8"), seqs).view(np.uint8).reshape(-1, 8)
    rec[:, 8:12] = nth.astype(">u4").view(np.uint8).reshape(-1, 4)
    rec[:, 12:16] = np.minimum(seq_len, np.repeat(used, seqs) - seq_len * nth).astype(">u4").view(np.uint8).reshape(-1, 4)
    rec[:, 16:] = out.view(np.uint8)
    return rec


def write_shards(docs: DataFrame, path: str, seq_len: int = 256, per_shard: int = 32_768, key: int = 20_240_229,
                 id_col: str = "doc_id", text_col: str = "text") -> int:
    """Write all of ``docs`` below ``path`` and return the number of sequences.

    ``docs`` must be a scan of a stored table: two passes number its rows by
    task (the second one checks that each task sees as many sequences as the
    first did).  A null or empty text is the end mark alone; a null id is
    stored as -2**63; repeated rows are written each.  Other columns are
    ignored.  An empty table writes no file."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast({"ranks": read_ranks(), "pattern": public_tokenizers.PATTERN, "encoding": None})

    def rows(b: pa.RecordBatch):
        for i in range(0, b.num_rows, 64):
            yield from zip(*(b.slice(i, 64).column(c).to_pylist() for c in (0, 1)))

    source = docs.select(F.col(id_col).cast("long").alias("id"), text_col)

    def count(batches):
        encode, n = _encoding(shared.value).encode_ordinary, 0
        for b in batches:
            for _, text in rows(b):
                n += -(-(len(encode(text or "")) + 1) // seq_len)
        yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64())], ["task", "n"])

    # one number per task of the scan reaches the driver
    counts = {r["task"]: r["n"] for r in source.mapInArrow(count, "task int, n long").collect()}
    total = sum(counts.values())
    if not total:
        return 0
    starts, at = {}, 0
    for task in sorted(counts):
        starts[task], at = at, at + counts[task]

    def records(batches):
        encode, task = _encoding(shared.value).encode_ordinary, TaskContext.get().partitionId()
        at = starts[task]
        for b in batches:
            doc, ids, held = [], [], 0
            for d, text in rows(b):
                doc.append(NO_ID if d is None else d)
                ids.append(array("H", encode(text or "")))
                held += len(ids[-1])
                if held > 1 << 21:
                    rec = _records(doc, ids, seq_len)
                    yield batch(rec, at)
                    doc, ids, held, at = [], [], 0, at + len(rec)
            if doc:
                rec = _records(doc, ids, seq_len)
                yield batch(rec, at)
                at += len(rec)
        if at != starts[task] + counts[task]:
            raise RuntimeError("the table changed between the two passes")

    def batch(rec, at):
        n, width = rec.shape
        slot = feistel(np.arange(at, at + n, dtype=np.uint64), total, key).astype(np.int64)
        ends = np.arange(0, (n + 1) * width, width, dtype=np.int32)
        return pa.record_batch([pa.array((slot // per_shard).astype(np.int32)), pa.array(slot),
                                pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(rec)])],
                               ["shard", "slot", "record"])

    shards = -(-total // per_shard)
    (source.mapInArrow(records, "shard int, slot long, record binary")
     .repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "slot")
     .select("shard", F.col("record").cast("string").alias("value"))     # text files take the bytes as they are
     .write.partitionBy("shard").text(path))
    return total


def read_shards(spark: SparkSession, path: str, seq_len: int = 256, per_shard: int = 32_768) -> DataFrame:
    """``slot, shard, offset, doc_id, seq, n_ids, ids`` (binary, without padding)
    of all records below ``path``; one task holds one file at a time."""
    stride = stride_of(seq_len)
    files = spark.read.format("binaryFile").load(path)
    n = F.floor(F.octet_length("content") / stride).cast("int")
    # a lambda would copy a column's bytes for each record, but not a bound variable's
    record = let(F.col("content"), lambda all_: F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        i.alias("at"), F.substring(all_, i * stride + 1, F.lit(stride)).alias("rec"))))
    r = files.select("shard", F.explode(record).alias("r")).select("shard", "r.at", "r.rec")
    big = lambda a, k: F.conv(F.hex(F.substring("rec", a, k)), 16, -10).cast("long")      # noqa: E731
    r = r.select((F.col("shard").cast("long") * per_shard + F.col("at")).alias("slot"), F.col("shard").cast("int").alias("shard"),
                 (F.col("at").cast("long") * stride).alias("offset"), big(1, 8).alias("doc_id"),
                 big(9, 4).cast("int").alias("seq"), big(13, 4).cast("int").alias("n_ids"), "rec")
    return r.select("slot", "shard", "offset", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"),
                    "seq", "n_ids", F.substring(F.col("rec"), F.lit(HEADER + 1), 2 * F.col("n_ids")).alias("ids"))
