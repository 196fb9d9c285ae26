"""Operator 11: ranked lexical search over hashed max-sketches.

A document's impact for a term grows with how often it holds the term, so one
scan folds each document into a sketch: the highest count of any term of each
of ``WIDTH`` hash places, with the document's length.  The same scan counts
what the weights need.  A query then looks its terms' places up: weight times
the impact of a place's highest count, summed, is never below the document's
score.  Each task takes its documents by descending bound, scores them exactly
from their whole texts and stops a query where bounds fall below its tenth best
score so far; the tasks' best meet in one ranking.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

WIDTH = 4096                    # places of a sketch; a power of two, 65,536 at most
BLOCK_BYTES = 2_000_000         # text of the queries that one scan answers
SLICE = 256                     # documents whose bounds are held at a time
QUERIES = 256                   # queries whose bounds are held at a time
SLACK = 1 + 2.0 ** -10          # far above the rounding of 32-bit sums

_TERM = bytes(b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all non-ASCII, A-Z lower-cased."""
    return text.encode("utf-8", "replace").translate(_TERM).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: int, n_docs: int, total: int) -> int:
    return 10 + 90 * n * n_docs // total


def impact(tf: int, m: int) -> int:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def fold(counts: list[Counter]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places ascending, highest count of a term there) of each document."""
    out = []
    for c in counts:
        if not c:
            out.append((np.zeros(0, np.uint16), np.zeros(0, np.uint32)))
            continue
        place = np.fromiter(map(zlib.crc32, c), np.int64, len(c)) & (WIDTH - 1)
        both = np.sort((place << 32) | np.fromiter(c.values(), np.int64, len(c)))
        place = both >> 32
        last = np.r_[place[1:] != place[:-1], True]
        out.append((place[last].astype(np.uint16), (both[last] & 0xFFFFFFFF).astype(np.uint32)))
    return out


def _slices(batch: pa.RecordBatch, rows: int):
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def sketch_documents(docs: DataFrame, vocabulary: set[bytes], scratch: Scratch, id_col: str, text_col: str) -> DataFrame:
    """Written table: a row per document ``(id, n, places, counts, text)``, and
    rows ``(term, df)`` with a task's documents that hold a term of the
    vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def scan(batches):
        own, df = shared.value, Counter()
        for b in batches:
            for part in _slices(b, 128):
                texts = part.column(1)
                counts = [Counter(terms_of(t)) for t in texts.to_pylist()]
                for c in counts:
                    df.update(own.intersection(c) if len(own) > len(c) else own & c.keys())
                sketches = fold(counts)
                k = len(counts)
                yield pa.record_batch([part.column(0), pa.array([c.total() for c in counts], pa.int64()),
                                       pa.array([p.tobytes() for p, _ in sketches], pa.binary()),
                                       pa.array([c.tobytes() for _, c in sketches], pa.binary()), texts,
                                       pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64())],
                                      ["id", "n", "places", "counts", "text", "term", "df"])
        k = len(df)
        yield pa.record_batch([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()),
                               pa.nulls(k, pa.string()), pa.array(list(df), pa.binary()), pa.array(list(df.values()), pa.int64())],
                              ["id", "n", "places", "counts", "text", "term", "df"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return scratch.save(rows.mapInArrow(scan, "id long, n long, places binary, counts binary, text string, term binary, df long"), "sketches")


def _frequencies(docs: DataFrame, vocabulary: set[bytes], scratch: Scratch, name: str) -> DataFrame:
    """``(term, df)`` of later blocks of queries, from the texts of the sketch table."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def scan(batches):
        own, df = shared.value, Counter()
        for b in batches:
            for part in _slices(b, 128):
                for t in part.column(0).to_pylist():
                    df.update(own.intersection(terms_of(t)))
        yield pa.record_batch([pa.array(list(df), pa.binary()), pa.array(list(df.values()), pa.int64())], ["term", "df"])
    return scratch.save(docs.select("text").mapInArrow(scan, "term binary, df long"), name)


class Best:
    """The ``k`` best ``(score, id)`` of a query: higher scores, then smaller ids (null last)."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 0

    def wants(self, bound: float) -> bool:
        return len(self.rows) < self.k or bound >= self.least

    def add(self, score: int, doc: int | None):
        if score <= 0 or len(self.rows) == self.k and score < self.least:
            return
        self.rows.append((-score, doc is None, doc or 0))
        self.rows.sort()
        del self.rows[self.k:]
        self.least = -self.rows[-1][0]


def search_task(batches, terms: list[list[tuple[bytes, int]]], n_docs: int, total: int, k: int):
    """Best ``(query, score, id)`` of a task's rows ``(id, n, places, counts, text)``."""
    best = [Best(k) for _ in terms]
    needed = np.unique(np.array([zlib.crc32(t) & (WIDTH - 1) for q in terms for t, _ in q], np.int64))
    column = np.full(WIDTH, -1)
    column[needed] = np.arange(len(needed))
    blocks = []
    for s in range(0, len(terms), QUERIES):
        w = np.zeros((len(needed), min(QUERIES, len(terms) - s)), np.float32)
        for i, q in enumerate(terms[s:s + QUERIES]):
            for t, x in q:
                w[column[zlib.crc32(t) & (WIDTH - 1)], i] += x
        blocks.append((s, w))
    for b in batches:
        for part in _slices(b, SLICE):
            n = part.column(1).to_numpy()
            ids, texts = part.column(0).to_pylist(), part.column(4)
            m = np.array([length_norm(x, n_docs, total) for x in n.tolist()], np.int64)
            dense = np.zeros((len(n), len(needed)), np.float32)
            for i, (p, c) in enumerate(zip(part.column(2), part.column(3))):
                at = column[np.frombuffer(p.as_py(), np.uint16)]
                tf = np.frombuffer(c.as_py(), np.uint32).astype(np.int64)[at >= 0]
                dense[i, at[at >= 0]] = 1_000_000_000 * tf // (1000 * tf + 8 * m[i])
            held: dict[int, Counter] = {}
            for s, w in blocks:
                bounds = (dense @ w) * SLACK
                for j in range(w.shape[1]):
                    own, bound = best[s + j], bounds[:, j]
                    some = np.flatnonzero((bound >= own.least if len(own.rows) == k else bound > 0))
                    for i in some[np.argsort(-bound[some], kind="stable")].tolist():
                        if not own.wants(bound[i]):
                            break
                        if i not in held:
                            held[i] = Counter(terms_of(texts[i].as_py()))
                        c, mi = held[i], int(m[i])
                        own.add(sum(x * impact(c[t], mi) for t, x in terms[s + j] if t in c), ids[i])
    rows = [(q, -r[0], None if r[1] else r[2]) for q, x in enumerate(best) for r in x.rows]
    yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                           pa.array([r[2] for r in rows], pa.int64())], ["query", "score", "id"])


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", item_col: str = "item_id",
                   text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of the highest
    positive score for each row of ``items``, ranks from 1, equal scores by
    ascending id (a null id last).

    Scores are 64-bit integers: over a query's distinct terms, floor(1000 ln((2N
    + 2) / (2 df + 1))) times (10^9 tf div (1000 tf + 8 m)), with m = 10 + (90 n
    N) div L.  Null and empty texts have no terms: such a document is never
    found and doesn't count in N, such an item finds nothing.  Rows of
    documents with equal ids are documents of their own; repeated items repeat
    their results.  Other columns are ignored; empty tables give no rows.  Items
    are answered in blocks of about ``block_bytes`` of text, one scan of the
    sketches each; an item's distinct terms must fit a task."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "lexical-search")
    items = items.select(F.col(item_col), F.col(text_col).cast("string").alias("q"))
    length = items.agg(F.coalesce(F.sum(F.octet_length("q")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-length // block_bytes))
    block = F.pmod(F.xxhash64(item_col, "q"), F.lit(n_blocks))
    table, stats, found = None, None, None
    for i in range(n_blocks):
        own = items.where(block == i).collect()             # about block_bytes of text
        queries = [sorted(set(terms_of(r["q"]))) for r in own]
        vocabulary = {t for q in queries for t in q}
        if table is None:
            table = sketch_documents(docs, vocabulary, scratch, id_col, text_col)
            stats = table.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
            counted = table.where("term is not null")
        else:
            counted = _frequencies(table.where("n > 0"), vocabulary, scratch, f"frequencies-{i}")
        df = {bytes(r["term"]): r["df"] for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect()}  # the block's terms
        if not df:
            continue
        shared = spark.sparkContext.broadcast([[(t, weight(stats[0], df[t])) for t in q if t in df] for q in queries])
        n_docs, total = stats
        hits = table.where("n > 0").select("id", "n", "places", "counts", "text").mapInArrow(
            lambda batches: search_task(batches, shared.value, n_docs, total, k), "query int, score long, id long")
        names = spark.createDataFrame([(j, r[item_col]) for j, r in enumerate(own)], _names_schema(items, item_col))
        hits = scratch.save(hits, f"hits-{i}").join(F.broadcast(names), "query").withColumn("block", F.lit(i))
        found = hits if found is None else found.union(hits)
    if found is None:
        found = spark.createDataFrame([], f"query int, score long, id long, `{item_col}` "
                                      f"{items.schema[item_col].dataType.simpleString()}, block int")
    order = Window.partitionBy("block", "query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        item_col, "rank", F.col("id").alias(id_col), "score")


def _names_schema(items: DataFrame, item_col: str) -> str:
    return f"query int, `{item_col}` {items.schema[item_col].dataType.simpleString()}"
