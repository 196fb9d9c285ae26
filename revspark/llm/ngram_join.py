"""Operator 8: n-gram Jaccard join by filters under several token orders.

Two sets with Jaccard >= t share a token among the first
``n - ceil(t n) + 1`` of each, whatever the order of tokens, as long as both
use the same one.  Every order here puts rarer tokens first (by the level of
their corpus count) and breaks ties by its own hash.  A pair is verified
only if it shares a prefix token under *every* order.  Buckets of frequent
tokens (near copies; nothing else lacks rarer tokens) give stars instead of
pairs, and the tiles of ``verify`` compare all that such a star holds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import frequency as Q
from .components import connected_components
from .scratch import BROADCAST_ROWS, Bitmap, Scratch, broadcast_if_small
from .shingles import WordHashes, as_long, mix, shingles, words_of
from .verify import BucketEdges, prefix, set_batches, verified_links
from .workers import lean

LEVELS = [8 * 4 ** k for k in range(10)]    # corpus counts at which a token gets less rare
SLOT_BITS = 24                              # 16 MB table of levels
META = 3                                    # low key bits: 0..2 an order, 3 the size of a set


def token_set(text: str | None, hashes: WordHashes, k: int) -> np.ndarray:
    """Distinct shingle hashes, sorted."""
    return np.unique(shingles(hashes.of(words_of(text)), k))


def texts(batch: pa.RecordBatch):
    """(first, second) column values, a few rows at a time."""
    for i in range(0, batch.num_rows, 64):
        part = batch.slice(i, 64)
        yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist())


def ngram_components(docs: DataFrame, words: int = 4, num: int = 85, den: int = 100, orders: int = 2,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``.

    Two documents link when the Jaccard of their sets of distinct word
    ``words``-shingles is at least ``num/den``; a component id is the smallest
    id reachable by links.  Words are runs of non-white-space with A-Z
    lower-cased; a shorter text is one shingle.  A text without words (or a
    null) has size 0, links with nothing and is its own component.  Rows with
    a null id get size 0 and a null component and link with nothing.  Repeated rows give
    repeated results; rows with one id but different texts count as one
    document that has the links of both (and the larger size).  Other columns
    are ignored.  An empty table gives no rows."""
    if not 1 <= orders <= 3:
        raise ValueError("orders must be 1 to 3")
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram-join")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("txt"))
    hashed = rows.withColumn("h", F.unhex(F.md5(F.coalesce("txt", F.lit("")))))

    # copies of a text are one member: the one with the smallest id
    ids = hashed.select("doc", "h", F.octet_length("txt").alias("len"))
    first = ids.where("doc is not null").groupBy("h").agg(F.min("doc").alias("rep"))
    ids = scratch.save(ids.join(first, "h", "left").select(
        "doc", F.when(F.col("doc").isNotNull(), F.col("rep")).alias("rep"), "len", F.when(F.col("doc") != F.col("rep"), F.col("h")).alias("h")), "ids")
    copies = ids.where("h is not null").select("doc", "h").distinct()
    small = copies.count() <= BROADCAST_ROWS
    members = (hashed.where("doc is not null")
               .join(F.broadcast(copies) if small else copies, ["doc", "h"], "left_anti").select("doc", "txt"))
    if not small:
        members = scratch.save(members, "members")      # text moves once, not in every pass

    total = ids.agg(F.sum("len")).first()[0] or 0
    bits = Q.part_bits(total)

    def all_tokens(batches):
        hashes, packer = WordHashes(), Q.KeyPacker(bits)
        for b in batches:
            for _, text in texts(b):
                packer.add(token_set(text, hashes, words))
                if packer.full():
                    yield from packer.flush()
        yield from packer.flush()

    table = spark.sparkContext.broadcast(
        Q.levels(members.mapInArrow(lean(all_tokens), Q.PACK_SCHEMA), bits, LEVELS, SLOT_BITS))

    def postings(batches):
        hashes, low = WordHashes(), ~np.uint64(3)
        for b in batches:
            keys, docs_, sizes, held = [], [], [], 0
            for doc, text in texts(b):
                s = token_set(text, hashes, words)
                if not len(s):
                    continue
                level = Q.lookup(table.value, s, SLOT_BITS)
                got = [np.array([mix(np.array([doc & (2**64 - 1)], np.uint64))[0]]) | np.uint64(META)]
                got += [mix(prefix(s, level, o, num, den)) & low | np.uint64(o) for o in range(orders)]
                keys += got
                m = sum(map(len, got))
                held += m
                docs_.append(np.full(m, doc, np.int64))
                sizes.append(np.full(m, len(s), np.int32))
                if held > 100_000:
                    yield _posting_batch(keys, docs_, sizes)
                    keys, docs_, sizes, held = [], [], [], 0
            if keys:
                yield _posting_batch(keys, docs_, sizes)

    posted = members.mapInArrow(lean(postings), "key long, doc long, n int")

    def edges(batches):
        buckets = BucketEdges()

        def out(key, doc, n, last=False):
            a, b, na, nb, k, dense = buckets.feed(key, doc, n, last)
            mask = np.where(dense, (1 << orders) - 1, 1 << (k & 3)).astype(np.int32)
            ok = den * np.minimum(na, nb) >= num * np.maximum(na, nb)
            ok |= dense.astype(bool)      # a star stands for all of its bucket
            return _edge_batch(a[ok], b[ok], na[ok], nb[ok], mask[ok])

        for t in batches:
            key, doc, n = (t.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            meta = (key & 3) == META
            if meta.any():
                m = int(meta.sum())
                yield _edge_batch(doc[meta], doc[meta], n[meta], n[meta], np.full(m, -1, np.int32))
            yield out(key[~meta], doc[~meta], n[~meta])
        z = np.zeros(0, np.int64)
        yield out(z, z, z, True)

    found = scratch.save(posted.repartition("key").sortWithinPartitions("key", "doc", "n")
                         .mapInArrow(lean(edges), "a long, b long, na int, nb int, mask int"), "edges")
    table.unpersist()
    # intersect the orders' filters
    candidates = scratch.save(
        found.where("mask > 0").groupBy("a", "b")
        .agg(F.max("na").alias("na"), F.max("nb").alias("nb"), F.bit_or("mask").alias("mask"))
        .where(F.col("mask") == (1 << orders) - 1).drop("mask"), "candidates")

    def sets_of(wanted: Bitmap) -> DataFrame:
        def sets(batches):
            hashes = WordHashes()
            return set_batches(((doc, token_set(text, hashes, words)) for b in batches for doc, text in texts(b)))

        return members.where(wanted.has("doc")).mapInArrow(lean(sets), "id long, tokens binary")

    links = verified_links(candidates, sets_of, num, den, scratch)
    sizes = scratch.save(found.where("mask = -1").groupBy(F.col("a").alias("rep")).agg(F.max("na").alias("n")), "sizes")
    out = ids.select("doc", "rep").join(sizes, "rep", "left")
    if links is None:
        out = out.withColumn("component", F.col("rep"))
    else:
        comps = scratch.save(connected_components(links, scratch), "components")
        out = out.join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    scratch.drop("members", "edges", "candidates")
    return out.select(
        F.col("doc").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"),
        F.when(F.col("n").isNull(), F.col("doc")).otherwise(F.coalesce("component", "rep")).alias("component_id"))


def _posting_batch(keys, docs, sizes) -> pa.RecordBatch:
    return pa.record_batch([pa.array(as_long(np.concatenate(keys))), pa.array(np.concatenate(docs)),
                            pa.array(np.concatenate(sizes))], ["key", "doc", "n"])


def _edge_batch(a, b, na, nb, mask) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.asarray(a, np.int64)), pa.array(np.asarray(b, np.int64)),
                            pa.array(np.asarray(na, np.int32)), pa.array(np.asarray(nb, np.int32)),
                            pa.array(np.asarray(mask, np.int32))], ["a", "b", "na", "nb", "mask"])


def keep_one_per_group(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the near copies: of each component the row whose id is
    the component's.  Rows with a null id stay; repeated rows of a kept id all
    stay (they are one document)."""
    comps = ngram_components(docs, words, num, den, id_col=id_col, text_col=text_col)
    gone = comps.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone_id")).distinct()
    gone = Scratch(docs.sparkSession, "ngram-gone").save(gone, "ids")
    return docs.join(broadcast_if_small(gone), docs[id_col].cast("long") == F.col("_gone_id"), "left_anti")
