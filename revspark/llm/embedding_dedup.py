"""Operator 3: embedding near-dedup by PCA-ordered tiled comparison.

Equal vectors fold into one first.  Unit vectors are turned into the basis
of their second moments, so the leading coordinates carry most of a dot
product.  Vectors whose first coordinates differ by more than
``sqrt(2 - 2 t)`` can't have cosine t, so the line of first coordinates is
cut into cells of that width and only a cell and its neighbours meet, in
tiles of blocks.  In a tile the dot product grows by groups of dimensions; a
pair drops out once what it has plus the product of the two suffix norms is
below the threshold.  What is left gets its cosine in double precision from
the original components.  A tile returns link counts and a spanning forest,
not pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import Scratch, broadcast_if_small

TILE_ROWS = 4096
SLACK = 1e-9            # far above the rounding of unit vectors


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row; scaled first so that squares neither overflow nor vanish."""
    x, y = x / np.abs(x).max(1, keepdims=True), y / np.abs(y).max(1, keepdims=True)
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))


def _matrix(column) -> np.ndarray:
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return a.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(a), -1)


def tile_pairs(x: np.ndarray, y: np.ndarray, basis: np.ndarray, t: float, lead: int):
    """Yields index arrays (i, j) with cosine(x[i], y[j]) >= t."""
    u, v = unit(x) @ basis, unit(y) @ basis
    d = u.shape[1]
    cuts = sorted({min(d, lead), min(d, 2 * lead), min(d, 4 * lead), d})
    tail = [[np.sqrt((a[:, c:] ** 2).sum(1)) for a in (u, v)] for c in cuts]
    m = cuts[0]
    right = np.concatenate([v[:, :m], tail[0][1][:, None]], 1).T
    for s in range(0, len(u), 512):
        # the suffix norms ride along as one more dimension: the product is the bound
        bound = np.concatenate([u[s:s + 512, :m], tail[0][0][s:s + 512, None]], 1) @ right
        i, j = np.nonzero(bound >= t - SLACK)
        i += s
        for k in range(0, len(i), 1 << 16):
            a, b = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
            have = (u[a, :m] * v[b, :m]).sum(1)
            for c, after, (p, q) in zip(cuts, cuts[1:], tail[1:]):
                have += (u[a, c:after] * v[b, c:after]).sum(1)
                ok = have + p[a] * q[b] >= t - SLACK
                a, b, have = a[ok], b[ok], have[ok]
            ok = cosine(x[a], y[b]) >= t
            yield a[ok], b[ok]


def cosine_components(vectors: DataFrame, threshold: float = 0.95, lead: int = 8, tile_rows: int = TILE_ROWS,
                      id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links`` (other vectors with
    cosine >= threshold), ``component_id`` (smallest id reachable by links) and
    ``kept`` (it is its component's id).

    All vectors of a length meet, whatever their labels; vectors of different
    length never link.  Null, empty or zero vectors, those with a null or
    non-finite component, and rows with a null id link with nothing; such a
    row is its own component (null for a null id, and not kept).  Copies and
    repeated rows are vectors of their own and link with each other; rows that
    share an id pool their links.  Other columns are ignored; an empty table
    gives no rows.  Meant for up to about a thousand dimensions: the basis
    takes their square on the driver."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embedding-dedup")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    fine = (F.col("id").isNotNull() & (F.size("vec") > 0)
            & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
            & F.exists("vec", lambda x: x != 0))
    rows = rows.withColumn("vec", F.when(F.coalesce(fine, F.lit(False)), F.col("vec")))
    unique = scratch.save(rows.where("vec is not null").groupBy("vec").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")).withColumn("dim", F.size("vec")), "unique")

    def moments(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims):
                u = unit(_matrix(b.column("vec").filter(pa.array(dims == d))))
                sums[d] = sums.get(d, 0) + u.T @ u
        for d, m in sums.items():
            i, j = np.triu_indices(d)
            yield pa.record_batch([pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)),
                                   pa.array(j.astype(np.int32)), pa.array(m[i, j])], ["dim", "i", "j", "v"])

    got = (unique.mapInArrow(moments, "dim int, i int, j int, v double").groupBy("dim", "i", "j")
           .agg(F.sum("v").alias("v")).toArrow())           # dimensions squared
    dims, i, j, v = (got[c].to_numpy() for c in ("dim", "i", "j", "v"))
    basis = {}
    for d in np.unique(dims):
        m, at = np.zeros((d, d)), dims == d
        m[i[at], j[at]] = m[j[at], i[at]] = v[at]
        basis[int(d)] = np.linalg.eigh(m)[1][:, ::-1].copy()
    if not basis:
        return _result(rows, None, None, unique, id_col)
    width = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    shared = spark.sparkContext.broadcast(basis)

    def cells(batches):
        for b in batches:
            dims, cell = b.column("dim").to_numpy(), np.zeros(b.num_rows, np.int32)
            for d in np.unique(dims):
                u = unit(_matrix(b.column("vec").filter(pa.array(dims == d))))
                cell[dims == d] = np.floor((u @ shared.value[d][:, 0]) / width)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], names=[*b.schema.names, "cell"])

    placed = scratch.save(unique.mapInArrow(cells, "vec array<double>, rep long, n long, dim int, cell int"), "placed")
    # first coordinates lie in [-1, 1]: at most 2 / width + 2 cells per dimension
    size = placed.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("blocks"))
    after = size.select("dim", (F.col("cell") - 1).alias("cell"), F.col("blocks").alias("next"))
    before = size.select("dim", (F.col("cell") + 1).alias("cell"), F.col("blocks").alias("prev"))
    size = scratch.save(size.join(after, ["dim", "cell"], "left").join(before, ["dim", "cell"], "left")
                        .fillna(0, ["next", "prev"]), "cells")
    own = F.pmod(F.xxhash64("rep", "vec"), F.col("blocks")).cast("int")

    def tile(c, b, c2, b2):
        return F.struct(c.alias("c"), b.alias("b"), c2.alias("c2"), b2.alias("b2"))

    def up_to(n):
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    c, own_ = F.col("cell"), F.col("block")
    tiles = F.concat(
        F.transform(up_to(F.col("blocks")), lambda o: tile(c, F.least(own_, o), c, F.greatest(own_, o))),
        F.transform(up_to(F.col("next")), lambda o: tile(c, own_, c + 1, o)),
        F.transform(up_to(F.col("prev")), lambda o: tile(c - 1, o, c, own_)))
    # a row per vector and block it meets
    spread = (placed.join(broadcast_if_small(size), ["dim", "cell"]).withColumn("block", own)
              .select("rep", "n", "vec", "dim", "cell", "block", F.explode(tiles).alias("t"))
              .select("rep", "n", "vec", "dim", "cell", "block", "t.*"))

    def compare(key, t):
        dim, c, b, c2, b2 = (k.as_py() for k in key)
        cell, block, x = t["cell"].to_numpy(), t["block"].to_numpy(), _matrix(t["vec"])
        ids, times = t["rep"].to_numpy(), t["n"].to_numpy()
        left = np.flatnonzero((cell == c) & (block == b))
        same = (c, b) == (c2, b2)
        right = left if same else np.flatnonzero((cell == c2) & (block == b2))
        links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for i, j in tile_pairs(x[left], x[right], shared.value[dim], threshold, lead) if len(left) and len(right) else ():
            i, j = left[i], right[j]
            if same:
                i, j = i[i != j], j[i != j]
            links += np.bincount(i, times[j], len(ids)).astype(np.int64)
            if not same:
                links += np.bincount(j, times[i], len(ids)).astype(np.int64)
            while True:                      # smallest label of each linked group
                low = np.minimum(label[i], label[j])
                if (label[i] == label[j]).all():
                    break
                np.minimum.at(label, label[i], low)
                np.minimum.at(label, label[j], low)
                np.minimum.at(label, i, low)
                np.minimum.at(label, j, low)
                while (label[label] != label).any():
                    label = label[label]
        hit = np.flatnonzero(links)
        return pa.table({"a": pa.array(ids[label[hit]]), "b": pa.array(ids[hit]), "links": pa.array(links[hit])})

    found = scratch.save(spread.groupBy("dim", "c", "b", "c2", "b2").applyInArrow(compare, "a long, b long, links long"), "found")
    return _result(rows, found, connected_components(found, scratch), unique, id_col)


def _result(rows: DataFrame, found: DataFrame | None, comps: DataFrame | None, unique: DataFrame, id_col: str) -> DataFrame:
    out = rows.join(unique.select(F.col("vec"), "rep", F.col("n").alias("copies")), "vec", "left")
    if found is None:
        out = out.withColumn("links", F.lit(0)).withColumn("component", F.col("rep"))
    else:
        sums = found.groupBy(F.col("b").alias("rep")).agg(F.sum("links").alias("links"))
        out = out.join(sums, "rep", "left").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    comp = F.coalesce("component", "rep", "id")
    return out.select(F.col("id").alias(id_col),
                      (F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
                      comp.alias("component_id"), F.coalesce(F.col("id") == comp, F.lit(False)).alias("kept"))
