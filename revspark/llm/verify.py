"""Candidate pairs -> exact links, without ever listing a group's pairs.

``BucketEdges`` turns sorted postings into candidate edges: all pairs of a
bucket of at most ``PAIR_CAP`` members, a star for a larger one.  The
candidate graph's components bound where links can be, so ``verified_links``
sends each member's set once per tile of its component and compares a tile's
sets with one another exactly.  A tile returns a spanning forest of its
links, never the pairs.  A component of more than a tile is first split by
``sharper``: weak candidates glue sets together that no link joins, the more
the larger the corpus, and tiles cost its square.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import frequency as Q
from .components import connected_components
from .scratch import Bitmap, Scratch, bitmap_bits, broadcast_if_small
from .shingles import as_long, mix
from .workers import few_rows, give_back, lean

PAIR_CAP = 32
TILE_TOKENS = 1 << 18
TILE_ITEMS = 1024
TILE_CELLS = 1 << 18      # pairs of a tile's rare tokens that are counted at once
BIN_TOKENS = 1 << 16      # components of at most a sixteenth of this share a group: most are two or three sets
LARGE = 1 << 20           # bytes of a tile after which a worker gives memory back
SHARP_LEVELS = [1 << k for k in range(24)]      # counts in large components at which a token gets less rare
SHARP_SLOT_BITS = 22      # 4 MB table of levels
SHARP_ORDERS = 2


def prefix_length(n: int, num: int, den: int) -> int:
    return n - -(-num * n // den) + 1


def prefix(tokens: np.ndarray, level: np.ndarray, order: int, num: int, den: int) -> np.ndarray:
    """The first tokens of a set under one order: by level, then by a hash."""
    p = prefix_length(len(tokens), num, den)
    salt = np.uint64((0x9E3779B97F4A7C15 * (order + 1)) % 2**64)
    rank = (level.astype(np.uint64) << np.uint64(58)) | (mix(tokens ^ salt) >> np.uint64(6))
    return tokens if p >= len(tokens) else tokens[np.argpartition(rank, p - 1)[:p]]


class BucketEdges:
    """Streams ``(key, id, n)`` sorted by key, id and n into candidate edges.

    Rows of one id with different n are members of their own; their edge to
    each other, an id to itself, is none.
    Holds the rows of one batch plus at most ``PAIR_CAP`` members of the
    bucket that the batch breaks off in, however large the bucket is."""

    def __init__(self):
        self.key = self.ids = self.n = None
        self.star = False      # the held bucket is past PAIR_CAP: only its first member is held

    def feed(self, key: np.ndarray, ids: np.ndarray, n: np.ndarray, last: bool = False):
        """Edges ``(a, b, na, nb, key, dense)`` of the buckets that end here."""
        if self.key is not None:
            key, ids, n = np.r_[self.key, key], np.r_[self.ids, ids], np.r_[self.n, n]
        star, self.key, self.star = self.star, None, False
        out = [[] for _ in range(6)]
        if len(key):
            new = np.r_[True, (key[1:] != key[:-1]) | (ids[1:] != ids[:-1]) | (n[1:] != n[:-1])]
            key, ids, n = key[new], ids[new], n[new]
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[start, len(key)])
            dense = size > PAIR_CAP
            dense[0] |= star
            if not last:
                at = start[-1]
                self.star = bool(dense[-1])
                stop = at + 1 if self.star else len(key)
                self.key, self.ids, self.n = key[at:stop].copy(), ids[at:stop].copy(), n[at:stop].copy()
                if not self.star:
                    start, size, dense = start[:-1], size[:-1], dense[:-1]
            for s in np.unique(size[~dense]):
                if s > 1:
                    i, j = np.triu_indices(s, 1)
                    at = start[(size == s) & ~dense]
                    self._add(out, key, ids, n, (at[:, None] + i).ravel(), (at[:, None] + j).ravel(), False)
            for s, m in zip(start[dense], size[dense]):
                if m > 1:
                    self._add(out, key, ids, n, np.full(m - 1, s), np.arange(s + 1, s + m), True)
        return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]

    @staticmethod
    def _add(out, key, ids, n, i, j, dense):
        two = ids[i] != ids[j]
        i, j = i[two], j[two]
        for o, x in zip(out, (ids[i], ids[j], n[i], n[j], key[i], np.full(len(i), dense))):
            o.append(x)


def set_batches(rows, names=("tokens",)):
    """Record batches ``(id, tokens)`` of about 4 MB from (id, hashes) pairs;
    with more ``names``, so many arrays of hashes an id."""
    ids, sets, held = [], [], 0
    for i, *s in rows:
        ids.append(i)
        sets.append([x.tobytes() for x in s])
        held += sum(x.nbytes for x in s)
        if held > 1 << 22:
            yield _set_batch(ids, sets, names)
            ids, sets, held = [], [], 0
    if ids:
        yield _set_batch(ids, sets, names)


def _set_batch(ids, sets, names) -> pa.RecordBatch:
    return pa.record_batch([pa.array(ids, pa.int64()), *(pa.array(x, pa.binary()) for x in zip(*sets))], ["id", *names])


def tile_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, num: int, den: int) -> np.ndarray:
    """Boolean matrix: which of ``left`` (positions in ``sets``) have a Jaccard
    of at least num/den with which of ``right``; exact integer arithmetic."""
    size = np.array([len(s) for s in sets], np.int64)
    if len(left) * len(right) <= 9:         # most components are a few sets
        pairs = {(min(i, j), max(i, j)) for i in left.tolist() for j in right.tolist() if i != j}
        common = {(i, j): len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in pairs}
        both = np.array([[common.get((min(i, j), max(i, j)), 0) for j in right.tolist()] for i in left.tolist()])
        return _reach(both, size, left, right, num, den)
    tokens, at, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), size)
    shared = df[at] > 1
    owner, at = owner[shared], at[shared]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    start = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, np.int64)
    width = np.diff(np.r_[start, len(at)])
    row = np.full(len(sets), -1)
    row[left] = np.arange(len(left))
    col = np.full(len(sets), -1)
    col[right] = np.arange(len(right))
    both = np.zeros(len(left) * len(right), np.float32)
    rare = 12 if len(sets) > 128 else 0
    for w in np.unique(width[width <= rare]):      # rare tokens of a large tile: their few pairs
        first, step = start[width == w], max(1, TILE_CELLS // int(w * w))
        for k in range(0, len(first), step):
            m = owner[first[k:k + step, None] + np.arange(w)]
            r, c = np.broadcast_arrays(row[m][:, :, None], col[m][:, None, :])
            ok = (r >= 0) & (c >= 0)
            both += np.bincount(r[ok] * len(right) + c[ok], minlength=len(both)).astype(np.float32)
    both = both.reshape(len(left), len(right))
    wide = np.flatnonzero(np.repeat(width > rare, width))
    nth = np.cumsum(width > rare) - 1
    column, owner = np.repeat(nth, width)[wide], owner[wide]
    for k in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):     # the others: 0/1 matrix products
        s, e = np.searchsorted(column, [k, k + 2048])
        m = np.zeros((len(sets), int(column[e - 1]) - k + 1), np.float32)
        m[owner[s:e], column[s:e] - k] = 1
        both += m[left] @ m[right].T
    return _reach(both.astype(np.int64), size, left, right, num, den)


def _reach(both: np.ndarray, size: np.ndarray, left: np.ndarray, right: np.ndarray, num: int, den: int) -> np.ndarray:
    ok = den * both >= num * (size[left][:, None] + size[right][None, :] - both)
    return ok & (left[:, None] != right[None, :])


def _incidence(sets: list[np.ndarray], which: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    x = np.concatenate([sets[i] for i in which])
    row = np.repeat(np.arange(len(which)), [len(sets[i]) for i in which])
    at = np.minimum(np.searchsorted(tokens, x), len(tokens) - 1)
    hit = tokens[at] == x
    m = np.zeros((len(which), len(tokens)), np.float32)
    m[row[hit], at[hit]] = 1
    return m


def meets(parts: list[np.ndarray], sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Boolean matrix: whose part in ``left`` is empty or shares a token with
    which set in ``right``."""
    tokens = np.unique(np.concatenate([parts[i] for i in left]))
    both = np.zeros((len(left), len(right)), np.float32)
    for k in range(0, len(tokens), 2048):
        t = tokens[k:k + 2048]
        both += _incidence(parts, left, t) @ _incidence(sets, right, t).T
    return (both > 0) | np.array([not len(parts[i]) for i in left])[:, None]


def forest(ok: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Spanning edges of the graph on positions that ``ok`` describes."""
    edges, seen = [], set()
    rows = {p: i for i, p in enumerate(left)}
    cols = {p: i for i, p in enumerate(right)}
    for p in left[ok.any(1)]:
        if p in seen:
            continue
        seen.add(p)
        todo = [p]
        while todo:
            q = todo.pop()
            near = set()
            if q in rows:
                near.update(right[ok[rows[q]]])
            if q in cols:
                near.update(left[ok[:, cols[q]]])
            for x in near - seen:
                seen.add(x)
                edges.append((p, x))
                todo.append(x)
    return edges


def sharper(sets: DataFrame, num: int, den: int, scratch: Scratch, name: str) -> DataFrame:
    """Candidates ``(a, b)`` among ``sets (id, component, tokens)``, a written
    table: every pair of a component with Jaccard >= num/den (see
    ``ngram_join`` for why), and few others.

    Rare is what few of these sets hold, so a passage that brought a large
    component together brings nobody together here."""
    spark = sets.sparkSession
    bits = Q.part_bits(sets.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0)

    def all_tokens(batches):
        packer = Q.KeyPacker(bits)
        for b in few_rows(batches):
            for x in b.column("tokens").to_pylist():
                packer.add(np.frombuffer(x, np.uint64))
                if packer.full():
                    yield from packer.flush()
        yield from packer.flush()

    table = spark.sparkContext.broadcast(
        Q.levels(sets.select("tokens").mapInArrow(lean(all_tokens), Q.PACK_SCHEMA), bits, SHARP_LEVELS, SHARP_SLOT_BITS))

    def postings(batches):
        low = ~np.uint64(3)
        for b in few_rows(batches):
            salt = mix(b.column("component").to_numpy().view(np.uint64))     # a component has keys of its own
            keys, counts, sizes = [], [], []
            for x, c in zip(b.column("tokens").to_pylist(), salt):
                s = np.frombuffer(x, np.uint64)
                level = Q.lookup(table.value, s, SHARP_SLOT_BITS)
                got = [mix(prefix(s, level, o, num, den) ^ c) & low | np.uint64(o) for o in range(SHARP_ORDERS)]
                keys += got
                counts.append(sum(map(len, got)))
                sizes.append(len(s))
            if keys:
                yield pa.record_batch([pa.array(as_long(np.concatenate(keys))),
                                       pa.array(np.repeat(b.column("id").to_numpy(), counts)),
                                       pa.array(np.repeat(np.array(sizes, np.int32), counts))], ["key", "id", "n"])

    def edges(batches):
        buckets = BucketEdges()

        def out(key, ids, n, last=False):
            a, b, na, nb, k, dense = buckets.feed(key, ids, n, last)
            mask = np.where(dense, (1 << SHARP_ORDERS) - 1, 1 << (k & 3)).astype(np.int32)
            ok = (den * np.minimum(na, nb) >= num * np.maximum(na, nb)) | dense.astype(bool)
            return pa.record_batch([pa.array(x[ok]) for x in (a, b, mask)], ["a", "b", "mask"])

        for t in batches:
            yield out(*(t.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
        z = np.zeros(0, np.int64)
        yield out(z, z, z.astype(np.int32), True)

    found = scratch.save(sets.select("id", "component", "tokens").mapInArrow(lean(postings), "key long, id long, n int")
                         .repartition("key").sortWithinPartitions("key", "id", "n")
                         .mapInArrow(lean(edges), "a long, b long, mask int"), f"{name}-sharp-edges")
    table.unpersist()
    return found.groupBy("a", "b").agg(F.bit_or("mask").alias("mask")).where(
        F.col("mask") == (1 << SHARP_ORDERS) - 1).select("a", "b")


def _members(nodes: DataFrame) -> DataFrame:
    """``nodes (node, component, n)`` with the blocks of their components."""
    blocks = nodes.groupBy("component").agg(
        F.ceil(F.greatest(F.sum("n") / TILE_TOKENS, F.count(F.lit(1)) / TILE_ITEMS)).cast("int").alias("blocks"),
        ((F.sum("n") <= BIN_TOKENS // 16) & (F.count(F.lit(1)) <= TILE_ITEMS)).alias("small"))
    return nodes.join(blocks, "component").select(
        F.col("node").alias("id"), "component", "blocks", "small", "n",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))


def verified_links(candidates: DataFrame, sets_of: Callable[[Bitmap], DataFrame], num: int, den: int,
                   scratch: Scratch, name: str = "links") -> DataFrame | None:
    """Links ``(a, b)`` whose components equal those of all pairs with Jaccard
    >= num/den among the components of ``candidates (a, b, na, nb)``.

    ``sets_of(bitmap)`` gives ``(id, tokens binary)`` (packed distinct 64-bit
    hashes) of a superset of the ids in the bitmap.  Any more columns are
    parts of a set (or empty) that must share a token with the other set of a
    link, both ways.  None: no candidates."""
    comps = scratch.save(connected_components(candidates, scratch, f"{name}-cand"), f"{name}-comps")
    sizes = (candidates.select(F.col("a").alias("node"), F.col("na").alias("n"))
             .union(candidates.select("b", "nb")).groupBy("node").agg(F.max("n").alias("n")))
    members = scratch.save(_members(comps.join(sizes, "node")), f"{name}-members")
    large = members.where("blocks > 1")
    if n := large.count():
        mine = large.select("id", "component")
        sets_ = scratch.save(sets_of(Bitmap(large, "id", bits=bitmap_bits(n))).select("id", "tokens")
                             .join(broadcast_if_small(mine), "id"), f"{name}-large")
        again = connected_components(sharper(sets_, num, den, scratch, name), scratch, f"{name}-sharp")
        members = scratch.save(members.where("blocks = 1").unionByName(
            _members(again.join(large.select(F.col("id").alias("node"), "n"), "node"))), f"{name}-sharp-members")
        scratch.drop(f"{name}-large", f"{name}-sharp-edges", f"{name}-members")
    scratch.drop(f"{name}-comps")
    ids = Bitmap(members, "id", bits=bitmap_bits(members.count()))
    if not ids.any():
        return None
    bins = -(-(members.where("small").agg(F.sum("n")).first()[0] or 1) // BIN_TOKENS)
    # a group of its own costs more than comparing a few sets: small components are dealt into bins
    members = members.select("id", "component", "blocks", "block",
                             F.when(F.col("small"), F.pmod(F.xxhash64("component"), F.lit(bins))).otherwise(F.lit(-1)).alias("bin"),
                             F.when(~F.col("small"), F.col("component")).alias("alone"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    # one row per set and tile of its component: sets x blocks, not pairs
    sets_ = sets_of(ids)
    parts = sets_.columns[2:]
    tiles = (sets_.join(broadcast_if_small(members), "id")
             .select("id", "tokens", *parts, "component", "block", "bin", "alone", other)
             .select("id", "tokens", *parts, "component", "block", "bin", "alone",
                     F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")))

    def compare(key, t):
        lo, hi = (k.as_py() for k in key[2:])
        ids, block, component = t["id"].to_pylist(), t["block"].to_numpy(), t["component"].to_numpy()
        all_sets = [np.frombuffer(x, np.uint64) for x in t["tokens"].to_pylist()]
        order = np.argsort(component, kind="stable")
        edges = []
        for own in np.split(order, np.flatnonzero(np.diff(component[order])) + 1):
            sets = [all_sets[i] for i in own]
            left, right = np.flatnonzero(block[own] == lo), np.flatnonzero(block[own] == hi)
            if len(left) and len(right):
                ok = tile_links(sets, left, right, num, den)
                for p in parts if ok.any() else ():
                    part = [np.frombuffer(t[p][i].as_py(), np.uint64) for i in own.tolist()]
                    ok &= meets(part, sets, left, right) & meets(part, sets, right, left).T
                edges += [(ids[own[i]], ids[own[j]]) for i, j in forest(ok, left, right)] if ok.any() else []
        if t.nbytes > LARGE:
            give_back()
        return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()),
                         "b": pa.array([b for _, b in edges], pa.int64())})

    return tiles.groupBy("bin", "alone", "lo", "hi").applyInArrow(compare, "a long, b long")
