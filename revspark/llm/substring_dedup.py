"""Operator 9: substring dedup by paragraph MinHash banding.

Paragraphs are of two kinds.  *Lines* of at least ``min_words`` words, and
consecutive shorter lines joined up to ``min_words`` and twice that, are
banded by MinHash; lines that collide in a band are verified by the exact
Jaccard of their word shingles, and components of verified links keep one
line.  Joined lines start at content-defined lines, so that copies align, and
link only if one of the first and one of the last ``k + 1`` shingles is in the
other too: more than ``k`` words of its own at an edge are never cut.  A
passage inside a longer line can't reach that Jaccard, so *windows*
of ``min_words`` words, at content-defined starts, are paragraphs too; their
one band is the whole window (an exact repeat).  Starts are the minima of
``gap`` consecutive positions, plus both ends of the text and of each long
line, so any repeated run of ``min_words + gap`` words holds a window that
its other copies hold as well.

Both kinds drop every copy outside the document that holds the first one.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import frequency as Q
from .components import connected_components
from .scratch import Bitmap, Scratch, bitmap_bits, slots_set
from .shingles import _ODD, as_long, hash_slices, mix, shingles
from .verify import BucketEdges, set_batches, verified_links
from .workers import few_rows, lean

SLOT_BITS = 27                  # 16 MB: one bit per slot, "this key occurs twice or more"
WINDOW, LINE, BAND, GONE = 0, 1, 2, 3    # low bits of a posting's key
PAIRED_BITS = 1 << 26           # 8 MB: lines of candidate pairs
FLUSH = 200_000                 # postings a task holds before it thins and sends them
BANDS, ROWS = 8, 2              # P(collision | Jaccard 0.8) = 1 - (1 - 0.8**2)**8 = 0.9997
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MUL2 = np.uint64(0xD1342543DE82EF95)


class Powers:
    """Powers of an odd constant and of its inverse modulo 2**64."""

    def __init__(self, mul: np.uint64):
        self.mul, self.inv, self.n = int(mul), pow(int(mul), -1, 2**64), 0

    def upto(self, n: int):
        if n > self.n:
            self.n = max(n, 2 * self.n, 4096)
            self.up = np.multiply.accumulate(np.full(self.n, self.mul, np.uint64))
            self.down = np.multiply.accumulate(np.full(self.n, self.inv, np.uint64))
        return self.up[:n], self.down[:n]


def window_hashes(h: np.ndarray, at: np.ndarray, width: int, powers: Powers) -> np.ndarray:
    up, down = powers.upto(len(h))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up, dtype=np.uint64)])
    return mix((sums[at + width] - sums[at]) * down[at])


def _slide(f, x: np.ndarray, w: int) -> np.ndarray:
    """f over each window of ``w`` values, by doubling."""
    n, have = len(x) - w + 1, 1
    while have < w:
        step = min(have, w - have)
        x = f(x[:len(x) - step], x[step:])
        have += step
    return x[:n]


class Group:
    """The words of a few texts in one array, so that numpy calls are shared."""

    def __init__(self, texts: list[str | None]):
        lower = [(t or "").encode("utf-8", "replace").lower() for t in texts]
        data = b"\n".join([*lower, b""])             # so that each line of each text ends at a line feed
        x = np.frombuffer(data, np.uint8)
        gap = np.r_[True, (x == 32) | (x - np.uint8(9) < 5)]       # white space of bytes.split; one before the first word
        turn = np.flatnonzero(gap[1:] != gap[:-1])
        begin, end = turn[::2], turn[1::2]
        self.h = hash_slices(data, begin, end)
        feed = np.flatnonzero(x == 10)
        last = np.searchsorted(feed, np.cumsum([len(t) + 1 for t in lower]) - 1)    # each text's last line
        self.ends = np.searchsorted(begin, feed)                      # the word index at which each line ends
        self.begins = np.r_[0, self.ends[:-1]]
        self.edge = np.r_[0, self.ends[last]]                         # text i holds words edge[i]..edge[i + 1]
        self.line_text = np.repeat(np.arange(len(texts)), np.diff(np.r_[-1, last]))

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edge, at, "right") - 1


def window_starts(group: Group, width: int, gap: int) -> np.ndarray:
    h, size = group.h, np.diff(group.edge)
    room = np.repeat(group.edge[1:], size) - np.arange(len(h)) >= width     # the window ends inside its text
    top = np.uint64(2**64 - 1)
    g = np.where(room, mix(h * _ODD[0] + np.r_[h[1:], h[:1]] * _ODD[1]), top)
    fill = np.full(gap - 1, top)
    low = _slide(np.minimum, np.concatenate([fill, g, fill]), gap)
    pick = g == _slide(np.maximum, low, gap)
    long = group.ends - group.begins >= width
    pick[group.begins[long]] = True
    pick[group.ends[long] - width] = True
    whole = size >= width
    pick[group.edge[:-1][whole]] = True
    pick[group.edge[1:][whole] - width] = True
    return np.flatnonzero(pick & room)


def joined_lines(group: Group, width: int, gap: int):
    """start, stop of consecutive lines of fewer than ``width`` words, joined
    up to ``width`` and ``2 * width``.

    They start at the first of such a run of lines and at lines whose hash is
    the least of those that begin within ``gap`` words (all, if lines have
    ``gap`` words or more); the last ones of a run also stop at its end."""
    h, begins, ends = group.h, group.begins, group.ends
    short = ends - begins < width
    same = short[1:] & short[:-1] & (group.line_text[1:] == group.line_text[:-1])
    first, last = np.flatnonzero(short & ~np.r_[False, same]), np.flatnonzero(short & ~np.r_[same, False])
    if not len(first) or (ends[last] - begins[first]).max() < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(short & (ends > begins))
    g = np.full(len(h), 2**64 - 1, np.uint64)
    b = begins[at]
    g[b] = mix(h[b] * _ODD[0] + h[(b + 1) % len(h)] * _ODD[1])
    fill = np.full(gap - 1, 2**64 - 1, np.uint64)
    pick = g == _slide(np.maximum, _slide(np.minimum, np.concatenate([fill, g, fill]), gap), gap)
    run = np.searchsorted(first, at, "right") - 1
    picked = pick[b] | (b == begins[first][run])
    b, stop = b[picked], ends[last][run[picked]]
    starts, stops = [], []
    for w in (width, 2 * width):
        fits = stop - b >= w
        starts.append(b[fits])
        stops.append(ends[np.searchsorted(ends, b[fits] + w)])
        fits = ends[last] - begins[first] >= w
        starts.append(begins[np.searchsorted(begins, ends[last][fits] - w, "right") - 1])
        stops.append(ends[last][fits])
    both = np.unique(np.stack([np.concatenate(starts), np.concatenate(stops)], 1), axis=0)
    return both[:, 0], both[:, 1]


class Units:
    """Paragraph keys of a group of texts."""

    def __init__(self, min_words: int, gap: int, k: int):
        self.min_words, self.gap, self.k = min_words, gap, k
        self.powers, self.powers2 = Powers(_MUL), Powers(_MUL2)
        rng = np.random.default_rng(7)
        self.mul = rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)

    def group(self, texts) -> Group:
        return Group(texts)

    def windows(self, group: Group):
        """start, key"""
        at = window_starts(group, self.min_words, self.gap)
        return at, window_hashes(group.h, at, self.min_words, self.powers) & ~np.uint64(3)

    def second(self, group: Group, at: np.ndarray):
        """Another hash of the windows, so that equal means equal in 126 bits."""
        return window_hashes(group.h, at, self.min_words, self.powers2)

    def lines(self, group: Group):
        """start, stop, content hash (odd if joined) of the long and the joined lines"""
        long = group.ends - group.begins >= self.min_words
        s, e = (np.concatenate(x) for x in zip((group.begins[long], group.ends[long]),
                                               joined_lines(group, self.min_words, self.gap)))
        order = np.argsort(s, kind="stable")
        joined = (order >= long.sum()).astype(np.uint64)
        s, e = s[order], e[order]
        up, down = self.powers.upto(len(group.h) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(group.h * up[:-1], dtype=np.uint64)])
        return s, e, mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)) & ~np.uint64(1) | joined

    def bands(self, group: Group, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Band keys, lines x BANDS"""
        band = np.zeros((len(s), BANDS), np.uint64)
        if len(s):
            sh = np.r_[shingles(group.h, self.k), np.uint64(0)]   # so that a line may end at the last word
            cuts = np.stack([s, e - self.k + 1], 1).ravel()       # even slices are the lines' own shingles
            for i in range(BANDS * ROWS):
                low = np.minimum.reduceat(sh * self.mul[i] + self.add[i], cuts)[::2]
                band[:, i // ROWS] = mix(band[:, i // ROWS] * _MUL + low + np.uint64(i // ROWS + 1))
        return band & ~np.uint64(3) | np.uint64(BAND)

    def line_sets(self, group: Group, lines):
        """For each (start, stop, joined): distinct shingles; those at the start and at the end of joined lines"""
        all_ = shingles(group.h, self.k) if lines else None
        for s, e, joined in lines:
            sh = all_[s:e - self.k + 1] if e - s >= self.k else shingles(group.h[s:e], self.k)
            edge = self.k + 1 if joined else 0
            distinct = np.sort(sh)
            yield distinct[np.r_[True, distinct[1:] != distinct[:-1]]], sh[:edge], sh[len(sh) - edge:]


def _groups(batches, names):
    """Columns ``names`` as lists, a few rows at a time."""
    for b in batches:
        for i in range(0, b.num_rows, 64):
            part = b.slice(i, 64)
            yield [part.column(c).to_pylist() for c in names]


def _batch(names, *columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c) for c in columns], names)


POSTING = ["key", "item", "doc", "th", "start", "stop"]
FOUND = ["kind", "a", "b", "doc", "th", "start", "stop"]


def _concat(parts, dtypes):
    return [np.concatenate([p[i] for p in parts]).astype(t, copy=False) if parts else np.zeros(0, t)
            for i, t in enumerate(dtypes)]


_POSTING_TYPES = (np.int64, np.int64, np.int64, np.int32, np.int32, np.int32)


class FirstCopies:
    """Streams window postings sorted by key, item, doc: the rows that lie
    outside the document of the first copy.  Holds that document only."""

    def __init__(self):
        self.last = None      # key, item, doc of the first copy in the run that a batch broke off in

    def feed(self, key, item, doc):
        if not len(key):
            return np.zeros(0, bool)
        new = np.r_[True, (key[1:] != key[:-1]) | (item[1:] != item[:-1])]
        at = np.flatnonzero(new)
        first = np.repeat(doc[at], np.diff(np.r_[at, len(key)]))
        if self.last is not None and (key[0], item[0]) == self.last[:2]:
            first[:at[1] if len(at) > 1 else len(key)] = self.last[2]
        self.last = (key[-1], item[-1], first[-1])
        return doc != first


def thin(key, item, doc, th, start, stop):
    """Postings of a task before they are sent, so that a key that a third of
    all documents hold is not one task's load: of the copies of a window only
    those of the smallest document here go to the window's key, as the others
    lie outside the document of its first copy in any case (``GONE``); lines,
    which nothing groups here, and ``GONE`` rows are dealt evenly; a line's bands go once."""
    kind = key & 3
    rest = np.flatnonzero(kind == LINE)
    b = np.flatnonzero(kind == BAND)
    b = b[np.lexsort((item[b], key[b]))]
    b = b[np.r_[True, (key[b][1:] != key[b][:-1]) | (item[b][1:] != item[b][:-1])]] if len(b) else b
    w = np.flatnonzero(kind == WINDOW)
    w = w[np.lexsort((doc[w], item[w], key[w]))]
    gone = FirstCopies().feed(key[w], item[w], doc[w])
    key = key.copy()
    for at, as_kind in ((rest, LINE), (w[gone], GONE)):
        key[at] = as_long(mix(doc[at].view(np.uint64) * _MUL + item[at].view(np.uint64)) & ~np.uint64(3) | np.uint64(as_kind))
    at = np.concatenate([w, b, rest])
    return key[at], item[at], doc[at], th[at], start[at], stop[at]


def repeated_spans(docs: DataFrame, scratch: Scratch, min_words: int, gap: int, k: int, num: int, den: int) -> DataFrame:
    """``(doc, th, spans array<long>)``: word spans (start << 32 | stop) to drop.
    ``docs`` has ``doc``, ``txt`` and ``th``, a hash of the text."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("txt"))).first()[0] or 0
    bits = Q.part_bits(total)
    texts = docs.where("doc is not null and txt is not null").select("doc", "th", "txt")

    def keys(batches):
        units, packer = Units(min_words, gap, k), Q.KeyPacker(bits)
        for (text,) in _groups(batches, ["txt"]):
            g = units.group(text)
            packer.add(units.windows(g)[1])
            packer.add(units.bands(g, *units.lines(g)[:2]).ravel())
            if packer.full():
                yield from packer.flush()
        yield from packer.flush()

    twice = spark.sparkContext.broadcast(Q.levels(texts.mapInArrow(lean(keys), Q.PACK_SCHEMA), bits, [1], SLOT_BITS))

    def postings(batches):
        units, parts, held = Units(min_words, gap, k), [], 0
        for doc, th, text in _groups(batches, ["doc", "th", "txt"]):
            g = units.group(text)
            doc, th = np.array(doc, np.int64), np.array(th, np.int32)
            at, key = units.windows(g)
            hit = Q.lookup(twice.value, key, SLOT_BITS) > 0
            at = at[hit]
            got = [(as_long(key[hit]), as_long(units.second(g, at)), at, at + min_words)]
            s, e, item = units.lines(g)
            band = units.bands(g, s, e)
            hit = Q.lookup(twice.value, band.ravel(), SLOT_BITS).reshape(band.shape) > 0
            some = hit.any(1)
            got.append((as_long(item[some] & ~np.uint64(3) | np.uint64(LINE)), as_long(item[some]), s[some], e[some]))
            r, c = np.nonzero(hit)
            got.append((as_long(band[r, c]), as_long(item[r]), s[r], e[r]))
            for key, item, s, e in got:
                i = g.text_of(s)
                parts.append((key, item, doc[i], th[i], s - g.edge[i], e - g.edge[i]))
                held += len(key)
            if held > FLUSH:
                yield _batch(POSTING, *thin(*_concat(parts, _POSTING_TYPES)))
                parts, held = [], 0
        yield _batch(POSTING, *thin(*_concat(parts, _POSTING_TYPES)))

    posted = texts.mapInArrow(lean(postings), "key long, item long, doc long, th int, start int, stop int")

    def group(batches):
        first, bands = FirstCopies(), BucketEdges()

        def out(kind, a, b, doc, th, start, stop):
            n = len(a)
            full = lambda x, t: np.asarray(x, t) if np.ndim(x) else np.full(n, x, t)
            return _batch(FOUND, full(kind, np.int32), full(a, np.int64), full(b, np.int64), full(doc, np.int64),
                          full(th, np.int32), full(start, np.int32), full(stop, np.int32))

        def edges(key, item, n, last=False):
            a, b, na, nb, _, _ = bands.feed(key, item, n, last)
            return out(BAND, a, b, 0, 0, na, nb)

        for t in batches:
            key, item, doc, th, s, e = (t.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            kind = key & 3
            w = kind == WINDOW
            again = np.flatnonzero(w)[first.feed(key[w], item[w], doc[w])]
            for again in (again, np.flatnonzero(kind == GONE)):
                yield out(WINDOW, key[again], item[again], doc[again], th[again], s[again], e[again])
            x = kind == LINE
            yield out(LINE, item[x], 0, doc[x], th[x], s[x], e[x])
            x = kind == BAND
            yield edges(key[x], item[x], (e - s)[x])
        z = np.zeros(0, np.int64)
        yield edges(z, z, z, True)

    found = scratch.save(posted.repartition("key").sortWithinPartitions("key", "item", "doc", "start")
                         .mapInArrow(lean(group), "kind int, a long, b long, doc long, th int, start int, stop int"), "found")
    twice.destroy()     # the written rows are all that is read of it

    candidates = scratch.save(found.where(F.col("kind") == BAND).groupBy("a", "b")
                              .agg(F.max("start").alias("na"), F.max("stop").alias("nb")), "candidates")
    lines = found.where(F.col("kind") == LINE).select(F.col("a").alias("node"), "doc", "th", "start", "stop")

    # only lines of a candidate pair need a set: the others' are neither built nor sent
    paired = Bitmap(candidates.select(F.col("a").alias("node")).union(candidates.select("b")), "node", bits=PAIRED_BITS)
    in_pair = spark.sparkContext.broadcast(paired.words)

    def sets_of(wanted: Bitmap) -> DataFrame:
        # a line's set comes from the smallest document that holds it, so texts of copies aren't split again
        holders = Bitmap(lines.where(wanted.has("node")).groupBy("node").agg(F.min("doc").alias("doc")), "doc", bits=wanted.bits)

        def sets(batches):
            units, done = Units(min_words, gap, k), set()

            def each():
                for (text,) in _groups(batches, ["txt"]):
                    g = units.group(text)
                    s, e, item = units.lines(g)
                    at = np.flatnonzero(slots_set(in_pair.value, as_long(item)))
                    mine = {}
                    for i, x, y in zip(as_long(item[at]).tolist(), s[at].tolist(), e[at].tolist()):
                        if i not in done:       # copies of a line within a task
                            done.add(i) if len(done) < 100_000 else done.clear()
                            mine[i] = x, y, i & 1
                    for i, sets in zip(mine, units.line_sets(g, mine.values())):
                        yield i, *sets
            return set_batches(each(), ("tokens", "head", "tail"))

        got = texts.where(holders.has("doc")).mapInArrow(lean(sets), "id long, tokens binary, head binary, tail binary")
        return got.where(wanted.has("id")).groupBy("id").agg(*(F.first(c).alias(c) for c in got.columns[1:]))

    links = verified_links(candidates, sets_of, num, den, scratch)
    if links is not None:
        comps = scratch.save(connected_components(links, scratch), "components")
        in_pair.destroy()
        lines = lines.join(comps, "node", "left").withColumn("node", F.coalesce("component", "node"))
    keep = lines.groupBy("node").agg(F.min("doc").alias("keep"), F.max("doc").alias("far")).where("keep < far")
    again = lines.join(keep, "node").where("doc <> keep")
    span = F.shiftleft(F.col("start").cast("long"), 32).bitwiseOR(F.col("stop").cast("long"))
    gone = found.where(F.col("kind") == WINDOW).select("doc", "th", span.alias("span")).union(
        again.select("doc", "th", span.alias("span")))
    spans = scratch.save(gone.groupBy("doc", "th").agg(F.collect_set("span").alias("spans")), "spans")
    scratch.drop("found", "candidates", "components")
    return spans


def merge(spans) -> list[list[int]]:
    """Sorted disjoint [start, stop) word spans."""
    out: list[list[int]] = []
    for s, e in sorted((int(x) >> 32, int(x) & 0xFFFFFFFF) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def cut(text: str, spans) -> tuple[str, int]:
    """``text`` without the words of ``spans`` (and the white space after each
    run), and how many words went."""
    at = [m.span() for m in re.finditer(r"[^ \t-\r]+", text)]
    out, done, gone = [], 0, 0
    for s, e in merge(spans):
        out.append(text[done:at[s][0]])
        done = at[e][0] if e < len(at) else len(text)
        gone += e - s
    out.append(text[done:])
    return "".join(out).rstrip(" \t\n\x0b\x0c\r"), gone


def substring_dedup(docs: DataFrame, min_words: int = 30, gap: int = 8, k: int = 5, num: int = 80, den: int = 100,
                    id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with repeated passages cut out of ``text_col``, plus
    ``removed_words``.

    Of each group of near-equal paragraphs (see the module) the document with
    the smallest id keeps its copies, repeats inside it included; the words of
    the others go.  All other text stays as it is, but for white space at the
    end of a text that was cut; a text that is all repeats becomes empty.
    ``chars_col``, if there, is set to the new length where a text was cut.
    Texts of fewer than ``min_words`` words, nulls and rows with a null id
    pass unchanged with 0 words removed.  Repeated rows (same id and text)
    count as one document and stay equal.  Other columns pass through; a
    column named ``removed_words`` is replaced.  An empty table stays empty."""
    scratch = Scratch(docs.sparkSession, "substring-dedup")
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("txt"),
                        F.hash(text_col).alias("th"))
    spans = repeated_spans(texts, scratch, min_words, gap, k, num, den)
    docs = docs.drop("removed_words")
    touched = Bitmap(spans, "doc", "th", bits=bitmap_bits(spans.count()))
    if not touched.any():
        return docs.withColumn("removed_words", F.lit(0).cast("long"))
    maybe = F.coalesce(touched.has(F.col(id_col).cast("long"), F.hash(text_col)), F.lit(False))

    names = docs.columns
    chars = docs.schema[chars_col] if chars_col in names else None

    def splice(batches):
        for b in few_rows(batches):
            text, gone = [], []
            for t, s in zip(b.column(text_col).to_pylist(), b.column("__sd_spans").to_pylist()):
                t, n = (t, 0) if s is None else cut(t, s)
                text.append(t)
                gone.append(n)
            out = {text_col: pa.array(text, b.schema.field(text_col).type)}
            if chars:
                old, kind = b.column(chars_col).to_pylist(), b.schema.field(chars_col).type
                out[chars_col] = pa.array([len(t) if n else c for t, n, c in zip(text, gone, old)], pa.int64()).cast(kind)
            yield pa.RecordBatch.from_arrays([*(out.get(c, b.column(c)) for c in names), pa.array(gone, pa.int64())],
                                             names=[*names, "removed_words"])

    # only documents whose slot is set meet the spans; the others never shuffle
    hit = (docs.where(maybe).withColumn("__sd_th", F.hash(text_col))
           .join(spans.select(F.col("doc").alias("__sd_doc"), F.col("th").alias("__sd_sth"), F.col("spans").alias("__sd_spans")),
                 (F.col(id_col).cast("long") == F.col("__sd_doc")) & (F.col("__sd_th") == F.col("__sd_sth")), "left")
           .select(*names, "__sd_spans"))
    schema = T.StructType([*docs.schema, T.StructField("removed_words", T.LongType())])
    return docs.where(~maybe).withColumn("removed_words", F.lit(0).cast("long")).unionByName(
        hit.mapInArrow(lean(splice), schema))
