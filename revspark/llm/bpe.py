"""Operator 6: byte-level BPE encoding and decoding.

Distinct words (matches of the tokenizer's pattern) start as arrays of their
bytes, and a fold merges, again and again, the leftmost adjacent pair of
lowest rank.  Pieces are held as token ids (a rank is the id of the joined
token), and the rank map leads from two ids to the joined one.  Decoding
concatenates the binary pieces of the ids.

The fold comes in two forms.  ``bpe_encode_native`` runs it in Spark's
higher-order functions over a literal rank map (cut into hash buckets, since
a Spark map is searched linearly).  It is exact, but takes 50 to 100 us of
JVM time per distinct word, beyond the limit on a corpus whose vocabulary
keeps growing (figures in the README).  ``bpe_encode`` runs the same fold on
Arrow batches, all new distinct words of some texts at a time.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .workers import few_rows, lean

BUCKETS = 1 << 16
NONE = 2**31 - 1                    # rank of what is no token
PLACES = 2**24                      # longer words (16 MB) can't be encoded natively
CACHED = 300_000                    # distinct words that a worker remembers
LONG = 256                          # bytes from which a word is merged by itself


def read_ranks(path: str | None = None) -> dict[bytes, int]:
    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def joins(ranks: dict[bytes, int]):
    """(left id, right id, joined id) for every way to cut a token in two."""
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            left, right = ranks.get(token[:k]), ranks.get(token[k:])
            if left is not None and right is not None:
                yield left, right, rank


def pair_table(ranks: dict[bytes, int]) -> Column:
    """Literal ``array<map<bigint, bigint>>``: (left id, right id) -> id of the
    joined token, for every way to cut a token in two; folded at planning.
    Bind it once with ``let``: each use of a literal is another copy in a task."""
    buckets: list[dict[int, int]] = [{} for _ in range(BUCKETS)]
    for left, right, rank in joins(ranks):
        buckets[left * 31 + right & BUCKETS - 1][left << 32 | right] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,bigint>>").cast("array<map<bigint,bigint>>")


def byte_table(ranks: dict[bytes, int]) -> Column:
    """Literal array: byte -> its token id."""
    return F.from_json(F.lit(json.dumps([ranks[bytes([i])] for i in range(256)])), "array<bigint>")


def let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), f), 0)


def encode_word(word: Column, pairs: Column, single: Column) -> Column:
    """``array<int>``: token ids of one non-empty word that is no token itself."""
    def rank(a, b):           # of the token that two pieces join to, which is its id too
        return F.coalesce(pairs[(a * 31 + b).bitwiseAND(F.lit(BUCKETS - 1))][a * (1 << 32) + b], F.lit(NONE).cast("long"))

    def merged(acc, i):       # i: the 0-based place of the pair; pieces and ranks move up behind it
        p, r = acc["p"], acc["r"]
        return F.struct(
            F.filter(F.transform(p, lambda x, j: F.when(j == i, r[i]).otherwise(x)), lambda x, j: j != i + 1).alias("p"),
            F.filter(F.transform(r, lambda x, j: F.when(j == i - 1, rank(p[j], r[i]))
                                 .when(j == i + 1, rank(r[i], p[i + 2])).otherwise(x)),
                     lambda x, j: j != i).alias("r"))

    def step(acc, _):
        # rank and place in one number: its minimum is the leftmost pair of lowest rank
        low = F.array_min(F.transform(acc["r"], lambda x, j: x * PLACES + j))
        return let(low, lambda v: F.when(
            v < NONE * PLACES, let(v.bitwiseAND(F.lit(PLACES - 1)).cast("int"), lambda i: merged(acc, i))).otherwise(acc))

    def fold(p):
        return F.aggregate(
            F.slice(p, F.lit(2), F.size(p)),
            F.struct(p.alias("p"), F.zip_with(F.slice(p, F.lit(1), F.size(p) - 1), F.slice(p, F.lit(2), F.size(p)),
                                              rank).alias("r")),
            step, lambda acc: acc["p"].cast("array<int>"))

    latin = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")      # one character per byte
    return let(F.transform(F.split(latin, ""), lambda c: single[F.ascii(c)]), fold)


def bpe_encode_native(docs: DataFrame, text_col: str = "text", ranks: dict[bytes, int] | None = None,
                      pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` without ``text_col`` and with ``ids array<int>``, by column
    functions alone; a text's distinct words are encoded once.  White space is
    spelt out, as Java's classes leave out what is not ASCII."""
    ranks = ranks or read_ranks()
    space = "\\t-\\r \\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
    java = pattern.replace("[^\\s", f"[^{space}").replace("\\s", f"[{space}]").replace("\\S", f"[^{space}]")
    whole = F.from_json(F.lit(json.dumps({t.decode(): i for t, i in ranks.items() if _is_text(t)})), "map<string,int>")
    words = F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit(java), F.lit(0))

    def ids(pairs, single, tokens):
        def encode(w):
            return F.coalesce(F.when(tokens[w].isNotNull(), F.array(tokens[w])), encode_word(w, pairs, single))
        return let(words, lambda ws: let(F.array_distinct(ws), lambda ds: let(
            F.map_from_arrays(ds, F.transform(ds, encode)), lambda m: F.flatten(F.transform(ws, lambda w: m[w])))))

    out = let(pair_table(ranks), lambda p: let(byte_table(ranks), lambda b: let(whole, lambda t: ids(p, b, t))))
    return docs.drop("ids").withColumn("ids", out).drop(text_col)


def _is_text(token: bytes) -> bool:
    try:
        token.decode()
        return True
    except UnicodeDecodeError:
        return False


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    end = np.cumsum(size)
    return np.repeat(start - end + size, size) + np.arange(end[-1] if len(end) else 0)


class Pieces:
    """Runs of numbers, kept one after another, that are looked up together."""

    def __init__(self, dtype):
        self.flat, self.start, self.size, self.n, self.used = np.empty(1 << 16, dtype), np.empty(1 << 14, np.int64), \
            np.empty(1 << 14, np.int64), 0, 0

    def add(self, flat: np.ndarray, size: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        while self.n + len(size) > len(self.size):
            self.start, self.size = np.resize(self.start, 2 * len(self.start)), np.resize(self.size, 2 * len(self.size))
        self.flat[self.used:self.used + len(flat)] = flat
        self.size[self.n:self.n + len(size)] = size
        self.start[self.n:self.n + len(size)] = self.used + np.cumsum(size) - size
        self.n, self.used = self.n + len(size), self.used + len(flat)

    def get(self, which: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs ``which`` joined, and how long each group of ``count`` runs is."""
        size = self.size[which]
        upto = np.r_[0, np.cumsum(size)]
        return self.flat[_spread(self.start[which], size)], np.diff(upto[np.r_[0, np.cumsum(count)]])


class Words(dict):
    """word -> its number; ``new`` has the words met for the first time."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class Merges:
    """The rank map as an open-addressed table, and the fold over many words at once."""

    BITS = 21

    def __init__(self, single: np.ndarray, keys: np.ndarray, joined: np.ndarray, whole: dict[bytes, int]):
        self.single, self.whole = single, whole
        self.keys, self.joined = np.full(1 << self.BITS, -1, np.int64), np.full(1 << self.BITS, NONE, np.int64)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            first = np.zeros(len(keys), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]], self.joined[slot[put]] = keys[put], joined[put]
            keys, joined, slot = keys[~put], joined[~put], (slot[~put] + 1) & (1 << self.BITS) - 1

    @staticmethod
    def arrays(ranks: dict[bytes, int]) -> tuple:
        """What ``Merges`` is made of: plain data to broadcast."""
        all_ = np.array([(a << 32 | b, j) for a, b, j in joins(ranks)], np.int64).reshape(-1, 2)
        return np.array([ranks[bytes([i])] for i in range(256)], np.int64), all_[:, 0].copy(), all_[:, 1].copy(), ranks

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.joined[slot], NONE)
        at = np.flatnonzero((found != key) & (found >= 0))        # another key's slot: look further
        while len(at):
            slot[at] = (slot[at] + 1) & (1 << self.BITS) - 1
            found = self.keys[slot[at]]
            hit = found == key[at]
            out[at[hit]] = self.joined[slot[at[hit]]]
            at = at[~hit & (found >= 0)]
        return out

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words (none empty), one after another, and how many each has."""
        one = [self.whole.get(w, -1) for w in words]
        rest = [k for k, i in enumerate(one) if i < 0]
        size = np.ones(len(words), np.int64)
        parts = [(np.flatnonzero(np.array(one) >= 0), None, np.array([i for i in one if i >= 0], np.int64))]
        some = [k for k in rest if len(words[k]) < LONG]
        if some:
            which, n, ids = self._fold([words[k] for k in some])
            which = np.array(some)[which]
            size[which] = n
            parts.append((which, n, ids))
        for k in rest:
            if len(words[k]) >= LONG:
                ids = self._long(words[k])
                size[k] = len(ids)
                parts.append((np.array([k]), size[k:k + 1], ids))
        start = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.uint32)
        for which, n, ids in parts:
            out[start[which] if n is None else _spread(start[which], n)] = ids
        return out, size

    def _fold(self, words: list[bytes]):
        """Words in the order in which they were done, their sizes, and the ids."""
        ids = self.single[np.frombuffer(b"".join(words), np.uint8)]
        start = np.cumsum([0] + [len(w) for w in words])
        which, done = np.arange(len(words)), []
        rank = np.full(len(ids), NONE, np.int64)        # of a piece with the next one of its word
        inner = np.ones(len(ids), bool)
        inner[start[1:] - 1] = False
        at = np.flatnonzero(inner)
        rank[at] = self.rank(ids[at], ids[at + 1])
        while len(which):
            # rank and place in one number: its minimum is the leftmost pair of lowest rank
            low = np.minimum.reduceat(rank * len(ids) + np.arange(len(ids)), start[:-1])
            open_, size = low < NONE * len(ids), np.diff(start)
            stay = np.repeat(open_, size)
            done.append((which[~open_], size[~open_], ids[~stay]))
            at = low[open_] % len(ids)
            ids[at] = rank[at]                          # one merge in every word that has one
            stay[at + 1] = False
            at = np.cumsum(stay)[at] - 1
            ids, rank = ids[stay], rank[stay]
            which, start = which[open_], np.r_[0, np.cumsum(size[open_] - 1)]
            left = at[at > start[:-1]] - 1
            rank[left] = self.rank(ids[left], ids[left + 1])
            last = at == start[1:] - 1
            rank[at[last]] = NONE
            at = at[~last]
            rank[at] = self.rank(ids[at], ids[at + 1])
        return tuple(np.concatenate(x) for x in zip(*done))

    def _long(self, word: bytes) -> np.ndarray:
        """One long word, with a heap of its pairs."""
        ids = self.single[np.frombuffer(word, np.uint8)]
        pairs = self.rank(ids[:-1], ids[1:]).tolist()
        ids, after, before = ids.tolist(), list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(r, i) for i, r in enumerate(pairs) if r < NONE]
        pairs.append(NONE)
        heapq.heapify(heap)

        def look(i):
            j = after[i]
            pairs[i] = int(self.rank(np.array([ids[i]]), np.array([ids[j]]))[0]) if j < len(ids) else NONE
            if pairs[i] < NONE:
                heapq.heappush(heap, (pairs[i], i))

        while heap:
            r, i = heapq.heappop(heap)
            if pairs[i] != r:           # a piece that is gone, or has another neighbour now
                continue
            j = after[i]
            ids[i], after[i], pairs[j] = r, after[j], -1
            if after[i] < len(ids):
                before[after[i]] = i
            look(i)
            if before[i] >= 0:
                look(before[i])
        out, i = [], 0
        while i < len(ids):
            out.append(ids[i])
            i = after[i]
        return np.array(out, np.uint32)


def bpe_encode(docs: DataFrame, text_col: str = "text", ranks: dict[bytes, int] | None = None,
               pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` without ``text_col`` and with ``ids`` (binary, 32-bit little-endian
    token ids of the text): those of the tiktoken library without special
    tokens.  A null or empty text has no ids.  Rows, repeated ones included,
    and other columns pass through; a column named ``ids`` is replaced."""
    docs = docs.drop("ids")
    shared = docs.sparkSession.sparkContext.broadcast({"arrays": Merges.arrays(ranks or read_ranks()), "state": None})
    keep = [c for c in docs.columns if c != text_col]

    def encode(batches):
        find = regex.compile(pattern).findall
        if shared.value["state"] is None:           # kept by the worker from task to task
            shared.value["state"] = [Merges(*shared.value["arrays"]), Words(), Pieces(np.uint32)]
        state = shared.value["state"]
        for b in few_rows(batches):
            body, sizes = [], []
            for i in range(0, b.num_rows, 256):
                merges, known, pieces = state
                if len(known) > CACHED:
                    state[1:] = known, pieces = Words(), Pieces(np.uint32)
                texts = [find(t) if t else [] for t in b.slice(i, 256).column(text_col).to_pylist()]
                count = np.array([len(x) for x in texts])
                which = np.fromiter(map(known.__getitem__, chain.from_iterable(texts)), np.int64, int(count.sum()))
                if known.new:
                    pieces.add(*merges.encode([w.encode() for w in known.new]))
                    known.new = []
                ids, size = pieces.get(which, count)
                body.append(ids)
                sizes.append(size)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), _binary(body, sizes)], names=[*keep, "ids"])

    return docs.mapInArrow(lean(encode), T.StructType([*(docs.schema[c] for c in keep), T.StructField("ids", T.BinaryType())]))


def _binary(ids: list[np.ndarray], sizes: list[np.ndarray]) -> pa.Array:
    """A binary value of 32-bit numbers for each size."""
    size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    ends = np.r_[0, 4 * np.cumsum(size)].astype(np.int32)
    flat = np.concatenate(ids).astype("<u4") if ids else np.zeros(0, "<u4")
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def bpe_digest(encoded: DataFrame, ranks: dict[bytes, int] | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_tokens``, ``ids_sha256`` of the decimal ids joined by
    a space and ``decoded_sha256`` of the decoded bytes."""
    ranks = ranks or read_ranks()
    tokens = encoded.sparkSession.sparkContext.broadcast(_by_id(ranks))
    names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"]

    def digest(batches):
        decimal, piece = Pieces(np.uint8), Pieces(np.uint8)
        for p, xs in ((piece, tokens.value), (decimal, [b"%d " % i for i in range(len(tokens.value))])):
            p.add(np.frombuffer(b"".join(xs), np.uint8), np.array([len(x) for x in xs]))
        sha = lambda x: hashlib.sha256(x).hexdigest()       # noqa: E731
        for b in few_rows(batches):
            n, a, d = [], [], []
            for x in b.column("ids"):
                ids = np.frombuffer(x.as_py(), np.uint32).astype(np.int64)
                n.append(len(ids))
                one = np.array([len(ids)])
                a.append(sha(decimal.get(ids, one)[0][:-1]))
                d.append(sha(piece.get(ids, one)[0]))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(n, pa.int64()),
                                              pa.array(a, pa.string()), pa.array(d, pa.string())], names=names)

    schema = T.StructType([encoded.schema[c] for c in keep] + [
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType())])
    return encoded.select(*keep, *(["ids"] if "ids" not in keep else [])).mapInArrow(lean(digest), schema)


def _by_id(ranks: dict[bytes, int]) -> list[bytes]:
    pieces = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    return pieces


def bpe_decode(encoded: DataFrame, ranks: dict[bytes, int] | None = None, text_col: str = "text") -> DataFrame:
    """The inverse of ``bpe_encode``: ``ids`` become the text again."""
    ranks = ranks or read_ranks()
    pieces = encoded.sparkSession.sparkContext.broadcast(_by_id(ranks))

    @F.pandas_udf("binary")
    def decode(ids):
        return ids.map(lambda x: b"".join([pieces.value[i] for i in np.frombuffer(x, np.uint32).tolist()]))

    return encoded.withColumn(text_col, F.decode(decode("ids"), "UTF-8")).drop("ids")
