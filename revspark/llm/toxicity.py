"""Operator 13: toxicity by maximum-scoring segments.

Each word has a log odds of toxic against other documents.  Its rate is a
chain of Dirichlet priors: the whole word is shrunk toward its first seven
letters, those toward six, and so on to the rate of all documents, so unseen
words inherit from their stem; the log odds moves toward 0 by its standard
error and then down by a drift.  A linear scan finds all maximal segments of
positive sum.  Their scores follow an extreme-value law in clean text, whose
lambda and K come from the clean labelled documents; a document's segments
add up to one significance, which a logistic curve turns into a probability.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import logistic
from .scratch import Scratch

SAMPLE = 20_000                 # labelled documents to learn from
SLOTS = 1 << 20                 # entries of the table of counts: 16 MB whatever the corpus
STEMS = (4, 5, 6, 7)
LEVELS = len(STEMS) + 1
ALPHA, ERRORS, DRIFT = 4.0, 1.0, 0.6
KNOWN = 60_000                  # word scores that a task keeps
BIN, BINS = 0.05, 400           # histogram of word scores, from -10 to 10
SIGNIFICANT = 0.01              # expected chance passages a document
TOKEN = re.compile(r"[^\W\d_]+")


def tokens_of(text: str | None) -> list[str]:
    """Runs of letters; a word in capitals is lower-cased."""
    return [w.lower() if len(w) > 1 and w.isupper() else w for w in TOKEN.findall(text)] if text else []


def keys_of(word: str) -> list[int]:
    """64-bit keys of a word's stems and of the lower-cased word; 0 where the word is shorter."""
    import xxhash
    n = len(word)
    return [(xxhash.xxh64_intdigest(word[:k]) or 1) if n >= k else 0 for k in STEMS] + [
        xxhash.xxh64_intdigest(word.lower() + "$") or 1]


class Odds:
    """Scores of words from the table of counts ``(key, toxic, all)`` by slot
    and the totals ``(toxic, all)`` of documents."""

    def __init__(self, keys: np.ndarray, toxic: np.ndarray, seen: np.ndarray, totals: tuple[int, int]):
        self.keys, self.toxic, self.seen, self.totals = keys, toxic, seen, totals
        self.known: dict[str, float] = {}

    def table(self, words: list[str], own: int | None = None) -> np.ndarray:
        """Scores of ``words``; with ``own`` (0 or 1) as if one document of
        that label, which holds them all, had not been counted."""
        if not words:
            return np.zeros(0)
        keys = np.array([keys_of(w) for w in words], np.uint64)
        slot = (keys % np.uint64(SLOTS)).astype(np.int64)
        hit = (self.keys[slot] == keys) & (keys > 0)
        less = 0 if own is None else 1
        toxic = np.where(hit, self.toxic[slot] - (own or 0), 0).astype(np.float64)
        seen = np.where(hit, self.seen[slot] - less, 0).astype(np.float64)
        t, n = self.totals[0] - (own or 0), self.totals[1] - less
        base = (t + 0.5) / (n + 1)
        even = math.log(base / (1 - base))
        rate, odds = np.full(len(words), base), np.zeros(len(words))
        for k in range(LEVELS):
            at = hit[:, k] & (seen[:, k] > 0)
            r = (toxic[:, k] + ALPHA * rate) / (seen[:, k] + ALPHA)
            error = ERRORS * np.sqrt(1 / (toxic[:, k] + ALPHA * base) + 1 / (seen[:, k] - toxic[:, k] + ALPHA * (1 - base)))
            o = np.log(r / (1 - r)) - even
            rate = np.where(at, r, rate)
            odds = np.where(at, np.sign(o) * np.maximum(np.abs(o) - error, 0), odds)
        return odds - DRIFT

    def scores(self, words: list[str]) -> np.ndarray:
        new = [w for w in set(words) if w not in self.known]
        fresh = dict(zip(new, self.table(new).tolist()))
        room = KNOWN - len(self.known)
        if room > 0:
            self.known.update(list(fresh.items())[:room])
        known = self.known
        return np.array([fresh[w] if w in fresh else known[w] for w in words])


def maximal_segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments ``(score, start, end)`` of a sequence, in
    linear time: every prefix and suffix of one is positive, and none can grow.
    Ties: a segment is not extended by parts that add nothing."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    kept: list[list] = []        # left sum, right sum, start, end, place of the last one with a smaller left sum
    for i in np.flatnonzero(np.asarray(scores) > 0).tolist():
        left, right, start = total[i], total[i + 1], i
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][0] >= left:
                j = kept[j][4]
            if j < 0 or kept[j][1] >= right:
                kept.append([left, right, start, i + 1, j])
                break
            left, start = kept[j][0], kept[j][2]
            del kept[j:]
    return [(float(r - l), s, e) for l, r, s, e, _ in kept]


def chance(segments: list[float], n: int, lam: float, k: float) -> float:
    """-log of the probability that clean text of ``n`` words has segments as
    high as the r highest of these, for the best r (sum statistics); -log(k n)
    without segments.  On a signed log scale, as one clear passage settles it."""
    each = math.log(max(k * max(n, 1), 1e-12))
    best, total = -each, 0.0
    for r, s in enumerate(sorted(segments, reverse=True), 1):
        total += lam * s - each
        if r > 1 and lam * s <= each:
            break
        x = total if r == 1 else total - (r - 1) * math.log(max(total, 1)) + math.lgamma(r + 1) + math.lgamma(r)
        best = max(best, x)
    return math.copysign(math.log1p(abs(best)), best)


class Model:
    def __init__(self, odds: Odds | None, lam: float, k: float, beta: np.ndarray, base: float):
        self.odds, self.lam, self.k, self.beta, self.base = odds, lam, k, beta, base

    def judge(self, text: str | None) -> tuple[float, list[tuple[int, int, float, float]]]:
        """Probability and the significant passages ``(start, end, score,
        expected)`` in characters of the text."""
        if self.odds is None:
            return self.base, []
        words = tokens_of(text)
        found = maximal_segments(self.odds.scores(words)) if words else []
        x = chance([s for s, _, _ in found], len(words), self.lam, self.k)
        z = float(np.clip(self.beta[0] + self.beta[1] * x, -30, 30))
        good = [(s, a, b, self.k * len(words) * math.exp(-self.lam * s)) for s, a, b in found]
        good = [g for g in good if g[3] <= SIGNIFICANT]
        spans = []
        if good:
            at = [m.span() for m in TOKEN.finditer(text)]
            spans = [(at[a][0], at[b - 1][1], s, e) for s, a, b, e in good]
        return 1 / (1 + math.exp(-z)), spans


def _texts(b: pa.RecordBatch, column: str):
    for i in range(0, b.num_rows, 64):
        yield from b.slice(i, 64).column(column).to_pylist()


def _count(batches):
    """``key, toxic, seen``: documents of the batch that hold a key."""
    from collections import Counter
    toxic, seen, held = Counter(), Counter(), 0

    def batch():
        return pa.record_batch([pa.array(np.fromiter(seen, np.uint64, len(seen)).view(np.int64)),
                                pa.array(np.array([toxic[k] for k in seen], np.int64)),
                                pa.array(np.fromiter(seen.values(), np.int64, len(seen)))], ["key", "toxic", "seen"])
    for b in batches:
        for text, t in zip(_texts(b, "txt"), b.column("t").to_pylist()):
            keys = {k for w in set(tokens_of(text)) for k in keys_of(w)} - {0}
            seen.update(keys)
            if t:
                toxic.update(keys)
            if len(seen) > 500_000:
                yield batch()
                toxic.clear(), seen.clear()
    yield batch()


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` labelled documents: those whose hashed id
    is smallest, one text an id (smallest hash).  Null labels and ids are
    ignored; of repeated labels the highest counts.  Where one of the two
    labels is missing, every document gets the rate of the other."""
    spark = docs.sparkSession
    named = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("__id")).agg((F.max(label_col) > 0).cast("int").alias("t")))
    picked = named.orderBy(F.xxhash64("__id"), "__id").limit(sample)
    # at most ``sample`` narrow rows are broadcast, and as many texts are learned from
    rows = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("txt")).join(
        F.broadcast(picked), F.col("__doc") == F.col("__id"))
    rows = rows.groupBy("__id").agg(F.max("t").alias("t"), F.min(F.struct(F.xxhash64("txt").alias("h"), "txt")).alias("x"))
    rows = Scratch(spark, "toxicity-fit").save(rows.select("t", F.col("x.txt").alias("txt")), "sample")
    totals = rows.agg(F.coalesce(F.sum("t"), F.lit(0)), F.count(F.lit(1))).first()
    if not 0 < totals[0] < totals[1]:
        return Model(None, 1.0, 1.0, np.zeros(2), (totals[0] + 0.5) / (totals[1] + 1))
    sums = rows.mapInArrow(_count, "key long, toxic long, seen long").groupBy("key").agg(
        F.sum("toxic").alias("toxic"), F.sum("seen").alias("seen")).where("seen > 1")
    # a slot keeps its most frequent key: SLOTS rows at most reach the driver
    slots = sums.groupBy(F.expr(f"(key & {SLOTS - 1}L)").alias("slot")).agg(F.max(F.struct("seen", "key", "toxic")).alias("m"))
    got = slots.select("slot", "m.key", "m.toxic", "m.seen").toArrow()
    keys, toxic, seen = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)
    at = got["slot"].to_numpy()
    keys[at] = got["key"].to_numpy().view(np.uint64)
    toxic[at], seen[at] = got["toxic"].to_numpy(), got["seen"].to_numpy()
    shared = spark.sparkContext.broadcast((keys, toxic, seen, (totals[0], totals[1])))

    def measure(batches):
        """Per document, without itself: label, words, segment scores; per task: histogram of clean word scores."""
        odds, bars = Odds(*shared.value), np.zeros(BINS, np.int64)
        for b in batches:
            n, kept = [], []
            labels_ = b.column("t").to_pylist()
            for text, t in zip(_texts(b, "txt"), labels_):
                words = tokens_of(text)
                each = list(set(words))
                score = dict(zip(each, odds.table(each, own=t).tolist()))
                s = np.array([score[w] for w in words])
                if not t and len(s):
                    bars += np.bincount(np.clip((s / BIN).round().astype(int) + BINS // 2, 0, BINS - 1), minlength=BINS)
                n.append(len(words))
                kept.append([x for x, _, _ in maximal_segments(s)] if words else [])
            kept = [sorted(x)[-64:] for x in kept]          # the sum statistic stops long before
            yield pa.record_batch([pa.array(labels_, pa.int32()), pa.array(n, pa.int32()),
                                   pa.array(kept, pa.list_(pa.float64())), pa.array([None] * len(n), pa.list_(pa.int64()))],
                                  ["t", "n", "segments", "bars"])
        yield pa.record_batch([pa.array([None], pa.int32()), pa.array([None], pa.int32()),
                               pa.array([None], pa.list_(pa.float64())), pa.array([bars.tolist()], pa.list_(pa.int64()))],
                              ["t", "n", "segments", "bars"])

    seen_rows = Scratch(spark, "toxicity-measure").save(
        rows.mapInArrow(measure, "t int, n int, segments array<double>, bars array<long>"), "rows")
    bars = np.zeros(BINS)
    for r in (seen_rows.where("bars is not null").select(F.posexplode("bars").alias("i", "c")).groupBy("i")
              .agg(F.sum("c").alias("c")).collect()):                       # BINS rows
        bars[r["i"]] = r["c"]
    own = seen_rows.where("t is not null").collect()                        # <= sample rows of 64 scores
    lam = _lambda((np.arange(BINS) - BINS // 2) * BIN, bars)
    clean = [(r["n"], max(r["segments"], default=0.0)) for r in own if not r["t"] and r["n"]]
    # K n exp(-lambda S) is exponential of mean 1 for the highest segment of clean text
    k = len(clean) / max(sum(n * math.exp(-lam * s) for n, s in clean), 1e-9) if clean else 1.0
    x = np.array([[1.0, chance(r["segments"], r["n"], lam, k)] for r in own])
    beta = logistic(x, np.array([r["t"] for r in own], np.float64))
    return Model(Odds(*shared.value), lam, k, beta, (totals[0] + 0.5) / (totals[1] + 1))


def _lambda(scores: np.ndarray, bars: np.ndarray) -> float:
    """The positive root of sum p exp(lambda s) = 1; within [0.05, 5]."""
    p = bars / max(bars.sum(), 1)
    low, high = 0.05, 5.0
    for _ in range(60):
        mid = (low + high) / 2
        if (p * np.exp(mid * scores)).sum() < 1:
            low = mid
        else:
            high = mid
    return (low + high) / 2


PASSAGES = "array<struct<start:int,end:int,score:double,expected:double>>"


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", sample: int = SAMPLE, threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``score`` (probability of the
    label), ``predicted`` (1 from ``threshold`` on) and ``passages``: the
    segments that clean text of this length would hold at most ``SIGNIFICANT``
    times, as characters ``start`` to ``end`` with their score and expected
    number.

    Labels of ids that ``labels`` doesn't hold are not learned from; a score
    reads the text alone.  Null and empty texts and texts without letters have
    no passage and the score of no evidence.  Repeated rows repeat; rows with a
    null id are scored; other columns are ignored; an empty table gives no rows.
    Without labels of both kinds all documents get the labels' smoothed rate."""
    model = fit(docs, labels, id_col, text_col, label_col, sample)
    odds = model.odds
    shared = docs.sparkSession.sparkContext.broadcast(
        (odds and (odds.keys, odds.toxic, odds.seen, odds.totals), model.lam, model.k, model.beta, model.base))

    def judge(batches):
        table, *rest = shared.value
        own = Model(Odds(*table) if table else None, *rest)
        for b in batches:
            got = [own.judge(t) for t in _texts(b, "__text")]
            passages = [[{"start": a, "end": e, "score": s, "expected": x} for a, e, s, x in spans] for _, spans in got]
            yield pa.record_batch([b.column(0), pa.array([p for p, _ in got], pa.float64()),
                                   pa.array(passages, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                                                          ("score", pa.float64()), ("expected", pa.float64())])))],
                                  [id_col, "score", "passages"])

    rows = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(judge, f"`{id_col}` {kind}, score double, passages {PASSAGES}").select(
        id_col, "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")
