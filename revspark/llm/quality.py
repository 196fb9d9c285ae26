"""Operator 5: quality classifier with hierarchical empirical Bayes.

A document's evidence comes from words and word shapes: smoothed log odds of
hashed features, counted over a bounded labelled sample and calibrated by a
small logistic regression on evidence that leaves each document's own label
out of the counts.  Sites pool
it: by grouped sums over all documents, a host's rate of good documents is
shrunk toward the global one and a path's rate toward its host's, by prior
strengths estimated from the spread of the rates themselves (method of
moments).  A document's final odds are its own times its site's (without the
document) over the global ones.  'Good' and 'toxic' are judged alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import Scratch
from .workers import few_rows, lean

SAMPLE = 20_000             # labelled rows to fit on, whatever the number of labels
SLOTS = 1 << 19             # hashed features
HEADS = ("quality", "toxic")
SHRINK = 4.0                # documents of prior weight on log odds 0 for each feature
CACHED = 60_000
N_EVIDENCE = 7


def shape(word: str) -> str:
    out = []
    for ch in word[:24]:
        c = "A" if ch.isupper() else "a" if ch.isalpha() else "0" if ch.isdigit() else ch
        if not out or out[-1] != c:
            out.append(c)
    return "".join(out[:8])


class Features(dict):
    """word -> (slot of the bare lower-case word, slot of its shape); keeps the first CACHED words"""

    def __missing__(self, word: str):
        import xxhash
        bare = word.strip(".,;:!?\"'()[]{}|*#$%&").lower()
        got = (xxhash.xxh64_intdigest("w" + bare) % SLOTS, xxhash.xxh64_intdigest("s" + shape(word)) % SLOTS)
        if len(self) < CACHED:
            self[word] = got
        return got

    def of(self, text: str | None) -> tuple[np.ndarray, int]:
        """Slots of the distinct words, as rows (word, shape), and the number of words."""
        words = text.split() if text else ()
        return np.array([self[w] for w in set(words)], np.int64).reshape(-1, 2), len(words)


def log_odds(no: np.ndarray, yes: np.ndarray, total_no: float, total_yes: float) -> np.ndarray:
    """Smoothed log odds of features, shrunk toward 0 by SHRINK documents."""
    odds = np.log((yes + 0.5) / (total_yes + 1)) - np.log((no + 0.5) / (total_no + 1))
    return odds * (no + yes) / (no + yes + SHRINK)


def evidence(found: tuple[np.ndarray, int], weights: np.ndarray) -> np.ndarray:
    """Of a document whose slots' weights are looked up in ``weights``."""
    slots, n = found
    return evidence_of(weights[slots[:, 0]], weights[slots[:, 1]], n)


def evidence_of(w: np.ndarray, s: np.ndarray, n: int) -> np.ndarray:
    """(1, mean word, mean shape, strongest three for, strongest three against,
    share of repeated words, log of the number of words)"""
    if not n:
        return np.r_[1.0, np.zeros(N_EVIDENCE - 1)]
    k = min(3, len(w))
    top = np.partition(w, (k - 1, len(w) - k)) if len(w) > 1 else w
    return np.array([1.0, w.mean(), s.mean(), np.maximum(top[-k:], 0).sum(), np.minimum(top[:k], 0).sum(),
                     1 - len(w) / n, np.log(n)])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method; the intercept (column 0) has no penalty, other columns are scaled."""
    scale = np.r_[1.0, np.maximum(x[:, 1:].std(0), 1e-9)]
    z, beta = x / scale, np.zeros(x.shape[1])
    pen = np.r_[1e-3, np.full(x.shape[1] - 1, ridge)]
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(pen), z.T @ (y - p) - pen * beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta / scale


def _texts(b: pa.RecordBatch, column: str):
    for i in range(0, b.num_rows, 64):
        yield from b.slice(i, 64).column(column).to_pylist()


class Model:
    """``weights[head]`` by slot and ``beta[head]`` by kind of evidence."""

    def __init__(self, weights: np.ndarray, beta: np.ndarray):
        self.weights, self.beta = weights, beta

    def logits(self, found: tuple[np.ndarray, int]) -> list[float]:
        return [float(np.clip(evidence(found, w) @ b, -12, 12)) for w, b in zip(self.weights, self.beta)]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents: those whose hashed id is
    smallest.  Labels with a null are ignored; of repeated labels the lowest
    quality and highest toxicity count.  Without labels, all odds are even."""
    spark = docs.sparkSession
    named = labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
    named = named.groupBy(F.col(id_col).alias("__id")).agg(F.min("quality").alias("__q"), F.max("toxic").alias("__t"))
    picked = named.orderBy(F.xxhash64("__id"), "__id").limit(sample)
    rows = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("txt")).join(
        F.broadcast(picked), F.col("__doc") == F.col("__id")).select(
        "__id", "txt", (F.col("__q") > 0).cast("int").alias("q"), (F.col("__t") > 0).cast("int").alias("t"))
    rows = rows.dropDuplicates(["__id", "txt"]).drop("__id")        # a repeated row weighs once
    rows = Scratch(spark, "quality-fit").save(rows, "sample")

    def counts(batches):
        features = Features()
        n = np.zeros((SLOTS + 1, 4), np.int64)         # last row: documents
        for b in batches:
            for text, q, t in zip(_texts(b, "txt"), b.column("q").to_pylist(), b.column("t").to_pylist()):
                at = np.unique(features.of(text)[0])
                n[at, q] += 1
                n[at, 2 + t] += 1
                n[SLOTS, [q, 2 + t]] += 1
        at = np.flatnonzero(n.any(1))
        yield pa.record_batch([pa.array(at), *(pa.array(n[at, i]) for i in range(4))], ["slot", "c0", "c1", "c2", "c3"])

    got = rows.mapInArrow(lean(counts), "slot long, c0 long, c1 long, c2 long, c3 long").groupBy("slot").agg(
        *(F.sum(f"c{i}").alias(f"c{i}") for i in range(4))).where("c0 + c1 > 1").toArrow()       # at most SLOTS + 1 rows
    n = np.zeros((SLOTS + 1, 4))
    n[got["slot"].to_numpy()] = np.stack([got[f"c{i}"].to_numpy() for i in range(4)], 1)
    weights = np.stack([log_odds(n[:SLOTS, no], n[:SLOTS, yes], n[SLOTS, no], n[SLOTS, yes]).astype(np.float32)
                        for no, yes in ((0, 1), (2, 3))])
    shared = spark.sparkContext.broadcast(n.astype(np.int32))

    def measure(batches):
        features, counted = Features(), shared.value
        for b in batches:
            x = []
            for text, q, t in zip(_texts(b, "txt"), b.column("q").to_pylist(), b.column("t").to_pylist()):
                slots, words = features.of(text)
                own = []
                for no, label in ((0, q), (2, t)):          # the counts without this document
                    less = np.eye(2)[label]
                    c = np.maximum(counted[slots, no:no + 2] - less, 0)
                    w = log_odds(c[..., 0], c[..., 1], *np.maximum(counted[SLOTS, no:no + 2] - less, 0))
                    own.append(evidence_of(w[:, 0], w[:, 1], words))
                x.append(np.concatenate(own))
            x = np.array(x, np.float64).reshape(-1, 2 * N_EVIDENCE)
            yield pa.RecordBatch.from_arrays([b.column("q"), b.column("t"), *(pa.array(c) for c in x.T)],
                                             names=["q", "t", *(f"x{i}" for i in range(2 * N_EVIDENCE))])

    got = rows.mapInArrow(
        lean(measure), "q int, t int, " + ", ".join(f"x{i} double" for i in range(2 * N_EVIDENCE))).toArrow()    # <= one row per labelled id and text
    x = np.stack([got[f"x{i}"].to_numpy() for i in range(2 * N_EVIDENCE)], 1)
    beta = [logistic(x[:, N_EVIDENCE * h:N_EVIDENCE * (h + 1)], got[y].to_numpy().astype(np.float64)) if len(got) else np.zeros(N_EVIDENCE)
            for h, y in enumerate("qt")]
    return Model(weights, np.stack(beta))


def _strength(mean: float, spread: float, within: float, groups: int, n: float) -> float:
    """Prior weight, in documents, of the level above: the spread of rates that
    chance leaves unexplained against the spread inside a group."""
    real = spread - within * max(groups - 1, 0) / max(n, 1)
    return float(np.clip(within / max(real, 1e-9), 1.0, 1e6))


def site_rates(scored: DataFrame, scratch: Scratch) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """``scored`` has ``host, path, quality, toxic`` (probabilities) of all
    documents.  A row per (host, path) with its sums and shrunken rates, and
    for each head (global mean, prior weight of a path's host)."""
    sums = [F.count(F.lit(1)).alias("n")]
    for h in HEADS:
        sums += [F.sum(h).alias(f"{h}_s"), F.sum(F.col(h) * F.col(h)).alias(f"{h}_ss")]
    paths = scratch.save(scored.groupBy("host", "path").agg(*sums), "paths")
    hosts = paths.groupBy("host").agg(*(F.sum(c).alias(f"h_{c}") for c in paths.columns[2:]))
    paths = scratch.save(paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).drop(hosts["host"]), "sites")
    square = lambda s, n: F.sum(F.col(s) * F.col(s) / F.col(n))             # noqa: E731
    info: dict[str, tuple[float, float]] = {}
    out = paths
    for h in HEADS:
        p = paths.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("g"), F.sum(f"{h}_s").alias("s"),
                      F.sum(f"{h}_ss").alias("ss"), square(f"{h}_s", "n").alias("sq")).first()
        q = hosts.agg(F.count(F.lit(1)).alias("g"), square(f"h_{h}_s", "h_n").alias("sq")).first()
        n = p["n"] or 0
        if not n:
            info[h] = (0.5, 1.0)
            continue
        mean = p["s"] / n
        k_host = _strength(mean, q["sq"] / n - mean**2, (p["ss"] - q["sq"]) / n, q["g"], n)
        k_path = _strength(mean, (p["sq"] - q["sq"]) / n, (p["ss"] - p["sq"]) / n, p["g"] - q["g"] + 1, n)
        out = out.withColumn(f"{h}_host", (F.lit(k_host * mean) + F.col(f"h_{h}_s")) / (F.lit(k_host) + F.col("h_n")))
        info[h] = (mean, k_path)
    return out.select("host", "path", "n", *(c for h in HEADS if n for c in (f"{h}_s", f"{h}_host"))), info


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", id_col: str = "doc_id",
             text_col: str = "text", sample: int = SAMPLE, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (their columns ``keep``, all by default) plus ``quality_p`` and ``toxic_p`` (posterior probabilities) and
    ``accepted`` (quality_p >= 0.5 and toxic_p < 0.5).

    ``host`` and ``path`` name the columns of a document's site; a null is a
    value of its own.  A null or empty text has no evidence and is judged by
    its site.  Labels may be empty (all odds even, every document accepted).
    Repeated rows and other columns pass through; columns named like the added
    ones are replaced; an empty table stays empty."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    added = ("quality_p", "toxic_p", "accepted")
    docs = docs.drop(*added)
    model = fit(docs, labels, id_col, text_col, sample)
    shared = spark.sparkContext.broadcast((model.weights, model.beta))

    def score(batches, keep):
        model, features = Model(*shared.value), Features()
        for b in few_rows(batches):
            z = np.array([model.logits(s) for s in map(features.of, _texts(b, text_col))]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(z[:, 0]), pa.array(z[:, 1])],
                                             names=[*keep, "__quality", "__toxic"])

    logits = [T.StructField("__quality", T.DoubleType()), T.StructField("__toxic", T.DoubleType())]
    # each text is scored once; what is kept of its row waits in the shared folder
    names = [c for c in docs.columns if keep is None or c in keep]
    rows = docs.select(*names, *([] if text_col in names else [text_col]), F.col(host).alias("__host"), F.col(path).alias("__path"))
    kept = [*names, "__host", "__path"]
    scored = scratch.save(rows.mapInArrow(lean(lambda bs: score(bs, kept)), T.StructType([*(rows.schema[c] for c in kept), *logits])), "scored")
    rates = scored.select(F.col("__host").alias("host"), F.col("__path").alias("path"), "__quality", "__toxic")
    rates = rates.select("host", "path", *((1 / (1 + F.exp(-F.col(f"__{h}")))).alias(h) for h in HEADS))
    sites, info = site_rates(rates, scratch)
    sites = scratch.save(sites.select(F.col("host").alias("__shost"), F.col("path").alias("__spath"),
                                      *(F.col(c).alias(f"__{c}") for c in sites.columns[2:])), "rates")
    # a table of sites: Spark broadcasts it if it is small, and deals hot sites out again if not
    out = scored.join(sites, scored["__host"].eqNullSafe(sites["__shost"]) & scored["__path"].eqNullSafe(sites["__spath"]), "left")
    for h in HEADS:
        mean, k = info[h]
        if f"__{h}_host" not in sites.columns:
            out = out.withColumn(f"{h}_p", F.lit(0.5))
            continue
        p = 1 / (1 + F.exp(-F.col(f"__{h}")))
        rate = (F.lit(k) * F.col(f"__{h}_host") + F.col(f"__{h}_s") - p) / (F.lit(k) + F.col("__n") - 1)   # without itself
        rate = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), rate))
        odds = F.col(f"__{h}") + F.log(rate / (1 - rate)) - float(np.log(mean / (1 - mean)) if 0 < mean < 1 else 0)
        out = out.withColumn(f"{h}_p", 1 / (1 + F.exp(-odds)))
    accepted = ((F.col("quality_p") >= 0.5) & (F.col("toxic_p") < 0.5)) if model.beta.any() else F.lit(True)
    return out.select(*names, "quality_p", "toxic_p", accepted.alias("accepted"))
