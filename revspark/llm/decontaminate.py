"""Operator 4: benchmark decontamination by one Aho-Corasick automaton.

Words are runs of letters, digits and non-ASCII characters with A-Z
lower-cased; a text is scanned once as ' word word ... ', one character per
byte, so a match's place counts words exactly and words lead back to places
in the original text.  The automaton holds every window of the benchmark's
items.  It is broadcast; a benchmark of more than ``AUTOMATON_CHARS`` window
characters is cut into automata of that size, scanned one after another.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import Scratch
from .workers import few_rows

AUTOMATON_CHARS = 2_000_000      # about 100 MB of automaton
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32
              for b in range(256))


def normal_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_FOLD).split() if text else []


def item_windows(items, window: int) -> dict[str, tuple[int, list[str]]]:
    """' w1 ... wn ' -> (n, ids of the items that hold it)."""
    found: dict[str, tuple[int, set[str]]] = {}
    for item, text in items:
        words = normal_words(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            w = (b" " + b" ".join(words[i:i + n]) + b" ").decode("latin-1")
            found.setdefault(w, (n, set()))[1].add(str(item))
    return {w: (n, sorted(ids)) for w, (n, ids) in found.items()}


def automaton_of(windows) -> ahocorasick.Automaton | None:
    if not windows:
        return None
    a = ahocorasick.Automaton()
    for w, value in windows.items():
        a.add_word(w, value)
    a.make_automaton()
    return a


def scan(a: ahocorasick.Automaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged [start, stop) word runs inside occurrences, and the items hit."""
    flat = b" " + b" ".join(words) + b" "
    hits = [(end, *value) for end, value in a.iter(flat.decode("latin-1"))]
    if not hits:
        return [], set()
    spaces = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
    runs: list[tuple[int, int]] = []
    stops = np.searchsorted(spaces, [e for e, _, _ in hits])
    for s, e in sorted((int(stop) - n, int(stop)) for stop, (_, n, _) in zip(stops, hits)):
        if runs and s <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(e, runs[-1][1]))
        else:
            runs.append((s, e))
    return runs, {i for _, _, ids in hits for i in ids}


def char_spans(text: str, runs) -> list[dict]:
    """Places of word runs in the original text, in characters."""
    at = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    return [{"start": at[s][0], "stop": at[e - 1][1]} for s, e in runs]


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
_SPANS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
ADDED = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
         T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType()),
         T.StructField("spans", SPANS)]


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, automaton_chars: int = AUTOMATON_CHARS,
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` plus ``n_words, n_hit`` (words inside an occurrence of an item's
    window), ``n_items, items_sha256`` (of the ids of the items hit, sorted as
    strings, comma-joined), ``contaminated`` and ``spans`` (the hit runs, in
    characters of the original text).

    A window is ``window`` consecutive words of an item; an item of fewer is
    one window, one without words (or null, or with a null id) has none.  Null
    or empty texts have no words.  Rows, repeated ones included, and other
    columns pass through; columns named like the added ones are replaced."""
    spark = docs.sparkSession
    added = [f.name for f in ADDED]
    docs = docs.drop(*added)
    items = items.where(F.col(item_col).isNotNull() & F.col(item_text_col).isNotNull()).select(
        F.col(item_col).alias("item"), F.col(item_text_col).alias("txt"))
    chars = items.agg(F.sum(F.octet_length("txt"))).first()[0] or 0
    slices = max(1, -(-chars * window // automaton_chars))

    def automaton(i: int):
        # a slice is about automaton_chars of windows, whatever the benchmark's size
        rows = items.where(F.pmod(F.xxhash64("item"), F.lit(slices)) == i).collect()
        return spark.sparkContext.broadcast(automaton_of(item_windows(rows, window)))

    schema = T.StructType([*docs.schema, *ADDED])
    names = [*docs.columns, *added]

    def digests(b: pa.RecordBatch, found):
        runs, hit = zip(*found) if found else ((), ())
        n_hit = [sum(e - s for s, e in r) for _, r, _ in runs]
        spans = [char_spans(text, r) if r else [] for text, r, _ in runs]
        return pa.RecordBatch.from_arrays([
            *(b.column(c) for c in docs_columns), pa.array([n for _, _, n in runs], pa.int64()), pa.array(n_hit, pa.int64()),
            pa.array([len(i) for i in hit], pa.int64()),
            pa.array([hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for i in hit], pa.string()),
            pa.array([n > 0 for n in n_hit], pa.bool_()), pa.array(spans, _SPANS_ARROW)], names=names)

    docs_columns = list(docs.columns)

    def texts(b: pa.RecordBatch):
        for i in range(0, b.num_rows, 64):
            yield from b.slice(i, 64).column(text_col).to_pylist()

    if slices == 1:
        shared = automaton(0)

        def whole(batches):
            a = shared.value
            for b in few_rows(batches):
                found = []
                for text in texts(b):
                    words = normal_words(text)
                    runs, hit = scan(a, words) if a is not None and words else ([], set())
                    found.append(((text if runs else None, runs, len(words)), hit))
                yield digests(b, found)

        return docs.mapInArrow(whole, schema)

    # several automata: one pass each, hits meet by the text's digest
    scratch = Scratch(spark, "decontaminate")
    keyed = docs.select(F.unhex(F.md5(F.coalesce(text_col, F.lit("")))).alias("h"), F.col(text_col).alias("txt"))
    hits = None
    for i in range(slices):
        shared = automaton(i)

        def part(batches, shared=shared):
            a = shared.value
            for b in batches:
                h, runs, hit = [], [], []
                for j in range(b.num_rows):
                    r, ids = scan(a, normal_words(b.column(1)[j].as_py())) if a is not None else ([], set())
                    if r:
                        h.append(b.column(0)[j].as_py())
                        runs.append([x for s in r for x in s])
                        hit.append(sorted(ids))
                yield pa.record_batch([pa.array(h, pa.binary()), pa.array(runs, pa.list_(pa.int32())),
                                       pa.array(hit, pa.list_(pa.string()))], ["h", "runs", "items"])

        got = scratch.save(keyed.mapInArrow(part, "h binary, runs array<int>, items array<string>").dropDuplicates(["h"]), f"hits-{i}")
        shared.unpersist()
        hits = got if hits is None else hits.union(got)
    hits = hits.groupBy(F.col("h").alias("__hit_h")).agg(F.flatten(F.collect_list("runs")).alias("__runs"),
                                 F.array_distinct(F.flatten(F.collect_list("items"))).alias("__items"))
    met = docs.withColumn("__h", F.unhex(F.md5(F.coalesce(text_col, F.lit(""))))).join(
        hits, F.col("__h") == F.col("__hit_h"), "left").select(*docs.columns, "__runs", "__items")

    def merge(batches):
        for b in few_rows(batches):
            found = []
            for text, flat, ids in zip(texts(b), b.column("__runs").to_pylist(), b.column("__items").to_pylist()):
                runs = []
                for s, e in sorted(zip((flat or [])[::2], (flat or [])[1::2])):
                    if runs and s <= runs[-1][1]:
                        runs[-1] = (runs[-1][0], max(e, runs[-1][1]))
                    else:
                        runs.append((s, e))
                found.append(((text if runs else None, runs, len(normal_words(text))), set(ids or [])))
            yield digests(b, found)

    return met.mapInArrow(merge, schema)
