"""Operators 11 to 13 against brute force and their oracles."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from revspark.llm import lexical_search, oracles, prefix_trie, queries, toxicity
from revspark.llm.scratch import Scratch

SF = "/root/testdata/sf0.001"
RND = random.Random(11)
LONG = " ".join(f"w{RND.randrange(3000)}" for _ in range(15_000))


def duck(sql):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    return sorted(repr(sorted(zip(names, r))) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(oracles.ORACLE))
def test_oracle(spark, name):
    got = queries.QUERIES[name](spark, SF)
    assert sorted(repr(sorted(r.asDict().items())) for r in got.collect()) == duck(oracles.ORACLE[name])


def brute_search(docs, items, k=10):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def terms(t):
        return term.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n, total = len(counts), sum(x for _, _, x in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, q in items:
        scores = []
        for i, c, size in counts:
            m = 10 + 90 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(terms(q)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if x[1] else x[2], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return out


def search_rows():
    words = [f"t{i}" for i in range(60)] + ["É", "ß", "日本", "x9"]
    docs = [(i, " ".join(RND.choices(words, weights=range(64, 0, -1), k=RND.randrange(1, 80)))) for i in range(300)]
    docs += [(1000 + i, "t5 t6, T7! copied") for i in range(40)]                        # ties
    docs += [(7, docs[7][1]), (8, "another text of id 8 t9"), (None, "t5 t6 t7 copied copied"), (400, None), (401, ""), (402, " .,; "),
             (403, LONG), (404, "t1 " * 5000)]
    items = [(1, "T5 t6 copied"), (2, "é É t59 t59"), (2, "t3"), (3, None), (4, "nowhere"), (5, "t1 w5 w17 w999"), (6, ""),
             (1, "T5 t6 copied"), (None, "t9 日本")]
    return docs, items


def test_op11_brute_force(spark):
    docs, items = search_rows()
    want = Counter(brute_search(docs, items))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for c in ("id", "n", "places", "term", "df", "score", "rank", "query", "q", "item_id", "block"):
        df = df.withColumn(c, F.lit("clash"))
    qs = spark.createDataFrame(items, "item_id long, text string").withColumn("query", F.lit(1)).withColumn("id", F.lit(2)).withColumn("q", F.lit(3))
    for block in (lexical_search.BLOCK_BYTES, 20):          # several blocks of queries
        got = lexical_search.rank_documents(df, qs, block_bytes=block).collect()
        assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == want
    assert lexical_search.rank_documents(df.limit(0), qs).count() == 0
    assert lexical_search.rank_documents(df, qs.limit(0)).count() == 0


def test_op11_bounds_hold(spark, monkeypatch):
    """Few places, so that terms collide: results stay exact, and bounds are
    never below scores."""
    monkeypatch.setattr(lexical_search, "WIDTH", 8)
    docs, items = search_rows()
    counts = [Counter(lexical_search.terms_of(t)) for _, t in docs]
    for c, (place, tf) in zip(counts, lexical_search.fold(counts)):
        top = dict(zip(place.tolist(), tf.tolist()))
        assert all(top[zlib.crc32(t) & 7] >= x for t, x in c.items()) and set(top.values()) <= set(c.values())
    df = spark.createDataFrame(docs, "doc_id long, text string")
    qs = spark.createDataFrame(items, "item_id long, text string")
    got = lexical_search.rank_documents(df, qs).collect()
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == Counter(brute_search(docs, items))


def brute_trie(convs):
    """``convs``: id -> [(role, text)]"""
    nodes = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    kids = Counter(p[:-1] for p in nodes if p)
    out = {}
    for p, members in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        ends = sorted(c for c in members if len(convs[c]) == len(p))
        out[min(members), len(p)] = (
            min(nodes[p[:-1]]) if p else None, len(members), kids[p], sum(not kids[q] for q in below),
            sum((len(nodes[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return out


def test_op12_brute_force(spark):
    rows, convs = [], {}
    for c in range(-20, 160):
        turns = [(RND.choice(["user", "assistant"]), RND.choice(["a b", "c", "", " x y z ", "é"])) for _ in range(RND.randrange(1, 6))]
        if c % 3 == 0:
            turns = [("user", "the same"), ("assistant", "hot reply")] + turns[:c % 2]
        if c == 77:
            turns = [("user", "deep")] * 40
        convs[c] = turns
        rows += [(c, t if t or c % 2 else None, *x) for t, x in enumerate(turns)]
    rows += [(500, 1, None, None), (500, 0, "user", LONG), (501, 5, "user", "b"), (501, 5, "user", "b"), (None, 0, "user", "x")]
    convs[500], convs[501] = [("user", LONG), ("", "")], [("user", "b")] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    for c in ("path", "depth", "n", "conv", "turns", "t", "k1", "saved", "children"):
        df = df.withColumn(c, F.lit("clash"))
    paths = prefix_trie.conversation_paths(df)
    got = prefix_trie.prefix_trie(paths).collect()
    want = brute_trie(convs)
    assert len(got) == len(want)
    assert {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got} == want
    empty = prefix_trie.conversation_paths(df.limit(0))
    assert prefix_trie.prefix_trie(empty).count() == 0
    # a conversation without turns ends at the root
    bare = prefix_trie.prefix_trie(paths.where("conv_id = 501").select("conv_id", F.slice("path", 1, 0).alias("path"))).collect()
    assert [(r.conv_id, r.depth, r.n_convs, r.n_leaves) for r in bare] == [(501, 0, 1, 1)]
    assert bare[0].ends_sha256 == hashlib.sha256(b"501").hexdigest()


def test_op12_digest_of_a_hot_path(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 100)
    paths = spark.range(5000).select(F.col("id").alias("conv_id"), F.array(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id"))).cast(
        "array<bigint>").alias("path"))
    got = {r.digest for r in prefix_trie.end_digests(paths).collect()}
    hot = sorted([1, *range(0, 5000, 3)])
    assert hashlib.sha256(",".join(map(str, hot)).encode()).hexdigest() in got
    assert {hashlib.sha256(str(i).encode()).hexdigest() for i in range(2, 5000) if i % 3} <= got
    assert len(got) == 1 + sum(1 for i in range(2, 5000) if i % 3)


def brute_segments(scores):
    """Maximal segments by their recursive definition: the best one (longest
    first start does not matter without ties), then left and right of it."""
    total = np.concatenate([[0], np.cumsum(scores)])
    best = max(((total[e] - total[s], s, e) for s in range(len(scores)) for e in range(s + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    _, s, e = best
    return brute_segments(scores[:s]) + [(s, e)] + [(a + e, b + e) for a, b in brute_segments(scores[e:])]


def test_op13_segments():
    rng = np.random.default_rng(4)
    for _ in range(300):
        scores = rng.normal(-0.3, 1, rng.integers(0, 40))
        got = toxicity.maximal_segments(scores)
        assert [(s, e) for _, s, e in got] == brute_segments(scores)
        assert all(abs(x - scores[s:e].sum()) < 1e-9 for x, s, e in got)


def toxic_corpus(n=1500):
    words = [f"{a}{b}" for a in ("lor", "ips", "dol", "sit", "ame", "con") for b in ("em", "um", "or", "et", "ra", "ti", "no")]
    rows = []
    for i in range(n):
        text = RND.choices(words, k=RND.randrange(20, 300))
        if i % 8 == 0:
            at = RND.randrange(len(text))
            text[at:at] = RND.choices(["vilest", "grubby", "Scoundrel", "vilestones"], k=4)
        rows.append((i, " ".join(text), int(i % 8 == 0)))
    return rows


def test_op13_planted(spark):
    rows = toxic_corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, rows[0][1]), (0, rows[0][1]), (9000, None), (9001, ""), (9002, "12 !!"),
                                                                  (9003, LONG), (9004, "A " + rows[8][1].upper())], "doc_id long, text string")
    for c in ("t", "score", "passages", "x", "predicted", "txt", "__id2"):
        docs = docs.withColumn(c, F.lit("clash"))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 4] + [(8, 1), (16, 1), (24, 1), (None, 1), (1, None), (2, 0)]
                                   + [(i, y) for i, _, y in rows if i % 3 == 0], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    at = {r.doc_id: r for r in got}
    y = np.array([y for _, _, y in rows])
    assert (np.array([at[i].predicted for i, _, _ in rows]) == y).mean() > 0.99
    assert at[9004].predicted == 1 and not any(at[i].predicted for i in (9000, 9001, 9002, 9003))
    texts = {i: t for i, t, _ in rows}
    for i in range(0, 1500, 8):
        for p in at[i].passages:            # whole words that hold the planted ones
            words = texts[i][p.start:p.end].split()
            assert {"vilest", "grubby", "Scoundrel", "vilestones"} & set(words) and len(words) <= 8
    assert sum(bool(at[i].passages) for i in range(0, 1500, 8)) > 180
    assert len({r.score for r in got if r.doc_id in (0, None)}) == 1
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0
    none = toxicity.score_toxicity(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and not any(r.passages for r in none)


def test_op13_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    got = queries.op13_toxicity(spark, sf).where("held_out").join(labels, "doc_id").collect()
    y, p = np.array([r.toxic for r in got]), np.array([r.predicted for r in got])
    assert (y == p).mean() > 0.97 and (p[y == 1]).mean() > 0.85
    score = np.array([r.score for r in got])
    rank = score[y == 1][:, None] - score[y == 0][None, :]
    assert ((rank > 0).mean() + (rank == 0).mean() / 2) > 0.97


def test_scratch_is_removed(spark):
    import os
    s = Scratch(spark, "test-removed")
    s.save(spark.range(3), "x")
    fs = s._fs(s.base)
    assert os.path.exists(s.base.removeprefix("file:")) and fs.cancelDeleteOnExit(s._path(s.base))
    s.drop("x")
    assert not os.path.exists(f"{s.base.removeprefix('file:')}/x")


def test_op12_deep_paths(spark, monkeypatch):
    """Long lone conversations, some that share many turns, some whole prefixes of others."""
    monkeypatch.setattr(prefix_trie, "STRIDE", 7)
    convs = {c: [("user", f"q{c % 2}"), ("assistant", "a b c")][:c % 3] for c in range(12)}
    long = [("user", f"turn {i} of it") for i in range(45)]
    convs |= {20: long, 21: long[:30] + [("user", f"other {i}") for i in range(9)], 22: long[:30], 23: long[:20] + [("user", "x")] * 12,
              24: long, 25: [("user", f"alone {i}") for i in range(23)], 26: long[:44]}
    rows = [(c, t, *x) for c, turns in convs.items() for t, x in enumerate(turns)]
    paths = prefix_trie.conversation_paths(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    bare = spark.createDataFrame([(c, []) for c, turns in convs.items() if not turns], "conv_id long, path array<long>")
    got = prefix_trie.prefix_trie(paths.union(bare)).collect()
    want = brute_trie(convs)
    assert len(got) == len(want)
    assert {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got} == want
