"""The dealt operators against brute force, with nulls, empty and long texts,
ties, repeated rows, empty tables and clashing extra columns."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from revspark.llm import (bpe, chat, decontaminate, embedding_dedup, ngram_join, quality, sharding, substring_dedup,
                          shingles, token_shards, url_filter, verify)
from revspark.llm.components import connected_components
from revspark.llm.scratch import BITMAP_BITS, BITMAP_MOST, FREE_SHUFFLES, Bitmap, Scratch, bitmap_bits, slots_set

SF = "/root/testdata/sf0.001"
RND = random.Random(5)
LONG = " ".join(f"w{RND.randrange(4000)}" for _ in range(12_000))
BASE = [f"word{i}" for i in range(120)]
NEAR = [" ".join(BASE[:k] + ["edit"] + BASE[k + 1:]) for k in (3, 50, 90)]
EDGE = [(1, " ".join(BASE)), (2, " ".join(BASE)), (2, " ".join(BASE)), (3, NEAR[0]), (4, NEAR[1]), (5, NEAR[2]), (6, None),
        (7, ""), (8, "  \n\t "), (9, "one two"), (10, "ONE two"), (11, LONG), (12, "é ß 日本 🙂 x"), (13, "x" * 4000), (None, "one two"),
        (None, None), (-5, " ".join(reversed(BASE)))]


def table(spark, rows=EDGE):
    """Documents with columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("doc", "txt", "rep", "h", "n", "ids", "component", "bucket", "shard", "runs", "spans", "accepted", "removed_words"):
        df = df.withColumn(c, F.lit("clash"))
    return df.withColumn("source", F.when(F.col("doc_id") != 4, "s")).withColumn("lang", F.lit("en")).withColumn(
        "n_chars", F.length("text").cast("long"))


def groups(items, linked):
    at = {i: i for i in items}

    def root(x):
        while at[x] != x:
            x = at[x]
        return x
    for a in items:
        for b in items:
            if a < b and linked(a, b):
                x, y = sorted((root(a), root(b)))
                at[y] = x
    return {i: root(i) for i in items}


def test_components(spark):
    edges = [(RND.randrange(200), RND.randrange(200)) for _ in range(140)] + [(300 + i, 301 + i) for i in range(12)] + [(7, 7), (None, 3)]
    df = connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"))
    nodes = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    pairs = {(min(e), max(e)) for e in edges if None not in e}
    assert {r.node: r.component for r in df.collect()} == groups(nodes, lambda a, b: (a, b) in pairs)
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0


def test_op1_token_shards(spark):
    import public_tokenizers
    import tiktoken
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(), special_tokens={})
    path = Scratch(spark, "test-shards").path("x")
    n = token_shards.write_shards(table(spark), path, seq_len=64, per_shard=50)
    rows = token_shards.read_shards(spark, path, 64, 50).collect()
    assert sorted(r.slot for r in rows) == list(range(n)) and all(r.offset == r.slot % 50 * token_shards.stride_of(64) for r in rows)
    want = Counter()
    for i, t in EDGE:
        ids = np.array(enc.encode_ordinary(t or "") + [token_shards.END], "<u2")
        for k in range(0, len(ids), 64):
            want[i, k // 64, ids[k:k + 64].tobytes()] += 1
    assert Counter((r.doc_id, r.seq, bytes(r.ids)) for r in rows) == want
    for n in (1, 2, 3, 17, 1000):
        assert sorted(token_shards.feistel(np.arange(n, dtype=np.uint64), n, 3)) == list(range(n))
    assert token_shards.write_shards(table(spark, []), Scratch(spark, "t").path("y")) == 0


def test_op1_faster_pattern(spark):
    import public_tokenizers
    import tiktoken
    fast = token_shards.FASTER[public_tokenizers.PATTERN]
    own, faster = (tiktoken.Encoding("own", pat_str=p, mergeable_ranks=bpe.read_ranks(), special_tokens={}) for p in (public_tokenizers.PATTERN, fast))
    parts = [*"aZ9'sdtmlrve .,-_\n\r\t\x0b\x0c\x1c\x1f\x85\xa0\u2003\u2028\u3000\u0301é中٣²Ⅷ😀\u200b\ufeff", "'s", "'ll", "'LL", "  ", " \n"]
    rnd = random.Random(1)
    for _ in range(20_000):
        text = "".join(rnd.choices(parts, k=rnd.randrange(14)))
        assert own.encode_ordinary(text) == faster.encode_ordinary(text), repr(text)
    # a long run of white space at the end: the pattern as published overflows its search stack
    n = token_shards.write_shards(table(spark, [(1, "\n" * 1_000_000)]), path := Scratch(spark, "test-shards").path("run"))
    rows = token_shards.read_shards(spark, path).collect()
    ids = b"".join(bytes(r.ids) for r in sorted(rows, key=lambda r: r.seq))
    assert len(rows) == n and np.frombuffer(ids, "<u2").tolist() == faster.encode_ordinary("\n" * 1_000_000) + [token_shards.END]


def test_workers_give_back():
    """What a task freed leaves the process, also below memory that stays in use."""
    from revspark.llm.workers import lean

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096 >> 20
    kept = []

    def task(batches):
        for b in batches:
            held = [np.ones(12_000) for _ in range(2000)]      # some 190 MB in pieces that the allocator keeps
            kept.append(np.ones(12_000))
            kept.append(resident())
            yield b + len(held)

    assert list(lean(task)([1, 2])) == [2001, 2002]
    assert resident() < max(kept[1::2]) - 120


def test_tile_links_in_parts(monkeypatch):
    rnd = np.random.default_rng(3)
    base = [np.unique(rnd.integers(0, 2**40, 60, dtype=np.uint64)) for _ in range(20)]
    sets = [np.unique(np.r_[base[i % 20][:55], rnd.integers(0, 2**40, 4, dtype=np.uint64)]) for i in range(160)]
    left, right = np.arange(80), np.arange(80, 160)
    monkeypatch.setattr(verify, "TILE_CELLS", 1000)
    got = verify.tile_links(sets, left, right, 80, 100)
    want = [[len(np.intersect1d(sets[i], sets[j])) * 100 >= 80 * len(np.union1d(sets[i], sets[j])) for j in right] for i in left]
    assert (got == np.array(want)).all() and got.any() and not got.all()


def test_op2_sharding(spark):
    import zlib
    rows = [(i, f"t{i % 7}") for i in range(500)] + EDGE
    df = table(spark, rows).withColumn("source", F.when(F.col("doc_id") % 10 < 4, "hot").when(F.col("doc_id") % 10 < 9, F.concat(F.lit("s"), F.col("doc_id") % 10)))
    out = sharding.interleaved_shards(df, shards=8, bucket_rows=40).collect()
    count = Counter(r.shard for r in out)
    assert len(out) == len(rows) and set(count) == set(range(8)) and max(count.values()) - min(count.values()) <= 1
    for s in range(8):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(count[s]))
        hot = sum(r.source == "hot" for r in out if r.shard == s)
        assert abs(hot - count[s] * sum(r.source == "hot" for r in out) / len(out)) <= 3
    text = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == text
    assert sharding.interleaved_shards(table(spark, [])).count() == 0


@pytest.mark.parametrize("dim", [3, 12, 64, 384])
@pytest.mark.parametrize("lead", [2, 8, 50])
def test_op3_bound_loses_nothing(dim, lead):
    """Every pair at the threshold is found, whatever the leading dimensions; float32 inputs too."""
    rng = np.random.default_rng(dim + lead)
    x = rng.normal(size=(150, dim)) * np.linspace(3, 0.1, dim)
    y = np.concatenate([x[:60] * 7 + rng.normal(size=(60, dim)) * np.linspace(0, 1.2, 60)[:, None], -x[:9], x[:9]]).astype(np.float32).astype(float)
    basis = np.linalg.eigh(embedding_dedup.unit(x).T @ embedding_dedup.unit(x))[1][:, ::-1]
    got = {(i, j) for a, b in embedding_dedup.tile_pairs(x, y, basis, 0.95, lead) for i, j in zip(a.tolist(), b.tolist())}
    cos = (x @ y.T) / np.sqrt((x * x).sum(1))[:, None] / np.sqrt((y * y).sum(1))
    assert got == set(zip(*(k.tolist() for k in np.nonzero(cos >= 0.95)))) and len(got) >= 60


def test_op3_noise_copies(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(300, 64))
    vecs = np.concatenate([base, base[:200] + 0.1 * rng.normal(size=(200, 64))]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)] + [(7, vecs[8].tolist())], "vec_id long, embedding array<float>")
    got = embedding_dedup.cosine_components(df, tile_rows=64).collect()
    near = {r.vec_id: r for r in got if r.vec_id != 7 and r.vec_id not in (8, 207, 208)}
    assert len(got) == 501 and all(near[i].n_links == 1 and near[300 + i].component_id == i for i in range(9, 200))
    # rows that share an id pool their links
    assert {r.component_id for r in got if r.vec_id in (7, 8)} == {7}


def test_op3_embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 12))
    vecs = [v.tolist() for v in np.concatenate([base, base[:20] + 0.08 * rng.normal(size=(20, 12)), 3 * base[:5], base[:4]])]
    rows = list(enumerate(vecs)) + [(100, None), (101, [0.0] * 12), (102, []), (103, [1.0, None] + [0.0] * 10), (104, [float("nan")] * 12),
                                    (105, [float("inf")] * 12), (None, vecs[0]), (106, [1.0, 2.0]), (107, [2.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rep", F.lit(1)).withColumn("n", F.lit(1))
    got = {r.vec_id: r for r in embedding_dedup.cosine_components(df, lead=3, tile_rows=16).collect()}
    ok = {i: np.array(v) for i, v in rows if i is not None and i < 100 or i in (106, 107)}

    def linked(a, b):
        x, y = ok[a], ok[b]
        return len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.95
    want = groups(list(ok), linked)
    assert {i: got[i].component_id for i in ok} == want and all(got[i].kept == (want[i] == i) for i in ok)
    assert {i: got[i].n_links for i in ok} == {i: sum(i != j and linked(i, j) for j in ok) for i in ok}
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in range(100, 106)) and got[None].component_id is None
    assert embedding_dedup.cosine_components(df.limit(0)).count() == 0


def test_op4_decontamination(spark):
    items = [(1, " ".join(BASE[10:30])), (2, "One, TWO"), (3, None), (4, "...") , (None, "word1"), (5, " ".join(BASE[15:26])), (2, "One, TWO")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = table(spark)
    words = decontaminate.normal_words
    wins = [(str(i), words(t)[k:k + min(10, len(words(t)))]) for i, t in items if i and words(t)
            for k in range(max(1, len(words(t)) - 9))]
    for chars in (decontaminate.AUTOMATON_CHARS, 700):       # one automaton, several
        got = decontaminate.contamination(df, bench, automaton_chars=chars).collect()
        assert len(got) == len(EDGE)
        for r in got:
            w = words(r.text)
            hit, ids = set(), set()
            for i, p in wins:
                for k in range(len(w) - len(p) + 1):
                    if w[k:k + len(p)] == p:
                        hit.update(range(k, k + len(p)))
                        ids.add(i)
            assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), len(hit), len(ids), bool(hit))
            assert r.items_sha256 == hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
            assert sum(len(words(r.text[s.start:s.stop])) for s in r.spans) == len(hit)
    assert not any(r.contaminated for r in decontaminate.contamination(df, bench.limit(0)).collect())
    assert decontaminate.contamination(df.limit(0), bench).count() == 0


def test_op5_quality(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.classify(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    assert np.mean([(r.quality_p >= 0.5) == (r.quality == 1) for r in got]) > 0.93
    clean = [r.accepted for r in got if r.quality == 1 and r.toxic == 0]
    assert np.mean(clean) > 0.95
    edge = quality.classify(table(spark), labels.limit(0)).collect()
    assert len(edge) == len(EDGE) and all(r.accepted for r in edge)
    odd = spark.createDataFrame([(1, 1, 0), (1, None, 0), (None, 1, 1), (9, 0, 0), (9, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.classify(table(spark), odd).count() == len(EDGE) and quality.classify(table(spark, []), odd).count() == 0


def test_op5_repeated_rows_weigh_once(spark):
    rows = [(i, f"good{i % 3} fine text {i}" if i % 2 else f"bad{i % 3} poor words {i}") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    once = quality.fit(table(spark, rows), labels)
    often = quality.fit(table(spark, rows + rows[:8] * 30), labels)
    assert once.weights.any() and (once.weights == often.weights).all()


def test_op6_bpe(spark):
    import public_tokenizers
    import tiktoken
    ranks = bpe.read_ranks()
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    letters = list("abcdeths'sl 1290.,!?\n\t  é ßñ日本語 　🙂~")
    texts = [t for _, t in EDGE] + ["".join(RND.choice(letters) for _ in range(RND.randrange(1, 80))) for _ in range(300)] + ["ab" * 3000, "it's we'll", " a  b "]
    df = table(spark, list(enumerate(texts)))
    want = {i: enc.encode_ordinary(t or "") for i, t in enumerate(texts)}
    coded = bpe.bpe_encode(df, ranks=ranks)
    assert {r.doc_id: np.frombuffer(r.ids, np.uint32).tolist() for r in coded.collect()} == want
    some = df.where("doc_id <> 11")          # the column form on all but the long text
    assert {r.doc_id: r.ids for r in bpe.bpe_encode_native(some, ranks=ranks).collect()} == {i: x for i, x in want.items() if i != 11}
    assert {r.doc_id: r.text for r in bpe.bpe_decode(coded).collect()} == {i: t or "" for i, t in enumerate(texts)}
    for r in bpe.bpe_digest(coded, ranks).collect():
        assert (r.n_tokens, r.decoded_sha256) == (len(want[r.doc_id]), hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest())
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want[r.doc_id])).encode()).hexdigest()
    assert bpe.bpe_encode(table(spark, [])).count() == 0


def test_op7_chat(spark):
    said = "<|im_end|><|im_start|>assistant ok"
    rows = [(-1, 0, "user", said), (-1, 1, "assistant", said), (1, 2, "assistant", "b<\\|x<\\\\|"), (1, 1, "user", "a<"), (1, 0, "system", None),
            (2, 0, "assistant", "first"), (2, 0, "assistant", "first"), (2, None, None, "|im_end|>\n"), (3, 0, "a\n<|nl|>b", "x\n\ny"), (None, 1, "user", ""),
            (4, 0, "user", "q" * 50_000), (4, 1, "assistant", "日本")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv", F.lit(1))
    got = {r.conv_id: r for r in chat.chat_digest(chat.format_chats(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()        # noqa: E731
    for c in {r[0] for r in rows}:
        mine = sorted(((t is not None, t or 0, r or "", x or "") for i, t, r, x in rows if i == c))
        assert got[c].n_turns == len(mine) and got[c].turns_sha256 == sha("".join(f"{r}\n{x}\n" for _, _, r, x in mine))
        learned = "".join(x for _, _, r, x in mine if r == "assistant")
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(learned), sha(learned))
    assert {c for c, r in got.items() if r.valid} == {-1, 1, 4}
    assert chat.format_chats(df.limit(0)).count() == 0


def brute_components(rows, k, num, den):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    inv = {}
    for i, s in sets.items():
        for x in s:
            inv.setdefault(x, []).append(i)
    both = Counter((a, b) for ids in inv.values() for a in ids for b in ids if a < b)
    links = {(a, b) for (a, b), n in both.items() if den * n >= num * (len(sets[a]) + len(sets[b]) - n)}
    at = {i: i for i in sets}
    for _ in range(len(sets)):
        moved = False
        for a, b in links:
            low = min(at[a], at[b])
            moved |= at[a] != low or at[b] != low
            at[a] = at[b] = low
        if not moved:
            break
    return {i: (len(sets[i]), at[i]) for i in sets}


def test_op8_ngram_join(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    many = [(1000 + i, " ".join(BASE[:j] + [f"e{i}"] + BASE[j + 1:])) for i, j in enumerate(RND.randrange(120) for _ in range(60))]
    rows = [(i if i is None or i < 0 else 10_000 + i, t) for i, t in EDGE] + docs + many
    got = ngram_join.ngram_components(table(spark, rows)).collect()
    assert len(got) == len(rows)
    want = brute_components([r for r in rows if r[0] is not None], 4, 85, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.component_id is None for r in got if r.doc_id is None)
    kept = ngram_join.keep_one_per_group(table(spark, rows)).collect()
    want = brute_components([r for r in rows if r[0] is not None], 5, 80, 100)
    assert {r.doc_id for r in kept if r.doc_id is not None} == {i for i, (_, c) in want.items() if c == i}
    assert ngram_join.ngram_components(table(spark, [])).count() == 0
    assert ngram_join.ngram_components(table(spark, [(1, None), (2, "")])).where("component_id = doc_id").count() == 2


def test_op8_one_id_two_texts(spark):
    from revspark.llm.verify import BucketEdges
    a = lambda *x: np.array(x, np.int64)                                          # noqa: E731
    for n in ((40, 120), (120, 40)):        # both sizes of id 5 meet id 6, however they are sorted
        x, y, nx, ny, _, _ = BucketEdges().feed(a(1, 1, 1), a(5, 5, 6), a(*n, 118), True)
        assert set(zip(x, y, nx, ny)) == {(5, 6, 40, 118), (5, 6, 120, 118)}
    long, short = " ".join(BASE), " ".join(BASE[:30])
    rows = [(5, short), (5, long), (6, " ".join([*BASE[:-1], "edit"])), (7, " ".join([*BASE[:29], "other"]))]
    got = ngram_join.ngram_components(table(spark, rows)).collect()
    assert {r.component_id for r in got if r.doc_id in (5, 6)} == {5}


def test_op9_substring_dedup(spark):
    own = lambda n: " ".join(f"u{RND.randrange(10**9)}" for _ in range(n))        # noqa: E731
    passage, line = own(60), own(80)
    near = line.split()
    near[40] = "edit"
    rows = [(1, f"{own(40)}\n{own(9)} {passage} {own(30)}"), (2, f"{own(20)} {passage} {own(7)}\n{own(50)}"), (3, passage), (4, own(300)),
            (5, f"{own(5)}\n{line}\n{own(8)}"), (6, f"{own(12)}\n{' '.join(near)}\n{own(4)}"), (7, passage + "\n" + passage + " tail")]
    edge = [(i if i is None else i + 100, t) for i, t in EDGE]
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(table(spark, rows + edge)).collect()}
    text = dict(rows + edge)
    assert got[1].text == text[1] and got[4].text == text[4] and got[5].text == text[5]
    for i in (2, 3, 6, 7):
        assert got[i].removed_words >= 44 and got[i].n_chars == len(got[i].text)
    left = " ".join(got[2].text.split()) + " " + got[3].text + got[7].text
    assert not any(" ".join(passage.split()[k:k + 40]) in left for k in range(20)) and len(got[3].text.split()) < 16
    assert line.split()[0] not in got[6].text and text[6].split()[0] in got[6].text and text[6].split()[-1] in got[6].text
    for i in (101, 106, 107, 108, 109, 111, 112, 113, None):
        assert got[i].text == text[i] or i is None
    assert got[102].text == "" and substring_dedup.substring_dedup(table(spark, [])).count() == 0
    assert substring_dedup.substring_dedup(table(spark, [(1, None), (2, "a b")])).where("removed_words = 0").count() == 2


def test_op9_joined_short_lines(spark):
    own = lambda n: [f"u{RND.randrange(10**9)}" for _ in range(n)]                # noqa: E731
    lines = lambda words, n: "\n".join(" ".join(words[i:i + n]) for i in range(0, len(words), n))     # noqa: E731
    passage, lone, long = own(60), " ".join(own(12)), " ".join(own(40))
    near = passage[:30] + ["edit"] + passage[31:]
    around = lambda text: f"{lines(own(10), 10)}\n{text}\n{lines(own(20), 10)}"         # noqa: E731
    rows = [(1, around(lines(passage, 10))), (2, around(lines(near, 10))), (3, around(lines(near, 12))), (4, around(" ".join(near))),
            (5, around(lines(passage, 1))), (6, around(lone)), (7, around(lone)), (8, f"{own(1)[0]}\n\n{long}\n{lone}\n\n{lines(own(25), 5)}")]
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(table(spark, rows)).collect()}
    for i, text in rows:
        gone = len(text.split()) - len(got[i].text.split())
        assert got[i].removed_words == gone and (gone == 0 if i in (1, 6, 7, 8) else gone == 60 if i < 5 else gone >= 44)
        assert text.split()[:10] == got[i].text.split()[:10] and text.split()[-20:] == got[i].text.split()[-20:]
    assert all(" ".join(near[30:45]) not in " ".join(got[i].text.split()) for i in (2, 3, 4))


def test_op9_thinned_postings_give_the_same_spans():
    """Tasks that thin their postings, against one that sees all of them."""
    S = substring_dedup
    rng = np.random.default_rng(3)
    n = 4000
    kind = rng.integers(0, 3, n)
    key = np.where(rng.random(n) < 1 / 3, 8, rng.integers(0, 300, n) * 4) | kind       # a third on one key
    item = np.where(kind == S.LINE, key, rng.integers(0, 2, n)).astype(np.int64)
    doc, start = rng.integers(-40, 40, n), rng.integers(0, 9, n).astype(np.int32)
    stop = np.where(kind == S.BAND, start + 30 + item % 7, start + 30).astype(np.int32)
    rows = [key.astype(np.int64), item, doc.astype(np.int64), doc.astype(np.int32), start, stop]

    def result(parts):
        k, i, d, _, s, e = (np.concatenate(x) for x in zip(*parts))
        o = np.lexsort((s, d, i, k))
        k, i, d, s, e = k[o], i[o], d[o], s[o], e[o]
        w = np.flatnonzero(k & 3 == S.WINDOW)
        w = np.r_[w[S.FirstCopies().feed(k[w], i[w], d[w])], np.flatnonzero(k & 3 == S.GONE)]
        x, b = k & 3 == S.LINE, k & 3 == S.BAND
        return (sorted(zip(i[w], d[w], s[w], e[w])), sorted(zip(i[x], d[x], s[x], e[x])), set(zip(k[b], i[b], (e - s)[b]))), k

    want, _ = result([rows])
    cut = [[c[a:a + 500] for c in rows] for a in range(0, n, 500)]
    got, keys = result([S.thin(*part) for part in cut])
    assert got == want and np.unique(keys, return_counts=True)[1].max() < n // 20
    empty = S.thin(*(c[:0] for c in rows))
    assert [len(c) for c in empty] == [0] * 6


def test_op9_joined_lines_are_whole_lines():
    words = [[f"w{RND.randrange(50)}" for _ in range(RND.choice((0, 1, 3, 9, 14, 29, 30, 45)))] for _ in range(400)]
    texts = ["\n".join(" ".join(w) for w in words[i:i + 20]) for i in range(0, 400, 20)] + [None, "", "a", "b\n" * 70]
    g = substring_dedup.Units(30, 8, 5).group(texts)
    start, stop = substring_dedup.joined_lines(g, 30, 8)
    short = g.ends - g.begins < 30
    assert len(start) > 20 and np.isin(start, g.begins).all() and np.isin(stop, g.ends).all()
    assert (g.text_of(start) == g.text_of(stop - 1)).all()
    for s, e in zip(start, stop):
        inside = (g.begins >= s) & (g.ends <= e) & (g.ends > g.begins)
        assert 30 <= e - s < 90 and short[inside].all() and (g.ends - g.begins)[inside].sum() == e - s
    # every line of a run of 30 words in short lines of 8 or more is in some joined paragraph
    one = substring_dedup.Units(30, 8, 5).group(["\n".join(" ".join(f"v{RND.randrange(10**6)}" for _ in range(RND.randrange(8, 30))) for _ in range(9))])
    start, stop = substring_dedup.joined_lines(one, 30, 8)
    assert all(((start <= b) & (stop >= e)).any() for b, e in zip(one.begins, one.ends))


def test_op10_url_filter(spark):
    rows = [(1, "http://A.com/x", "<link rel='canonical' href='/y'>"), (2, "https://a.com/y#z", None),
            (3, "http://b.EXAMPLE.org/es/1?q", '<meta http-equiv="refresh" content="0; url=http://q.net/z">'), (4, "http://q.net/z#f", ""), (5, None, None),
            (6, "foo", "x"), (7, "http://h.net", "<LINK REL=canonical HREF=sub/p?a=1#x>"), (8, "http://h.net/sub/p?a=1", "<link rel=canonical href=http://x.com/de/>"),
            (9, "http://example.org/en/1x", None), (10, "http://example.org/en/2", None), (10, "http://example.org/en/2", None), (11, "http://notexample.com/de", "x" * 50_000),
            (12, "http://z.net/a", "<link rel=canonical href=http://z.com/de/1>"), (13, "http://z.net/b", "<link rel=canonical href=http://z.net/a><link rel=canonical href=http://z.com/fr/1>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit(1)).withColumn("own", F.lit(2))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df).collect()}
    assert got == {
        1: ("a.com", "/x", None, "allow"), 2: ("a.com", "/y", None, "allow"), 3: ("b.example.org", "/es/1", "example.org/es/", "block"),
        4: ("q.net", "/z", None, "block"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("h.net", "", None, "block"),
        8: ("h.net", "/sub/p", None, "block"), 9: ("example.org", "/en/1x", "example.org/en/1", "block"), 10: ("example.org", "/en/2", "org/", "allow"),
        11: ("notexample.com", "/de", None, "allow"), 12: ("z.net", "/a", None, "allow"), 13: ("z.net", "/b", None, "allow")}
    moved = spark.createDataFrame([("http://a.com/x", "http://m.com/de/"), (None, "x")], "src string, dst string")
    assert {r.page_id for r in url_filter.judge_urls(df, redirects=moved).where("verdict = 'block'").collect()} == {1, 2, 3, 4, 7, 8, 9}
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_op10_link_targets(spark):
    ends = {("http://a.com/l", '<link rel="canonical" href="?page=2&amp;ref=x">'): "a.com/l?page=2&ref=x",
            ("http://a.com/l?z", "<link href='?u=http://q.net/' rel='alternate canonical'>"): "a.com/l?u=http://q.net/",
            ("http://a.com/d/e/f", '<link rel="canonical nofollow" href="../x">'): "a.com/d/x",
            ("http://a.com/d/e/f", "<link rel=canonical href=./../../../../g/.>"): "a.com/g/",
            ("http://a.com/d/e", "<link rel=canonical href=..>"): "a.com/",
            ("http://a.com/d?k", '<link rel="canonical" href="#top">'): "a.com/d?k",
            ("http://a.com", '<meta http-equiv=refresh content="0; url=/p?a=1&#38;b=2">'): "a.com/p?a=1&b=2",
            ("http://a.com/", '<link rel="not-canonical" href="/n">'): None}
    rows = [(i, u, h) for i, (u, h) in enumerate(ends)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for i, want in enumerate(ends.values()):
        assert [r.b for r in url_filter.link_edges(df.where(f"page_id = {i}"), "url", "html").collect()] == ([want] if want else [])
    pages = [(1, "http://a.com/l", '<link rel="alternate canonical" href="../de/?p=2&amp;r=x">'), (2, "http://a.com/de/?p=2&r=x", None)]
    got = url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.verdict for r in got} == {1: "block", 2: "block"}


@pytest.mark.parametrize("sf", [SF])
def test_pipeline(spark, sf):
    import corpus_pipeline
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = Scratch(spark, "test-pipeline").save(stage(spark, docs, sf), "out")
        if name != "byte-level BPE":
            assert docs.columns == before.columns and 0 < docs.count() <= before.count()
    want = {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in before.collect()}
    assert {r.doc_id: r.decoded_sha256 for r in docs.collect()} == want


def test_frequency_levels(spark):
    """Counts over several tasks and flushes; keys repeat within and across them."""
    import pyarrow as pa

    from revspark.llm import frequency
    bits, slot_bits, bounds = 6, 14, [2, 8, 32]
    keys = np.random.default_rng(2).integers(0, 2**63, 400, dtype=np.uint64) * np.uint64(2)
    times = [1 + i % 60 for i in range(400)]
    rows = [int(np.int64(np.uint64(k).view(np.int64))) for k, n in zip(keys, times) for _ in range(n)]
    RND.shuffle(rows)

    def pack(batches):
        packer = frequency.KeyPacker(bits)
        for b in batches:
            x = b.column(0).to_numpy().view(np.uint64)
            for i in range(0, len(x), 700):
                packer.add(x[i:i + 700])
                yield from packer.flush()
        yield from packer.flush()

    packed = spark.createDataFrame(pa.table({"k": rows}).to_pandas()).repartition(5).mapInArrow(pack, frequency.PACK_SCHEMA)
    for bound in (bounds, [5]):
        table = frequency.levels(packed, bits, bound, slot_bits)
        want = Counter()
        for k, n in zip(keys.tolist(), times):
            slot = k >> (64 - slot_bits)
            want[slot] = max(want[slot], sum(n > x for x in bound))
        got = frequency.lookup(table, keys, slot_bits)
        assert got.tolist() == [want[k >> (64 - slot_bits)] for k in keys.tolist()]


def test_op9_sets_of_candidate_lines(spark):
    """Tasks find the slots that Spark set; a line's set is cut out of its texts' shingles."""
    ids = spark.range(-500, 500).select((F.col("id") * 7919000001).alias("node"))
    half = Bitmap(ids.where("pmod(node, 2) = 0"), "node", bits=1 << 20)
    rows = ids.select("node", half.has("node").alias("has")).collect()
    got = slots_set(half.words, np.array([r.node for r in rows], np.int64))
    assert got.tolist() == [r.has for r in rows] and 500 <= got.sum() < 520

    units = substring_dedup.Units(30, 8, 5)
    text = "\n".join(" ".join(f"w{i}x{j % 40}" for j in range(45)) for i in range(6)) + "\na b\n" + "short line here now\n" * 12
    g = units.group([text])
    s, e, item = units.lines(g)
    sets = list(units.line_sets(g, list(zip(s.tolist(), e.tolist(), (item & np.uint64(1)).tolist()))))
    for (x, y, i), (tokens, head, tail) in zip(zip(s, e, item), sets):
        sh = shingles.shingles(g.h[x:y], 5)
        edge = 6 if i & np.uint64(1) else 0
        assert np.array_equal(tokens, np.unique(sh))
        assert np.array_equal(head, sh[:edge]) and np.array_equal(tail, sh[len(sh) - edge:])


def test_tile_links_of_few_sets():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    sets = [np.unique(x) for x in (base, np.r_[base[:57], rng.integers(0, 2**63, 2, dtype=np.uint64)], base[:30])]
    for left, right in (([0, 1, 2], [0, 1, 2]), ([0, 1], [2]), ([0], [1, 2])):
        got = verify.tile_links(sets, np.array(left), np.array(right), 80, 100)
        want = [[i != j and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j])) for j in right] for i in left]
        assert got.tolist() == want


def test_hashes_of_slices_and_longs():
    """Whole arrays hash like the library does word by word; words and lines are those of bytes.split."""
    rng = np.random.default_rng(4)
    data = rng.integers(0, 256, 5000, dtype=np.uint8).tobytes()
    s = rng.integers(0, len(data) + 1, 2000)
    e = np.minimum(s + rng.integers(0, 45, 2000), len(data))
    h = shingles.WordHashes()
    assert np.array_equal(shingles.hash_slices(data, s, e), h.of([data[a:b] for a, b in zip(s, e)]))
    texts = [None, "", "\n", "A b\x1cc\x0b\x0cd\r\n\n e", " " + LONG, "é\x85ß", "x" * 40 + "\t"]
    g = substring_dedup.Group(texts)
    lines = [line.split() for t in texts for line in (t or "").encode().lower().split(b"\n")]
    assert np.array_equal(g.h, h.of([w for line in lines for w in line]))
    assert (g.ends - g.begins).tolist() == [len(line) for line in lines]
    assert np.diff(g.edge).tolist() == [len((t or "").encode().split()) for t in texts]
    assert g.line_text.tolist() == [i for i, t in enumerate(texts) for _ in (t or "").split("\n")]


def test_small_components_share_groups(spark, monkeypatch):
    """Small components are compared in bins, a large one in tiles; the links are those of all pairs."""
    monkeypatch.setattr(verify, "TILE_ITEMS", 8)
    rng = np.random.default_rng(6)
    sets, pairs = {}, []
    for c in range(40):
        base = rng.integers(0, 2**63, 50, dtype=np.uint64)
        ids = range(1000 * c, 1000 * c + (30 if c == 7 else 2))
        for i in ids:
            sets[i] = np.unique(np.r_[base[int(rng.integers(0, 12)):], rng.integers(0, 2**63, 1, dtype=np.uint64)])
        pairs += [(ids[0], i, len(sets[ids[0]]), len(sets[i])) for i in ids[1:]]
    rows = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in sets.items()], "id long, tokens binary")
    scratch = Scratch(spark, "bins")
    links = verify.verified_links(spark.createDataFrame(pairs, "a long, b long, na long, nb long"),
                                  lambda wanted: rows.where(wanted.has("id")), 80, 100, scratch)
    got = {r.node: r.component for r in connected_components(links, scratch).collect()}

    def linked(a, b):
        both = len(np.intersect1d(sets[a], sets[b]))
        return a // 1000 == b // 1000 and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both)
    want = groups(sets, linked)
    assert {i: got.get(i, i) for i in sets} == want and 0 < len(got) < len(sets)


def test_bitmap_is_no_literal(spark):
    """A plan's text, which the driver makes again for each stage that ends, doesn't hold the bitmap."""
    has = Bitmap(spark.range(300), "id").has("id")
    df = spark.range(1000).where(has)
    assert len(df._jdf.queryExecution().toString()) < 20_000
    assert 300 <= df.count() < 310


def test_tasks_hold_few_rows(spark):
    """A task's input comes in one large batch; what it makes leaves in small ones, with nothing lost or moved."""
    import pyarrow as pa
    from revspark.llm.workers import few_rows
    batch = pa.record_batch([pa.array(range(2500))], ["x"])
    got = list(few_rows([batch, batch.slice(0, 0), batch.slice(5, 3)]))
    assert [b.num_rows for b in got] == [1024, 1024, 452, 3]
    assert [x for b in got for x in b.column(0).to_pylist()] == [*range(2500), 5, 6, 7]
    docs = spark.range(0, 2500, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit("tëxt no "), "id").alias("text"))
    back = bpe.bpe_decode(bpe.bpe_encode(docs)).collect()
    assert [(r.doc_id, r.text) for r in back] == [(i, f"tëxt no {i}") for i in range(2500)]


def shuffle_files(spark):
    import glob
    dirs = spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d.getPath()}/*/shuffle_*.data")}


def test_shuffle_files_go_with_their_query(spark):
    """What a step shuffled is off the disk once its result is written or collected; the session keeps its own setting."""
    import time

    from revspark.llm import frequency
    docs = spark.range(20_000).select("id", (F.col("id") % 77).alias("k"))
    scratch = Scratch(spark, "freed")

    def pack(batches):
        packer = frequency.KeyPacker(6)
        for b in batches:
            packer.add(b.column(0).to_numpy().view(np.uint64) << np.uint64(40))
        yield from packer.flush()

    for own in (None, "false"):
        if own is not None:
            spark.conf.set(FREE_SHUFFLES, own)
        before = shuffle_files(spark)
        saved = scratch.save(docs.repartition(7, "k").groupBy("id").agg(F.max("k").alias("k")), f"saved-{own}")
        bitmap = Bitmap(docs, "k")
        table = frequency.levels(docs.select("id").mapInArrow(pack, frequency.PACK_SCHEMA), 6, [1, 2], 12)
        end = time.time() + 20
        while (left := shuffle_files(spark) - before) and time.time() < end:
            time.sleep(0.2)
        assert not left and spark.conf.get(FREE_SHUFFLES, None) == own
        assert saved.count() == 20_000 and bitmap.any() and len(table) == 1 << 12
    spark.conf.unset(FREE_SHUFFLES)


def test_weak_candidates_glue_no_tiles(spark, monkeypatch):
    """A large component of weak candidates is split before tiles are made: each set goes to one tile, no link is lost."""
    monkeypatch.setattr(verify, "TILE_ITEMS", 64)
    rng = np.random.default_rng(8)
    common = rng.integers(0, 2**63, 25, dtype=np.uint64)      # a passage that all sets of a component hold
    sets, pairs = {}, []
    for c in range(2):
        start = 10_000 * c
        for g in range(90):
            base = rng.integers(0, 2**63, 30, dtype=np.uint64)
            for i in range(4):
                sets[start + 10 * g + i] = np.unique(np.r_[common, base[int(rng.integers(0, 12)):], rng.integers(0, 2**63, 1, dtype=np.uint64)])
        ids = [i for i in sets if i >= start]
        pairs += [(ids[0], i, len(sets[ids[0]]), len(sets[i])) for i in ids[1:]]
    rows = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in sets.items()], "id long, tokens binary")
    scratch = Scratch(spark, "glued")
    links = verify.verified_links(spark.createDataFrame(pairs, "a long, b long, na long, nb long"),
                                  lambda wanted: rows.where(wanted.has("id")), 80, 100, scratch)
    got = {r.node: r.component for r in connected_components(links, scratch).collect()}

    def linked(a, b):
        both = len(np.intersect1d(sets[a], sets[b]))
        return a // 10_000 == b // 10_000 and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both)
    want = groups(sets, linked)
    assert {i: got.get(i, i) for i in sets} == want and len(set(want.values())) > 180
    members = spark.read.parquet(scratch.path("links-sharp-members"))
    assert members.agg(F.max("blocks")).first()[0] == 1 and members.count() <= len(sets)


def test_split_component_of_copies_keeps_its_links(spark, monkeypatch):
    """All of a large component's sets are near copies, in more than one tile; one id has two sets."""
    monkeypatch.setattr(verify, "TILE_ITEMS", 16)
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    other = rng.integers(0, 2**63, 60, dtype=np.uint64)
    rows = [(i, np.unique(np.r_[base[2:], rng.integers(0, 2**63, 2, dtype=np.uint64)])) for i in range(50)]
    rows += [(i, np.unique(np.r_[other[2:], rng.integers(0, 2**63, 2, dtype=np.uint64)])) for i in range(50, 60)]
    rows += [(100, base), (100, other)]
    df = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in rows], "id long, tokens binary")
    pairs = [(0, i, 60, 60) for i in [*range(1, 60), 100]]
    scratch = Scratch(spark, "copies")
    links = verify.verified_links(spark.createDataFrame(pairs, "a long, b long, na long, nb long"),
                                  lambda wanted: df.where(wanted.has("id")), 80, 100, scratch)
    got = {r.node: r.component for r in connected_components(links, scratch).collect()}
    assert got == {i: 0 for i, _ in rows}


def test_bitmap_grows_with_its_ids():
    assert [bitmap_bits(n) for n in (0, 100_000, 10**9)] == [BITMAP_BITS, BITMAP_BITS, BITMAP_MOST]
    assert all(16 * n <= bitmap_bits(n) <= 32 * n for n in (200_000, 540_000, 1_000_000))


def test_pipeline_keeps_one_stage(spark, monkeypatch, tmp_path):
    """A stage's table goes when the next one is written."""
    import os

    import corpus_pipeline
    spark.range(100).write.parquet(f"{tmp_path}/documents.parquet")
    made, init = [], Scratch.__init__
    monkeypatch.setattr(Scratch, "__init__", lambda self, *a: (init(self, *a), made.append(self))[0])
    stage = ("half", lambda s, docs, d: docs.where("id % 2 = 0").withColumn("id", F.expr("id div 2")))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [stage] * 4)
    assert sorted(r.id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == list(range(7))
    assert os.listdir(made[0].base.removeprefix("file:")) == ["stage-2"]
