"""M2 against a brute-force, single-machine word-cloud computation."""

import math
import re
from collections import Counter, defaultdict

from revspark.functions import lexicon as L
from revspark.operators import ngrams as NG

DOCS = [
    "Apps crash. The app crashes; my apps keep crashing!",
    "Worst internet service, worst internet ever. Internet service is down.",
    "Good app, good apps, GOOD App. Internet Service again",
    "It's the app's fault 42 times; 42 is a number",
    "worst internet worst internet worst internet service service",
    "Great great great great great great great great great great",
]


def _fold(tokens):
    d = defaultdict(Counter)
    for w in tokens:
        d[w.lower()][w] += 1
    merged = {}
    for key in list(d):
        if key.endswith("s") and not key.endswith("ss") and key[:-1] in d:
            for w, c in d[key].items():
                d[key[:-1]][w[:-1]] += c
            merged[key] = key[:-1]
            del d[key]
    counts, std = {}, {}
    for low, cases in d.items():
        rep = min(cases.items(), key=lambda kv: (-kv[1], kv[0]))[0]
        counts[rep] = sum(cases.values())
        std[low] = rep
    for plural, sing in merged.items():
        std[plural] = std[sing]
    return counts, std


def _ll(k, n, x):
    return math.log(max(x, 1e-10)) * k + math.log(max(1 - x, 1e-10)) * (n - k)


def _score(c12, c1, c2, n):
    if n <= c1 or n <= c2:
        return 0
    p, p1, p2 = c2 / n, c12 / c1, (c2 - c12) / (n - c1)
    return -2 * (_ll(c12, c1, p) + _ll(c2 - c12, n - c1, p) - _ll(c12, c1, p1) - _ll(c2 - c12, n - c1, p2))


def brute(docs, max_words=200, threshold=30.0):
    stop = {w.lower() for w in L.WORDCLOUD_STOPWORDS}
    uni, bi = [], []
    for d in docs:
        words = re.findall(r"\w[\w']*", d)
        words = [w[:-2] if w.lower().endswith("'s") else w for w in words]
        words = [w for w in words if not w.isdigit()]
        bi += [f"{a} {b}" for a, b in zip(words, words[1:])
               if a.lower() not in stop and b.lower() not in stop]
        uni += [w for w in words if w.lower() not in stop]
    counts, std = _fold(uni)
    bcounts, _ = _fold(bi)
    orig = dict(counts)
    n = len(uni)
    for b, c in bcounts.items():
        a1, a2 = b.split(" ")
        w1, w2 = std[a1.lower()], std[a2.lower()]
        if _score(c, orig[w1], orig[w2], n) > threshold:
            counts[w1] -= c
            counts[w2] -= c
            counts[b] = c
    items = sorted(((w, c) for w, c in counts.items() if c > 0), key=lambda kv: (-kv[1], kv[0]))[:max_words]
    top = items[0][1]
    return [(w, c, round(c / top, 6)) for w, c in items]


def test_word_frequencies_match_brute_force(spark):
    df = spark.createDataFrame([(d,) for d in DOCS], "text string")
    got = [(r["word"], r["count"], round(r["weight"], 6))
           for r in NG.word_frequencies(df, "text").collect()]
    assert sorted(got) == sorted(brute(DOCS))


def test_word_frequencies_without_collocations(spark):
    df = spark.createDataFrame([(d,) for d in DOCS], "text string")
    got = {r["word"]: r["count"] for r in NG.word_frequencies(df, "text", collocations=False).collect()}
    want = {w: c for w, c, _ in brute(DOCS, threshold=float("inf"))}
    assert got == want
    assert got["app"] == 7 and "apps" not in got and got["internet"] == 7


def test_top_ngrams_tie_order(spark):
    df = spark.createDataFrame([("alpha beta gamma",), ("gamma delta alpha beta",)], "t string")
    got = [(r["ngram"], r["count"]) for r in NG.top_ngrams(df, "t", 2, 2).collect()]
    assert got == [("alpha beta", 2), ("beta gamma", 1)]


def _py_cloud_words(text):
    words = re.findall(r"\w[\w']*", text)
    words = [w[:-2] if w.lower().endswith("'s") else w for w in words]
    return [w for w in words if not w.isdigit()]


def test_cloud_words_edge_cases(spark):
    texts = ["it's's abc''s 's 123's x'S abc' ab'cd'", "² ①② 12³ x² l'été's ñ's 42 ٣٤ rock'n'roll's",
             "''s s's 'x 9's 'S", ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r["w"] for r in df.select(NG.cloud_words("text").alias("w")).collect()]
    assert got == [_py_cloud_words(t) for t in texts]


def test_word_frequency_sql_matches_spark_on_fixture(spark):
    import duckdb
    from revspark.plans import sqlfrag as S
    texts = DOCS + ["² ①② 12³ x² l'été's ñ's 42 ٣٤", "it's's abc''s 's 123's x'S abc'"]
    con = duckdb.connect()
    con.execute("CREATE TABLE docs(text VARCHAR)")
    con.executemany("INSERT INTO docs VALUES (?)", [(t,) for t in texts])
    want = sorted((w, c, round(x, 6)) for w, c, x in con.execute(S.word_frequency("text", "docs")).fetchall())
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = sorted((r["word"], r["count"], round(r["weight"], 6))
                 for r in NG.word_frequencies(df, "text").collect())
    assert got == want


def test_top_ngrams_pruned_by_slots_is_exact(spark):
    """Any number of slots, down to one, gives the counts of a full aggregate."""
    rows = [(" ".join(f"w{(i * j) % 7}" for j in range(1, 30)),) for i in range(1, 40)] + [(None,), ("",), ("one two",)]
    df = spark.createDataFrame(rows, "t string").repartition(3)
    full = sorted(((-r["count"], r["ngram"]) for r in NG.ngram_counts(df, "t", 3, ()).collect()))
    for k in (1, 5, len(full), len(full) + 10):
        for slots in (1, 4, NG.SLOTS):
            got = [(-r["count"], r["ngram"]) for r in NG.top_ngrams(df, "t", 3, k, (), slots=slots).collect()]
            assert got == full[:k]
    assert NG.top_ngrams(df.where("false"), "t", 3).count() == 0
