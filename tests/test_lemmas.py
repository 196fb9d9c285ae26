"""both lookups against a plain dictionary, and the derived dictionary."""

import random

from revspark.operators import lemmas as LM

ROWS = [(1, ["apps", "app", "crashed", "crash", "apps"]), (2, ["loves", "love", "crash", "app", "app"]), (3, []), (4, None),
        (5, ["parties", "party", "class", "using", "use", None]), (6, ["running", "use", "love", "bus", "bu"]), (7, ["ünïts", "ünït", "s", "es"])]
SCHEMA = "doc_id long, tokens array<string>"


def brute_dictionary(rows):
    count = {}
    for _, tokens in rows:
        for t in tokens or ():
            count[t] = count.get(t, 0) + 1
    out = {}
    for t in filter(None, count):
        for suffix, other in LM.SUFFIXES:
            base = t.removesuffix(suffix) + other
            if t.endswith(suffix) and len(base) >= LM.MIN_BASE and count.get(base, 0) >= count[t]:
                out[t] = base
                break
    return out


def test_dictionary_and_both_lookups(spark):
    rng = random.Random(5)
    stems = ["walk", "us", "use", "car", "carry", "bake", "miss", "sing", "note"]
    rows = ROWS + [(i, [rng.choice(stems) + rng.choice(["", "", "s", "ed", "ing", "es", "ies"]) for _ in range(rng.randrange(30))]) for i in range(10, 60)]
    df = spark.createDataFrame(rows, SCHEMA)
    dictionary = LM.lemma_dictionary(df, "tokens")
    want = brute_dictionary(rows)
    assert len(want) > 5 and {r.token: r.lemma for r in dictionary.collect()} == want
    for limit in (LM.LITERAL_BYTES, 0):
        out = LM.lemmatize(df, "tokens", "doc_id", dictionary, literal_bytes=limit)
        assert out.columns == ["doc_id", "tokens", "lemmas"]
        assert {r.doc_id: r.lemmas for r in out.collect()} == {i: t and [want.get(x, x) for x in t] for i, t in rows}


def test_small_dictionary_shuffles_nothing(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    plan = LM.lemmatize(df, "tokens", "doc_id", LM.lemma_dictionary(df, "tokens"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    for limit in (LM.LITERAL_BYTES, -1):
        assert LM.lemmatize(df, "tokens", "doc_id", LM.lemma_dictionary(df, "tokens"), literal_bytes=limit).count() == 0


def test_lemmatize_reads_the_corpus_twice(spark):
    """Once for the dictionary, once for the result."""
    from pyspark.sql import functions as F
    calls = spark.sparkContext.accumulator(0)

    def seen(t):
        calls.add(1)
        return t.split(" ")

    df = spark.createDataFrame([(i, "walk walks walked run") for i in range(10)], "id int, t string")
    tokens = df.select("id", F.udf(seen, "array<string>")("t").alias("tokens"))
    got = LM.lemmatize(tokens, "tokens", "id", LM.lemma_dictionary(tokens, "tokens")).collect()
    assert [r["lemmas"] for r in got] == [["walk", "walk", "walk", "run"]] * 10
    assert calls.value == 20
