"""FIXTURES 2: literal rows through F1, F7-F11 in Spark and in DuckDB."""

import duckdb
import pytest
from pyspark.sql import functions as F

from revspark.functions import labels as LB
from revspark.functions import lexicon as L
from revspark.functions import text as TX
from revspark.operators import prep as PR
from revspark.plans import sqlfrag as S

ROWS = [
    (1, "Please fix the login. It is slow! Thanks", "5"),
    (2, "The prefix works well", "4"),
    (3, "You must add dark mode", "2"),
    (4, "नमस्ते app", "1"),
    (5, "👍👍", "5"),
    (6, None, "3"),
    (7, "   ", None),
    (8, "I cannot log in, don't know why", "x"),
    (9, "Café naïve x² 1_a", "4.7"),
    (10, "fixé est cassé", " 4 "),
    (11, "Would be better if fast? Needs work.  Hope you read", "3"),
    (12, "the and of", "2"),
    (13, 'slow\nnet, "quoted"', "1"),
]

CLEAN = {1: "please fix login slow thanks", 8: "log dont know", 9: "café naïve x² 1_a",
         13: "slow net quoted", 3: "must add dark mode", 2: "prefix works well",
         10: "fixé est cassé", 11: "would better fast needs work hope read"}
LABEL = {1: "positive", 2: "positive", 3: "negative", 6: "neutral", 7: "unknown", 8: "unknown",
         9: "unknown", 10: "positive", 11: "neutral", 12: "negative", 13: "negative"}
FLAG = {1: 1, 2: 1, 3: 0, 10: 1, 11: 1, 8: 0, 9: 0, 12: 0, 13: 0}
EXTRACT = {1: "Please fix the login", 2: "", 3: "You must add dark mode", 10: "",
           11: "Would be better if fast | Needs work | Hope you read", 6: "", 7: ""}
KEPT = {1, 2, 3, 8, 9, 10, 11, 13}


@pytest.fixture(scope="module")
def fixture_df(spark):
    return spark.createDataFrame(ROWS, "id int, text string, rating string")


def _spark_rows(df):
    out = df.select(
        "id",
        TX.in_script("text").alias("script"),
        TX.clean_text("text").alias("clean"),
        LB.label_review("rating").alias("label"),
        TX.detect_suggestion("text").alias("flag"),
        TX.extract_suggestions("text").alias("extract"),
    )
    return {r["id"]: r.asDict() for r in out.collect()}


def test_fixture_rows_spark(fixture_df):
    got = _spark_rows(fixture_df)
    for i, want in CLEAN.items():
        assert got[i]["clean"] == want, i
    for i, want in LABEL.items():
        assert got[i]["label"] == want, i
    for i, want in FLAG.items():
        assert got[i]["flag"] == want, i
    for i, want in EXTRACT.items():
        assert got[i]["extract"] == want, i
    assert got[4]["script"] and not got[6]["script"]


def test_preprocess_keeps_expected_rows(fixture_df):
    out = PR.preprocess_reviews(fixture_df, "text", "rating")
    assert {r["id"] for r in out.collect()} == KEPT
    assert set(out.columns) >= {"cleaned_review", "label", "is_suggestion", "suggestion_text"}


def test_drop_reasons_account_for_every_row(fixture_df):
    counts = {r["reason"]: r["n"] for r in PR.drop_reasons(fixture_df, "text").collect()}
    assert counts == {"script": 1, "blank": 4, "kept": len(KEPT)}
    assert sum(counts.values()) == len(ROWS)


def test_clean_is_idempotent(fixture_df):
    once = fixture_df.select("id", TX.clean_text("text").alias("c"))
    twice = once.select("id", "c", TX.clean_text("c").alias("c2"))
    assert twice.filter(F.col("c") != F.col("c2")).count() == 0


def test_fixture_rows_match_duckdb(fixture_df):
    got = _spark_rows(fixture_df)
    values = ", ".join(
        "(" + ", ".join(["NULL" if v is None else (str(v) if isinstance(v, int) else S.q(v)) for v in r]) + ")"
        for r in ROWS)
    sql = f"""SELECT id, {S.clean_text('text')} AS clean, {S.label_review('rating')} AS label,
                     {S.detect_suggestion('text')} AS flag, {S.extract_suggestions('text')} AS extract,
                     {S.in_script('text', *L.DEVANAGARI)} AS script
              FROM (VALUES {values}) v(id, text, rating)"""
    for row in duckdb.sql(sql).fetchall():
        i, clean, label, flag, extract, script = row
        assert (clean, label, flag, extract, script) == (
            got[i]["clean"], got[i]["label"], got[i]["flag"], got[i]["extract"], got[i]["script"]), i


def test_keycap_and_info_emoji_removed(spark):
    df = spark.createDataFrame([("1️⃣ great ℹ️ app",)], "t string")
    assert df.select(TX.clean_text("t")).first()[0] == "great app"


def test_ngrams_expression(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"],), (["x"],)], "t array<string>")
    got = [r[0] for r in df.select(TX.ngrams("t", 3)).collect()]
    assert got == [["a b c", "b c d"], []]


def test_java_classes_equal_the_spelled_out_ones(spark):
    """Every code point, and texts that the guards of the costly regexes let through."""
    cps = spark.createDataFrame([(chr(i),) for i in range(0x110000) if not 0xD800 <= i < 0xE000], "c string")
    differ = [F.col("c").rlike(f"^{fast}$") != F.col("c").rlike(f"^{slow}$") for fast, slow in
              ((TX._FAST_SPACE_RUN, TX.SPACE_RUN), (TX._FAST_NOT_WORD_OR_SPACE, TX.NOT_WORD_OR_SPACE))]
    assert cps.where(differ[0] | differ[1]).count() == 0
    rows = ["I cannot go, gimme 5️⃣ stars ℹ️", "xcannot cannots can't", "⃣ wanna　gotta\x85go", "", None]
    t = F.lower(F.coalesce(F.col("t"), F.lit("")))
    t = F.regexp_replace(F.regexp_replace(t, TX.EMOJI_WORDLIKE, ""), TX.NOT_WORD_OR_SPACE, "")
    t = F.split(F.regexp_replace(t, TX._contraction_pattern(), "$1 "), TX.SPACE_RUN)
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    want = df.select(F.filter(t, lambda w: w != "").alias("x")).collect()
    assert df.select(TX.clean_tokens("t", ["-"]).alias("x")).collect() == want


def test_blank_test_tries_no_inner_white_space(spark):
    import time
    rows = [("",), (None,), (" \t\n\x0b\x1c\x1f\x85\u00a0\u2028\u2029\u3000",), (" x ",), ("\u200b",), ("\n\ud55c\n",)]
    got = spark.createDataFrame(rows, "s string").select(TX.is_blank("s")).collect()
    assert [r[0] for r in got] == [True, True, True, False, False, False]
    # a run of white space inside was tried from each of its places: quadratic
    long = spark.range(1).select(F.concat(F.lit("x"), F.repeat(F.lit(" "), 200_000), F.lit("x")).alias("s")).persist()
    long.count()
    at = time.time()
    assert not long.select(TX.is_blank("s")).first()[0]
    assert time.time() - at < 5
