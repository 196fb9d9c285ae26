"""Plan-shape regressions: costly per-row expressions are evaluated once."""

from revspark.functions import text as TX
from revspark.operators import prep as PR
from revspark.operators.rows import explode_rows


def _regex_calls(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace")


def test_prepare_training_does_not_rerun_cleaning(spark):
    raw = spark.createDataFrame([("Great app!!", "POSITIVE"), ("  ", "NEGATIVE"), (None, "NEGATIVE")],
                                "review_text string, sentiment string")
    cleaned = PR.clean_corpus(raw, "review_text")
    prepared = PR.prepare_training(cleaned, "cleaned_text", "sentiment")
    # only the blank test of prepare_training itself is added
    assert _regex_calls(prepared) == _regex_calls(cleaned) + 1
    assert [r["cleaned_text"] for r in prepared.collect()] == ["great app"]


def test_explode_rows_keeps_cleaning_single(spark):
    raw = spark.createDataFrame([("Apps crash, apps crash",), ("",)], "text string")
    toks = raw.select(TX.clean_tokens("text").alias("t"))
    exploded = explode_rows(toks, "t", "w")
    assert _regex_calls(exploded) == _regex_calls(toks)
    assert sorted(r["w"] for r in exploded.collect()) == ["apps", "apps", "crash", "crash"]
