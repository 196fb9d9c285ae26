import pytest

from revspark.functions import labels as LB
from revspark.functions import schema as SC


def test_label_normalization(spark):
    df = spark.createDataFrame([("pos",), ("NEG",), ("negativeative",), ("Positive",), ("neutral",), (None,)],
                               "l string")
    got = [r[0] for r in df.select(LB.normalize_label("l")).collect()]
    assert got == ["POSITIVE", "NEGATIVE", "NEGATIVE", "POSITIVE", "NEUTRAL", None]


def test_predicted_label_and_confidence(spark):
    df = spark.createDataFrame([(.5, .5), (.1, .9), (.87654, .12346), (.87655, .12345)], "p0 double, p1 double")
    got = [(r[0], r[1]) for r in df.select(LB.predicted_label("p0", "p1"), LB.confidence("p0", "p1")).collect()]
    assert got[:3] == [("NEGATIVE", .5), ("POSITIVE", .9), ("NEGATIVE", .8765)]
    assert got[3][1] == round(.87655 * 10000) / 10000  # half to even on the scaled value


def test_encode_label(spark):
    df = spark.createDataFrame([("POSITIVE",), ("NEGATIVE",), ("other",), (None,)], "s string")
    assert [r[0] for r in df.select(LB.encode_label("s")).collect()] == [1, 0, 0, 0]


@pytest.mark.parametrize("cols,want", [
    (["reviewId", "content"], "content"),
    (["id", "video_text"], "video_text"),
    (["uuid", "body"], "body"),
    (["x"], "x"),
])
def test_infer_text_column(cols, want):
    assert SC.infer_text_column(cols) == want


def test_infer_text_column_empty():
    with pytest.raises(SC.SchemaMismatch):
        SC.infer_text_column([])


def test_label_column_ignores_predictions():
    assert SC.label_column(["raw_review", "score"]) is None
    assert SC.label_column(["text", "Sentiment"]) == "Sentiment"
