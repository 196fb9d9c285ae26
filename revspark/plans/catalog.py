"""Registered queries: one Spark plan per SURVEY 2 operator over the driver's
tables, and (where the operator is relational) an independent DuckDB SQL
oracle with identical column names.

Doubles are rounded to 6 places on both sides before hashing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as LB
from ..functions import lexicon as L
from ..functions import text as TX
from ..operators import features as FT
from ..operators import lemmas as LM
from ..operators import ngrams as NG
from ..operators import prep as PR
from ..operators import split as SP
from ..operators import stats as ST
from ..session import ensure_parallelism
from ..sources import tables as TB
from . import sqlfrag as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

R = 6  # rounding of doubles before comparison


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _r(c):
    return F.round(F.col(c) if isinstance(c, str) else c, R)


def _docs(spark, sf):
    return ensure_parallelism(TB.table(spark, sf, "documents"))


# SQL building blocks -------------------------------------------------------

_CLEAN = S.clean_text("text")
_CLEAN_LABELLED = f"""
labelled AS (
  SELECT d.doc_id, d.text,
         CASE WHEN l.quality = 1 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS sentiment
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
training AS (
  SELECT doc_id, cleaned_text, sentiment FROM (
    SELECT doc_id, sentiment, {S.clean_text('text')} AS cleaned_text FROM labelled
    WHERE NOT {S.in_script('text', *L.DEVANAGARI)})
  WHERE NOT {S.is_blank('cleaned_text')})"""
_VOCAB = f"""
vtok AS (SELECT doc_id, {S.vector_tokens('cleaned_text')} AS toks FROM training),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(toks) AS term FROM vtok)
       GROUP BY doc_id, term),
vocab AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY term
          ORDER BY total DESC, term ASC LIMIT 5000),
ndocs AS (SELECT count(*) AS n FROM training)"""


# --- F7 / F1 / F2 / G5 ------------------------------------------------------

@query("clean_text", f"SELECT doc_id, {_CLEAN} AS cleaned_text FROM documents")
def q_clean_text(spark, sf):
    return _docs(spark, sf).select("doc_id", TX.clean_text("text").alias("cleaned_text"))


@query("script_filter", f"""
SELECT doc_id, lang FROM documents WHERE NOT {S.in_script('text', *TB.CORPUS_SCRIPT)}""")
def q_script_filter(spark, sf):
    return PR.script_filter(_docs(spark, sf), "text", TB.CORPUS_SCRIPT).select("doc_id", "lang")


@query("blank_filter", f"""
SELECT doc_id, cleaned_text FROM (SELECT doc_id, {_CLEAN} AS cleaned_text FROM documents)
WHERE NOT {S.is_blank('cleaned_text')}""")
def q_blank_filter(spark, sf):
    return PR.blank_filter(PR.with_clean_text(_docs(spark, sf), "text")).select("doc_id", "cleaned_text")


@query("drop_reasons", f"""
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN {S.in_script('text', *TB.CORPUS_SCRIPT)} THEN 'script'
              WHEN {S.is_blank(_CLEAN)} THEN 'blank' ELSE 'kept' END AS reason
  FROM documents) GROUP BY reason""")
def q_drop_reasons(spark, sf):
    return PR.drop_reasons(_docs(spark, sf), "text", TB.CORPUS_SCRIPT)


@query("stage_counts", f"""
WITH r AS (SELECT CASE WHEN {S.in_script('text', *TB.CORPUS_SCRIPT)} THEN 'script'
                       WHEN {S.is_blank(_CLEAN)} THEN 'blank' ELSE 'kept' END AS reason
           FROM documents),
c AS (SELECT count(*) AS loaded, count(*) FILTER (WHERE reason <> 'script') AS script_filtered,
             count(*) FILTER (WHERE reason = 'kept') AS final FROM r)
SELECT 'loaded' AS stage, loaded AS "rows" FROM c
UNION ALL SELECT 'script_filtered', script_filtered FROM c
UNION ALL SELECT 'final', final FROM c""")
def q_stage_counts(spark, sf):
    return PR.stage_counts(_docs(spark, sf), "text", TB.CORPUS_SCRIPT)


# --- F13 ---------------------------------------------------------------------

_RULES_SQL = ", ".join(f"({i}, '{s}', '{r}')" for i, (s, r) in enumerate(LM.SUFFIXES))


@query("lemmatize", f"""
WITH c AS (SELECT doc_id, {_CLEAN} AS t FROM documents),
tok AS (SELECT doc_id, unnest(string_split(t, ' ')) AS w, generate_subscripts(string_split(t, ' '), 1) AS pos FROM c WHERE t <> ''),
voc AS (SELECT w, count(*) AS n FROM tok GROUP BY w),
cand AS (SELECT w, n, rule, left(w, length(w) - length(suffix)) || other AS base
         FROM voc JOIN (VALUES {_RULES_SQL}) AS r(rule, suffix, other) ON suffix(w, suffix)),
dict AS (SELECT cand.w, arg_min(base, rule) AS lemma FROM cand JOIN voc ON voc.w = base AND voc.n >= cand.n
         WHERE length(base) >= {LM.MIN_BASE} GROUP BY cand.w),
done AS (SELECT doc_id, string_agg(coalesce(lemma, tok.w), ' ' ORDER BY pos) AS lemmas
         FROM tok LEFT JOIN dict ON dict.w = tok.w GROUP BY doc_id)
SELECT doc_id, coalesce(lemmas, '') AS lemmas FROM c LEFT JOIN done USING (doc_id)""")
def q_lemmatize(spark, sf):
    """cleaned text by lemmas, with a dictionary derived from the corpus."""
    tokens = _docs(spark, sf).select("doc_id", TX.clean_tokens("text").alias("tokens"))
    out = LM.lemmatize(tokens, "tokens", "doc_id", LM.lemma_dictionary(tokens, "tokens"))
    return out.select("doc_id", F.array_join("lemmas", " ").alias("lemmas"))


# --- F8 / F12 / F9 / F10 / F11 / G3 -------------------------------------------

@query("label_review", f"""
SELECT doc_id, rating, {S.label_review('rating')} AS label
FROM (SELECT doc_id, {TB.rating_sql()} AS rating FROM documents)""")
def q_label_review(spark, sf):
    d = TB.review_corpus(spark, sf)
    return d.select("doc_id", "rating", LB.label_review("rating").alias("label"))


_RAW_LABEL_SQL = """(CASE WHEN l.doc_id IS NULL THEN NULL
  WHEN l.quality = 1 AND l.toxic = 0 THEN 'pos' WHEN l.quality = 1 THEN 'Positive'
  WHEN l.toxic = 0 THEN 'NEG' ELSE 'negativeative' END)"""


def _raw_label():
    return (F.when(F.col("quality").isNull(), F.lit(None).cast("string"))
            .when((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit("pos"))
            .when(F.col("quality") == 1, F.lit("Positive"))
            .when(F.col("toxic") == 0, F.lit("NEG"))
            .otherwise(F.lit("negativeative")))


@query("label_normalize", f"""
SELECT doc_id, raw_label, {S.normalize_label('raw_label')} AS actual_sentiment FROM (
  SELECT d.doc_id, {_RAW_LABEL_SQL} AS raw_label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""")
def q_label_normalize(spark, sf):
    d = TB.table(spark, sf, "documents").select("doc_id")
    lab = TB.table(spark, sf, "labels")
    j = d.join(lab, "doc_id", "left").select("doc_id", _raw_label().alias("raw_label"))
    return j.select("doc_id", "raw_label", LB.normalize_label("raw_label").alias("actual_sentiment"))


@query("detect_suggestion", f"""
SELECT doc_id, {S.detect_suggestion('text', TB.CORPUS_KEYWORDS)} AS is_suggestion FROM documents""")
def q_detect_suggestion(spark, sf):
    return _docs(spark, sf).select(
        "doc_id", TX.detect_suggestion("text", TB.CORPUS_KEYWORDS).alias("is_suggestion"))


@query("extract_suggestions", f"""
SELECT doc_id, {S.extract_suggestions('text', TB.CORPUS_PHRASES)} AS suggestion_text FROM documents""")
def q_extract_suggestions(spark, sf):
    return _docs(spark, sf).select(
        "doc_id", TX.extract_suggestions("text", TB.CORPUS_PHRASES).alias("suggestion_text"))


@query("has_suggestion_count", f"""
SELECT CAST(sum(CASE WHEN NOT {S.is_blank('s')} THEN 1 ELSE 0 END) AS BIGINT) AS n_with_suggestion,
       count(*) AS n_total
FROM (SELECT {S.extract_suggestions('text', TB.CORPUS_PHRASES)} AS s FROM documents)""")
def q_has_suggestion_count(spark, sf):
    d = _docs(spark, sf).select(
        TX.has_suggestion(TX.extract_suggestions("text", TB.CORPUS_PHRASES)).alias("has_suggestion"))
    return ST.suggestion_count(d)


# --- batch preprocess (3.1) and training extract ----------------------------

_PREP_SQL = f"""
raw AS (SELECT doc_id, text, {TB.rating_sql()} AS rating FROM documents),
kept AS (SELECT * FROM raw WHERE NOT {S.in_script('text', *L.DEVANAGARI)}),
prep AS (
  SELECT doc_id, rating, {S.clean_text('text')} AS cleaned_review,
         {S.label_review('rating')} AS label,
         {S.detect_suggestion('text', TB.CORPUS_KEYWORDS)} AS is_suggestion,
         {S.extract_suggestions('text', TB.CORPUS_PHRASES)} AS suggestion_text
  FROM kept),
cleaned AS (SELECT * FROM prep WHERE NOT {S.is_blank('cleaned_review')})"""


def _preprocessed(spark, sf):
    d = ensure_parallelism(TB.review_corpus(spark, sf))
    return PR.preprocess_reviews(d, "review_text", "rating", L.DEVANAGARI,
                                 TB.CORPUS_KEYWORDS, TB.CORPUS_PHRASES)


@query("preprocess_reviews", f"""WITH {_PREP_SQL}
SELECT doc_id, rating, cleaned_review, label, is_suggestion, suggestion_text FROM cleaned""")
def q_preprocess(spark, sf):
    return _preprocessed(spark, sf).select("doc_id", "rating", "cleaned_review", "label",
                                           "is_suggestion", "suggestion_text")


@query("training_extract", f"""WITH {_PREP_SQL}
SELECT doc_id, cleaned_review AS cleaned_text, upper(label) AS sentiment FROM cleaned
WHERE label IN ('positive', 'negative')""")
def q_training_extract(spark, sf):
    return PR.training_extract(_preprocessed(spark, sf)).select("doc_id", "cleaned_text", "sentiment")


@query("preview_reviews", f"""WITH {_PREP_SQL}
SELECT doc_id, rating, cleaned_review, label FROM cleaned ORDER BY doc_id LIMIT 10""")
def q_preview_reviews(spark, sf):
    """A 10-row preview of the preprocessed reviews in a total order
    (the limit is the feature; a per-task top-k, never a global sort)."""
    p = _preprocessed(spark, sf).select("doc_id", "rating", "cleaned_review", "label")
    return PR.head_k(p, 10, "doc_id")


# --- labelled training corpus: G1 / G2 / F14 / M3 ----------------------------

def training_table(spark, sf) -> DataFrame:
    """(doc_id, cleaned_text, sentiment) of the labelled documents."""
    d = ensure_parallelism(TB.labelled_corpus(spark, sf))
    return PR.clean_corpus(d, "review_text").select("doc_id", "cleaned_text", "sentiment")


@query("class_counts", f"""WITH {_CLEAN_LABELLED}
SELECT sentiment, count(*) AS n FROM training GROUP BY sentiment""")
def q_class_counts(spark, sf):
    return ST.class_counts(training_table(spark, sf), "sentiment")


@query("class_proportions", f"""WITH {_CLEAN_LABELLED}
SELECT sentiment, round(count(*) / sum(count(*)) OVER (), {R}) AS share
FROM training WHERE sentiment IS NOT NULL GROUP BY sentiment""")
def q_class_proportions(spark, sf):
    p = ST.class_proportions(training_table(spark, sf), "sentiment")
    return p.select("sentiment", _r("share").alias("share"))


@query("encode_label", f"""WITH {_CLEAN_LABELLED}
SELECT doc_id, sentiment, CASE WHEN sentiment = 'POSITIVE' THEN 1 ELSE 0 END AS label FROM training""")
def q_encode_label(spark, sf):
    t = training_table(spark, sf)
    return t.select("doc_id", "sentiment", LB.encode_label("sentiment").alias("label"))


@query("stratified_split_sizes", f"""WITH {_CLEAN_LABELLED},
c AS (SELECT sentiment, count(*) AS n FROM training GROUP BY sentiment),
t AS (SELECT sum(n) AS total, CAST(ceil(0.2 * sum(n)) AS BIGINT) AS n_test FROM c),
a AS (SELECT c.sentiment, c.n, CAST(c.n * (t.total - t.n_test) AS DOUBLE) / t.total AS cont,
             t.total - t.n_test AS train_total FROM c, t),
b AS (SELECT *, floor(cont) AS fl FROM a),
r AS (SELECT *, row_number() OVER (ORDER BY cont - fl DESC, sentiment) AS rk,
             train_total - sum(fl) OVER () AS need FROM b)
SELECT sentiment, CAST(fl + CASE WHEN rk <= need THEN 1 ELSE 0 END AS BIGINT) AS n_train,
       CAST(n - fl - CASE WHEN rk <= need THEN 1 ELSE 0 END AS BIGINT) AS n_test FROM r""")
def q_split_sizes(spark, sf):
    split = SP.stratified_split(training_table(spark, sf), "sentiment", "doc_id", 0.2, 42)
    return SP.split_sizes(split, "sentiment")


@query("split_membership", f"""WITH {_CLEAN_LABELLED},
u AS (SELECT doc_id, sentiment, ('0x' || substr(md5('42:' || doc_id), 1, 15))::BIGINT AS u FROM training),
r AS (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY u, doc_id) AS rk FROM u),
c AS (SELECT sentiment, count(*) AS n FROM training GROUP BY sentiment),
t AS (SELECT sum(n) AS total, sum(n) - CAST(ceil(0.2 * sum(n)) AS BIGINT) AS n_train FROM c),
a AS (SELECT sentiment, n, floor(n * n_train / total) AS fl, (n * n_train / total) - floor(n * n_train / total) AS rest, n_train FROM c, t),
q AS (SELECT sentiment, n - fl - CASE WHEN row_number() OVER (ORDER BY rest DESC, sentiment) <= n_train - sum(fl) OVER ()
                                      THEN 1 ELSE 0 END AS n_test FROM a)
SELECT doc_id, rk <= n_test AS is_test FROM r JOIN q USING (sentiment)""")
def q_split_membership(spark, sf):
    """M3: which rows are the test rows."""
    return SP.stratified_split(training_table(spark, sf), "sentiment", "doc_id", 0.2, 42).select("doc_id", "is_test")


# --- publish flow: S2, S5-S7, S10, S11, F17 ------------------------------------

def _published(spark, name, df, checks):
    from ..session import scratch_path
    from ..sources import io as IO
    from ..sources.ledger import fresh_name
    return IO.replace_table(df, scratch_path(spark, fresh_name(f"tables/{name}")), checks)


@query("publish_cleaned", ORACLE["preprocess_reviews"])
def q_publish_cleaned(spark, sf):
    """S6 + S11: the cleaned reviews written, audited, published and read back."""
    return _published(spark, "cleaned", q_preprocess(spark, sf), {
        "text": ~TX.is_blank("cleaned_review"), "label": F.col("label").isin("positive", "neutral", "negative", "unknown"),
        "flag": F.col("is_suggestion").isin(0, 1)})


@query("publish_training", ORACLE["training_extract"])
def q_publish_training(spark, sf):
    """S6 + F5: the training table, published, then read by the training loader."""
    from ..session import scratch_path
    from ..sources import io as IO
    from ..sources.ledger import fresh_name
    path = scratch_path(spark, fresh_name("tables/training"))
    IO.replace_table(q_training_extract(spark, sf), path, {"sentiment": F.col("sentiment").isin(*LB.CLASSES)})
    return IO.prepare_clean_reviews_for_model(spark, path).select("doc_id", "cleaned_text", "sentiment")


@query("publish_suggestions", f"""WITH {_PREP_SQL},
s AS (SELECT doc_id, {S.extract_suggestions('cleaned_review', TB.CORPUS_PHRASES)} AS suggestion_text FROM cleaned)
SELECT doc_id, suggestion_text, trim(suggestion_text) <> '' AS has_suggestion FROM s""")
def q_publish_suggestions(spark, sf):
    """F10 + F11 on the published cleaned reviews, published in turn."""
    cleaned = q_publish_cleaned(spark, sf).select("doc_id", TX.extract_suggestions("cleaned_review", TB.CORPUS_PHRASES).alias("suggestion_text"))
    out = cleaned.withColumn("has_suggestion", TX.has_suggestion("suggestion_text"))
    return _published(spark, "suggestions", out, {"flag": F.col("has_suggestion").isNotNull()})


@query("append_reviews", f"""SELECT CAST(event_id AS VARCHAR) AS review_id, props AS review_text,
       {TB.FEED_RATING_SQL} AS rating, ts AS date FROM events""")
def q_append_reviews(spark, sf):
    """A landed JSON feed appended twice; the table holds each review once."""
    from ..session import scratch_path
    from ..sources import io as IO
    from ..sources.ledger import fresh_name
    base = scratch_path(spark, fresh_name("tables/raw"))
    e = TB.table(spark, sf, "events")
    rating = (F.lit(1) + F.floor("value").cast("int") % 5).cast("int")
    feed = e.select(F.col("event_id").cast("string").alias("reviewId"), F.col("user_id").cast("string").alias("userName"),
                    rating.alias("score"), F.col("ts").alias("at"), F.col("props").alias("content"), F.lit("").alias("replyContent"))
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    feed.write.option("timestampFormat", iso).option("timestampNTZFormat", iso).json(f"{base}-feed")
    landed = IO.read_review_feed(spark, f"{base}-feed")
    for _ in range(2):
        IO.append_reviews(landed, base)
    return IO.read_table(spark, base).select("review_id", "review_text", "rating", "date")


@query("csv_round_trip", """SELECT 'd' || doc_id AS id, md5(text) AS text_md5, lang, n_chars AS number, NULL::TIMESTAMP AS ts FROM documents
UNION ALL SELECT 'e' || event_id, md5(props), event_type, user_id, ts FROM events""")
def q_csv_round_trip(spark, sf):
    """S4 + S5 + F17: documents and events through one lossless CSV."""
    from ..session import scratch_path
    from ..sources import io as IO
    from ..sources.ledger import fresh_name
    d = TB.table(spark, sf, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), "text", "lang", F.col("n_chars").alias("number"),
                                                F.lit(None).cast(TB.table(spark, sf, "events").schema["ts"].dataType).alias("ts"))
    e = TB.table(spark, sf, "events").select(F.concat(F.lit("e"), "event_id").alias("id"), F.col("props").alias("text"),
                                             F.col("event_type").alias("lang"), F.col("user_id").alias("number"), "ts")
    both = d.unionByName(e)
    path = scratch_path(spark, fresh_name("csv"))
    IO.write_text_csv(both, path)
    return IO.read_text_csv(spark, path, both.schema).select("id", F.md5("text").alias("text_md5"), "lang", "number", "ts")


# --- M1 / M2 / G7 / M4 --------------------------------------------------------

def _ngram_sql(n: int, k: int = 25) -> str:
    return f"""
WITH c AS (SELECT {_CLEAN} AS cleaned_text FROM documents),
t AS (SELECT {S.ngram_tokens('cleaned_text')} AS toks FROM c),
g AS (SELECT unnest({S.ngrams('toks', n)}) AS ngram FROM t)
SELECT ngram, count(*) AS count FROM g GROUP BY ngram ORDER BY count DESC, ngram ASC LIMIT {k}"""


def _cleaned_docs(spark, sf):
    return _docs(spark, sf).select("doc_id", TX.clean_text("text").alias("cleaned_text"))


@query("top_bigrams", _ngram_sql(2))
def q_top_bigrams(spark, sf):
    return NG.top_ngrams(_cleaned_docs(spark, sf), "cleaned_text", 2, 25)


@query("top_trigrams", _ngram_sql(3))
def q_top_trigrams(spark, sf):
    return NG.top_ngrams(_cleaned_docs(spark, sf), "cleaned_text", 3, 25)


@query("text_profile", f"""WITH {_CLEAN_LABELLED}, {_VOCAB},
p AS (SELECT {S.vector_tokens(_CLEAN)} AS toks FROM documents),
d AS (SELECT len(toks) AS len,
             CASE WHEN len(toks) > 0 THEN
               CAST(len(list_filter(toks, lambda w: NOT list_contains(v.terms, w))) AS DOUBLE) / len(toks)
             END AS oov
      FROM p, (SELECT list(term) AS terms FROM vocab) v)
SELECT count(*) AS doc_count, round(avg(len), {R}) AS len_mean,
       round(quantile_cont(len, 0.5), {R}) AS len_p50, round(quantile_cont(len, 0.95), {R}) AS len_p95,
       round(avg(oov), {R}) AS oov_mean, round(quantile_cont(oov, 0.95), {R}) AS oov_p95,
       count(*) FILTER (WHERE len = 0) AS empty_docs
FROM d""")
def q_text_profile(spark, sf):
    vocab = _profile_vocabulary(spark, sf)
    docs = _docs(spark, sf).select(TX.vector_tokens(TX.clean_text("text")).alias("t"))
    return _rounded_profile(ST.text_profile(docs, "t", vocab.terms))


def _profile_vocabulary(spark, sf):
    train = training_table(spark, sf).select("doc_id", TX.vector_tokens("cleaned_text").alias("t"))
    return FT.fit_vocabulary(train, "t", 5000)


def _rounded_profile(p):
    return p.select("doc_count", *[_r(c).alias(c) for c in
                                   ("len_mean", "len_p50", "len_p95", "oov_mean", "oov_p95")],
                    "empty_docs")


@query("tfidf_weights", f"""WITH {_CLEAN_LABELLED}, {_VOCAB},
w AS (SELECT tf.doc_id, tf.term,
             tf.tf * (ln((1 + ndocs.n) / (1 + vocab.df)) + 1) AS w
      FROM tf JOIN vocab ON tf.term = vocab.term, ndocs)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), {R}) AS tfidf FROM w""")
def q_tfidf_weights(spark, sf):
    train = training_table(spark, sf).select("doc_id", TX.vector_tokens("cleaned_text").alias("t"))
    vocab = FT.fit_vocabulary(train, "t", 5000)
    w = FT.tfidf_weights(train, "t", vocab, "doc_id")
    return w.select("doc_id", "term", _r("tfidf").alias("tfidf"))


@query("tfidf_vectors", ORACLE["tfidf_weights"])
def q_tfidf_vectors(spark, sf):
    """M4: the fitted model's own vectors, term by term."""
    from ..operators import linear as LN
    from ..operators import models as MD
    train = training_table(spark, sf).persist()
    feats, vocab = MD.fit_tfidf(train, "cleaned_text")
    w = LN.tfidf_terms(feats, vocab, train, "doc_id")
    train.unpersist()
    return w.select("doc_id", "term", _r("tfidf").alias("tfidf"))


_SPLIT_SQL = ORACLE["split_membership"].split("SELECT doc_id, rk <= n_test AS is_test", 1)[0]


@query("naive_bayes_predict", f"""{_SPLIT_SQL.rstrip()},
member AS (SELECT r.doc_id, r.sentiment, cleaned_text, rk <= n_test AS is_test
           FROM r JOIN q USING (sentiment) JOIN training USING (doc_id)),
tok AS (SELECT doc_id, sentiment, is_test, unnest({S.vector_tokens('cleaned_text')}) AS term FROM member),
vocab AS (SELECT term FROM tok WHERE NOT is_test GROUP BY term ORDER BY count(*) DESC, term LIMIT 5000),
size AS (SELECT count(*) AS v FROM vocab),
cls AS (SELECT sentiment, ln(count(*) / sum(count(*)) OVER ()) AS prior FROM member WHERE NOT is_test GROUP BY sentiment),
cnt AS (SELECT sentiment, term, count(*) AS n FROM tok JOIN vocab USING (term) WHERE NOT is_test GROUP BY ALL),
tot AS (SELECT sentiment, sum(n) AS total FROM cnt GROUP BY sentiment),
wt AS (SELECT cls.sentiment AS label, vocab.term, ln((coalesce(n, 0) + 1.0) / (total + v)) AS weight
       FROM cls CROSS JOIN vocab CROSS JOIN size JOIN tot ON tot.sentiment = cls.sentiment
       LEFT JOIN cnt ON cnt.sentiment = cls.sentiment AND cnt.term = vocab.term),
sc AS (SELECT doc_id, label, sum(weight) AS s FROM tok JOIN wt USING (term) WHERE is_test GROUP BY ALL),
al AS (SELECT m.doc_id, m.sentiment, cls.sentiment AS label, prior + coalesce(s, 0) AS score
       FROM member m CROSS JOIN cls LEFT JOIN sc ON sc.doc_id = m.doc_id AND sc.label = cls.sentiment WHERE m.is_test)
SELECT doc_id, any_value(sentiment) AS actual, arg_max(label, score) AS predicted, round(max(score), 4) AS score FROM al GROUP BY doc_id""")
def q_naive_bayes(spark, sf):
    """M9: naive Bayes in closed form, fitted on the train rows, applied to the test rows."""
    from ..operators import linear as LN
    t = training_table(spark, sf).select("doc_id", "sentiment", TX.vector_tokens("cleaned_text").alias("t")).persist()
    split = SP.stratified_split(t, "sentiment", "doc_id", 0.2, 42)
    train, test = split.where("not is_test"), split.where("is_test")
    vocab = FT.fit_vocabulary(train, "t", 5000)
    got = LN.naive_bayes_predict(test, "t", "doc_id", LN.naive_bayes_weights(train, "t", "sentiment", vocab))
    return got.join(test.select("doc_id", F.col("sentiment").alias("actual")), "doc_id").select(
        "doc_id", "actual", F.col("label").alias("predicted"), F.round("score", 4).alias("score"))


# --- metric fixtures: F15 / F16 / G8 / G9 / G10 -------------------------------

@query("predicted_label", f"""
SELECT doc_id, CASE WHEN p1 > 1.0 - p1 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS predicted_label
FROM (SELECT doc_id, {TB.P_POSITIVE_SQL} AS p1 FROM labels)""")
def q_predicted_label(spark, sf):
    m = TB.metric_fixture(spark, sf)
    return m.select("doc_id", LB.predicted_label("p0", "p1").alias("predicted_label"))


@query("confidence", f"""
SELECT doc_id, {S.round_half_even('greatest(p1, 1.0 - p1)')} AS confidence
FROM (SELECT doc_id, {TB.P_POSITIVE_SQL} AS p1 FROM labels)""")
def q_confidence(spark, sf):
    m = TB.metric_fixture(spark, sf)
    return m.select("doc_id", LB.confidence("p0", "p1").alias("confidence"))


@query("accuracy", f"""
SELECT round(coalesce(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 0.0), {R}) AS accuracy
FROM labels""")
def q_accuracy(spark, sf):
    return ST.accuracy(TB.metric_fixture(spark, sf)).select(_r("accuracy").alias("accuracy"))


@query("log_loss", f"""
SELECT round(avg(-ln(least(greatest(CASE WHEN quality = 1 THEN p1 ELSE 1.0 - p1 END, 1e-15),
                                    1.0 - 1e-15))), {R}) AS log_loss
FROM (SELECT quality, {TB.P_POSITIVE_SQL} AS p1 FROM labels)""")
def q_log_loss(spark, sf):
    return ST.log_loss(TB.metric_fixture(spark, sf)).select(_r("log_loss").alias("log_loss"))


@query("confusion_matrix", """
WITH cells AS (SELECT a, p FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(a, p))
SELECT cells.a AS actual, cells.p AS predicted, count(l.doc_id) AS n
FROM cells LEFT JOIN labels l ON l.quality = cells.a AND l.toxic = cells.p
GROUP BY cells.a, cells.p""")
def q_confusion(spark, sf):
    return ST.confusion_matrix(TB.metric_fixture(spark, sf))


# --- feed: T1 / G11 / A4 / A1 / J1 ---------------------------------------------

_FEED_SQL = f"""feed AS (SELECT event_id AS review_id, ts AS "at", user_id,
  {TB.FEED_RATING_SQL} AS rating FROM events)"""


@query("latest_reviews", f"""WITH {_FEED_SQL}
SELECT review_id, "at", user_id, rating FROM feed ORDER BY "at" DESC, review_id ASC LIMIT 100""")
def q_latest(spark, sf):
    f = TB.review_feed(spark, sf)
    return PR.latest_n(f, 100, "at", "review_id").select("review_id", "at", "user_id", "rating")


@query("sentiment_by_day", f"""WITH {_FEED_SQL},
c AS (SELECT date_trunc('day', "at") AS period, {S.label_review('rating')} AS label, count(*) AS n
      FROM feed GROUP BY 1, 2)
SELECT period, label, n, round(n / sum(n) OVER (PARTITION BY period), {R}) AS share FROM c""")
def q_sentiment_by_day(spark, sf):
    s = ST.sentiment_by_period(TB.review_feed(spark, sf), "at", "label", "day")
    return s.select("period", "label", "n", _r("share").alias("share"))


@query("rolling_rates", f"""WITH {_FEED_SQL},
l AS (SELECT "at", {S.label_review('rating')} AS label FROM feed),
x AS (SELECT date_trunc('day', "at") - to_days(CAST(k AS INTEGER)) AS window_start, label
      FROM l, range(0, 7) r(k))
SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, count(*) AS n,
       round(avg(CASE WHEN label = 'negative' THEN 1.0 ELSE 0.0 END), {R}) AS negative_rate,
       round(avg(CASE WHEN label = 'positive' THEN 1.0 ELSE 0.0 END), {R}) AS positive_rate
FROM x GROUP BY window_start""")
def q_rolling_rates(spark, sf):
    r = ST.rolling_rates(TB.review_feed(spark, sf), "at", "label")
    return r.select("window_start", "window_end", "n", _r("negative_rate").alias("negative_rate"),
                    _r("positive_rate").alias("positive_rate"))


@query("feed_dedupe", f"""WITH {_FEED_SQL},
refetch AS (SELECT event_id AS review_id, ts + INTERVAL 1 HOUR AS "at", user_id,
  CAST(1 + (CAST(floor(value) AS INTEGER) + 1) % 5 AS INTEGER) AS rating FROM events),
u AS (SELECT * FROM feed UNION ALL SELECT * FROM refetch)
SELECT review_id, arg_max("at", "at") AS "at", arg_max(user_id, "at") AS user_id,
       arg_max(rating, "at") AS rating FROM u GROUP BY review_id""")
def q_feed_dedupe(spark, sf):
    f = TB.review_feed(spark, sf).select("review_id", "at", "user_id", "rating")
    e = TB.table(spark, sf, "events")
    refetch = e.select(F.col("event_id").alias("review_id"),
                       (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("at"), "user_id",
                       (F.lit(1) + (F.floor("value").cast("int") + 1) % 5).cast("int").alias("rating"))
    return PR.dedupe_latest(f.unionByName(refetch), "review_id", "at")


@query("join_back", f"""
WITH c AS (SELECT doc_id, {_CLEAN} AS cleaned_text FROM documents)
SELECT d.doc_id, d.lang, d.source, d.n_chars, c.cleaned_text
FROM documents d JOIN c ON d.doc_id = c.doc_id WHERE NOT {S.is_blank('c.cleaned_text')}""")
def q_join_back(spark, sf):
    raw = TB.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    processed = PR.blank_filter(PR.with_clean_text(_docs(spark, sf), "text")).select("doc_id", "cleaned_text")
    return PR.join_back(raw, processed, "doc_id")


# --- model jobs (rows-only: no SQL form) -------------------------------------

def _trained(spark, sf, model_path: str | None = None):
    from .train import train_sentiment
    return train_sentiment(training_table(spark, sf), key_col="doc_id", model_path=model_path)


@query("train_predict")
def q_train_predict(spark, sf):
    """M3-M6: held-out predictions of the TF-IDF + LR model."""
    res = _trained(spark, sf)
    return res.test_predictions.select("doc_id", "predicted_label", "confidence",
                                       F.col("sentiment").alias("actual_sentiment"))


@query("model_metrics")
def q_model_metrics(spark, sf):
    """G8-G10 on the held-out split: accuracy, log loss, cells, P/R/F1."""
    m = _trained(spark, sf).metrics
    return m.select("n", *[_r(c).alias(c) for c in ("accuracy", "log_loss", "precision", "recall", "f1")],
                    "tp", "fp", "fn", "tn")


@query("lr_gradient")
def q_lr_gradient(spark, sf):
    """M5: the fitted model's gradient, from sums over the stored features."""
    from ..operators.linear import fit_certificate
    res = _trained(spark, sf)
    got = fit_certificate(res.model, res.split.where("not is_test"))
    return got.select("n_features", (F.col("max_abs_gradient") < 1e-2 * F.col("gradient_at_zero")).alias("optimal"))


@query("score_reviews")
def q_score_reviews(spark, sf):
    """M7 + S9: train, save, reload, then score the whole documents table.
    documents has no label column, so there is no actual_sentiment (Q1)."""
    from ..session import scratch_path
    from .score import score_reviews
    import uuid
    path = scratch_path(spark, f"models/sentiment-{uuid.uuid4().hex[:12]}")
    _trained(spark, sf, model_path=path)
    res = score_reviews(_docs(spark, sf), path, keep=("doc_id",))
    return res.predictions


@query("score_labelled", f"""
SELECT doc_id, actual_sentiment, coalesce(actual_sentiment IN ('POSITIVE', 'NEGATIVE'), false) AS evaluated,
       count(*) FILTER (WHERE actual_sentiment IN ('POSITIVE', 'NEGATIVE')) OVER () AS n_evaluated, true AS accuracy_agrees FROM (
  SELECT doc_id, {S.normalize_label('raw_label')} AS actual_sentiment FROM (
    SELECT d.doc_id, d.text, {_RAW_LABEL_SQL} AS raw_label, {S.clean_text('text')} AS cleaned_text
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
  WHERE NOT {S.in_script('text', *L.DEVANAGARI)} AND NOT {S.is_blank('cleaned_text')})""")
def q_score_labelled(spark, sf):
    """M7 + F6: a source with labels of its own, scored by the saved model.
    Every row is predicted; accuracy counts rows with a valid label only."""
    import uuid
    from ..session import scratch_path
    from .score import score_reviews
    path = scratch_path(spark, f"models/sentiment-{uuid.uuid4().hex[:12]}")
    _trained(spark, sf, model_path=path)
    source = (_docs(spark, sf).select("doc_id", F.col("text").alias("review_text"))
              .join(TB.table(spark, sf, "labels"), "doc_id", "left")
              .select("doc_id", "review_text", _raw_label().alias("sentiment")))
    res = score_reviews(source, path, text_col="review_text", keep=("doc_id",))
    out = scratch_path(spark, f"scored/labelled-{uuid.uuid4().hex[:12]}")
    evaluated = F.coalesce(F.col("actual_sentiment").isin(*LB.CLASSES), F.lit(False))
    res.predictions.withColumn("evaluated", evaluated).write.parquet(out)
    p = spark.read.parquet(out).where(F.col("predicted_label").isin(*LB.CLASSES) & F.col("confidence").between(0.5, 1.0))
    n, right = p.where("evaluated").agg(F.count(F.lit(1)), F.avg((F.col("predicted_label") == F.col("actual_sentiment")).cast("int"))).first()
    agrees = abs(res.accuracy.first()["accuracy"] - (right or 0.0)) < 1e-9
    res.scored.unpersist()
    return p.select("doc_id", "actual_sentiment", "evaluated", F.lit(n).cast("long").alias("n_evaluated"),
                    F.lit(agrees).alias("accuracy_agrees"))


@query("model_comparison")
def q_model_comparison(spark, sf):
    """M9: LR, naive Bayes, linear SVM, random forest on the same split."""
    from ..operators.models import compare_models
    from ..operators.split import stratified_split
    t = PR.prepare_training(training_table(spark, sf)).withColumn("label", LB.encode_label("sentiment"))
    split = stratified_split(t, "label", "doc_id", 0.2, 42)
    return compare_models(split.filter(~F.col("is_test")), split.filter(F.col("is_test")),
                          "cleaned_text", "label")


@query("cluster_text")
def q_cluster_text(spark, sf):
    """M8: TF-IDF(500, English stopwords) -> PCA(2) -> KMeans(2) per document."""
    from ..operators.models import cluster_text
    c = PR.clean_corpus(_docs(spark, sf), "text").select("doc_id", "cleaned_text").persist()    # read by the vocabulary and the features
    out = cluster_text(c, "cleaned_text", "doc_id", k=2, max_features=500, seed=42)
    c.unpersist()
    return out


# --- streaming jobs -------------------------------------------------------------

@query("stream_dedupe", f"""WITH {_FEED_SQL}
SELECT review_id, "at", user_id, rating, {S.label_review('rating')} AS label FROM feed""")
def q_stream_dedupe(spark, sf):
    """A1: the feed ingested twice; the stream keeps one row per review."""
    from ..streaming import feed as SF
    path = f"{sf.rstrip('/')}/events.parquet"
    twice = SF.events_as_feed(SF.read_stream(spark, SF.stream_path(path), SF.EVENTS_SCHEMA)).unionByName(
        SF.events_as_feed(SF.read_stream(spark, SF.stream_path(path), SF.EVENTS_SCHEMA)))
    return SF.run_sink(SF.dedupe_feed(twice), spark, "dedupe")


@query("stream_score")
def q_stream_score(spark, sf):
    """A2: saved model applied to the documents stream."""
    from ..streaming import feed as SF
    model = _trained(spark, sf).model
    docs = SF.read_stream(spark, SF.stream_path(f"{sf.rstrip('/')}/documents.parquet"), SF.DOCUMENTS_SCHEMA)
    return SF.run_sink(SF.score_stream(docs, model), spark, "score")


def _event_stream(spark, sf):
    from ..streaming import feed as SF
    return SF.read_stream(spark, SF.stream_path(f"{sf.rstrip('/')}/events.parquet"), SF.EVENTS_SCHEMA)


@query("stream_ingest_exact", ORACLE["feed_dedupe"])
def q_stream_ingest_exact(spark, sf):
    """A1: feed and refetch in one stream; the target keeps the latest copies."""
    from ..streaming import feed as SF
    e = _event_stream(spark, sf)
    refetch = e.select(F.col("event_id").alias("review_id"), (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("at"), "user_id",
                       (F.lit(1) + (F.floor("value").cast("int") + 1) % 5).cast("int").alias("rating"))
    both = SF.events_as_feed(e).select(*refetch.columns).unionByName(refetch)
    base = SF.stream_dir(spark, "ingest")
    SF.run_to_completion(SF.ingest_exact(both, f"{base}/out", f"{base}/ckpt"))
    return SF.read_ingested(spark, f"{base}/out")


@query("stream_window_counts", f"""WITH {_FEED_SQL}
SELECT date_trunc('day', "at") AS window_start, date_trunc('day', "at") + INTERVAL 1 DAY AS window_end,
       {S.label_review('rating')} AS label, count(*) AS n FROM feed GROUP BY 1, 2, 3""")
def q_stream_window_counts(spark, sf):
    """A3: daily sentiment counts over the feed stream, open windows included."""
    from ..streaming import feed as SF
    counts = SF.window_counts(SF.events_as_feed(_event_stream(spark, sf)))
    return SF.run_upserts(counts, spark, "window_counts", ["window_start", "window_end", "label"])


@query("stream_rolling_rates", ORACLE["rolling_rates"])
def q_stream_rolling_rates(spark, sf):
    """A4: 7-day rates sliding by a day over the feed stream."""
    from ..streaming import feed as SF
    r = SF.rolling_rates(SF.events_as_feed(_event_stream(spark, sf)), spark)
    return r.select("window_start", "window_end", "n", _r("negative_rate").alias("negative_rate"),
                    _r("positive_rate").alias("positive_rate"))


@query("stream_profile", ORACLE["text_profile"])
def q_stream_profile(spark, sf):
    """A5: per-micro-batch text profile appended idempotently."""
    from ..streaming import feed as SF
    base = SF.stream_dir(spark, "profile")
    docs = SF.read_stream(spark, SF.stream_path(f"{sf.rstrip('/')}/documents.parquet"), SF.DOCUMENTS_SCHEMA)
    vocab = _profile_vocabulary(spark, sf)
    SF.run_to_completion(SF.profile_batches(docs, f"{base}/out", f"{base}/ckpt", vocab_terms=vocab.terms, stream="documents"))
    return _rounded_profile(spark.read.parquet(f"{base}/out"))


# --- M2: word-cloud table ------------------------------------------------------

@query("word_frequency", S.word_frequency("cleaned_text", f"(SELECT {_CLEAN} AS cleaned_text FROM documents) c"))
def q_word_frequency(spark, sf):
    """M2: word-cloud table (word, count, weight) of the cleaned corpus."""
    c = _cleaned_docs(spark, sf)
    f = NG.word_frequencies(c, "cleaned_text", max_words=200)
    return f.select("word", "count", _r("weight").alias("weight"))
