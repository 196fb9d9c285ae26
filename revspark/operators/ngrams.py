"""Corpus term statistics: top n-grams (M1) and the word-frequency table
behind the word cloud (M2).

Both explode per-row arrays and aggregate with map-side combining, so a
hot n-gram or word is summed in every task before the shuffle; the top-k
step is a ``TakeOrderedAndProject`` (per-task top-k, merged), never a
global sort or a driver-side concatenation of the corpus.  Most n-grams of
a corpus are distinct, so ``top_ngrams`` first counts all of them per hash
slot and shuffles as strings only those whose slot can reach the top k.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as TX
from .rows import explode_rows

SLOTS = 1 << 20         # hash slots of the n-gram counts that prune the exact ones


def _token_rows(df: DataFrame, text_col: str, stopwords: Iterable[str]) -> DataFrame:
    return df.select(TX.ngram_tokens(text_col, stopwords).alias("_t"))


def _ngram_rows(toks: DataFrame, n: int) -> DataFrame:
    return explode_rows(toks.select(TX.ngrams("_t", n).alias("_g")), "_g", "ngram")


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("ngram").agg(F.count(F.lit(1)).alias("count"))


def ngram_counts(df: DataFrame, text_col: str, n: int,
                 stopwords: Iterable[str] = L.SKLEARN_ENGLISH) -> DataFrame:
    """Corpus totals of n-grams (column sums of the count matrix)."""
    return _counted(_ngram_rows(_token_rows(df, text_col, stopwords), n))


def top_ngrams(df: DataFrame, text_col: str, n: int = 2, k: int = 25,
               stopwords: Iterable[str] = L.SKLEARN_ENGLISH, slots: int = SLOTS) -> DataFrame:
    """M1 + T2: the k most frequent n-grams; ties by n-gram ascending.

    Exact: every n-gram is counted into one of ``slots`` hash slots, and no
    n-gram is more frequent than its slot.  The n-grams of slots with at least
    half the count of the k-th fullest are counted exactly; if the k-th of
    those counts is lower, it is still a floor that the true top k reach, and
    the n-grams of all slots that reach it are counted exactly in turn (all
    slots, if there were fewer than k n-grams).

    The tokens are persisted, so a text is analysed once; the result is at
    most k rows and is brought back to release them."""
    spark = df.sparkSession
    toks = _token_rows(df, text_col, stopwords).persist()
    rows = _ngram_rows(toks, n).withColumn("_slot", F.pmod(F.xxhash64("ngram"), F.lit(slots)))
    full = rows.groupBy("_slot").agg(F.count(F.lit(1)).alias("_n")).persist()

    def top(floor: int) -> list:
        # at most ``slots`` numbers are broadcast
        heavy = F.broadcast(full.where(F.col("_n") >= floor).select("_slot"))
        return (_counted(rows.join(heavy, "_slot", "left_semi"))
                .orderBy(F.col("count").desc(), F.col("ngram").asc()).limit(k).collect())

    fullest = full.select("_n").orderBy(F.col("_n").desc()).limit(k).collect()
    guess = max(1, fullest[-1]["_n"] // 2) if fullest else 1
    got = top(guess)
    floor = got[-1]["count"] if len(got) == k and k else 1
    if floor < guess:
        got = top(floor)
    full.unpersist()
    toks.unpersist()
    return spark.createDataFrame(got, "ngram string, count bigint")


# --- word frequencies (word cloud) -------------------------------------------

WORD_RUN = f"[{TX.WORD}][{TX.WORD}']*"
# A word run less a final 's, as group 1: the lazy body stops where an
# optional 's and the end of the run follow.
CLOUD_WORD = f"([{TX.WORD}][{TX.WORD}']*?)(?:'[sS])?(?![{TX.WORD}'])"
COLLOCATION_THRESHOLD = 30.0
MAX_WORDS = 200


def cloud_words(text) -> Column:
    """Word-cloud tokenizer: runs of word characters and apostrophes that
    start with a word character; a trailing 's is dropped; all-digit words
    are dropped."""
    t = F.coalesce(TX._col(text).cast("string"), F.lit(""))
    words = F.regexp_extract_all(t, F.lit(CLOUD_WORD), 1)
    return F.filter(words, lambda w: ~w.rlike(f"^[{TX.DIGIT}]+$"))


def _fold(tokens: DataFrame, key: str = "tok") -> DataFrame:
    """Case folding + plural merging of a token-count table.

    In: (tok, cnt).  Out: (lower, cnt, rep), one row per surviving
    lower-case form with ``rep`` its most frequent spelling, and a second
    frame (lower, sing) of the merged plurals.  A lower-case form ending
    in a single 's' whose singular also occurs is merged into the singular
    (its spellings lose the final character).

    Rows are keyed on their singular candidate ``k`` (the form less its
    single final 's', else the form itself), so a key holds at most the
    forms ``k`` and ``k + 's'``: one shuffle on ``k`` decides every merge,
    and the later groupings include ``k`` and reuse that partitioning."""
    from pyspark.sql import Window
    low = F.lower(F.col(key))
    cand = low.endswith("s") & ~low.endswith("ss")
    t = tokens.select(F.col(key).alias("tok"), "cnt", low.alias("form"),
                      F.when(cand, F.expr(f"substring(lower({key}), 1, length({key}) - 1)"))
                      .otherwise(low).alias("k"))
    has_sing = F.max((F.col("form") == F.col("k")).cast("int")).over(Window.partitionBy("k")) == 1
    t = t.withColumn("merged", has_sing & (F.col("form") != F.col("k")))
    moved = t.select("k", "cnt", "merged", "form",
                     F.when(F.col("merged"), F.col("k")).otherwise(F.col("form")).alias("lower"),
                     F.when(F.col("merged"), F.expr("substring(tok, 1, length(tok) - 1)"))
                     .otherwise(F.col("tok")).alias("tok"))
    per_tok = moved.groupBy("k", "lower", "tok").agg(F.sum("cnt").alias("cnt"))
    folded = (per_tok.groupBy("k", "lower")
              .agg(F.sum("cnt").alias("cnt"),
                   F.min_by("tok", F.struct(-F.col("cnt"), F.col("tok"))).alias("rep"))
              .drop("k"))
    merged = (moved.filter(F.col("merged")).select("k", "form").distinct()
              .select(F.col("form").alias("lower"), F.col("k").alias("sing")))
    return folded, merged


def word_frequencies(df: DataFrame, text_col: str, max_words: int = MAX_WORDS,
                     stopwords: Iterable[str] = L.WORDCLOUD_STOPWORDS,
                     collocations: bool = True,
                     threshold: float = COLLOCATION_THRESHOLD) -> DataFrame:
    """M2: (word, count, weight) of the ``max_words`` heaviest entries.

    Unigrams exclude stopwords (case-insensitive); with ``collocations``,
    adjacent non-stopword pairs whose Dunning log-likelihood score exceeds
    ``threshold`` become entries of their own and their count is taken off
    both member words.  Pairs are formed within a row, never across rows.
    ``weight`` is the count relative to the largest count."""
    stop = [w.lower() for w in stopwords]
    words = df.select(cloud_words(text_col).alias("w"))
    words = words.select("w", F.transform("w", lambda x: F.lower(x).isin(stop)).alias("s"))
    unis = F.transform(F.filter("w", lambda x: ~F.lower(x).isin(stop)),
                       lambda x: F.struct(F.lit(1).alias("kind"), x.alias("tok")))
    pair = F.filter(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 1, F.lit(1))),
                    lambda i: F.when(~F.try_element_at("s", i) & ~F.try_element_at("s", i + 1),
                                     F.concat_ws(" ", F.try_element_at("w", i),
                                                 F.try_element_at("w", i + 1)))),
        lambda b: b.isNotNull())
    bis = F.transform(F.when(F.size("w") >= 2, pair).otherwise(F.array().cast("array<string>")),
                      lambda x: F.struct(F.lit(2).alias("kind"), x.alias("tok")))
    tagged = words.select((F.concat(unis, bis) if collocations else unis).alias("_k"))
    # One pass over the text; the result is bounded by the distinct
    # vocabulary (words and adjacent pairs), and every later step reads it.
    # Each vocabulary-sized intermediate below is referenced several times;
    # materializing it keeps the plan linear instead of re-deriving it per use.
    counts = (explode_rows(tagged, "_k", "e")
              .groupBy(F.col("e.kind").alias("kind"), F.col("e.tok").alias("tok"))
              .agg(F.count(F.lit(1)).alias("cnt")))
    counts = _materialize(counts)
    uni_tok = counts.filter(F.col("kind") == 1).select("tok", "cnt")
    uni, uni_merged = _fold(uni_tok)
    uni = _materialize(uni.select(F.col("rep").alias("word"), "lower", "cnt"))
    if not collocations:
        result = uni.select("word", "cnt")
    else:
        bi_tok = counts.filter(F.col("kind") == 2).select("tok", "cnt")
        bi, _ = _fold(bi_tok)
        # lower-case word -> (standard spelling, its count); merged plurals
        # map to their singular.  Bounded by the distinct vocabulary.
        std = _materialize(uni.select("lower", "word", "cnt")
                           .unionByName(uni_merged.join(uni.select(F.col("lower").alias("sing"), "word", "cnt"), "sing")
                                        .select("lower", "word", "cnt")))
        # Total unigram count: one scalar, brought back eagerly.
        n_words = uni.agg(F.sum("cnt")).first()[0] or 0
        parts = bi.select(F.col("rep").alias("bigram"), F.col("cnt").alias("c12"),
                          F.lower(F.split("rep", " ").getItem(0)).alias("l1"),
                          F.lower(F.split("rep", " ").getItem(1)).alias("l2"))
        scored = (parts
                  .join(std.select(F.col("lower").alias("l1"), F.col("word").alias("w1"),
                                   F.col("cnt").alias("c1")), "l1")
                  .join(std.select(F.col("lower").alias("l2"), F.col("word").alias("w2"),
                                   F.col("cnt").alias("c2")), "l2")
                  .withColumn("score", _dunning("c12", "c1", "c2", F.lit(n_words).cast("long"))))
        colloc = _materialize(scored.filter(F.col("score") > threshold)
                              .select("bigram", "c12", "w1", "w2"))
        discount = (colloc.select(F.explode(F.array(
                        F.struct(F.col("w1").alias("word"), F.col("c12").alias("d")),
                        F.struct(F.col("w2").alias("word"), F.col("c12").alias("d")))).alias("x"))
                    .groupBy(F.col("x.word").alias("word")).agg(F.sum("x.d").alias("d")))
        adjusted = (uni.join(discount, "word", "left")
                    .select("word", (F.col("cnt") - F.coalesce("d", F.lit(0))).alias("cnt")))
        result = adjusted.unionByName(colloc.select(F.col("bigram").alias("word"),
                                                    F.col("c12").alias("cnt")))
    top = (result.filter(F.col("cnt") > 0)
           .orderBy(F.col("cnt").desc(), F.col("word").asc()).limit(max_words))
    out = top.select("word", F.col("cnt").alias("count"),
                     (F.col("cnt") / F.max("cnt").over(_whole())).alias("weight"))
    # The result is a top-k report of at most ``max_words`` rows: bring it
    # back (bounded by k) so the cached vocabulary tables can be released.
    rows = out.collect()
    out = df.sparkSession.createDataFrame(rows, out.schema)
    for cached in (counts, uni) + ((std, colloc) if collocations else ()):
        cached.unpersist()
    return out


def _materialize(df: DataFrame) -> DataFrame:
    """Persist a vocabulary-sized intermediate and build it now, in order:
    left lazy, a table read by several later stages of one job is built by
    each of them.  A lost block is recomputed from lineage."""
    df = df.persist()
    df.count()
    return df


def _whole():
    from pyspark.sql import Window
    # Spans the <= max_words rows of the top-k result only.
    return Window.partitionBy()


def _ll(k: Column, n: Column, x: Column) -> Column:
    return (F.log(F.greatest(x, F.lit(1e-10))) * k
            + F.log(F.greatest(1 - x, F.lit(1e-10))) * (n - k))


def _dunning(c12, c1, c2, n) -> Column:
    """Dunning log-likelihood collocation score (0 when a word is the whole corpus)."""
    c12, c1, c2, n = (TX._col(c).cast("double") for c in (c12, c1, c2, n))
    p = c2 / n
    p1 = c12 / c1
    p2 = (c2 - c12) / (n - c1)
    s = _ll(c12, c1, p) + _ll(c2 - c12, n - c1, p) - _ll(c12, c1, p1) - _ll(c2 - c12, n - c1, p2)
    return F.when((n <= c1) | (n <= c2), F.lit(0.0)).otherwise(-2 * s)
