"""Lemmatization by a token-to-lemma dictionary.

The dictionary is a table ``token, lemma``.  ``lemma_dictionary`` derives one
from a corpus: an inflected form maps to the base form its suffix leaves, if
the corpus holds that base at least as often.  ``lemmatize`` looks up each
distinct token of a row once.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .rows import explode_rows

#: (suffix, what takes its place), in the order in which they are tried.
SUFFIXES = (("ies", "y"), ("ing", ""), ("ing", "e"), ("ed", ""), ("ed", "e"), ("es", ""), ("s", ""))
MIN_BASE = 3
LITERAL_BYTES = 2 << 20     # a dictionary of at most that size goes along with the tasks' code
SLOTS = 4096


def lemma_dictionary(df: DataFrame, tokens_col: str) -> DataFrame:
    """``token, lemma`` of the tokens that have a base form in the corpus.

    Counts are over all rows; a token's first rule (``SUFFIXES``) whose base
    has ``MIN_BASE`` characters and occurs as often wins.  Lemmas are not
    looked up again."""
    counts = explode_rows(df, tokens_col, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    tries = [F.when(F.col("token").endswith(s) & (F.length("token") >= len(s) - len(r) + MIN_BASE),
                    F.struct(F.concat(F.expr(f"left(token, length(token) - {len(s)})"), F.lit(r)).alias("base"),
                             F.col("token").alias("token"), F.col("n").alias("n"), F.lit(i).alias("rule")))
             for i, (s, r) in enumerate(SUFFIXES)]
    # each token goes to its own name and to its bases, at most 8 rows to a name:
    # a join of the counts with themselves would analyse the corpus for both sides
    own = F.struct(F.col("token").alias("base"), F.lit(None).cast("string").alias("token"), F.col("n").alias("n"), F.lit(-1).alias("rule"))
    rows = counts.select(F.explode(F.array_compact(F.array(own, *tries))).alias("b")).select("b.*")
    n_base = F.max(F.when(F.col("token").isNull(), F.col("n"))).over(Window.partitionBy("base"))
    return (rows.withColumn("n_base", n_base).where("token is not null and n_base >= n")
            .groupBy("token").agg(F.min_by("base", "rule").alias("lemma")))


def lemmatize(df: DataFrame, tokens_col: str, key_col: str, dictionary: DataFrame, out_col: str = "lemmas",
              literal_bytes: int = LITERAL_BYTES) -> DataFrame:
    """``df`` with ``out_col``: the tokens of ``tokens_col``, each replaced by
    its lemma if ``dictionary`` (one row per token) has one.

    A dictionary of at most ``literal_bytes`` becomes a literal of small maps
    by hash, looked up inside the row: nothing is shuffled.  A larger one is
    joined to the distinct tokens of each row, and the few that change come
    back as one map per ``key_col`` (unique, not null).  A null array stays
    null, as does a null token; an empty array stays empty."""
    dictionary = dictionary.persist()       # its size, then its rows; a joined one stays until the session ends
    size = dictionary.agg(F.sum(F.octet_length("token") + F.octet_length("lemma") + 8)).first()[0] or 0
    if size <= literal_bytes:
        out = df.withColumn(out_col, _by_literal(F.col(tokens_col), dictionary))
        dictionary.unpersist()
        return out
    found = (df.select(F.col(key_col).alias("_key"), F.explode(F.array_distinct(tokens_col)).alias("token"))
             .join(dictionary, "token").groupBy("_key")
             .agg(F.map_from_entries(F.collect_list(F.struct("token", "lemma"))).alias("_lemmas")))
    joined = df.join(found, df[key_col] == found["_key"], "left")
    swapped = F.transform(tokens_col, lambda t: F.coalesce(F.element_at("_lemmas", t), t))
    return joined.withColumn(out_col, F.when(F.col("_lemmas").isNull(), F.col(tokens_col)).otherwise(swapped)).drop("_key", "_lemmas")


def _by_literal(tokens, dictionary: DataFrame):
    slots: list[dict] = [{} for _ in range(SLOTS)]
    for r in dictionary.select("token", "lemma").toLocalIterator():     # at most ``literal_bytes``
        slots[zlib.crc32(r["token"].encode()) % SLOTS][r["token"]] = r["lemma"]
    maps = F.from_json(F.lit(json.dumps(slots)), "array<map<string,string>>")
    return F.transform(tokens, lambda t: F.coalesce(
        F.element_at(F.element_at(maps, (F.crc32(F.encode(t, "UTF-8")) % SLOTS + 1).cast("int")), t), t))
