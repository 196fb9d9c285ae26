"""SQL fragments for the independent DuckDB oracle.

Each function returns a DuckDB SQL expression with the same meaning as the
matching Spark expression in ``revspark.functions``.  They are generated
from the same fixed lexicon, but written against RE2/DuckDB semantics
(no look-arounds, ASCII ``\\s``, ``\\b`` that treats accents as non-word),
so they are an independent check of the Spark expressions rather than a
copy of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from ..functions import lexicon as L
from ..functions.text import DIGIT, EMOJI_WORDLIKE, SPACE, WORD

NOT_WORD = f"[^{WORD}]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def str_list(words: Iterable[str]) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


def clean_tokens(expr: str, stopwords: Iterable[str] = L.NLTK_ENGLISH) -> str:
    base = (f"regexp_replace(regexp_replace(lower(coalesce(CAST({expr} AS VARCHAR), '')), "
            f"{q(EMOJI_WORDLIKE)}, '', 'g'), {q(f'[^{WORD}{SPACE}]')}, '', 'g')")
    cases = " ".join(f"WHEN {q(a + b)} THEN [{q(a)}, {q(b)}]" for a, b in L.CONTRACTIONS)
    split = (f"flatten(list_transform(string_split_regex({base}, {q(f'[{SPACE}]+')}), "
             f"lambda w: CASE w {cases} ELSE [w] END))")
    return (f"list_filter({split}, lambda w: w <> '' AND NOT list_contains("
            f"{str_list(stopwords)}, w))")


def clean_text(expr: str, stopwords: Iterable[str] = L.NLTK_ENGLISH) -> str:
    return f"array_to_string({clean_tokens(expr, stopwords)}, ' ')"


def strip_space(expr: str) -> str:
    return f"regexp_replace({expr}, {q(f'^[{SPACE}]+|[{SPACE}]+$')}, '', 'g')"


def is_blank(expr: str) -> str:
    return f"(coalesce({strip_space(expr)}, '') = '')"


def in_script(expr: str, lo: str, hi: str) -> str:
    return f"coalesce(regexp_matches({expr}, {q(f'[{lo}-{hi}]')}), false)"


def detect_suggestion(expr: str, keywords: Iterable[str] = L.SUGGESTION_SUBSTRINGS) -> str:
    low = f"lower(CAST({expr} AS VARCHAR))"
    ors = " OR ".join(f"contains({low}, {q(k.lower())})" for k in keywords)
    return f"CAST(coalesce({ors}, false) AS INTEGER)"


def extract_suggestions(expr: str, phrases: Iterable[str] = L.SUGGESTION_PHRASES) -> str:
    alts = "|".join(re.escape(p) for p in phrases)
    rx = f"(?i)(^|{NOT_WORD})(?:{alts})($|{NOT_WORD})"
    delims = "[" + re.escape(L.SENTENCE_DELIMITERS) + "]"
    sents = f"string_split_regex(coalesce(CAST({expr} AS VARCHAR), ''), {q(delims)})"
    kept = f"list_filter({sents}, lambda s: regexp_matches(s, {q(rx)}))"
    return (f"array_to_string(list_transform({kept}, lambda s: {strip_space('s')}), "
            f"{q(L.SUGGESTION_JOIN)})")


def label_review(expr: str) -> str:
    """F8 in DuckDB.  DuckDB's TRY_CAST rounds '4.7' to 5, Spark's gives
    null (as does Python ``int``), so the oracle gates on an integer shape
    first; numeric inputs are truncated like ``int(3.9)``."""
    s = f"trim(CAST({expr} AS VARCHAR))"
    r = (f"(CASE WHEN regexp_full_match({s}, '[+-]?[0-9]+') "
         f"THEN TRY_CAST({s} AS INTEGER) END)")
    n = L.NEUTRAL_RATING
    return (f"(CASE WHEN {r} > {n} THEN 'positive' WHEN {r} < {n} THEN 'negative' "
            f"WHEN {r} = {n} THEN 'neutral' ELSE 'unknown' END)")


def normalize_label(expr: str) -> str:
    up = f"upper(CAST({expr} AS VARCHAR))"
    cases = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in L.LABEL_FIXUPS)
    return f"(CASE {up} {cases} ELSE {up} END)"


def ngram_tokens(expr: str, stopwords: Iterable[str] = L.SKLEARN_ENGLISH) -> str:
    toks = f"string_split_regex(lower(coalesce(CAST({expr} AS VARCHAR), '')), {q(NOT_WORD + '+')})"
    return (f"list_filter({toks}, lambda w: length(w) >= 2 AND NOT list_contains("
            f"{str_list(stopwords)}, w))")


def vector_tokens(expr: str) -> str:
    toks = f"string_split_regex(lower(coalesce(CAST({expr} AS VARCHAR), '')), {q(NOT_WORD + '+')})"
    return f"list_filter({toks}, lambda w: length(w) >= 2)"


def ngrams(tokens: str, n: int) -> str:
    """n-grams of a token-list *column* (referenced n+1 times)."""
    if n == 1:
        return tokens
    parts = ", ".join(f"{tokens}[i + {j}]" for j in range(n))
    return (f"list_transform(range(1, len({tokens}) - {n - 2}), "
            f"lambda i: concat_ws(' ', {parts}))")


def round_half_even(expr: str, digits: int = 4) -> str:
    scale = 10 ** digits
    return f"(round_even(({expr}) * {scale}.0, 0) / {scale}.0)"


def _fold_sql(src: str, out: str) -> str:
    """CTEs folding a (tok, cnt) table: case variants merge into their most
    frequent spelling, and a form ending in one 's' merges into its
    singular when that occurs.  Defines ``{out}`` (lower, rep, cnt) and
    ``{out}_mg`` (lower, sing) of the merged plurals."""
    return f"""
{out}_bc AS (SELECT lower(tok) AS lower, tok, sum(cnt) AS cnt FROM {src} GROUP BY 1, 2),
{out}_lw AS (SELECT DISTINCT lower FROM {out}_bc),
{out}_mg AS (
  SELECT p.lower, p.sing FROM (
    SELECT lower, regexp_replace(lower, '.$', '') AS sing FROM {out}_lw
    WHERE ends_with(lower, 's') AND NOT ends_with(lower, 'ss')) p
  JOIN {out}_lw l ON l.lower = p.sing),
{out}_mv AS (
  SELECT coalesce(m.sing, b.lower) AS lower,
         CASE WHEN m.sing IS NULL THEN b.tok ELSE regexp_replace(b.tok, '.$', '') END AS tok,
         sum(b.cnt) AS cnt
  FROM {out}_bc b LEFT JOIN {out}_mg m ON b.lower = m.lower GROUP BY 1, 2),
{out} AS (
  SELECT lower, CAST(sum(cnt) AS BIGINT) AS cnt, first(tok ORDER BY cnt DESC, tok ASC) AS rep
  FROM {out}_mv GROUP BY lower)"""


def _loglik(k: str, n: str, x: str) -> str:
    return f"(ln(greatest({x}, 1e-10)) * ({k}) + ln(greatest(1 - ({x}), 1e-10)) * (({n}) - ({k})))"


def word_frequency(expr: str, src: str, stopwords: Iterable[str] = L.WORDCLOUD_STOPWORDS,
                   max_words: int = 200, threshold: float = 30.0, digits: int = 6) -> str:
    """M2 as one DuckDB query over ``expr`` of table ``src``: word-cloud
    words, plural/case folding, Dunning collocations above ``threshold``
    (their count taken off both member words), top ``max_words``."""
    stop = str_list(sorted({w.lower() for w in stopwords}))
    run = f"[{WORD}][{WORD}']*"
    poss = q("'[sS]$")
    words = (f"list_filter(list_transform(regexp_extract_all(coalesce(CAST({expr} AS VARCHAR), ''), "
             f"{q(run)}, 0), lambda x: regexp_replace(x, {poss}, '')), "
             f"lambda x: NOT regexp_full_match(x, {q(f'[{DIGIT}]+')}))")
    c12, c1, c2, n = "CAST(c12 AS DOUBLE)", "CAST(c1 AS DOUBLE)", "CAST(c2 AS DOUBLE)", "CAST(n AS DOUBLE)"
    p, p1, p2 = f"({c2} / {n})", f"({c12} / {c1})", f"(({c2} - {c12}) / ({n} - {c1}))"
    s = (f"{_loglik(c12, c1, p)} + {_loglik(f'{c2} - {c12}', f'{n} - {c1}', p)} "
         f"- {_loglik(c12, c1, p1)} - {_loglik(f'{c2} - {c12}', f'{n} - {c1}', p2)}")
    return f"""
WITH ws0 AS (SELECT {words} AS w FROM {src}),
ws AS (SELECT w, list_transform(w, lambda x: list_contains({stop}, lower(x))) AS s FROM ws0),
uni_tok AS (
  SELECT tok, count(*) AS cnt FROM (
    SELECT unnest(list_filter(w, lambda x: NOT list_contains({stop}, lower(x)))) AS tok FROM ws)
  GROUP BY tok),
bi_tok AS (
  SELECT tok, count(*) AS cnt FROM (
    SELECT unnest(list_filter(list_transform(range(1, len(w)),
             lambda i: CASE WHEN NOT s[i] AND NOT s[i + 1] THEN w[i] || ' ' || w[i + 1] END),
           lambda b: b IS NOT NULL)) AS tok FROM ws)
  GROUP BY tok),
{_fold_sql('uni_tok', 'uni')},
{_fold_sql('bi_tok', 'bi')},
std AS (SELECT lower, rep FROM uni
        UNION ALL SELECT m.lower, u.rep FROM uni_mg m JOIN uni u ON u.lower = m.sing),
nw AS (SELECT CAST(sum(cnt) AS BIGINT) AS n FROM uni),
parts AS (SELECT rep AS bigram, cnt AS c12, lower(split_part(rep, ' ', 1)) AS l1,
                 lower(split_part(rep, ' ', 2)) AS l2 FROM bi),
sc AS (
  SELECT p.bigram, p.c12, s1.rep AS w1, s2.rep AS w2, u1.cnt AS c1, u2.cnt AS c2, nw.n
  FROM parts p JOIN std s1 ON s1.lower = p.l1 JOIN std s2 ON s2.lower = p.l2
  JOIN uni u1 ON u1.rep = s1.rep JOIN uni u2 ON u2.rep = s2.rep, nw),
colloc AS (
  SELECT * FROM sc
  WHERE (CASE WHEN n <= c1 OR n <= c2 THEN 0.0 ELSE -2 * ({s}) END) > {threshold}),
disc AS (SELECT word, sum(d) AS d FROM (SELECT w1 AS word, c12 AS d FROM colloc
                                        UNION ALL SELECT w2, c12 FROM colloc) GROUP BY word),
res AS (SELECT u.rep AS word, CAST(u.cnt - coalesce(d.d, 0) AS BIGINT) AS cnt
        FROM uni u LEFT JOIN disc d ON d.word = u.rep
        UNION ALL SELECT bigram, c12 FROM colloc),
top AS (SELECT word, cnt FROM res WHERE cnt > 0 ORDER BY cnt DESC, word ASC LIMIT {max_words})
SELECT word, cnt AS count, round(cnt / max(cnt) OVER (), {digits}) AS weight FROM top"""
