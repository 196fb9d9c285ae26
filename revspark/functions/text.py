"""Row-level text functions as ``Column -> Column`` expressions.

Everything here compiles to built-in Catalyst expressions (regex, split,
higher-order ``filter``/``transform``); there is no Python UDF, so the work
stays in the JVM, partitions freely and never leaves the executor.

Unicode parity notes (Python ``re`` is the semantics we match):

* Python ``\\w`` is ``[\\p{L}\\p{N}_]``.  Java's ``(?U)\\w`` also admits
  combining marks and connector punctuation, so the class is spelled out.
* Python ``\\s`` / ``str.split()`` / ``str.strip()`` use ``str.isspace``,
  which Java's ``(?U)\\s`` misses for U+001C..U+001F; the class is spelled
  out as well (the same text is used by the SQL oracle).
* Python ``\\b`` becomes explicit look-arounds on the word class, because
  Java 19+ treats a bare ``\\b`` as ASCII-only.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as L

WORD = r"\p{L}\p{N}_"
SPACE = (r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
         r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")

def _char_class(pred) -> str:
    """Regex class body (Java and RE2 syntax) of the code points matching
    ``pred``, as ranges."""
    cps = [cp for cp in range(0x110000) if pred(chr(cp))]
    out, i = [], 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        out.append(f"\\x{{{cps[i]:X}}}" + (f"-\\x{{{cps[j]:X}}}" if j > i else ""))
        i = j + 1
    return "".join(out)


# Python ``str.isdigit``: decimal digits plus the other Numeric_Type=Digit
# characters (superscripts, circled and Ethiopic digits, ...), built by rule.
DIGIT = r"\p{Nd}" + _char_class(lambda c: c.isdigit() and not c.isdecimal())

# Emoji whose code points are letters or digits survive punctuation
# stripping; the emoji pass removes them first: keycaps (digit + U+20E3,
# the digit goes too) and INFORMATION SOURCE (a lowercase letter).
EMOJI_WORDLIKE = r"[0-9#*]\x{FE0F}?\x{20E3}|\x{2139}\x{FE0F}?"
NOT_WORD_OR_SPACE = f"[^{WORD}{SPACE}]"
SPACE_RUN = f"[{SPACE}]+"
STRIP_SPACE = f"^[{SPACE}]+|[{SPACE}]+$"

# The same sets for Java, which tests one bit set and one category instead of
# a dozen ranges per character: Zs, Zl and Zp are SPACE without its controls.
_SPACE_BITS = r"\t\n\x0B\f\r\x1C\x1D\x1E\x1F \x85\p{Z}"
_FAST_SPACE_RUN = f"[{_SPACE_BITS}]+"
_FAST_LEADING_SPACE = f"^[{_SPACE_BITS}]+"
_FAST_NOT_WORD_OR_SPACE = f"[^{WORD}{_SPACE_BITS}]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), f), 0)


def _replace_if_any(text: Column, needles: Iterable[str], pattern: str, to: str) -> Column:
    """``regexp_replace`` of the texts that hold a needle, one of which is part
    of every match; the others skip the regex."""
    def one(t):
        hit = None
        for x in needles:
            hit = t.contains(x) if hit is None else hit | t.contains(x)
        return F.when(hit, F.regexp_replace(t, pattern, to)).otherwise(t)
    return _let(text, one)


def _contraction_pattern() -> str:
    alts = "|".join(f"{a}(?={b}(?![{WORD}]))" for a, b in L.CONTRACTIONS)
    return f"(?<![{WORD}])({alts})"


def script_range_class(lo: str, hi: str) -> str:
    return f"[\\x{{{ord(lo):04X}}}-\\x{{{ord(hi):04X}}}]"


def in_script(text, script: tuple[str, str] = L.DEVANAGARI) -> Column:
    """F1 predicate: true if any character lies in the script range.

    Null text is not in any script (kept by the filter)."""
    return F.coalesce(_col(text).rlike(script_range_class(*script)), F.lit(False))


def normalize_for_tokens(text) -> Column:
    """null -> '', lower-case, drop word-like emoji, strip punctuation."""
    t = F.lower(F.coalesce(_col(text).cast("string"), F.lit("")))
    t = _replace_if_any(t, ("\u20e3", "\u2139"), EMOJI_WORDLIKE, "")
    return F.regexp_replace(t, _FAST_NOT_WORD_OR_SPACE, "")


def clean_tokens(text, stopwords: Iterable[str] = L.NLTK_ENGLISH) -> Column:
    """F7 up to the token array: tokenize, split contractions, drop stopwords."""
    t = normalize_for_tokens(text)
    t = _replace_if_any(t, [a + b for a, b in L.CONTRACTIONS], _contraction_pattern(), "$1 ")
    stop = list(stopwords)
    return F.filter(F.split(t, _FAST_SPACE_RUN), lambda w: (w != F.lit("")) & ~w.isin(stop))


def clean_text(text, stopwords: Iterable[str] = L.NLTK_ENGLISH) -> Column:
    """F7 ``clean_text``: tokens joined by one space ('' for null/blank)."""
    return F.array_join(clean_tokens(text, stopwords), " ")


def is_blank(text) -> Column:
    """F2 predicate: blank after stripping Unicode whitespace (null is blank).

    What is blank is gone without its leading white space; stripping the end too
    would try each white space of the text as the start of the end."""
    return F.coalesce(F.regexp_replace(_col(text), _FAST_LEADING_SPACE, ""), F.lit("")) == F.lit("")


def strip_space(text) -> Column:
    return F.regexp_replace(_col(text), STRIP_SPACE, "")


def detect_suggestion(text, keywords: Iterable[str] = L.SUGGESTION_SUBSTRINGS) -> Column:
    """1 if the lower-cased text contains any keyword as a substring."""
    low = F.lower(_col(text).cast("string"))
    hit = None
    for k in keywords:
        c = low.contains(k.lower())
        hit = c if hit is None else (hit | c)
    return F.coalesce(hit, F.lit(False)).cast("int")


def phrase_pattern(phrases: Iterable[str] = L.SUGGESTION_PHRASES) -> str:
    alts = "|".join(re.escape(p) for p in phrases)
    return f"(?iu)(?<![{WORD}])(?:{alts})(?![{WORD}])"


def extract_suggestions(text, phrases: Iterable[str] = L.SUGGESTION_PHRASES) -> Column:
    """sentences (split on . ! ?) holding a whole-word phrase, stripped,
    joined with ' | '; '' when none (and for null text)."""
    rx = phrase_pattern(phrases)
    delims = "[" + re.escape(L.SENTENCE_DELIMITERS) + "]"
    sentences = F.split(F.coalesce(_col(text).cast("string"), F.lit("")), delims)
    kept = F.filter(sentences, lambda s: s.rlike(rx))
    return F.array_join(F.transform(kept, strip_space), L.SUGGESTION_JOIN)


def has_suggestion(suggestion_text) -> Column:
    """the extracted suggestion text is not blank."""
    return ~is_blank(suggestion_text)


def ngram_tokens(text, stopwords: Iterable[str] = L.SKLEARN_ENGLISH) -> Column:
    """Analyzer of the n-gram counter: lower-case, runs of >= 2 word
    characters, stopwords removed *before* n-grams are formed."""
    t = F.lower(F.coalesce(_col(text).cast("string"), F.lit("")))
    stop = list(stopwords)
    return F.filter(F.split(t, f"[^{WORD}]+"),
                    lambda w: (F.length(w) >= 2) & ~w.isin(stop))


def vector_tokens(text) -> Column:
    """Analyzer of the TF-IDF vectorizer (no stopwords): runs of >= 2 word
    characters of the lower-cased text."""
    t = F.lower(F.coalesce(_col(text).cast("string"), F.lit("")))
    return F.filter(F.split(t, f"[^{WORD}]+"), lambda w: F.length(w) >= 2)


def ngrams(tokens: str, n: int) -> Column:
    """Contiguous n-grams of a token-array *column*, joined by one space.

    ``tokens`` must name a column that is already materialized by an
    earlier projection: an expression captured inside a lambda is
    re-evaluated per element, which would make this quadratic per row."""
    if not isinstance(tokens, str):
        raise TypeError("ngrams() needs the name of a materialized token column")
    toks = F.col(tokens)
    if n == 1:
        return toks
    k = F.size(toks) - F.lit(n - 1)
    return F.when(F.size(toks) >= n, F.transform(
        F.sequence(F.lit(1), k),
        lambda i: F.concat_ws(" ", *[F.element_at(toks, i + j) for j in range(n)]),
    )).otherwise(F.array().cast("array<string>"))
