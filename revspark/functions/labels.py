"""Label, rating and probability expressions (``Column -> Column``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as L

POSITIVE, NEGATIVE, NEUTRAL, UNKNOWN = "positive", "negative", "neutral", "unknown"
CLASSES = ("NEGATIVE", "POSITIVE")  # index = encoded class


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rating_as_int(rating) -> Column:
    """Integer value of a rating the way ``int(x)`` reads it.

    ``try_cast`` truncates fractional numbers, trims blanks around digit
    strings and yields null for '4.7', 'x', NaN or null, all of which are
    "unknown"."""
    return _col(rating).try_cast("int")


def label_review(rating) -> Column:
    """F8: >3 positive, <3 negative, ==3 neutral, unparseable/null unknown."""
    r = rating_as_int(rating)
    return (F.when(r > L.NEUTRAL_RATING, F.lit(POSITIVE))
            .when(r < L.NEUTRAL_RATING, F.lit(NEGATIVE))
            .when(r == L.NEUTRAL_RATING, F.lit(NEUTRAL))
            .otherwise(F.lit(UNKNOWN)))


def normalize_label(label) -> Column:
    """upper-case, then whole-value fix-ups (POS, NEG, NEGATIVEATIVE)."""
    up = F.upper(_col(label).cast("string"))
    out = up
    for src, dst in reversed(L.LABEL_FIXUPS):
        out = F.when(up == F.lit(src), F.lit(dst)).otherwise(out)
    return out


def encode_label(sentiment) -> Column:
    """POSITIVE -> 1, anything else (NEGATIVE, unknown, null) -> 0."""
    return F.when(_col(sentiment) == F.lit("POSITIVE"), F.lit(1)).otherwise(F.lit(0))


def predicted_label(p0, p1) -> Column:
    """argmax of the two class probabilities; a tie picks NEGATIVE."""
    return F.when(_col(p1) > _col(p0), F.lit("POSITIVE")).otherwise(F.lit("NEGATIVE"))


def round_half_even(x, digits: int = 4) -> Column:
    """``numpy.round``: scale, round half to even (``rint``), unscale."""
    scale = float(10 ** digits)
    return F.rint(_col(x) * F.lit(scale)) / F.lit(scale)


def confidence(p0, p1, digits: int = 4) -> Column:
    """F16: max class probability, rounded half-even to 4 places."""
    return round_half_even(F.greatest(_col(p0), _col(p1)), digits)
