"""Row helpers that keep expensive per-row expressions computed once.

Catalyst pushes filters below projections by substituting the projected
expression for the column (``PushPredicateThroughNonJoin``), and infers a
``size(array) > 0`` filter under every non-outer ``explode``
(``InferFiltersFromGenerate``).  For cheap columns that is a win; for a
cleaned-text or n-gram column it means the whole regex/lambda pipeline runs
again inside the filter -- and inside a lambda it runs once per element.
A ``Generate`` is a barrier to both rules, so these helpers express
"filter" and "explode" through an outer generator and drop the empty rows
above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, array_col: str, out: str, *keep: str) -> DataFrame:
    """``explode`` of a materialized array column without the inferred
    pushed-down size filter; rows with an empty/null array disappear."""
    return (df.select(*keep, F.explode_outer(array_col).alias(out))
            .filter(F.col(out).isNotNull()))


def keep_where(df: DataFrame, cond: Column) -> DataFrame:
    """Filter on a predicate over columns computed by an earlier projection,
    evaluated once on the materialized values (the predicate cannot be
    pushed below the projection that computes them)."""
    k = "_keep_row"
    return (df.withColumn(k, F.explode_outer(F.when(cond, F.array(F.lit(True)))))
            .filter(F.col(k).isNotNull()).drop(k))
