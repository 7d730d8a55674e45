"""Predicates with the null behaviour of the data frames they replace, and small scalars.

Three-valued logic drops a row whenever `NOT IN`, `<>` or `NOT LIKE` meets a null. The negative
helpers below keep such rows; the positive ones reject them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def not_in(column: Column, values: Iterable) -> Column:
    """True unless the column equals one of the values; null is kept."""
    return F.coalesce(~column.isin(list(values)), F.lit(True))


def differs(column: Column, value) -> Column:
    """`column != value` where null differs from everything."""
    return ~column.eqNullSafe(F.lit(value))


def _alternatives(terms: Sequence[str], literal: bool) -> str:
    return "|".join(re.escape(t) if literal else t for t in terms)


def rlike_any(column: Column, terms: Sequence[str], literal: bool = False) -> Column:
    """Any of the terms occurs in the text; null text contains nothing."""
    return F.coalesce(column.rlike(_alternatives(terms, literal)), F.lit(False))


def not_rlike_any(column: Column, terms: Sequence[str], literal: bool = False) -> Column:
    """None of the terms occurs in the text; null text is kept."""
    return ~rlike_any(column, terms, literal)


def flag_gt(column: Column, threshold: Column | float) -> Column:
    """1 when strictly above the threshold, else 0."""
    bound = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return (column > bound).cast("int")


def label_state(column: Column, name: str) -> Column:
    """Text of a label that may be present, absent or unknown."""
    return (
        F.when(column == 1, F.lit(f"{name}_dmg"))
        .when(column == 0, F.lit(f"{name}_no_dmg"))
        .otherwise(F.lit(f"{name}_N/A"))
    )


def clip(column: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; null stays null (`least` and `greatest` alone would skip it)."""
    return F.when(column.isNotNull(), F.least(F.greatest(column, F.lit(low)), F.lit(high)))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; null instead of an error when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def positive_labels(parts: Sequence[str]) -> Column:
    """Names of the columns that hold 1, in column order."""
    named = F.array(*[F.when(F.col(p) == 1, F.lit(p)) for p in parts])
    return F.array_compact(named)
