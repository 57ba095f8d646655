"""Order, top rows and shares. Ties go to the smallest key, so results repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveframe.functions.numbers import ratio


def ordered(df: DataFrame, value: str, *keys: str, largest: bool = True) -> DataFrame:
    """Sort by a value with nulls last, then by the keys."""
    col = F.col(value)
    first = col.desc_nulls_last() if largest else col.asc_nulls_last()
    return df.orderBy(first, *(F.col(k).asc_nulls_last() for k in keys))


def top(df: DataFrame, value: str, *keys: str, n: int = 1) -> DataFrame:
    """The n rows with the largest value (each task keeps only its n)."""
    return ordered(df, value, *keys).limit(n)


def key_at_max(value: Column, key: Column, kept: Column | None = None) -> Column:
    """Aggregate: the key (or ``kept``) of the row with the largest value.

    The smallest key wins ties. Rows whose value is null never win.
    """
    return _first_by(-value, key, kept)


def key_at_min(value: Column, key: Column, kept: Column | None = None) -> Column:
    """The same for the smallest value."""
    return _first_by(value, key, kept)


def _first_by(value: Column, key: Column, kept: Column | None) -> Column:
    place = F.when(value.isNotNull(), F.struct(value, key))
    return F.min_by(key if kept is None else kept, place)


def with_top_flag(df: DataFrame, label: str, value: str) -> DataFrame:
    """Rows from smallest to largest value, the single largest one flagged.

    The table is read twice, so settle it first.
    """
    best = df.agg(key_at_max(F.col(value), F.col(label))).scalar()
    flagged = df.withColumn("is_top", F.col(label).eqNullSafe(best))
    return flagged.orderBy(F.col(value).asc_nulls_first(), F.col(label).desc_nulls_first())


def share_of_total(df: DataFrame, value: str) -> Column:
    """Each row's part of the column's sum over an already grouped table.

    The total is a scalar subquery; a window without keys would move all groups
    into one task. The table is read twice, so settle it first.
    """
    return ratio(F.col(value), df.agg(F.sum(value)).scalar())


def category_order(col: Column, categories: Sequence[str], start: int = 1) -> Column:
    """1, 2, ... for the listed categories; the last one also takes the rest."""
    out = None
    for i, label in enumerate(categories[:-1], start):
        out = F.when(col == label, i) if out is None else out.when(col == label, i)
    last = F.lit(start + len(categories) - 1)
    return last if out is None else out.otherwise(last)
