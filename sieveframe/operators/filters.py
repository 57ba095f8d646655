"""Filters over rows or summary tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the label that stands for all small groups together.
OTHER = "Other (small groups)"


def select_rows(df: DataFrame, choices: Mapping[str, Sequence]) -> DataFrame:
    """Rows whose columns hold one of the chosen values.

    An empty choice means "all", and a column the table lacks is skipped, so
    one set of choices filters every summary table.
    """
    for name, values in choices.items():
        if values and name in df.columns:
            df = df.filter(F.col(name).isin(*values))
    return df


def domain_values(df: DataFrame, name: str) -> DataFrame:
    """The sorted distinct values of a column, null last."""
    return df.select(name).distinct().orderBy(F.col(name).asc_nulls_last())


def selection_size(df: DataFrame) -> DataFrame:
    """The number of selected rows as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("claims"))


def full_weeks(weeks: DataFrame) -> DataFrame:
    """Only the weeks whose first and last day with data lie six days apart."""
    return weeks.filter(F.datediff("last_day", "first_day") == 6)


def without_other(df: DataFrame, name: str) -> DataFrame:
    """Leave out the merged group, which mixes several labels."""
    return df.filter(F.col(name) != OTHER)


def at_least(df: DataFrame, size: str, n: int) -> DataFrame:
    """Only groups of n or more."""
    return df.filter(F.col(size) >= n)
