"""Gap-filled daily series, rolling means and the two halves of a period.

Rows are counted per (key, day) first. What follows works on at most one row
per day of the calendar and key, so a key with a third of all rows weighs no
more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from sieveframe.functions.dates import day, days_spanned
from sieveframe.functions.numbers import ratio

ROLLING_DAYS = 14


def count_by_day(
    rows: DataFrame, date: str, keys: Sequence[str] = (), n: Column | None = None
) -> DataFrame:
    """Rows (or the sum of ``n``) per day and key; missing days or keys drop out."""
    count = F.count(F.lit(1)) if n is None else F.sum(n)
    return (
        rows.dropna(subset=[date, *keys])
        .groupBy(*keys, day(F.col(date)).alias("day"))
        .agg(count.alias("claims"))
    )


def fill_days(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per day from first to last (per key); absent days count 0.

    Gives what a calendar left-joined to the counts gives, but each day is
    stretched to the next one instead. So the counts are needed once, there is
    no join, and later windows over the same keys go on using the one shuffle.
    """
    following = F.lead("day").over(Window.partitionBy(*keys).orderBy("day"))
    until = F.coalesce(F.date_sub(F.col("_next"), 1), F.col("day"))
    days = F.explode(F.sequence("day", until, F.expr("interval 1 day")))
    return (
        counts.withColumn("_next", following)
        .select(*keys, F.col("day").alias("_from"), "claims", days.alias("day"))
        .select(
            *keys,
            "day",
            F.when(F.col("day") == F.col("_from"), F.col("claims"))
            .otherwise(0)
            .alias("claims"),
        )
    )


def rolling_mean(
    series: DataFrame,
    value: str,
    name: str,
    order: str = "day",
    keys: Sequence[str] = (),
    length: int = ROLLING_DAYS,
) -> DataFrame:
    """Mean of the last ``length`` rows; null until there are that many."""
    along = _along(keys, order)
    mean = F.avg(value).over(along.rowsBetween(1 - length, 0))
    full = F.row_number().over(along) >= length
    return series.withColumn(name, F.when(full, mean))


def daily(
    counts: DataFrame, keys: Sequence[str] = (), length: int = ROLLING_DAYS
) -> DataFrame:
    """The filled series with its rolling mean."""
    return rolling_mean(
        fill_days(counts, keys), "claims", f"avg_{length}d", keys=keys, length=length
    )


def halves(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean per day in the first n // 2 days and in the rest (per key)."""
    number = F.row_number().over(_along(keys, "day"))
    total = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    early = F.col("_number") <= F.floor(F.col("_total") / 2)
    return (
        series.withColumn("_number", number)
        .withColumn("_total", total)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.avg(F.when(early, F.col("claims"))).alias("first_half"),
            F.avg(F.when(~early, F.col("claims"))).alias("second_half"),
        )
    )


def period(rows: DataFrame, date: str, keys: Sequence[str] = ()) -> DataFrame:
    """First and last day with their distance in days and in months of 30 days."""
    ends = rows.groupBy(*keys).agg(
        day(F.min(date)).alias("first_day"), day(F.max(date)).alias("last_day")
    )
    days = days_spanned(F.col("first_day"), F.col("last_day"))
    return ends.withColumn("days", days).withColumn(
        "months", ratio(F.col("days"), F.lit(30))
    )


def _along(keys: Sequence[str], order: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)
