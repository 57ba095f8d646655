"""Exact quantiles per group that never hold a whole group in one task."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sieveframe.functions.numbers import nan_to_null
from sieveframe.sources.scratch import settle

# One task sorts at most about this many distinct values of a group.
MAX_SORTED = 2_000_000
# Slices per narrowing round.
SLICES = 64


def group_quantiles(
    df: DataFrame,
    key: str,
    value: str,
    points: dict[str, float],
    max_sorted: int = MAX_SORTED,
    slices: int = SLICES,
) -> DataFrame:
    """One row per key with linearly interpolated quantiles as doubles.

    ``percentile`` keeps every distinct value of a group in one buffer. Here
    equal values are counted first, with partial aggregates, so a hot group or
    a hot value shrinks before the shuffle. The counts are written once; the
    rows are scanned a single time. As long as a group holds more distinct
    values than one task should sort, the values are cut into slices and only
    the slices around the wanted ranks are kept. What is left is sorted.

    Null keys are left out; a key with nothing but null values gets null.
    """
    counted = settle(
        df.select(F.col(key), nan_to_null(F.col(value).cast("double")).alias("_v"))
        .filter(F.col(key).isNotNull())
        .groupBy(key, "_v")
        .agg(F.count(F.lit(1)).alias("_n")),
        "value-counts",
    )
    totals = settle(
        counted.groupBy(F.col(key).alias("_key")).agg(
            F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("_n"))), F.lit(0))
            .alias("_total")
        ),
        "value-totals",
    )
    # A segment is a run of neighbouring values: (key, position of its first row).
    values = (
        counted.filter(F.col("_v").isNotNull())
        .join(totals, F.col(key) == F.col("_key"))
        .select(key, "_v", "_n", "_total", F.lit(0).cast("bigint").alias("_base"))
    )
    size = counted.count()
    while size > max_sorted and _largest_segment(values, key) > max_sorted:
        narrowed = _narrowed(values, key, points, max_sorted, slices)
        values = settle(narrowed, "value-slices")
        size = values.count()

    inside = Window.partitionBy(key, "_base").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, 0
    )
    end = F.col("_base") + F.sum("_n").over(inside)
    placed = values.withColumn("_end", end).withColumn(
        "_begin", F.col("_end") - F.col("_n")
    )
    picked = []
    for i, p in enumerate(points.values()):
        for side, rank in zip("ab", _ranks(p)):
            here = (rank >= F.col("_begin")) & (rank < F.col("_end"))
            picked.append(F.max(F.when(here, F.col("_v"))).alias(f"_{side}{i}"))
    found = placed.groupBy(key).agg(F.max("_total").alias("_total"), *picked)
    valueless = totals.filter("_total = 0").select(
        "_key", *(F.lit(None).cast("double").alias(name) for name in points)
    )
    return found.select(
        key,
        *(
            _between(F.col(f"_a{i}"), F.col(f"_b{i}"), p).alias(name)
            for i, (name, p) in enumerate(points.items())
        ),
    ).unionAll(valueless)


def _largest_segment(values: DataFrame, key: str) -> int:
    """The most distinct values that a task would have to sort."""
    segments = values.groupBy(key, "_base").count()
    return segments.agg(F.max("count")).first()[0] or 0


def _narrowed(
    values: DataFrame, key: str, points: dict[str, float], most: int, slices: int
) -> DataFrame:
    """The values of those slices of each large segment that hold a wanted rank.

    A segment is cut at approximate quantiles of its own distinct values, and behind
    its smallest one, so it always falls apart and every round makes progress. Cuts
    only balance the work: each value falls into exactly one slice and the slices are
    counted exactly, so the result does not depend on them. Segments that a task can
    sort stay whole.
    """
    steps = [i / slices for i in range(1, slices)]
    cuts = (
        values.groupBy(F.col(key).alias("_k"), F.col("_base").alias("_b"))
        .agg(
            F.count(F.lit(1)).alias("_size"),
            F.min("_v").alias("_least"),
            F.percentile_approx("_v", steps, slices * 100).alias("_cuts"),
        )
        .filter(F.col("_size") > most)
        .select("_k", "_b", F.array_append("_cuts", F.col("_least")).alias("_cuts"))
    )
    here = (F.col(key) == F.col("_k")) & (F.col("_base") == F.col("_b"))
    below = F.size(F.filter("_cuts", lambda cut: cut < F.col("_v")))
    sliced = values.join(cuts, here, "left").select(
        key, "_v", "_n", "_total", "_base",
        F.when(F.col("_cuts").isNull(), 0).otherwise(below).alias("_slice"),
    )

    # At most slices + 1 rows per segment.
    along = Window.partitionBy(key, "_base").orderBy("_slice")
    before = F.sum("_size").over(along.rowsBetween(Window.unboundedPreceding, 0))
    sizes = (
        sliced.groupBy(key, "_base", "_slice")
        .agg(F.sum("_n").alias("_size"), F.max("_total").alias("_total"))
        .withColumn("_first", F.col("_base") + before - F.col("_size"))
    )
    end = F.col("_first") + F.col("_size")
    wanted = _any(
        (rank >= F.col("_first")) & (rank < end)
        for p in points.values()
        for rank in _ranks(p)
    )
    needed = sizes.filter(wanted).select(key, "_base", "_slice", "_first")
    kept = sliced.join(needed, [key, "_base", "_slice"])
    return kept.select(key, "_v", "_n", "_total", F.col("_first").alias("_base"))


def _ranks(p: float) -> tuple[Column, Column]:
    """The two neighbouring positions (from 0) of quantile p."""
    place = F.lit(p) * (F.col("_total") - 1)
    return F.floor(place), F.ceil(place)


def _between(low: Column, high: Column, p: float) -> Column:
    place = F.lit(p) * (F.col("_total") - 1)
    return low + (high - low) * (place - F.floor(place))


def _any(conditions: Iterable[Column]) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out
