"""Pre-aggregated claims tables that every filter and rate re-aggregates.

All measures are counts and sums, so a rate or mean over any selection is a
ratio of sums. Rows with a missing key are left out of these tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sieveframe.functions.dates import day
from sieveframe.functions.numbers import (
    exact_sum,
    half_even,
    percent,
    ratio,
    to_bigint,
)
from sieveframe.operators.filters import OTHER
from sieveframe.operators.groups import with_group_size
from sieveframe.operators.quantiles import group_quantiles
from sieveframe.operators.ranking import ordered
from sieveframe.operators.rules import ERROR, WARN
from sieveframe.plans.claims import (
    AMOUNTS,
    CLAIMS,
    DATE,
    FRAUD,
    PARTS,
    SEVERITIES,
    SEVERITY,
    STATE,
    TOTAL,
    TYPE,
)
from sieveframe.sources.scratch import settle_small

MIN_GROUP = 10
KEYS = (STATE, TYPE)
GRAINS = {
    "by_state_type": KEYS,
    "by_state_type_severity": (*KEYS, SEVERITY),
    "by_state_type_day": (*KEYS, DATE),
}
# The five numbers of a box plot with 5% whiskers.
BOX = {"p5": 0.05, "q1": 0.25, "median": 0.5, "q3": 0.75, "p95": 0.95}


def summarize(claims: DataFrame) -> dict[str, DataFrame]:
    """The three summary tables, each a lazy aggregate over its own columns.

    Right for one table. ``summarize_at_once`` serves all of them.
    """
    return {name: _complete(_grouped(claims, name), name) for name in GRAINS}


def summarize_at_once(
    claims: DataFrame, min_group: int | None = None
) -> dict[str, DataFrame]:
    """The three summary tables from one pass over the claims, written once.

    The pass groups by severity and by day side by side, so the claims (and the
    joins that make them) are read a single time; the tables then read a small
    settled table. With ``min_group`` the result equals the summaries of
    ``merge_small(claims)``, without touching the rows again: group sizes are
    sums over the settled table, whose (state, type) groups hold at most one
    row per severity or day, and the relabelled groups are added up.
    """
    fine = [(*KEYS, SEVERITY), (*KEYS, "_day")]
    rows = claims.withColumn("_day", day(F.col(DATE)))
    base = settle_small(
        rows.groupingSets(fine, *KEYS, SEVERITY, "_day").agg(
            F.grouping(SEVERITY).alias("_by_day"), *_measures(claims)
        ),
        "summary-base",
    )
    measures = ["claims", "fraud_claims", *AMOUNTS]
    out = {}
    for name, keys in GRAINS.items():
        by_day = name == "by_state_type_day"
        part = base.filter(F.col("_by_day") == int(by_day))
        part = part.withColumn(DATE, F.col("_day")) if by_day else part
        if min_group is not None:
            size = F.sum("claims").over(Window.partitionBy(*KEYS))
            part = part.withColumn("_label", _merged_label(size, min_group))
            part = part.withColumn(TYPE, F.col("_label"))
        kept = [c for c in measures if c in _measure_names(name)]
        table = part.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in kept))
        out[name] = _complete(table, name)
    return out


def merge_small(
    df: DataFrame,
    keys: tuple[str, str] = KEYS,
    min_group: int = MIN_GROUP,
    **options,
) -> DataFrame:
    """Rows of groups below the limit get OTHER as the second key's value.

    So do rows with a missing key. The merged group may itself stay small;
    ``publish_report`` looks at that.
    """
    size = "_group_size"
    sized = with_group_size(df, list(keys), size, **options)
    label = _merged_label(F.col(size), min_group, keys)
    return sized.withColumn(keys[1], label).drop(size)


def amount_stats(claims: DataFrame) -> DataFrame:
    """Whole-number percentiles of the amount per type."""
    stats = group_quantiles(claims, TYPE, TOTAL, BOX)
    return stats.select(TYPE, *(half_even(F.col(c)).alias(c) for c in BOX))


def fraud_rate_by(summary: DataFrame, name: str) -> DataFrame:
    """fraud_pct of each value of ``name``, from counts of a summary table."""
    rate = half_even(percent(F.sum("fraud_claims"), F.sum("claims")), 1)
    return (
        summary.filter(F.col(name).isNotNull())
        .groupBy(name)
        .agg(rate.alias("fraud_pct"))
    )


def rate_heatmap(
    by_severity: DataFrame, severities: tuple[str, ...] = SEVERITIES
) -> DataFrame:
    """Whole percent of fraud per type (rows) and severity (columns in order).

    Unknown severities are left out; a cell without claims is null.
    """
    rate = half_even(percent(F.sum("fraud_claims"), F.sum("claims")))
    return (
        by_severity.filter(F.col(TYPE).isNotNull())
        .groupBy(TYPE)
        .pivot(SEVERITY, list(severities))
        .agg(rate)
    )


def state_table(by_type: DataFrame) -> DataFrame:
    """Claims, cost, mean claim and fraud rate per state, costliest first."""
    claims, cost = F.sum("claims"), F.sum(TOTAL)
    table = (
        by_type.filter(F.col(STATE).isNotNull())
        .groupBy(STATE)
        .agg(
            claims.alias("claims"),
            cost.cast("double").alias("total_cost"),
            to_bigint(F.rint(ratio(cost, claims))).alias("avg_claim"),
            percent(F.sum("fraud_claims"), claims).alias("fraud_pct"),
        )
    )
    return ordered(table, "total_cost", STATE)


def cost_parts(by_type: DataFrame) -> DataFrame:
    """Cost parts per type, ordered by what the parts add up to."""
    parts = by_type.filter(F.col(TYPE).isNotNull()).groupBy(TYPE).agg(
        *(F.sum(p).alias(p) for p in PARTS)
    )
    total = sum((F.coalesce(F.col(p).cast("double"), F.lit(0.0)) for p in PARTS), F.lit(0.0))
    named = {p: p.removesuffix("_claim") for p in PARTS}
    return ordered(parts.withColumn("_total", total), "_total", TYPE).select(
        TYPE, *(F.col(p).cast("double").alias(named[p]) for p in PARTS)
    )


def fraud_split(by_type: DataFrame) -> DataFrame:
    """Two rows: claims flagged as fraud and claims not flagged."""
    sums = by_type.agg(
        F.sum("fraud_claims").alias("flagged"), F.sum("claims").alias("claims")
    )
    return sums.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("Flagged as fraud").alias("name"),
                    F.col("flagged").alias("claims"),
                ),
                F.struct(
                    F.lit("Not flagged").alias("name"),
                    (F.col("claims") - F.col("flagged")).alias("claims"),
                ),
            )
        )
    )


def publish_report(
    tables: dict[str, DataFrame],
    rows: int,
    min_group: int = MIN_GROUP,
    without_state: int = 0,
) -> DataFrame:
    """Checks on summary tables that are about to be published.

    No sensitive column in any table, no state x type group below the limit,
    and as many claims as there are ``rows`` behind them. A warning says how many rows
    have no state, since these are in no group. The finer tables may hold smaller
    cells.
    """
    groups = tables["by_state_type"]
    leaks = sum(
        len(CLAIMS.sensitive & {c.lower() for c in df.columns})
        for df in tables.values()
    )
    facts = groups.agg(
        F.count_if(F.col("claims") < min_group).alias("small"),
        F.coalesce(F.sum("claims"), F.lit(0)).alias("total"),
    )
    lost = F.abs(F.lit(rows) - F.col("total"))
    checks = {
        "no sensitive columns": (ERROR, F.lit(leaks)),
        "groups large enough": (ERROR, F.col("small")),
        "all claims counted": (ERROR, lost),
        "claims without a state": (WARN, F.lit(without_state)),
    }
    return facts.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(name).alias("check"),
                        F.lit(severity).alias("severity"),
                        failed.cast("bigint").alias("failed_rows"),
                        F.array().cast("array<bigint>").alias("failed_index"),
                    )
                    for name, (severity, failed) in checks.items()
                )
            )
        )
    )


def _grouped(claims: DataFrame, name: str) -> DataFrame:
    keys = [day(F.col(DATE)).alias(DATE) if k == DATE else k for k in GRAINS[name]]
    table = claims.groupBy(*keys).agg(*_measures(claims))
    return table.select(*GRAINS[name], *_measure_names(name))


def _measures(claims: DataFrame) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("claims"),
        F.count_if(F.col(FRAUD)).alias("fraud_claims"),
        # A sum over nothing but missing amounts is 0.
        *(F.coalesce(exact_sum(claims, c), F.lit(0)).alias(c) for c in AMOUNTS),
    ]


def _measure_names(name: str) -> tuple[str, ...]:
    return {
        "by_state_type": ("claims", "fraud_claims", *AMOUNTS),
        "by_state_type_severity": ("claims", "fraud_claims"),
        "by_state_type_day": ("claims",),
    }[name]


def _complete(table: DataFrame, name: str) -> DataFrame:
    return table.dropna(subset=list(GRAINS[name]))


def _merged_label(
    size: Column, min_group: int, keys: tuple[str, str] = KEYS
) -> Column:
    known = F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull()
    return F.when(known & (size >= min_group), F.col(keys[1])).otherwise(OTHER)
