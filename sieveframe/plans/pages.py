"""Figures computed from claim rows: overview, fraud and geography.

These keep a NULL group where a key is missing, as SQL's GROUP BY does, and
leave rates unrounded. Every function takes the selected rows.

Fixed values: the wording of notes and captions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveframe.functions.dates import long_day, week_start
from sieveframe.functions.numbers import (
    as_percent,
    big_dollars,
    dollars,
    exact_mean,
    exact_sum,
    grouped,
    rate,
    ratio,
    signed,
)
from sieveframe.functions.text import sentence
from sieveframe.operators.filters import select_rows
from sieveframe.operators.ranking import (
    category_order,
    key_at_max,
    key_at_min,
    ordered,
    share_of_total,
)
from sieveframe.operators.series import count_by_day, daily
from sieveframe.plans.claims import (
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


def select_claims(
    df: DataFrame, states: Sequence[str] = (), types: Sequence[str] = ()
) -> DataFrame:
    """The chosen states and types; no choice means all."""
    return select_rows(df, {STATE: states, TYPE: types})


def kpis(claims: DataFrame) -> DataFrame:
    """Count, cost, fraud rate, mean claim, first and last date of a selection."""
    return claims.agg(
        _claims(),
        exact_sum(claims, TOTAL).cast("double").alias("total_amount"),
        _fraud_rate(),
        exact_mean(claims, TOTAL).alias("avg_claim"),
        long_day(F.min(DATE)).alias("first_date"),
        long_day(F.max(DATE)).alias("last_date"),
    )


def compare_kpis(selected: DataFrame, everything: DataFrame, filtered: bool) -> DataFrame:
    """Headline numbers of a selection, each against the whole data set.

    Takes (state, type) summaries. The totals of the whole stand beside the
    selection as scalar subqueries.
    """
    claims, fraud, cost = F.col("claims"), F.col("fraud_claims"), F.col("cost")

    def sums(df: DataFrame) -> DataFrame:
        return df.agg(
            F.sum("claims").alias("claims"),
            F.sum("fraud_claims").alias("fraud_claims"),
            F.sum(TOTAL).cast("double").alias("cost"),
        )

    whole = sums(everything)
    all_claims = whole.select("claims").scalar()
    all_fraud = whole.select("fraud_claims").scalar()
    all_cost = whole.select("cost").scalar()
    mean = ratio(cost, claims)
    share, all_share = ratio(fraud, claims), ratio(all_fraud, all_claims)
    if filtered:
        notes = {
            "claims_note": F.concat(
                as_percent(ratio(claims, all_claims), 1), F.lit(" of all claims")
            ),
            "cost_note": F.concat(
                as_percent(ratio(cost, all_cost), 1), F.lit(" of total cost")
            ),
            "rate_note": F.concat(
                signed((share - all_share) * 100, 1),
                F.lit(" pts vs. dataset average"),
            ),
            "avg_note": F.concat(
                signed((ratio(mean, ratio(all_cost, all_claims)) - 1) * 100, 0),
                F.lit("% vs. dataset average"),
            ),
        }
    else:
        everything_text, average = F.lit("All claims"), F.lit("Dataset average")
        notes = {
            "claims_note": everything_text,
            "cost_note": everything_text,
            "rate_note": average,
            "avg_note": average,
        }
    return sums(selected).select(
        grouped(claims).alias("total_claims"),
        big_dollars(cost).alias("total_amount"),
        as_percent(share, 1).alias("fraud_rate"),
        dollars(mean).alias("avg_claim"),
        *(note.alias(name) for name, note in notes.items()),
    )


def caption(
    selected: DataFrame, everything: DataFrame, selected_days: DataFrame
) -> DataFrame:
    """'Incidents from Jan 1, 2015 to Mar 1, 2015 · 12 of 1,000 claims'.

    Takes (state, type) summaries and the day summary of the selection.
    """
    total = everything.agg(F.sum("claims")).scalar()
    ends = selected_days.agg(F.min(DATE).alias("first"), F.max(DATE).alias("last"))
    return selected.agg(F.sum("claims").alias("claims")).select(
        sentence(
            "Incidents from ", long_day(ends.select("first").scalar()),
            " to ", long_day(ends.select("last").scalar()), " \u00b7 ",
            grouped(F.col("claims")), " of ", grouped(total), " claims",
        ).alias("caption")
    )


def daily_claims(claims: DataFrame) -> DataFrame:
    """Claims per day with the two-week mean, days without claims as 0."""
    return daily(count_by_day(claims, DATE)).orderBy("day")


def weekly(claims: DataFrame) -> DataFrame:
    """Claims, cost and distinct days with data per week from Monday."""
    return (
        claims.groupBy(week_start(F.col(DATE)).alias("week_start"))
        .agg(
            _claims(),
            exact_sum(claims, TOTAL).cast("double").alias("claim_cost"),
            F.count_distinct(DATE).alias("days_with_data"),
        )
        .orderBy(F.col("week_start").asc_nulls_last())
    )


def cost_split(claims: DataFrame) -> DataFrame:
    """Cost parts per type, ordered by the total amount."""
    parts = claims.groupBy(TYPE).agg(
        *(
            exact_sum(claims, p).cast("double").alias(p.removesuffix("_claim"))
            for p in PARTS
        ),
        exact_sum(claims, TOTAL).alias("_total"),
    )
    return ordered(parts, "_total", TYPE).drop("_total")


def fraud_kpis(claims: DataFrame) -> DataFrame:
    """Fraud count and rate, and what a flagged claim costs against another."""
    flagged, other = F.col(FRAUD), ~F.col(FRAUD)
    means = claims.select(
        FRAUD,
        F.when(flagged, F.col(TOTAL)).alias("flagged"),
        F.when(other, F.col(TOTAL)).alias("other"),
    )
    out = means.agg(
        F.count_if(flagged).alias("fraud_claims"),
        _fraud_rate(),
        exact_mean(means, "flagged").alias("avg_fraud_claim"),
        exact_mean(means, "other").alias("avg_other_claim"),
    )
    premium = ratio(F.col("avg_fraud_claim"), F.col("avg_other_claim")) - 1
    return out.withColumn("fraud_premium", premium)


def rate_by(claims: DataFrame, name: str) -> DataFrame:
    """Claims and fraud rate per value of a column, highest rate first."""
    out = claims.groupBy(name).agg(_claims(), _fraud_rate())
    return ordered(out, "fraud_rate", name)


def type_by_severity(
    claims: DataFrame, severities: Sequence[str] = SEVERITIES
) -> DataFrame:
    """Claims and fraud rate per type and severity, severities light to heavy."""
    place = category_order(F.col(SEVERITY), severities)
    out = claims.groupBy(TYPE, SEVERITY).agg(_claims(), _fraud_rate())
    return out.withColumn("severity_order", place).orderBy(
        "severity_order",
        F.col(TYPE).asc_nulls_last(),
        F.col(SEVERITY).asc_nulls_last(),
    )


def by_state(claims: DataFrame) -> DataFrame:
    """Claims, cost, share of cost, mean claim and fraud rate per state."""
    groups = settle_small(
        claims.groupBy(STATE).agg(
            _claims(),
            exact_sum(claims, TOTAL).cast("double").alias("claim_cost"),
            exact_mean(claims, TOTAL).alias("avg_claim"),
            _fraud_rate(),
        ),
        "states",
    )
    share = share_of_total(groups, "claim_cost").alias("cost_share")
    out = groups.select(
        STATE, "claims", "claim_cost", share, "avg_claim", "fraud_rate"
    )
    return ordered(out, "claim_cost", STATE)


def state_extremes(states: DataFrame) -> DataFrame:
    """The costliest state with its claims and share, and the smallest state."""
    claims, state = F.col("claims"), F.col(STATE)
    kept = F.struct(state.alias("state"), claims.alias("claims"))
    best = key_at_max(F.col("claim_cost"), state, kept)
    return states.agg(
        best.alias("best"),
        F.max("cost_share").alias("share"),
        key_at_min(claims, state).alias("small_state"),
        F.min(claims).alias("small_claims"),
    ).select(
        F.col("best.state").alias("top_state"),
        grouped(F.col("best.claims")).alias("top_claims"),
        as_percent(F.col("share"), 0).alias("top_share"),
        "small_state",
        "small_claims",
    )


def _claims() -> Column:
    return F.count(F.lit(1)).alias("claims")


def _fraud_rate() -> Column:
    return rate(F.col(FRAUD)).alias("fraud_rate")
