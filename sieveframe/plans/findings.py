"""Findings as sentences, every number computed from the data.

``page_*`` functions work on claim rows and keep their numbers as columns;
``insights`` works on the three summary tables and returns the sentences as
rows ``(section, seq, text)``.

Fixed values: section names and the wording of the sentences.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveframe.functions.dates import day, days_spanned, long_day, short_day
from sieveframe.functions.numbers import (
    as_percent,
    dollars,
    exact_sum,
    fixed,
    grouped,
    ratio,
    signed,
)
from sieveframe.functions.text import sentence
from sieveframe.operators.filters import at_least, without_other
from sieveframe.operators.ranking import share_of_total, top
from sieveframe.operators.series import (
    ROLLING_DAYS,
    count_by_day,
    fill_days,
    halves,
)
from sieveframe.plans.claims import DATE, FRAUD, SEVERITY, STATE, TOTAL, TYPE
from sieveframe.sources.scratch import settle_small

MIN_CLAIMS = 20
KEY, TRENDS, WATCH, CAVEATS = (
    "Key findings",
    "Trends",
    "What to watch next",
    "Caveats",
)


def facts(claims: DataFrame) -> DataFrame:
    """Counts, fraud rate and the period of a selection, formatted."""
    return _facts(_measure(claims))


def top_severity(claims: DataFrame) -> DataFrame:
    """The severity with the highest fraud rate."""
    return _top_severity(_measure(claims, SEVERITY))


def top_type(claims: DataFrame) -> DataFrame:
    """The type with the highest mean amount, and its share of all cost."""
    return _top_type(settle_small(_measure(claims, TYPE), "types"))


def top_state(claims: DataFrame) -> DataFrame:
    """The costliest state, its share of all cost and its fraud rate."""
    return _top_state(settle_small(_measure(claims, STATE), "states"))


def trend(claims: DataFrame) -> DataFrame:
    """Claims per day in the two halves of the period and the change."""
    return _trend(count_by_day(claims, DATE))


def watch(claims: DataFrame, min_claims: int = MIN_CLAIMS) -> DataFrame:
    """The type and severity with the highest fraud rate among large groups."""
    return _watch(_measure(claims, TYPE, SEVERITY), min_claims)


def page_sentences(claims: DataFrame) -> DataFrame:
    """The findings page as rows: the six tables above put into sentences.

    One pass groups the claims by state, by type and severity, and by day side
    by side; the six tables add up what they need from the settled groups.
    """
    rows = claims.withColumn("_day", day(F.col(DATE)))
    grains = [(STATE,), (TYPE, SEVERITY), ("_day",)]
    base = settle_small(
        rows.groupingSets(grains, STATE, TYPE, SEVERITY, "_day").agg(
            F.grouping(STATE).alias("_no_state"),
            F.grouping("_day").alias("_no_day"),
            *_measures(claims),
        ),
        "page-base",
    )
    states = base.filter("_no_state = 0")
    days = base.filter("_no_day = 0")
    pairs = base.filter("_no_state = 1 AND _no_day = 1")

    seen = _facts(_regroup(pairs))
    overall = seen.select("fraud_rate").scalar()
    count = seen.select("claims").scalar()
    severity = _say(
        _top_severity(_regroup(pairs, SEVERITY)), KEY, 1,
        F.col(SEVERITY), " claims have the highest fraud rate at ",
        F.col("fraud_rate"), " (", F.col("fraud_claims"), " of ", F.col("claims"),
        "), versus ", overall, " across all ", count, " selected claims.",
    )
    kind = _say(
        _top_type(_regroup(pairs, TYPE)), KEY, 2,
        F.col(TYPE), " claims cost the most on average (", F.col("avg_claim"),
        ") and make up ", F.col("cost_share"), " of total claim cost.",
    )
    state = _say(
        _top_state(states), KEY, 3,
        F.col(STATE), " accounts for the largest share of claim cost (",
        F.col("cost_share"), "), with a fraud rate of ", F.col("fraud_rate"), ".",
    )
    direction = F.when(F.col("rose"), "a rise").otherwise("a drop")
    change = _say(
        _trend(count_by_day(days, "_day", n=F.col("claims"))), TRENDS, 1,
        F.when(F.col("days") < ROLLING_DAYS, _too_short(F.col("days"))).otherwise(
            sentence(
                "Claims averaged ", F.col("first_half"),
                " per day in the first half of the period and ",
                F.col("second_half"), " in the second half, ", direction, " of ",
                F.col("change"), " per day.",
            )
        ),
    )
    single = sentence(
        F.col(TYPE), " claims with ", F.col(SEVERITY), ": ", F.col("fraud_rate"),
        " of ", F.col("claims"),
    )
    best = _watch(pairs, MIN_CLAIMS)
    singled_out = _watch_sentence(best, single, " has 20+ claims, so none")
    caveats = _caveats(seen, F.col("claims"), F.col("fraud_claims"))
    return _stack(severity, kind, state, change, singled_out, *caveats)


def _measures(claims: DataFrame) -> list[Column]:
    """Counts and sums that add up over groups, for the columns there are."""
    out = [F.count(F.lit(1)).alias("claims")]
    if FRAUD in claims.columns:
        out += [
            F.count_if(FRAUD).alias("fraud_claims"), F.count(FRAUD).alias("labelled"),
        ]
    if TOTAL in claims.columns:
        out += [exact_sum(claims, TOTAL).alias("cost"), F.count(TOTAL).alias("priced")]
    if DATE in claims.columns:
        out += [F.min(DATE).alias("first"), F.max(DATE).alias("last")]
    return out


def _measure(claims: DataFrame, *keys: str) -> DataFrame:
    return claims.groupBy(*keys).agg(*_measures(claims))


def _regroup(groups: DataFrame, *keys: str) -> DataFrame:
    """The same measures for coarser groups."""
    added = ("claims", "fraud_claims", "labelled", "cost", "priced")
    return groups.groupBy(*keys).agg(
        *(F.sum(c).alias(c) for c in added),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )


def _rate() -> Column:
    return ratio(F.col("fraud_claims"), F.col("labelled"))


def _facts(total: DataFrame) -> DataFrame:
    days = days_spanned(F.col("first"), F.col("last"))
    return total.select(
        grouped(F.col("claims")).alias("claims"),
        grouped(F.col("fraud_claims")).alias("fraud_claims"),
        as_percent(_rate(), 1).alias("fraud_rate"),
        short_day(F.col("first")).alias("first_date"),
        long_day(F.col("last")).alias("last_date"),
        days.alias("days"),
        fixed(days / F.lit(30.0), 1).alias("months"),
    )


def _top_severity(groups: DataFrame) -> DataFrame:
    return top(groups.withColumn("rate", _rate()), "rate", SEVERITY).select(
        SEVERITY, as_percent(F.col("rate"), 1).alias("fraud_rate"),
        "fraud_claims", "claims",
    )


def _top_type(groups: DataFrame) -> DataFrame:
    groups = groups.select(
        TYPE, "cost", ratio(F.col("cost"), F.col("priced")).alias("mean")
    )
    groups = groups.withColumn("share", share_of_total(groups, "cost"))
    return top(groups, "mean", TYPE).select(
        TYPE,
        dollars(F.round("mean")).alias("avg_claim"),
        as_percent(F.col("share"), 0).alias("cost_share"),
    )


def _top_state(groups: DataFrame) -> DataFrame:
    groups = groups.select(STATE, "cost", _rate().alias("rate"))
    groups = groups.withColumn("share", share_of_total(groups, "cost"))
    return top(groups, "cost", STATE).select(
        STATE,
        as_percent(F.col("share"), 0).alias("cost_share"),
        as_percent(F.col("rate"), 1).alias("fraud_rate"),
    )


def _trend(counts: DataFrame) -> DataFrame:
    both = halves(fill_days(counts))
    change = F.col("second_half") - F.col("first_half")
    return both.select(
        "days",
        fixed(F.col("first_half"), 1).alias("first_half"),
        fixed(F.col("second_half"), 1).alias("second_half"),
        (F.col("second_half") >= F.col("first_half")).alias("rose"),
        fixed(F.abs(change), 1).alias("change"),
    )


def _watch(groups: DataFrame, min_claims: int) -> DataFrame:
    large = at_least(groups.withColumn("rate", _rate()), "claims", min_claims)
    return top(large, "rate", TYPE, SEVERITY).select(
        TYPE, SEVERITY, "claims", as_percent(F.col("rate"), 0).alias("fraud_rate")
    )


def insights(tables: dict[str, DataFrame]) -> DataFrame:
    """Findings from the (filtered) summary tables as rows.

    The merged group of small types is never named, but its cost counts in the
    total. A selection that leaves nothing to name yields no such row.
    """
    by_type, by_severity = tables["by_state_type"], tables["by_state_type_severity"]
    series = fill_days(
        count_by_day(tables["by_state_type_day"], DATE, n=F.col("claims"))
    )
    totals = by_type.agg(
        F.sum("claims").alias("claims"), F.sum("fraud_claims").alias("fraud")
    )
    all_claims = totals.select("claims").scalar()
    all_fraud = totals.select("fraud").scalar()

    severity = _say(
        top(_rates(by_severity, SEVERITY), "rate", SEVERITY), KEY, 1,
        F.col(SEVERITY), " claims have the highest fraud rate at ",
        as_percent(F.col("rate"), 1), " (", F.col("fraud"), " of ", F.col("claims"),
        "), versus ", as_percent(ratio(all_fraud, all_claims), 1), " across all ",
        grouped(all_claims), " selected claims.",
    )

    costs = by_type.filter(F.col(TYPE).isNotNull()).groupBy(TYPE).agg(
        F.sum(TOTAL).alias("cost"),
        ratio(F.sum(TOTAL), F.sum("claims")).alias("mean"),
    )
    share = ratio(F.col("cost"), costs.agg(F.sum("cost")).scalar())
    kind = _say(
        top(without_other(costs, TYPE), "mean", TYPE), KEY, 2,
        F.col(TYPE), " claims cost the most on average (", dollars(F.col("mean")),
        ") and make up ", as_percent(share, 0), " of total claim cost.",
    )

    first, second = F.col("first_half"), F.col("second_half")
    change = _say(
        halves(series).filter(F.col("days") > 0), TRENDS, 1,
        F.when(F.col("days") < ROLLING_DAYS, _too_short(F.col("days"))).otherwise(
            sentence(
                "Claims averaged ", fixed(first, 1),
                " per day in the first half of the period and ", fixed(second, 1),
                " in the second half (", signed(second - first, 1), " per day).",
            )
        ),
    )

    pairs = at_least(
        _rates(without_other(by_severity, TYPE), TYPE, SEVERITY), "claims", MIN_CLAIMS
    )
    single = sentence(
        F.col(TYPE), " claims with ", F.col(SEVERITY), ": ",
        as_percent(F.col("rate"), 0), " of ", F.col("claims"),
    )
    singled_out = _watch_sentence(
        top(pairs, "rate", TYPE, SEVERITY),
        single,
        " has 20+ claims under these filters, so none",
    )

    days = days_spanned(F.min("day"), F.max("day"))
    ends = series.agg(
        short_day(F.min("day")).alias("first_date"),
        long_day(F.max("day")).alias("last_date"),
        days.alias("days"),
        fixed(days / F.lit(30.0), 1).alias("months"),
    ).filter(F.col("days").isNotNull())
    caveats = _caveats(ends, grouped(all_claims), grouped(all_fraud))
    return _stack(severity, kind, change, singled_out, *caveats)


def _rates(summary: DataFrame, *keys: str) -> DataFrame:
    claims, fraud = F.sum("claims"), F.sum("fraud_claims")
    return (
        summary.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(
            claims.alias("claims"),
            fraud.alias("fraud"),
            ratio(fraud, claims).alias("rate"),
        )
    )


def _watch_sentence(best: DataFrame, single: Column, none: str) -> DataFrame:
    """One row whether or not a combination qualifies."""
    named = sentence(
        F.col("text"),
        f" are flagged as fraud, the highest of any combination with {MIN_CLAIMS}+ "
        "claims. These deserve a closer look in the next review.",
    )
    nothing = f"No incident type and severity combination{none} is singled out."
    # A global aggregate yields a row even if there is none to name.
    found = best.select(single.alias("text")).agg(F.max("text").alias("text"))
    return _say(found, WATCH, 1, F.coalesce(named, F.lit(nothing)))


def _caveats(ends: DataFrame, claims: Column, fraud: Column) -> list[DataFrame]:
    period = _say(
        ends, CAVEATS, 1,
        "The data covers only ", F.col("days"), " days (", F.col("first_date"),
        " to ", F.col("last_date"), ", about ", F.col("months"),
        " months), too short for a reliable forecast or any seasonal pattern.",
    )
    label = _say(
        ends, CAVEATS, 2,
        '"Fraud" is the dataset\'s `fraud_reported` label (', fraud, " of ", claims,
        " claims), not proof of fraud; every pattern here is a correlation.",
    )
    return [period, label]


def _too_short(days: Column) -> Column:
    return sentence("Only ", days, " days are selected, too few to compare periods.")


def _say(df: DataFrame, section: str, seq: int, *parts: Column | str) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"),
        F.lit(seq).alias("seq"),
        sentence(*parts).alias("text"),
    )


def _stack(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionAll, tables)
