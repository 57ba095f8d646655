"""The report as data: headline facts, headline sentences and section tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveframe.functions.numbers import fixed, grouped, percent
from sieveframe.functions.text import sentence
from sieveframe.operators.filters import full_weeks
from sieveframe.operators.ranking import key_at_max, top, with_top_flag
from sieveframe.operators.rules import ERROR, WARN
from sieveframe.plans.claims import SEVERITY, STATE, TYPE

TOP_STATES = 3


def report_facts(results: dict[str, DataFrame], validation: DataFrame) -> DataFrame:
    """One row with every number the report's text needs.

    ``results`` are the four analysis tables. Each gives one row of small aggregates,
    put beside the others as a scalar subquery.
    """
    severity = results["fraud_by_severity"]
    kind = results["fraud_by_incident_type"]
    state, week = results["claims_by_state"], results["claims_by_week"]
    leading = top(state, "total_amount", STATE, n=TOP_STATES).agg(
        F.array_join(
            F.transform(
                F.array_sort(
                    F.collect_list(F.struct(-F.col("total_amount"), F.col(STATE)))
                ),
                lambda row: row[STATE],
            ),
            ", ",
        ).alias("states"),
        F.sum("pct_of_total_amount").alias("share"),
    )
    failed = F.col("failed_rows") > 0
    # One row of facts a table, and one scan for it.
    of_severity = severity.agg(
        F.sum("claims").alias("claims"),
        F.sum("fraud_claims").cast("bigint").alias("fraud_claims"),
        _row_at_max("fraud_pct", SEVERITY).alias("best"),
    )
    of_kind = _scalar(
        kind,
        worst=_row_at_max("fraud_pct", TYPE),
        costly=_row_at_max("avg_amount", TYPE),
    )
    of_state = _scalar(state, total=F.sum("total_amount"))
    of_week = _scalar(week, first=F.min("first_day"), last=F.max("last_day"))
    of_checks = _scalar(
        validation,
        errors=F.count_if((F.col("severity") == ERROR) & failed),
        warnings=F.count_if((F.col("severity") == WARN) & failed),
    )
    found = of_severity.select(
        "*",
        of_kind.alias("kind"), of_state.alias("state"), of_week.alias("week"),
        of_checks.alias("checks"),
        leading.select(F.struct("states", "share")).scalar().alias("front"),
    )
    return found.select(
        "claims",
        "fraud_claims",
        percent(F.col("fraud_claims"), F.col("claims")).alias("fraud_pct"),
        F.col("state.total").alias("total_amount"),
        F.col("week.first").alias("first_day"),
        F.col("week.last").alias("last_day"),
        F.col("best.label").alias("top_severity"),
        F.col("best.value").alias("top_severity_pct"),
        F.col("kind.worst.label").alias("top_type"),
        F.col("kind.worst.value").alias("top_type_pct"),
        F.col("kind.costly.label").alias("costly_type"),
        F.col("kind.costly.value").alias("costly_type_avg"),
        F.col("front.states").alias("top_states"),
        F.col("front.share").alias("top_states_pct"),
        F.col("checks.errors").alias("failed_errors"),
        F.col("checks.warnings").alias("failed_warnings"),
    )


def _scalar(df: DataFrame, **facts: Column) -> Column:
    """Aggregates of a table as one struct beside another table's row."""
    named = [value.alias(name) for name, value in facts.items()]
    return df.agg(*named).select(F.struct(*facts)).scalar()


def headlines(facts: DataFrame) -> DataFrame:
    """The report's sentences as rows ``(seq, section, title, text)``.

    Fixed values: section names, titles and the wording of the sentences.
    """
    overall = _pct(F.col("fraud_pct"))
    lines = [
        (
            "Summary",
            None,
            sentence(
                grouped(F.col("claims")), " auto claims totalling $",
                grouped(F.col("total_amount")), ", incidents ",
                F.col("first_day"), " to ", F.col("last_day"), ". ",
                grouped(F.col("fraud_claims")), " claims (", overall,
                ") are labelled as fraud.",
            ),
        ),
        (
            "Fraud by severity",
            sentence(
                F.col("top_severity"), " claims are labelled fraud ",
                _pct(F.col("top_severity_pct")), " of the time vs ", overall,
                " overall",
            ),
            sentence("Overall fraud rate is ", overall, "."),
        ),
        (
            "Fraud by incident type",
            F.lit("Fraud rate (%) by incident type"),
            sentence(
                "Highest fraud rate: ", F.col("top_type"), " (",
                _pct(F.col("top_type_pct")), "). Highest average claim: ",
                F.col("costly_type"), " ($", grouped(F.col("costly_type_avg")), ").",
            ),
        ),
        (
            "Claim cost by state",
            sentence(
                F.col("top_states"), " account for ",
                fixed(F.col("top_states_pct"), 0), "% of claim cost",
            ),
            F.lit("Share of total claim cost by incident state."),
        ),
        (
            "Weekly claim volume",
            F.lit("Weekly claim volume (full weeks only)"),
            F.lit("Weeks run from Monday. Partial weeks are only in the table."),
        ),
        (
            "Data quality",
            None,
            sentence(
                F.when(F.col("failed_errors") == 0, "All error checks passed. ")
                .otherwise(sentence(F.col("failed_errors"), " error checks failed. ")),
                F.col("failed_warnings"),
                " warning checks flagged rows that were kept for review.",
            ),
        ),
        (
            "Caveats",
            None,
            F.lit(
                "'Fraud' is the fraud_reported label of the data, not a proven "
                "outcome. The patterns are correlations, not causes, and a short "
                "period shows no seasons."
            ),
        ),
    ]
    rows = [
        F.struct(
            F.lit(i).alias("seq"),
            F.lit(section).alias("section"),
            (F.lit(None) if title is None else title).cast("string").alias("title"),
            text.alias("text"),
        )
        for i, (section, title, text) in enumerate(lines, 1)
    ]
    return facts.select(F.inline(F.array(*rows)))


def section_tables(
    results: dict[str, DataFrame], validation: DataFrame
) -> dict[str, DataFrame]:
    """The tables behind the sections; ranked ones flag their largest row."""
    return {
        "Fraud by severity": with_top_flag(
            results["fraud_by_severity"], SEVERITY, "fraud_pct"
        ),
        "Fraud by incident type": with_top_flag(
            results["fraud_by_incident_type"], TYPE, "fraud_pct"
        ),
        "Claim cost by state": with_top_flag(
            results["claims_by_state"], STATE, "total_amount"
        ),
        "Weekly claim volume": results["claims_by_week"],
        "Weekly claim volume, full weeks": full_weeks(results["claims_by_week"]),
        "Data quality": validation,
    }


def _row_at_max(value: str, label: str) -> Column:
    kept = F.struct(F.col(label).alias("label"), F.col(value).alias("value"))
    return key_at_max(F.col(value), F.col(label), kept)


def _pct(col: Column) -> Column:
    return F.concat(fixed(col, 1), F.lit("%"))
