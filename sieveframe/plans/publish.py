"""What leaves the house: published summaries and the full export."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveframe.operators.rules import raise_on_errors
from sieveframe.plans.claims import CLAIMS
from sieveframe.plans.summaries import (
    MIN_GROUP,
    STATE,
    amount_stats,
    publish_report,
    summarize_at_once,
)
from sieveframe.sources.exports import export_csvs
from sieveframe.sources.scratch import settle

# The columns of the published summary tables.
PUBLISHED = {
    "by_state_type": (
        "incident_state string, incident_type string, claims bigint, "
        "fraud_claims bigint, total_claim_amount double, injury_claim double, "
        "property_claim double, vehicle_claim double"
    ),
    "by_state_type_severity": (
        "incident_state string, incident_type string, incident_severity string, "
        "claims bigint, fraud_claims bigint"
    ),
    "by_state_type_day": (
        "incident_state string, incident_type string, incident_date date, "
        "claims bigint"
    ),
    "claim_amount_stats": (
        "incident_type string, p5 double, q1 double, median double, q3 double, "
        "p95 double"
    ),
}


def publish_summaries(
    claims: DataFrame,
    results: Mapping[str, DataFrame],
    folder: str,
    min_group: int = MIN_GROUP,
) -> list[str]:
    """Write the merged summaries, the amount statistics and the query results.

    The summaries are computed once, checked, and only then written as CSV. If
    a group is still too small after merging, or a claim is in no group because it has
    no state, nothing is written.
    """
    ready = {
        **summarize_at_once(claims, min_group),
        "claim_amount_stats": settle(amount_stats(claims), "amount-stats"),
    }
    seen = claims.agg(F.count(F.lit(1)).alias("rows"), F.count(STATE).alias("placed"))
    counted = seen.first()
    report = publish_report(
        {**ready, **results}, counted["rows"], min_group, counted["rows"] - counted["placed"]
    )
    raise_on_errors(report)
    return export_csvs({**ready, **results}, folder)


def export_all(
    claims: DataFrame, results: Mapping[str, DataFrame], folder: str
) -> list[str]:
    """The cleaned table and every query result."""
    return export_csvs({f"{CLAIMS.table}_clean": claims, **results}, folder)
