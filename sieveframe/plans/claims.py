"""Auto insurance claims: column names, cleaning choices and rules."""

from __future__ import annotations

from pathlib import Path

from sieveframe.operators.rules import (
    ERROR,
    WARN,
    any_negative,
    between,
    not_before,
    not_null,
    parts_sum_to,
    unique,
)
from sieveframe.plans.domain import Domain

STATE, TYPE, SEVERITY = "incident_state", "incident_type", "incident_severity"
DATE, FRAUD = "incident_date", "fraud_reported"
TOTAL = "total_claim_amount"
PARTS = ("injury_claim", "property_claim", "vehicle_claim")
AMOUNTS = (TOTAL, *PARTS)

# The severities from light to heavy.
SEVERITIES = ("Trivial Damage", "Minor Damage", "Major Damage", "Total Loss")


CLAIMS = Domain(
    table="claims",
    id_col="policy_number",
    # Fixed values from here on: the fill, the fix, the rules with their labels, severities
    # and limits, and the columns that never leave the house.
    fills={"collision_type": "Not Applicable"},
    fixes={"auto_make": {"Suburu": "Subaru"}},
    rules={
        "key columns present": (
            ERROR,
            not_null("policy_number", DATE, TOTAL, TYPE),
        ),
        "policy_number unique": (ERROR, unique("policy_number")),
        "claim parts sum to total": (ERROR, parts_sum_to(TOTAL, *PARTS)),
        "claim amounts not negative": (ERROR, any_negative(*AMOUNTS)),
        "age 16-100": (ERROR, between("age", 16, 100)),
        "incident hour 0-23": (ERROR, between("incident_hour_of_the_day", 0, 23)),
        "umbrella_limit not negative": (WARN, any_negative("umbrella_limit")),
        "incident on/after policy start": (
            WARN,
            not_before(DATE, "policy_bind_date"),
        ),
    },
    queries=Path(__file__).parent / "claims_sql",
    sensitive=frozenset({"policy_number", "insured_zip", "incident_location"}),
)
