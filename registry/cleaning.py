"""Cleaning steps on a messy customer table."""

from pyspark.sql import functions as F

from registry.common import CLAIMS, MESSY, Registry, messy
from sieveframe.bindings import claims
from sieveframe.functions.numbers import half_even, percent
from sieveframe.operators import cleaning
from sieveframe.operators.ranking import category_order
from sieveframe.plans.claims import CLAIMS as DOMAIN
from sieveframe.plans.claims import SEVERITIES, SEVERITY, TOTAL

REGISTRY = Registry()
query = REGISTRY.query

ALL = "customer_id, mkt_segment, in_credit, c39, auto_make, collision_type, acct_bal"


@query("snake_case", f"{MESSY} SELECT {ALL} FROM messy")
def snake_case(spark, folder):
    return cleaning.rename_snake_case(messy(spark, folder))


@query("strip_text", f"{MESSY} SELECT {ALL} FROM tidy")
def strip_text(spark, folder):
    return cleaning.strip_text(cleaning.rename_snake_case(messy(spark, folder)))


@query(
    "fill_missing",
    f"""{MESSY}
SELECT customer_id, mkt_segment, in_credit, c39, auto_make,
       coalesce(collision_type, 'Not Applicable') AS collision_type, acct_bal
FROM tidy""",
)
def fill_missing(spark, folder):
    df = cleaning.strip_text(cleaning.rename_snake_case(messy(spark, folder)))
    fills = {"collision_type": "Not Applicable", "no_such_column": "x"}
    return cleaning.fill_missing(df, fills)


@query(
    "drop_empty_columns",
    f"""{MESSY}
SELECT customer_id, mkt_segment, in_credit, auto_make, collision_type, acct_bal
FROM messy""",
)
def drop_empty_columns(spark, folder):
    return cleaning.drop_empty_columns(
        cleaning.rename_snake_case(messy(spark, folder))
    )


@query("drop_duplicates", f"{MESSY} SELECT DISTINCT {ALL} FROM messy")
def drop_duplicates(spark, folder):
    return cleaning.drop_duplicates(cleaning.rename_snake_case(messy(spark, folder)))


@query(
    "yes_no_to_bool",
    f"""{MESSY}
SELECT customer_id, mkt_segment, upper(in_credit) = 'YES' AS in_credit, c39,
       auto_make, collision_type, acct_bal
FROM tidy""",
)
def yes_no_to_bool(spark, folder):
    df = cleaning.strip_text(cleaning.rename_snake_case(messy(spark, folder)))
    return cleaning.convert_yes_no(df)


CLEAN = f"""{MESSY}
SELECT DISTINCT customer_id, mkt_segment, upper(in_credit) = 'YES' AS in_credit,
       {{make}} AS auto_make,
       coalesce(collision_type, 'Not Applicable') AS collision_type, acct_bal
FROM tidy"""


@query("clean_all", CLEAN.format(make="auto_make"))
def clean_all(spark, folder):
    return cleaning.clean(messy(spark, folder), DOMAIN.fills)


@query(
    "replace_values",
    f"""{MESSY}
SELECT customer_id, mkt_segment, in_credit, c39,
       replace(auto_make, 'Suburu', 'Subaru') AS auto_make, collision_type, acct_bal
FROM messy""",
)
def replace_values(spark, folder):
    df = cleaning.rename_snake_case(messy(spark, folder))
    return cleaning.replace_values(df, {**DOMAIN.fixes, "absent": {"a": "b"}})


@query(
    "clean_claims",
    CLEAN.format(make="replace(auto_make, 'Suburu', 'Subaru')"),
)
def clean_claims(spark, folder):
    return DOMAIN.clean(messy(spark, folder))


@query(
    "derived_columns",
    f"""{CLAIMS}
SELECT policy_number AS policy,
       CASE WHEN total_claim_amount <> 0
            THEN round_even(100.0 * injury_claim / total_claim_amount, 1) END
         AS injury_pct
FROM claims""",
)
def derived_columns(spark, folder):
    df = claims(spark, folder, "policy_number", TOTAL, "injury_claim")
    share = half_even(percent(F.col("injury_claim"), F.col(TOTAL)), 1)
    return (
        df.withColumn("injury_pct", share)
        .withColumnRenamed("policy_number", "policy")
        .drop(TOTAL, "injury_claim")
    )


@query(
    "severity_order",
    f"""{CLAIMS}
SELECT policy_number,
       CASE incident_severity WHEN 'Trivial Damage' THEN 1 WHEN 'Minor Damage' THEN 2
            WHEN 'Major Damage' THEN 3 ELSE 4 END AS severity_order
FROM claims""",
)
def severity_order(spark, folder):
    df = claims(spark, folder, "policy_number", SEVERITY)
    place = category_order(F.col(SEVERITY), SEVERITIES)
    return df.select("policy_number", place.alias("severity_order"))
