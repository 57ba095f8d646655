"""Data-quality rules, the report and the gate."""

from pyspark.sql import functions as F

from registry.common import CLAIMS, Registry
from sieveframe.bindings import claims, read
from sieveframe.operators import cleaning, rules
from sieveframe.operators.groups import with_group_size
from sieveframe.plans.claims import CLAIMS as DOMAIN
from sieveframe.plans.claims import DATE, PARTS, TOTAL, TYPE
from sieveframe.sources.scratch import settle

REGISTRY = Registry()
query = REGISTRY.query

# Order lines with a key of one column, two parts of the price, and the order's
# day. The first line of each order misses its total by one.
LINES = """
WITH lines AS (
  SELECT l_orderkey * 10 + l_linenumber AS line_id, l_orderkey, l_partkey, l_quantity,
         l_returnflag, l_shipdate, l_discount,
         l_extendedprice * l_discount AS saved,
         l_extendedprice * (1 - l_discount) AS paid,
         l_extendedprice + CASE WHEN l_linenumber = 1 THEN 1.0 ELSE 0.0 END AS total,
         o_orderdate
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
)"""


def lines(spark, folder, with_order=True):
    price, off = F.col("l_extendedprice"), F.col("l_discount")
    items = read(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"),
        "l_orderkey",
        "l_partkey",
        "l_quantity",
        "l_returnflag",
        "l_shipdate",
        "l_discount",
        (price * off).alias("saved"),
        (price * (1 - off)).alias("paid"),
        (price + F.when(F.col("l_linenumber") == 1, 1.0).otherwise(0.0)).alias("total"),
    )
    if not with_order:
        return items
    orders = read(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.drop("o_orderkey")


RETURNED = "nullif(l_returnflag, 'R')"
BAD = {
    "not_null": f"{RETURNED} IS NULL",
    "between": "NOT coalesce(l_quantity BETWEEN 5 AND 45, false)",
    "parts": "NOT coalesce(abs(saved + paid - total) <= 1e-8 + 1e-5 * abs(total), false)",
    "not_before": "coalesce(l_shipdate < o_orderdate, false)",
    "custom": "l_discount * l_quantity > 4.0",
}
CHECKS = {
    "not_null": rules.not_null("returned", "l_orderkey"),
    "between": rules.between("l_quantity", 5, 45),
    "parts": rules.parts_sum_to("total", "saved", "paid"),
    "not_before": rules.not_before("l_shipdate", "o_orderdate"),
    "custom": "l_discount * l_quantity > 4.0D",
}


def _rule_query(name):
    def run(spark, folder):
        df = lines(spark, folder).withColumn(
            "returned", F.nullif("l_returnflag", F.lit("R"))
        )
        return rules.bad_rows(df, CHECKS[name]).select("line_id", "l_partkey")

    return run


for _name, _bad in BAD.items():
    REGISTRY.add(
        f"rule_{_name}",
        _rule_query(_name),
        f"{LINES} SELECT line_id, l_partkey FROM lines WHERE {_bad}",
    )


@query(
    "rule_unique",
    f"""{LINES}
SELECT line_id, l_partkey FROM lines
WHERE line_id IN (SELECT line_id FROM lines GROUP BY line_id HAVING count(*) > 1)""",
)
def rule_unique(spark, folder):
    df = lines(spark, folder, with_order=False).select("line_id", "l_partkey")
    return rules.bad_rows(df, rules.unique("line_id"))


@query(
    "group_size",
    """
SELECT event_id, user_id, event_type,
       count(*) OVER (PARTITION BY user_id, event_type) AS group_size
FROM events""",
)
def group_size(spark, folder):
    df = read(spark, folder, "events").select("event_id", "user_id", "event_type")
    return with_group_size(df, ["user_id", "event_type"])


def _report_sql(source, entries, key):
    parts = [
        f"""
SELECT '{name}' AS "check", '{severity}' AS severity, count(*) AS failed_rows,
       coalesce(list(id ORDER BY id) FILTER (WHERE place <= 10), []) AS failed_index
FROM (SELECT {key} AS id, row_number() OVER (ORDER BY {key}) AS place
      FROM {source} WHERE {bad})"""
        for name, severity, bad in entries
    ]
    return " UNION ALL ".join(parts)


LINE_RULES = {
    "line_id unique": (rules.ERROR, rules.unique("line_id")),
    "parts": (rules.ERROR, CHECKS["parts"]),
    "shipped late enough": (rules.WARN, CHECKS["not_before"]),
    "quantity": (rules.WARN, CHECKS["between"]),
    "custom": (rules.WARN, lambda df: df["l_discount"] * df["l_quantity"] > 4.0),
    "never": (rules.WARN, "l_quantity < 0"),
}


@query(
    "validation_report",
    LINES
    + _report_sql(
        "lines",
        [
            (
                "line_id unique",
                "error",
                "line_id IN (SELECT line_id FROM lines GROUP BY 1 HAVING count(*) > 1)",
            ),
            ("parts", "error", BAD["parts"]),
            ("shipped late enough", "warn", BAD["not_before"]),
            ("quantity", "warn", BAD["between"]),
            ("custom", "warn", BAD["custom"]),
            ("never", "warn", "l_quantity < 0"),
        ],
        "line_id",
    ),
)
def validation_report(spark, folder):
    # Like the run does: join once, then check the snapshot.
    return rules.validate(settle(lines(spark, folder)), LINE_RULES, "line_id")


CLAIM_BAD = [
    (
        "key columns present",
        "error",
        "policy_number IS NULL OR incident_date IS NULL OR total_claim_amount IS NULL "
        "OR incident_type IS NULL",
    ),
    (
        "policy_number unique",
        "error",
        "policy_number IN "
        "(SELECT policy_number FROM claims GROUP BY 1 HAVING count(*) > 1)",
    ),
    (
        "claim parts sum to total",
        "error",
        "NOT coalesce(abs(injury_claim + property_claim + vehicle_claim "
        "- total_claim_amount) <= 1e-8 + 1e-5 * abs(total_claim_amount), false)",
    ),
    (
        "claim amounts not negative",
        "error",
        "least(total_claim_amount, injury_claim, property_claim, vehicle_claim) < 0",
    ),
    ("age 16-100", "error", "NOT coalesce(age BETWEEN 16 AND 100, false)"),
    (
        "incident hour 0-23",
        "error",
        "NOT coalesce(incident_hour_of_the_day BETWEEN 0 AND 23, false)",
    ),
    ("umbrella_limit not negative", "warn", "umbrella_limit < 0"),
    ("incident on/after policy start", "warn", "incident_date < policy_bind_date"),
]


# What the rules read.
RULED = (
    "policy_number", "policy_bind_date", DATE, "incident_hour_of_the_day", "age",
    "umbrella_limit", TYPE, TOTAL, *PARTS,
)


@query("claims_rules", CLAIMS + _report_sql("claims", CLAIM_BAD, "policy_number"))
def claims_rules(spark, folder):
    return DOMAIN.validate(settle(claims(spark, folder, *RULED)))


@query(
    "failing_warnings",
    f"""{CLAIMS}
SELECT "check", failed_rows FROM ({_report_sql("claims", CLAIM_BAD, "policy_number")})
WHERE severity = 'warn' AND failed_rows > 0""",
)
def failing_warnings(spark, folder):
    report = DOMAIN.validate(settle(claims(spark, folder, *RULED)))
    return rules.failing_warnings(report).select("check", "failed_rows")


@query(
    "gate",
    LINES
    + f"""
SELECT true AS stopped, count(*) AS errors FROM (
  SELECT 1 FROM lines GROUP BY line_id HAVING count(*) > 1 LIMIT 1)
HAVING (SELECT count(*) FROM lines WHERE {BAD["between"]}) > 0""",
)
def gate(spark, folder):
    """The gate closes on errors and stays open on warnings."""
    df = lines(spark, folder, with_order=False)
    warnings = {"quantity": LINE_RULES["quantity"]}
    rules.raise_on_errors(rules.validate(df, warnings, "line_id"))
    one = {"line_id unique": LINE_RULES["line_id unique"]}
    report = rules.validate(df, one, "line_id")
    try:
        rules.raise_on_errors(report)
        stopped = False
    except ValueError:
        stopped = True
    return report.agg(
        F.lit(stopped).alias("stopped"),
        F.count_if(F.col("failed_rows") > 0).alias("errors"),
    )


# Line items with some numbers that are none: NaN stands for a missing one.
HOLEY = """
WITH holey AS (
  SELECT l_orderkey * 8 + l_linenumber AS line_id, l_quantity AS total,
         CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS kept,
         CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_quantity END AS part,
         CASE WHEN l_orderkey % 5 = 0 THEN l_quantity ELSE 0.0 END AS other
  FROM lineitem
)"""


def holey(spark, folder):
    key, quantity = F.col("l_orderkey"), F.col("l_quantity").cast("double")
    nan = F.lit(float("nan"))
    return read(spark, folder, "lineitem").select(
        (key * 8 + F.col("l_linenumber")).alias("line_id"),
        quantity.alias("total"),
        F.when(key % 7 == 0, nan).otherwise(quantity).alias("kept"),
        F.when(key % 5 == 0, nan).otherwise(quantity).alias("part"),
        F.when(key % 5 == 0, quantity).otherwise(F.lit(0.0)).alias("other"),
        nan.alias("nothing"),
    )


@query(
    "nan_rules",
    f"""{HOLEY}
SELECT 'present' AS "check", count(*) AS failed_rows FROM holey WHERE kept IS NULL
UNION ALL
SELECT 'parts', count(*) FROM holey
WHERE NOT abs(coalesce(part, 0) + coalesce(other, 0) - total) <= 1e-8 + 1e-5 * abs(total)
UNION ALL SELECT 'whole', count(*) FROM holey WHERE kept IS NULL""",
)
def nan_rules(spark, folder):
    """NaN is no value, adds nothing as a part, and makes a total bad."""
    checks = {
        "present": ("warn", rules.not_null("kept")),
        "parts": ("warn", rules.parts_sum_to("total", "part", "other")),
        "whole": ("warn", rules.parts_sum_to("kept", "part", "other")),
    }
    report = rules.validate(holey(spark, folder), checks, "line_id")
    return report.select("check", "failed_rows")


@query(
    "nan_cleaning",
    f"""{HOLEY}
SELECT line_id, CAST(coalesce(kept, -1) AS DOUBLE) AS kept, CAST(part AS DOUBLE) AS part
FROM holey""",
)
def nan_cleaning(spark, folder):
    """NaN is filled, and a column of nothing else goes."""
    df = cleaning.fill_missing(holey(spark, folder), {"kept": -1.0})
    found = cleaning.drop_empty_columns(df)
    if "nothing" in found.columns:
        raise AssertionError("the empty column is still there")
    return found.select("line_id", "kept", F.nullif("part", F.lit(float("nan"))).alias("part"))
