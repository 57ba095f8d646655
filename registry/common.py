"""The views that the queries share, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveframe.bindings import read

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name, each with the SQL that must give the same rows."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            self.add(name, fn, sql)
            return fn

        return register

    def add(self, name: str, fn: Query, sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"two queries named {name}")
        self.queries[name] = fn
        if sql is not None:
            self.sql[name] = sql

    def merge(self, other: Registry) -> None:
        for name, fn in other.queries.items():
            self.add(name, fn, other.sql.get(name))


# The claims binding in SQL; every claims query starts with it.
CLAIMS = """
WITH claims AS (
  SELECT o_orderkey AS policy_number,
         o_orderdate - to_days(CAST(o_orderkey * 7 % 400 - 3 AS INTEGER))
           AS policy_bind_date,
         o_orderdate AS incident_date,
         o_orderkey % 24 AS incident_hour_of_the_day,
         16 + o_custkey % 85 AS age,
         CASE WHEN o_orderkey % 1009 = 0 THEN -1000000
              ELSE (o_orderkey % 5) * 1000000 END AS umbrella_limit,
         n_name AS incident_state,
         c_mktsegment AS incident_type,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Total Loss'
              WHEN '2-HIGH' THEN 'Major Damage'
              WHEN '3-MEDIUM' THEN 'Minor Damage'
              WHEN '4-NOT SPECIFIED' THEN 'Trivial Damage'
              ELSE 'Unknown' END AS incident_severity,
         o_totalprice AS total_claim_amount,
         CAST(cents // 5 AS DOUBLE) / 100 AS injury_claim,
         CAST(cents // 4 AS DOUBLE) / 100 AS property_claim,
         CAST(cents - cents // 5 - cents // 4 AS DOUBLE) / 100 AS vehicle_claim,
         o_orderstatus = 'F' AS fraud_reported
  FROM (SELECT *, CAST(round_even(o_totalprice * 100, 0) AS BIGINT) AS cents
        FROM orders) o
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
)"""


def money(x: str) -> str:
    """Exact sum of a money column as a double."""
    return f"(CAST(sum(CAST(round_even({x} * 100, 0) AS BIGINT)) AS DOUBLE) / 100)"


def mean_money(x: str) -> str:
    return f"({money(x)} / count({x}))"


COUNT = "count(*)"
FRAUD = "CAST(count_if(fraud_reported) AS BIGINT)"
RATE = "avg(CAST(fraud_reported AS INT))"

SUMMARIES = {
    "by_state_type": f"""
SELECT incident_state, incident_type, count(*) AS claims, {FRAUD} AS fraud_claims,
       {money("total_claim_amount")} AS total_claim_amount,
       {money("injury_claim")} AS injury_claim,
       {money("property_claim")} AS property_claim,
       {money("vehicle_claim")} AS vehicle_claim
FROM claims
WHERE incident_state IS NOT NULL AND incident_type IS NOT NULL
GROUP BY ALL""",
    "by_state_type_severity": f"""
SELECT incident_state, incident_type, incident_severity, count(*) AS claims,
       {FRAUD} AS fraud_claims
FROM claims
WHERE incident_state IS NOT NULL AND incident_type IS NOT NULL
  AND incident_severity IS NOT NULL
GROUP BY ALL""",
    "by_state_type_day": """
SELECT incident_state, incident_type,
       CAST(incident_date AS DATE) AS incident_date, count(*) AS claims
FROM claims
WHERE incident_state IS NOT NULL AND incident_type IS NOT NULL
  AND incident_date IS NOT NULL
GROUP BY ALL""",
}


def with_summaries(*names: str) -> str:
    """The claims binding plus summary tables as further WITH steps."""
    steps = [f",\n{name} AS ({SUMMARIES[name]})" for name in names]
    return CLAIMS + "".join(steps)


def doubles(df: DataFrame, *names: str) -> DataFrame:
    """Money columns as doubles, the type that the SQL side returns."""
    return df.withColumns({n: F.col(n).cast("double") for n in names})


# A messy customer table: odd names, padding, blanks, an empty column, and
# every row twice.
_SEGMENT = "c_mktsegment"


def messy(spark: SparkSession, folder: str) -> DataFrame:
    key, segment = F.col("c_custkey"), F.col(_SEGMENT)
    one = read(spark, folder, "customer").select(
        key.alias("Customer-ID"),
        F.when(key % 7 == 0, "   ")
        .when(key % 7 == 1, F.concat(F.lit("\u00a0"), segment, F.lit("\t")))
        .when(key % 7 == 2, F.concat(F.lit(" \u2003"), segment, F.lit("\x1f\r\n")))
        .otherwise(segment)
        .alias("mktSegment "),
        F.when(key % 5 == 0, None)
        .when(F.col("c_acctbal") < 0, " no ")
        .otherwise("YES")
        .alias("In Credit?"),
        F.lit(None).cast("string").alias("_c39"),
        F.when(key % 11 == 0, "Suburu").otherwise("Saab").alias("autoMake"),
        F.when(key % 3 != 0, "Rear Collision").alias("Collision Type"),
        F.col("c_acctbal").alias("acct.bal"),
    )
    return one.unionAll(one)


MESSY = """
WITH one AS (
  SELECT c_custkey AS customer_id,
         CASE c_custkey % 7 WHEN 0 THEN '   '
              WHEN 1 THEN chr(160) || c_mktsegment || chr(9)
              WHEN 2 THEN ' ' || chr(8195) || c_mktsegment || chr(31) || chr(13) || chr(10)
              ELSE c_mktsegment END AS mkt_segment,
         CASE WHEN c_custkey % 5 = 0 THEN NULL
              WHEN c_acctbal < 0 THEN ' no ' ELSE 'YES' END AS in_credit,
         CAST(NULL AS VARCHAR) AS c39,
         CASE WHEN c_custkey % 11 = 0 THEN 'Suburu' ELSE 'Saab' END AS auto_make,
         CASE WHEN c_custkey % 3 <> 0 THEN 'Rear Collision' END AS collision_type,
         c_acctbal AS acct_bal
  FROM customer
),
messy AS (SELECT * FROM one UNION ALL SELECT * FROM one),
tidy AS (
  SELECT customer_id,
         CASE WHEN customer_id % 7 = 0 THEN NULL ELSE c_mktsegment END AS mkt_segment,
         trim(in_credit) AS in_credit, c39, auto_make, collision_type, acct_bal
  FROM messy JOIN customer ON customer_id = c_custkey
)"""
