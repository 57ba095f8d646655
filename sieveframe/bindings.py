"""The order tables seen as a claims table, with no more joins than needed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveframe.plans.claims import (
    DATE,
    FRAUD,
    SEVERITY,
    STATE,
    TOTAL,
    TYPE,
)

# Order priorities as claim severities.
SEVERITY_OF = {
    "1-URGENT": "Total Loss",
    "2-HIGH": "Major Damage",
    "3-MEDIUM": "Minor Damage",
    "4-NOT SPECIFIED": "Trivial Damage",
}
UNKNOWN = "Unknown"

_FROM_CUSTOMER = {STATE, TYPE}
_FROM_NATION = {STATE}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def claims(spark: SparkSession, folder: str, *names: str) -> DataFrame:
    """The named claims columns of every order (all of them if none is named).

    Customers and nations are looked up by their key, and an order without one
    stays, so leaving a lookup out changes no other column. Nations are joined
    to the customers first, which are far fewer than orders. Join sides are left
    to Spark, which broadcasts by measured size and splits skewed partitions.
    """
    names = names or tuple(_columns())
    df = read(spark, folder, "orders")
    if _FROM_CUSTOMER & set(names):
        customer = read(spark, folder, "customer")
        if _FROM_NATION & set(names):
            nation = read(spark, folder, "nation")
            here = F.col("c_nationkey") == F.col("n_nationkey")
            customer = customer.join(nation, here, "left")
        df = df.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    columns = _columns()
    return df.select(*(columns[n].alias(n) for n in names))


def _columns() -> dict:
    key = F.col("o_orderkey")
    cents = F.rint(F.col("o_totalprice") * 100).cast("bigint")
    fifth, quarter = F.floor(cents / 5), F.floor(cents / 4)
    lead = (key * 7 % 400 - 3).cast("int")
    priority = F.col("o_orderpriority")
    severity = None
    for code, label in SEVERITY_OF.items():
        same = priority == code
        severity = (
            F.when(same, label) if severity is None else severity.when(same, label)
        )
    return {
        "policy_number": key,
        "policy_bind_date": F.col("o_orderdate") - F.make_dt_interval(days=lead),
        DATE: F.col("o_orderdate"),
        "incident_hour_of_the_day": key % 24,
        "age": F.lit(16) + F.col("o_custkey") % 85,
        "umbrella_limit": F.when(key % 1009 == 0, -1000000).otherwise(
            (key % 5) * 1000000
        ),
        STATE: F.col("n_name"),
        TYPE: F.col("c_mktsegment"),
        SEVERITY: severity.otherwise(UNKNOWN),
        TOTAL: F.col("o_totalprice"),
        "injury_claim": fifth / 100,
        "property_claim": quarter / 100,
        "vehicle_claim": (cents - fifth - quarter) / 100,
        FRAUD: F.col("o_orderstatus") == "F",
    }
