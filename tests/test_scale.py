"""The plans behind the claims about size: joins, scans, skew and executors."""

import pytest
from pyspark.sql import functions as F

from sieveframe import bindings
from sieveframe.plans import findings, pages, summaries
from sieveframe.plans.claims import FRAUD, SEVERITY, STATE, TOTAL


def plan_of(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Orders of which a third belong to one customer."""
    out = str(tmp_path_factory.mktemp("orders"))
    key = F.col("id")
    spark.range(0, 60_000, 1, 4).select(
        key.alias("o_orderkey"),
        F.when(key % 3 == 0, 7).otherwise(key % 5000).alias("o_custkey"),
        F.when(key % 2 == 0, "F").otherwise("O").alias("o_orderstatus"),
        (key / 100).alias("o_totalprice"),
        F.expr("timestamp_ntz '1995-01-01 00:00:00'").alias("o_orderdate"),
        F.lit("2-HIGH").alias("o_orderpriority"),
    ).write.parquet(f"{out}/orders.parquet")
    spark.range(5000).select(
        key.alias("c_custkey"),
        (key % 25).cast("int").alias("c_nationkey"),
        F.concat(F.lit("M"), (key % 3).cast("string")).alias("c_mktsegment"),
    ).write.parquet(f"{out}/customer.parquet")
    spark.range(25).select(
        key.cast("int").alias("n_nationkey"), F.concat(F.lit("N"), key).alias("n_name")
    ).write.parquet(f"{out}/nation.parquet")
    return out


def test_only_the_needed_tables_and_columns_are_read(spark, folder):
    df = bindings.claims(spark, folder, SEVERITY, FRAUD)
    plan = plan_of(df.groupBy(SEVERITY).agg(F.count_if(FRAUD)))
    assert plan.count("FileScan") == 1
    assert "o_totalprice" not in plan and "o_custkey" not in plan


def test_a_filter_reaches_the_files(spark, folder):
    df = bindings.claims(spark, folder, "policy_number", TOTAL).filter(F.col(TOTAL) > 500)
    assert "GreaterThan(o_totalprice,500" in plan_of(df)


def test_aggregates_are_partial_before_the_shuffle(spark, folder):
    plan = plan_of(summaries.summarize(bindings.claims(spark, folder))["by_state_type"])
    assert "partial_count" in plan and "Python" not in plan


def test_a_hot_customer_is_split(spark, folder):
    """Beyond the broadcast limit, AQE cuts the partition of the hot key."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        claims = bindings.claims(spark, folder, STATE, FRAUD)
        df = claims.groupBy(STATE).agg(F.count_if(FRAUD), F.count("*").alias("claims"))
        plan = plan_of(df, final=True)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
    assert df.agg(F.sum("claims")).first()[0] == 60_000


def test_one_pass_for_all_summaries(spark, folder):
    """The orders are read once; the tables read what was settled."""
    tables = summaries.summarize_at_once(bindings.claims(spark, folder))
    for table in tables.values():
        assert "orders.parquet" not in plan_of(table)
        assert "summary-base" in plan_of(table)


def test_one_pass_for_the_findings_page(spark, folder):
    plan = plan_of(findings.page_sentences(bindings.claims(spark, folder)))
    assert "orders.parquet" not in plan


def test_shares_and_tops_read_the_claims_once(spark, folder):
    claims = bindings.claims(spark, folder)
    for df in (pages.by_state(claims), findings.top_type(claims), findings.top_state(claims)):
        assert "orders.parquet" not in plan_of(df)


def test_no_operator_uses_python_workers_or_cross_joins(spark, folder):
    claims = bindings.claims(spark, folder)
    for df in (
        pages.daily_claims(claims), pages.weekly(claims), pages.fraud_kpis(claims),
        pages.type_by_severity(claims), pages.cost_split(claims), pages.kpis(claims),
    ):
        plan = plan_of(df)
        for word in ("Python", "Cartesian", "BroadcastNestedLoopJoin"):
            assert word not in plan
