import datetime as dt

import pytest
from pyspark.sql import functions as F

from sieveframe.operators.filters import OTHER, domain_values, select_rows
from sieveframe.plans import pages, summaries
from tests.conftest import values

DAY = dt.datetime(2015, 1, 5)


@pytest.fixture
def untidy(spark):
    """Small groups, missing keys and missing amounts."""
    rows = []
    for state, kind, severity, n in [
        ("NY", "Parked Car", "Minor Damage", 12),
        ("NY", "Vehicle Theft", "Total Loss", 9),
        ("NY", "Vehicle Theft", None, 1),
        ("OH", "Parked Car", "Minor Damage", 3),
        ("OH", "Vehicle Theft", "Odd", 4),
        ("OH", None, "Minor Damage", 11),
        (None, "Parked Car", "Minor Damage", 20),
    ]:
        for i in range(n):
            amount = None if i == 0 else 100.25 * i
            rows.append(
                (state, kind, severity, DAY + dt.timedelta(days=i % 4, hours=i),
                 amount, amount, None, amount, None if i == 1 else i % 2 == 0)
            )
    return spark.createDataFrame(
        rows,
        "incident_state string, incident_type string, incident_severity string, "
        "incident_date timestamp_ntz, total_claim_amount double, injury_claim double, "
        "property_claim double, vehicle_claim double, fraud_reported boolean",
    )


def same(a, b):
    assert a.columns == b.columns
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_summary_leaves_out_missing_keys(untidy):
    table = summaries.summarize(untidy)["by_state_type"]
    found = {(r.incident_state, r.incident_type): r for r in table.collect()}
    assert set(found) == {
        ("NY", "Parked Car"), ("NY", "Vehicle Theft"),
        ("OH", "Parked Car"), ("OH", "Vehicle Theft"),
    }
    row = found["NY", "Parked Car"]
    assert (row.claims, row.fraud_claims) == (12, 6)
    assert float(row.total_claim_amount) == 100.25 * 66
    assert float(row.property_claim) == 0  # a sum over missing cells


def test_at_once_equals_one_by_one(untidy):
    lazy, once = summaries.summarize(untidy), summaries.summarize_at_once(untidy)
    for name in summaries.GRAINS:
        assert same(lazy[name], once[name]), name


def test_merging_summaries_equals_merging_rows(untidy):
    by_row = summaries.summarize(summaries.merge_small(untidy))
    merged = summaries.summarize_at_once(untidy, min_group=10)
    for name in summaries.GRAINS:
        assert same(by_row[name], merged[name]), name
    found = {
        (r.incident_state, r.incident_type): r.claims
        for r in merged["by_state_type"].collect()
    }
    assert found == {
        ("NY", "Parked Car"): 12, ("NY", "Vehicle Theft"): 10, ("OH", OTHER): 18,
    }


@pytest.mark.parametrize("limit", [1 << 22, 0], ids=["broadcast", "shuffle"])
def test_merge_small(spark, limit):
    df = spark.createDataFrame(
        [("ME", "Hail")] * 13 + [("ID", "Hail")] * 9 + [(None, "Rollover"), ("ME", None)] * 2,
        "incident_state string, incident_type string",
    )
    out = summaries.merge_small(df, hot_bytes=limit)
    found = {(r.incident_state, r.incident_type): r["count"] for r in
             out.groupBy(*df.columns).count().collect()}
    assert found == {
        ("ME", "Hail"): 13, ("ID", OTHER): 9, (None, OTHER): 2, ("ME", OTHER): 2,
    }


def test_summaries_add_up_to_the_rows(make_claims):
    claims = make_claims(30)
    tables = summaries.summarize_at_once(claims)
    for table in tables.values():
        assert table.agg(F.sum("claims")).first()[0] == 90


def test_rates(make_claims):
    table = summaries.summarize(make_claims(2))["by_state_type"]
    assert values(summaries.fraud_rate_by(table, "incident_type"), "fraud_pct", "incident_type") == [25.0, 100.0]


def test_amount_stats_are_percentiles(spark):
    df = spark.range(61).selectExpr("'Hail' as incident_type", "id * 20 as total_claim_amount")
    row = summaries.amount_stats(df).first()
    assert tuple(row) == ("Hail", 60.0, 300.0, 600.0, 900.0, 1140.0)


def test_heatmap_has_fixed_columns_and_blank_cells(untidy):
    table = summaries.summarize(untidy)["by_state_type_severity"]
    heat = summaries.rate_heatmap(table)
    assert heat.columns == ["incident_type", *pages.SEVERITIES]
    found = {r.incident_type: tuple(r)[1:] for r in heat.collect()}
    assert found == {
        "Parked Car": (None, 53.0, None, None), "Vehicle Theft": (None, None, None, 56.0),
    }


def test_state_table_and_split(make_claims):
    table = summaries.summarize(make_claims(3))["by_state_type"]
    assert tuple(summaries.state_table(table).first()) == ("UT", 3, 21000.0, 7000, 100.0)
    assert values(summaries.fraud_split(table), "claims") == [5, 4]


def test_cost_parts_order_by_their_own_sum(make_claims):
    table = summaries.summarize(make_claims(3))["by_state_type"]
    out = summaries.cost_parts(table)
    assert out.columns == ["incident_type", "injury", "property", "vehicle"]
    assert values(out, "incident_type") == ["Rollover", "Hail"]


def test_publish_report(untidy):
    merged = summaries.summarize_at_once(untidy, min_group=10)
    rows = untidy.filter("incident_state is not null").count()

    def failed(**options):
        tables = {**merged, **options.pop("more", {})}
        report = summaries.publish_report(tables, options.pop("rows", rows), **options)
        return {r.check: r.failed_rows for r in report.collect()}

    assert set(failed().values()) == {0}
    assert failed(min_group=15)["groups large enough"] == 2
    assert failed(rows=rows + 3)["all claims counted"] == 3
    leak = untidy.withColumn("Policy_Number", F.lit(1))
    assert failed(more={"leak": leak})["no sensitive columns"] == 1


def test_select_rows(spark):
    df = spark.createDataFrame([("NY", 1), ("OH", 2), (None, 3)], "incident_state string, n int")
    chosen = {"incident_state": ["NY"], "incident_type": ["x"]}
    assert values(select_rows(df, chosen), "n") == [1]
    assert values(select_rows(df, {"incident_state": []}), "n", "n") == [1, 2, 3]


def test_domain_values(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "x string")
    assert values(domain_values(df, "x"), "x") == ["a", "b", None]


def test_kpi_compare(make_claims):
    table = summaries.summarize(make_claims(10))["by_state_type"]
    part = pages.select_claims(table, types=["Rollover"])
    assert tuple(pages.compare_kpis(part, table, filtered=True).first()) == (
        "10", "$70,000", "100.0%", "$7,000", "33.3% of all claims", "82.4% of total cost",
        "+50.0 pts vs. dataset average", "+147% vs. dataset average",
    )
    assert tuple(pages.compare_kpis(table, table, filtered=False).first())[4:] == (
        "All claims", "All claims", "Dataset average", "Dataset average",
    )


def test_page_figures_keep_a_null_group(untidy):
    assert pages.rate_by(untidy, "incident_type").filter("incident_type is null").count() == 1
    states = pages.by_state(untidy)
    assert states.agg(F.round(F.sum("cost_share"), 9)).first()[0] == 1.0
    assert states.filter("incident_state is null").count() == 1


def test_state_extremes_break_ties_by_name(spark):
    df = spark.createDataFrame(
        [("B", 1200, 5.0, 0.5), ("A", 1100, 5.0, 0.5), ("C", 1100, None, None)],
        "incident_state string, claims long, claim_cost double, cost_share double",
    )
    assert tuple(pages.state_extremes(df).first()) == ("A", "1,100", "50%", "A", 1100)


def test_fraud_kpis_without_fraud(make_claims):
    row = pages.fraud_kpis(make_claims(2).filter("not fraud_reported")).first()
    assert tuple(row) == (0, 0.0, None, 600.0, None)


def test_type_by_severity_order(make_claims):
    out = pages.type_by_severity(make_claims(1))
    assert [tuple(r) for r in out.collect()] == [
        ("Hail", "Trivial Damage", 1, 0.0, 1), ("Hail", "Major Damage", 1, 1.0, 3),
        ("Rollover", "Total Loss", 1, 1.0, 4),
    ]


def test_no_global_window_over_rows(make_claims):
    """The share of the total is a scalar over the groups, not a window."""
    plan = pages.by_state(make_claims(2))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
