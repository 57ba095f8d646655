import datetime as dt

from pyspark.sql import functions as F

from sieveframe.operators.filters import OTHER
from sieveframe.plans import findings, report, summaries
from sieveframe.plans.analysis import run_queries, run_query
from sieveframe.plans.claims import CLAIMS


def said(df):
    out = {}
    for row in df.orderBy("section", "seq").collect():
        out.setdefault(row.section, []).append(row.text)
    return out


def test_two_months(make_claims):
    notes = said(findings.insights(summaries.summarize_at_once(make_claims(60))))
    assert set(notes) == {"Key findings", "Trends", "What to watch next", "Caveats"}
    assert notes["Key findings"] == [
        "Total Loss claims have the highest fraud rate at 100.0% (60 of 60), versus "
        "50.0% across all 180 selected claims.",
        "Rollover claims cost the most on average ($7,000) and make up 82% of "
        "total claim cost.",
    ]
    assert notes["Trends"] == [
        "Claims averaged 3.0 per day in the first half of the period and 3.0 in the "
        "second half (+0.0 per day)."
    ]
    assert notes["What to watch next"] == [
        "Rollover claims with Total Loss: 100% of 60 are flagged as fraud, the "
        "highest of any combination with 20+ claims. These deserve a closer look in "
        "the next review."
    ]
    assert notes["Caveats"] == [
        "The data covers only 60 days (Mar 4 to May 2, 2019, about 2.0 months), too "
        "short for a reliable forecast or any seasonal pattern.",
        '"Fraud" is the dataset\'s `fraud_reported` label (90 of 180 claims), not '
        "proof of fraud; every pattern here is a correlation.",
    ]


def test_short_periods_and_small_groups(make_claims):
    notes = said(findings.insights(summaries.summarize(make_claims(5))))
    assert notes["Trends"] == ["Only 5 days are selected, too few to compare periods."]
    assert "under these filters, so none is singled out." in notes["What to watch next"][0]


def test_the_merged_group_is_never_named(make_claims):
    day = dt.datetime(2019, 3, 20)
    dear = (day, "ME", OTHER, "Total Loss", 50_000, 0, 0, 50_000, True)
    notes = said(findings.insights(summaries.summarize(make_claims(60, [dear] * 33))))
    assert notes["Key findings"][1].startswith("Rollover claims cost the most")
    # 420,000 of 2,160,000: the group is unnamed but counts.
    assert "make up 19% of" in notes["Key findings"][1]
    assert notes["What to watch next"][0].startswith("Rollover claims with")


def test_nothing_but_the_merged_group(make_claims):
    only = make_claims(3).withColumn("incident_type", F.lit(OTHER))
    notes = said(findings.insights(summaries.summarize(only)))
    assert len(notes["Key findings"]) == 1
    assert "none is singled out" in notes["What to watch next"][0]


def test_nothing_selected(make_claims):
    notes = said(findings.insights(summaries.summarize(make_claims(0))))
    assert set(notes) == {"What to watch next"}


def test_ties_go_to_the_smallest_key(make_claims):
    claims = make_claims(30).withColumn("fraud_reported", F.lit(True))
    notes = said(findings.insights(summaries.summarize(claims)))
    assert notes["Key findings"][0].startswith("Major Damage claims")
    assert notes["What to watch next"][0].startswith("Hail claims with")


def test_page_sentences(make_claims):
    notes = said(findings.page_sentences(make_claims(60)))
    assert notes["Key findings"][2] == (
        "UT accounts for the largest share of claim cost (82%), with a fraud rate of 100.0%."
    )
    assert notes["Trends"][0].endswith("a rise of 0.0 per day.")
    few = said(findings.page_sentences(make_claims(5)))
    assert few["Trends"] == ["Only 5 days are selected, too few to compare periods."]
    assert few["What to watch next"] == [
        "No incident type and severity combination has 20+ claims, so none is singled out."
    ]


def test_trend_says_drop(make_claims):
    start = dt.datetime(2019, 3, 4)
    more = [(start, "ID", "Hail", "Minor Damage", 15, 5, 5, 5, False)] * 20
    row = findings.trend(make_claims(20, extra=more)).first()
    assert (row.days, row.first_half, row.second_half, row.rose, row.change) == (
        20, "5.0", "3.0", False, "2.0",
    )


def results(spark):
    day = dt.date(2019, 3, 6)
    return {
        "fraud_by_severity": spark.createDataFrame(
            [("Trivial Damage", 32, 2, 6.3), ("Total Loss", 8, 2, 25.0)],
            "incident_severity string, claims long, fraud_claims int, fraud_pct double",
        ),
        "fraud_by_incident_type": spark.createDataFrame(
            [("Rollover", 9.0, 2150.0), ("Hail", 12.5, 640.0)],
            "incident_type string, fraud_pct double, avg_amount double",
        ),
        "claims_by_state": spark.createDataFrame(
            [("TX", 510, 51.0), ("UT", 300, 30.0), ("ME", 120, 12.0), ("ID", 70, 7.0)],
            "incident_state string, total_amount long, pct_of_total_amount double",
        ),
        "claims_by_week": spark.createDataFrame(
            [(day - dt.timedelta(2), day, day + dt.timedelta(3), 40)],
            "week_start date, first_day date, last_day date, claims long",
        ),
    }


def checks(spark, *rows):
    return spark.createDataFrame(list(rows), "check string, severity string, failed_rows long")


def test_report_headlines(spark):
    validation = checks(spark, ("a", "error", 0), ("b", "warn", 1))
    facts = report.report_facts(results(spark), validation)
    lines = {r.section: r for r in report.headlines(facts).collect()}
    assert lines["Summary"].text == (
        "40 auto claims totalling $1,000, incidents 2019-03-06 to 2019-03-09. "
        "4 claims (10.0%) are labelled as fraud."
    )
    assert lines["Fraud by severity"].title == (
        "Total Loss claims are labelled fraud 25.0% of the time vs 10.0% overall"
    )
    assert lines["Fraud by incident type"].text == (
        "Highest fraud rate: Hail (12.5%). Highest average claim: Rollover ($2,150)."
    )
    assert lines["Claim cost by state"].title == "TX, UT, ME account for 93% of claim cost"
    assert lines["Data quality"].text == (
        "All error checks passed. 1 warning checks flagged rows that were kept for review."
    )
    assert [r.seq for r in report.headlines(facts).orderBy("seq").collect()] == list(range(1, 8))


def test_the_report_says_when_checks_failed(spark):
    facts = report.report_facts(results(spark), checks(spark, ("a", "error", 3)))
    text = report.headlines(facts).filter("section = 'Data quality'").first().text
    assert text.startswith("1 error checks failed. 0 warning")


def test_section_tables(spark):
    tables = report.section_tables(results(spark), checks(spark, ("a", "warn", 1)))
    assert tables["Weekly claim volume"].count() == 1
    assert tables["Weekly claim volume, full weeks"].isEmpty()
    assert [r.is_top for r in tables["Claim cost by state"].collect()] == [
        False, False, False, True,
    ]


def test_the_four_queries(spark, make_claims):
    tables = run_queries(spark, CLAIMS.queries, {"claims": make_claims(10)})
    assert list(tables) == [
        "claims_by_state", "claims_by_week", "fraud_by_incident_type", "fraud_by_severity",
    ]
    assert [tuple(r) for r in tables["fraud_by_incident_type"].collect()] == [
        ("Rollover", 10, 10, 100.0, 7000.0), ("Hail", 20, 5, 25.0, 750.0),
    ]
    assert [r.claims for r in tables["claims_by_week"].collect()] == [21, 9]
    assert tuple(tables["claims_by_state"].first()) == ("UT", 10, 70000, 7000.0, 82.4)
    assert dict(tables["claims_by_state"].dtypes)["total_amount"] == "bigint"


def test_rounding_of_the_state_query(spark):
    claims = spark.createDataFrame(
        [("A", 1.25), ("A", 1.25), ("B", 0.5), ("C", None)],
        "incident_state string, total_claim_amount double",
    )
    text = (CLAIMS.queries / "claims_by_state.sql").read_text()
    found = [tuple(r) for r in run_query(spark, text, {"claims": claims}).collect()]
    # 2.5 and 0.5 round half to even as whole amounts, half up as means.
    assert found == [("A", 2, 2, 1.0, 83.3), ("B", 1, 0, 1.0, 16.7), ("C", 1, None, None, None)]


def test_amounts_are_not_rounded_before_they_are_summed(spark):
    claims = spark.range(1000).selectExpr("'ME' AS incident_state", "0.004D AS total_claim_amount")
    text = (CLAIMS.queries / "claims_by_state.sql").read_text()
    row = run_query(spark, text, {"claims": claims}).first()
    assert (row.total_amount, row.pct_of_total_amount) == (4, 100.0)


def test_no_view_stays_behind(spark, make_claims):
    before = {t.name for t in spark.catalog.listTables()}
    run_queries(spark, CLAIMS.queries, {"claims": make_claims(2)})
    assert {t.name for t in spark.catalog.listTables()} == before
