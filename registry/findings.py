"""Findings, report facts and scalar functions.

Fixed values: the wording of the sentences that the SQL twins put together.
"""

from pyspark.sql import functions as F

from registry.analysis import ANALYSIS_SQL, QUERIED, SHOWN
from registry.common import (
    CLAIMS,
    COUNT,
    FRAUD,
    RATE,
    Registry,
    mean_money,
    money,
    with_summaries,
)
from registry.quality import CLAIM_BAD, RULED, _report_sql
from registry.series import DAILY
from sieveframe.bindings import claims, read
from sieveframe.functions import dates, numbers, text
from sieveframe.functions.numbers import plain
from sieveframe.plans import findings, report, summaries
from sieveframe.plans.analysis import run_queries, run_query
from sieveframe.plans.claims import CLAIMS as DOMAIN
from sieveframe.plans.claims import DATE, FRAUD as FLAG
from sieveframe.plans.claims import SEVERITY, STATE, TOTAL, TYPE
from sieveframe.operators.filters import full_weeks
from sieveframe.sources.scratch import settle, settle_all

REGISTRY = Registry()
query = REGISTRY.query

FACTS = f"""
facts AS (
  SELECT format('{{:,}}', count(*)) AS claims,
         format('{{:,}}', {FRAUD}) AS fraud_claims,
         format('{{:.1f}}%', 100 * {RATE}) AS fraud_rate,
         strftime(min(incident_date), '%b %-d') AS first_date,
         strftime(max(incident_date), '%b %-d, %Y') AS last_date,
         datediff('day', min(incident_date), max(incident_date)) + 1 AS days,
         format('{{:.1f}}', (datediff('day', min(incident_date), max(incident_date)) + 1)
                            / 30.0) AS months
  FROM claims
)"""
TOP_SEVERITY = f"""
top_severity AS (
  SELECT incident_severity, format('{{:.1f}}%', 100 * {RATE}) AS fraud_rate,
         {FRAUD} AS fraud_claims, {COUNT} AS claims
  FROM claims GROUP BY 1 ORDER BY {RATE} DESC, 1 LIMIT 1
)"""
TOP_TYPE = f"""
top_type AS (
  SELECT incident_type,
         '$' || format('{{:,}}', CAST(round({mean_money("total_claim_amount")}) AS BIGINT))
           AS avg_claim,
         format('{{:.0f}}%', 100 * ({money("total_claim_amount")}
           / sum({money("total_claim_amount")}) OVER ())) AS cost_share
  FROM claims GROUP BY 1 ORDER BY {mean_money("total_claim_amount")} DESC, 1 LIMIT 1
)"""
TOP_STATE = f"""
top_state AS (
  SELECT incident_state,
         format('{{:.0f}}%', 100 * ({money("total_claim_amount")}
           / sum({money("total_claim_amount")}) OVER ())) AS cost_share,
         format('{{:.1f}}%', 100 * {RATE}) AS fraud_rate
  FROM claims GROUP BY 1 ORDER BY {money("total_claim_amount")} DESC, 1 LIMIT 1
)"""
TREND = """
numbered AS (
  SELECT claims, row_number() OVER (ORDER BY day) AS k, count(*) OVER () AS n FROM daily
),
halved AS (
  SELECT avg(claims) FILTER (WHERE k <= n / 2) AS a,
         avg(claims) FILTER (WHERE k > n / 2) AS b, max(n) AS days
  FROM numbered
),
trend AS (
  SELECT days, format('{:.1f}', a) AS first_half, format('{:.1f}', b) AS second_half,
         b >= a AS rose, format('{:.1f}', abs(b - a)) AS change, b - a AS diff
  FROM halved
)"""
WATCH = f"""
watch AS (
  SELECT incident_type, incident_severity, {COUNT} AS claims,
         format('{{:.0f}}%', 100 * {RATE}) AS fraud_rate
  FROM claims GROUP BY ALL HAVING count(*) >= 20
  ORDER BY {RATE} DESC, incident_type, incident_severity LIMIT 1
)"""


@query("facts", f"{CLAIMS}, {FACTS} SELECT * FROM facts")
def facts(spark, folder):
    found = findings.facts(claims(spark, folder, DATE, FLAG))
    return found.withColumn("days", F.col("days").cast("bigint"))


@query("top_severity", f"{CLAIMS}, {TOP_SEVERITY} SELECT * FROM top_severity")
def top_severity(spark, folder):
    return findings.top_severity(claims(spark, folder, SEVERITY, FLAG))


@query("top_type", f"{CLAIMS}, {TOP_TYPE} SELECT * FROM top_type")
def top_type(spark, folder):
    return findings.top_type(claims(spark, folder, TYPE, TOTAL))


@query("top_state", f"{CLAIMS}, {TOP_STATE} SELECT * FROM top_state")
def top_state(spark, folder):
    return findings.top_state(claims(spark, folder, STATE, TOTAL, FLAG))


@query(
    "trend",
    f"""{DAILY}, {TREND}
SELECT days, first_half, second_half, rose, change FROM trend""",
)
def trend(spark, folder):
    return findings.trend(claims(spark, folder, DATE))


@query("watch_list", f"{CLAIMS}, {WATCH} SELECT * FROM watch")
def watch_list(spark, folder):
    return findings.watch(claims(spark, folder, TYPE, SEVERITY, FLAG))


WATCH_TEXT = """
incident_type || ' claims with ' || incident_severity || ': ' || fraud_rate || ' of '
|| claims || ' are flagged as fraud, the highest of any combination with 20+ claims. '
|| 'These deserve a closer look in the next review.'"""
CAVEAT_TEXTS = """
SELECT 'Caveats' AS section, 1 AS seq, 'The data covers only ' || days || ' days ('
  || first_date || ' to ' || last_date || ', about ' || months
  || ' months), too short for a reliable forecast or any seasonal pattern.' AS text
FROM facts
UNION ALL
SELECT 'Caveats', 2, '"Fraud" is the dataset''s `fraud_reported` label ('
  || fraud_claims || ' of ' || claims
  || ' claims), not proof of fraud; every pattern here is a correlation.'
FROM facts"""
SEVERITY_TEXT = """
SELECT 'Key findings' AS section, 1 AS seq, incident_severity
  || ' claims have the highest fraud rate at ' || t.fraud_rate || ' ('
  || t.fraud_claims || ' of ' || t.claims || '), versus ' || f.fraud_rate
  || ' across all ' || f.claims || ' selected claims.' AS text
FROM top_severity t, facts f"""
TYPE_TEXT = """
SELECT 'Key findings', 2, incident_type || ' claims cost the most on average ('
  || avg_claim || ') and make up ' || cost_share || ' of total claim cost.'
FROM top_type"""

PAGE_STEPS = ", ".join(
    [DAILY, FACTS, TOP_SEVERITY, TOP_TYPE, TOP_STATE, TREND, WATCH]
)


@query(
    "page_sentences",
    f"""{PAGE_STEPS}
{SEVERITY_TEXT}
UNION ALL {TYPE_TEXT}
UNION ALL
SELECT 'Key findings', 3, incident_state
  || ' accounts for the largest share of claim cost (' || cost_share
  || '), with a fraud rate of ' || fraud_rate || '.' FROM top_state
UNION ALL
SELECT 'Trends', 1, CASE WHEN days < 14
  THEN 'Only ' || days || ' days are selected, too few to compare periods.'
  ELSE 'Claims averaged ' || first_half
  || ' per day in the first half of the period and ' || second_half
  || ' in the second half, ' || CASE WHEN rose THEN 'a rise' ELSE 'a drop' END
  || ' of ' || change || ' per day.' END FROM trend
UNION ALL SELECT 'What to watch next', 1, {WATCH_TEXT} FROM watch
UNION ALL {CAVEAT_TEXTS}""",
)
def page_sentences(spark, folder):
    return findings.page_sentences(claims(spark, folder))


INSIGHTS_SQL = f"""{PAGE_STEPS}
{SEVERITY_TEXT}
UNION ALL {TYPE_TEXT}
UNION ALL
SELECT 'Trends', 1, 'Claims averaged ' || first_half
  || ' per day in the first half of the period and ' || second_half
  || ' in the second half (' || format('{{:+.1f}}', diff) || ' per day).' FROM trend
UNION ALL SELECT 'What to watch next', 1, {WATCH_TEXT} FROM watch
UNION ALL {CAVEAT_TEXTS}"""


@query("insights_text", INSIGHTS_SQL)
def insights_text(spark, folder):
    return findings.insights(summaries.summarize_at_once(claims(spark, folder)))


RESULTS = ", ".join(
    f"{name} AS ({sql.removeprefix(CLAIMS).lstrip(',').strip()})"
    for name, sql in ANALYSIS_SQL.items()
    if name != "claims_by_state"
)
STATE_RESULT = f"""
state_groups AS (
  SELECT incident_state, count(*) AS claims, {money("total_claim_amount")} AS cost
  FROM claims GROUP BY 1),
claims_by_state AS (
  SELECT incident_state, claims, CAST(cost AS BIGINT) AS total_amount,
         round(100.0 * cost / sum(cost) OVER (), 1) AS pct_of_total_amount
  FROM state_groups)"""
REPORT_FACTS = f"""
front AS (
  SELECT * FROM claims_by_state ORDER BY total_amount DESC, incident_state LIMIT 3
),
validation AS ({_report_sql("claims", CLAIM_BAD, "policy_number")}),
facts AS (
  SELECT CAST(sum(claims) AS BIGINT) AS claims,
         CAST(sum(fraud_claims) AS BIGINT) AS fraud_claims,
         100.0 * sum(fraud_claims) / sum(claims) AS fraud_pct,
         (SELECT CAST(sum(total_amount) AS BIGINT) FROM claims_by_state) AS total_amount,
         (SELECT min(first_day) FROM claims_by_week) AS first_day,
         (SELECT max(last_day) FROM claims_by_week) AS last_day,
         (SELECT incident_severity FROM fraud_by_severity
          ORDER BY fraud_pct DESC, incident_severity LIMIT 1) AS top_severity,
         (SELECT max(fraud_pct) FROM fraud_by_severity) AS top_severity_pct,
         (SELECT incident_type FROM fraud_by_incident_type
          ORDER BY fraud_pct DESC, incident_type LIMIT 1) AS top_type,
         (SELECT max(fraud_pct) FROM fraud_by_incident_type) AS top_type_pct,
         (SELECT incident_type FROM fraud_by_incident_type
          ORDER BY avg_amount DESC, incident_type LIMIT 1) AS costly_type,
         (SELECT max(avg_amount) FROM fraud_by_incident_type) AS costly_type_avg,
         (SELECT string_agg(incident_state, ', '
                            ORDER BY total_amount DESC, incident_state)
          FROM front) AS top_states,
         (SELECT round(sum(pct_of_total_amount), 6) FROM front) AS top_states_pct,
         (SELECT count(*) FROM validation WHERE severity = 'error' AND failed_rows > 0)
           AS failed_errors,
         (SELECT count(*) FROM validation WHERE severity = 'warn' AND failed_rows > 0)
           AS failed_warnings
  FROM fraud_by_severity
)"""
REPORT = f"{CLAIMS}, {RESULTS}, {STATE_RESULT}, {REPORT_FACTS}"


def _report_facts(spark, folder):
    results, validation = _results(spark, folder)
    found = report.report_facts(results, validation)
    return found.withColumn("top_states_pct", F.round("top_states_pct", 6))


def _results(spark, folder):
    """The four results, and the validation report: each from the columns it reads."""
    rows = settle(claims(spark, folder, *dict.fromkeys([*QUERIED, *RULED])))
    queried = {"claims": rows.select(*QUERIED)}
    results = settle_all(run_queries(spark, DOMAIN.queries, queried))
    return results, DOMAIN.validate(rows.select(*RULED))


@query("report_facts", f"{REPORT} SELECT * FROM facts")
def report_facts(spark, folder):
    return _report_facts(spark, folder)


@query(
    "report_headlines",
    f"""{REPORT}
SELECT 1 AS seq, 'Summary' AS section, NULL AS title, format('{{:,}}', claims)
  || ' auto claims totalling $' || format('{{:,}}', total_amount) || ', incidents '
  || first_day || ' to ' || last_day || '. ' || format('{{:,}}', fraud_claims)
  || ' claims (' || format('{{:.1f}}%', fraud_pct) || ') are labelled as fraud.' AS text
FROM facts
UNION ALL
SELECT 2, 'Fraud by severity', top_severity || ' claims are labelled fraud '
  || format('{{:.1f}}%', top_severity_pct) || ' of the time vs '
  || format('{{:.1f}}%', fraud_pct) || ' overall',
  'Overall fraud rate is ' || format('{{:.1f}}%', fraud_pct) || '.' FROM facts
UNION ALL
SELECT 3, 'Fraud by incident type', 'Fraud rate (%) by incident type',
  'Highest fraud rate: ' || top_type || ' (' || format('{{:.1f}}%', top_type_pct)
  || '). Highest average claim: ' || costly_type || ' ($'
  || format('{{:,.0f}}', costly_type_avg) || ').' FROM facts
UNION ALL
SELECT 4, 'Claim cost by state', top_states || ' account for '
  || format('{{:.0f}}', top_states_pct) || '% of claim cost',
  'Share of total claim cost by incident state.' FROM facts
UNION ALL
SELECT 5, 'Weekly claim volume', 'Weekly claim volume (full weeks only)',
  'Weeks run from Monday. Partial weeks are only in the table.' FROM facts
UNION ALL
SELECT 7, 'Caveats', NULL, '''Fraud'' is the fraud_reported label of the data, not a proven '
  'outcome. The patterns are correlations, not causes, and a short '
  'period shows no seasons.' FROM facts
UNION ALL
SELECT 6, 'Data quality', NULL, CASE WHEN failed_errors = 0
  THEN 'All error checks passed. ' ELSE failed_errors || ' error checks failed. ' END
  || failed_warnings || ' warning checks flagged rows that were kept for review.'
FROM facts""",
)
def report_headlines(spark, folder):
    """All seven headlines; two sections hold only fixed text."""
    return report.headlines(_report_facts(spark, folder))


SECTIONS = {
    "Fraud by severity": SHOWN["fraud_by_severity"],
    "Fraud by incident type": SHOWN["fraud_by_incident_type"],
    "Claim cost by state": ("incident_state", "claims", "total_amount"),
    "Weekly claim volume": SHOWN["claims_by_week"],
    "Weekly claim volume, full weeks": SHOWN["claims_by_week"],
    "Data quality": ("check", "severity", "failed_rows"),
}


def _section(name, flagged_by=None):
    cells = ", ".join(
        f"""coalesce(CAST("{c}" AS VARCHAR), '-')""" for c in SECTIONS[name]
    )
    flag = f"{flagged_by} = max({flagged_by}) OVER ()" if flagged_by else "false"
    return f"SELECT '{name}' AS section, concat_ws('|', {cells}) AS line, {flag} AS top"


@query(
    "section_tables",
    f"""{REPORT}
{_section("Fraud by severity", "fraud_pct")} FROM fraud_by_severity
UNION ALL {_section("Fraud by incident type", "fraud_pct")} FROM fraud_by_incident_type
UNION ALL {_section("Claim cost by state", "total_amount")} FROM claims_by_state
UNION ALL {_section("Weekly claim volume")} FROM claims_by_week
UNION ALL {_section("Weekly claim volume, full weeks")}
FROM claims_by_week WHERE last_day - first_day = 6
UNION ALL {_section("Data quality")} FROM validation""",
)
def section_tables(spark, folder):
    """Every row of every section's table, with the flag of its largest row."""
    results, validation = _results(spark, folder)
    out = None
    for name, df in report.section_tables(results, validation).items():
        kinds, cells = dict(df.dtypes), []
        for c in SECTIONS[name]:
            cell = plain(F.col(c)) if kinds[c] == "double" else F.col(c).cast("string")
            cells.append(F.coalesce(cell, F.lit("-")))
        flag = F.col("is_top") if "is_top" in df.columns else F.lit(False)
        part = df.select(
            F.lit(name).alias("section"), F.concat_ws("|", *cells).alias("line"), flag.alias("top")
        )
        out = part if out is None else out.unionAll(part)
    return out


@query(
    "report_weeks",
    f"""{CLAIMS}, {RESULTS}
SELECT week_start, claims FROM claims_by_week WHERE last_day - first_day = 6""",
)
def report_weeks(spark, folder):
    rows = claims(spark, folder, DATE, TOTAL)
    sql = (DOMAIN.queries / "claims_by_week.sql").read_text(encoding="utf-8")
    return full_weeks(run_query(spark, sql, {"claims": rows})).select("week_start", "claims")


@query(
    "rounding",
    """
SELECT o_orderkey, round(o_totalprice / 1000, 1) AS half_up,
       round_even(o_totalprice, 0) AS half_even,
       CAST(o_totalprice AS BIGINT) AS whole,
       abs(round_even(o_totalprice, 0) - 100000) AS distance
FROM orders""",
)
def rounding(spark, folder):
    price = F.col("o_totalprice")
    return read(spark, folder, "orders").select(
        "o_orderkey",
        F.round(price / 1000, 1).alias("half_up"),
        numbers.half_even(price).alias("half_even"),
        numbers.to_bigint(price).alias("whole"),
        F.abs(numbers.half_even(price) - 100000).alias("distance"),
    )


@query(
    "number_formats",
    """
SELECT c_custkey, format('{:,.0f}', c_acctbal) AS grouped,
       format('{:.1f}', c_acctbal) AS one_digit,
       format('{:+.1f}', c_acctbal) AS with_sign,
       format('{:.1f}%', c_acctbal / 100.0 * 100) AS as_percent,
       CASE WHEN c_acctbal * 1000 >= 1e6
            THEN '$' || format('{:,.1f}', c_acctbal * 1000 / 1e6) || 'M'
            ELSE '$' || format('{:,.0f}', c_acctbal * 1000) END AS short_dollars
FROM customer""",
)
def number_formats(spark, folder):
    balance = F.col("c_acctbal")
    return read(spark, folder, "customer").select(
        "c_custkey",
        numbers.grouped(balance).alias("grouped"),
        numbers.fixed(balance, 1).alias("one_digit"),
        numbers.signed(balance, 1).alias("with_sign"),
        numbers.as_percent(balance / 100, 1).alias("as_percent"),
        numbers.big_dollars(balance * 1000).alias("short_dollars"),
    )


@query(
    "date_functions",
    """
SELECT event_id, CAST(date_trunc('week', ts) AS DATE) AS week_start,
       CAST(ts AS DATE) AS day, strftime(ts, '%b %-d') AS short_day,
       strftime(ts, '%b %-d, %Y') AS long_day,
       datediff('day', TIMESTAMP '2024-01-01 23:59:00', ts) + 1 AS days
FROM events""",
)
def date_functions(spark, folder):
    ts = F.col("ts")
    start = F.expr("TIMESTAMP_NTZ '2024-01-01 23:59:00'")
    return read(spark, folder, "events").select(
        "event_id",
        dates.week_start(ts).alias("week_start"),
        dates.day(ts).alias("day"),
        dates.short_day(ts).alias("short_day"),
        dates.long_day(ts).alias("long_day"),
        dates.days_spanned(start, ts).cast("bigint").alias("days"),
    )


@query(
    "conditional_functions",
    """
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'none') AS status,
       CASE WHEN o_totalprice >= 250000 THEN 'high' ELSE 'low' END AS size,
       upper(trim(lower(o_orderpriority))) AS priority,
       o_orderstatus IN ('F', 'O') AS known,
       o_totalprice >= 100000 AS large,
       'order ' || o_orderkey || ' is ' || o_orderstatus AS line
FROM orders""",
)
def conditional_functions(spark, folder):
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return read(spark, folder, "orders").select(
        "o_orderkey",
        F.coalesce(F.nullif(status, F.lit("P")), F.lit("none")).alias("status"),
        F.when(price >= 250000, "high").otherwise("low").alias("size"),
        F.upper(text.strip_blank(F.lower("o_orderpriority"))).alias("priority"),
        status.isin("F", "O").alias("known"),
        (price >= 100000).alias("large"),
        text.sentence("order ", F.col("o_orderkey"), " is ", status).alias("line"),
    )
