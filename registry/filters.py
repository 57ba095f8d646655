"""Filters, order, top rows and set operations."""

from pyspark.sql import functions as F

from registry.common import CLAIMS, COUNT, RATE, Registry, money, with_summaries
from sieveframe.bindings import claims, read
from sieveframe.functions.numbers import exact_sum
from sieveframe.operators import filters, ranking
from sieveframe.plans import pages, summaries
from sieveframe.plans.analysis import run_query
from sieveframe.plans.claims import SEVERITY, STATE, TOTAL, TYPE
from sieveframe.sources.scratch import settle

REGISTRY = Registry()
query = REGISTRY.query

STATES = ["NATION_1", "NATION_7", "NATION_19"]
TYPES = ["BUILDING", "MACHINERY"]
CHOSEN = (
    "incident_state IN ('NATION_1', 'NATION_7', 'NATION_19') "
    "AND incident_type IN ('BUILDING', 'MACHINERY')"
)


@query(
    "filter_in",
    f"""{CLAIMS}
SELECT policy_number, incident_state, incident_type, total_claim_amount
FROM claims WHERE {CHOSEN}""",
)
def filter_in(spark, folder):
    df = claims(spark, folder, "policy_number", STATE, TYPE, TOTAL)
    return pages.select_claims(df, STATES, TYPES)


@query(
    "filter_empty_choice",
    f"""{CLAIMS}
SELECT incident_type, count(*) AS claims FROM claims
WHERE incident_type IN ('BUILDING', 'MACHINERY') GROUP BY 1""",
)
def filter_empty_choice(spark, folder):
    """No state chosen means all; a column that the table lacks is skipped."""
    df = claims(spark, folder, TYPE)
    chosen = filters.select_rows(df, {STATE: STATES, TYPE: TYPES, "absent": ["x"]})
    return chosen.groupBy(TYPE).agg(F.count(F.lit(1)).alias("claims"))


@query(
    "filtered_view",
    f"""{CLAIMS}
SELECT incident_type, {COUNT} AS claims, {RATE} AS fraud_rate
FROM claims WHERE {CHOSEN} GROUP BY ALL""",
)
def filtered_view(spark, folder):
    """A query over another query by name."""
    df = claims(spark, folder, STATE, TYPE, "fraud_reported")
    chosen = pages.select_claims(df, STATES, TYPES)
    return run_query(
        spark,
        """
        SELECT incident_type, count(*) AS claims,
               avg(CAST(fraud_reported AS INT)) AS fraud_rate
        FROM filtered GROUP BY ALL;  -- a trailing remark
        """,
        {"filtered": chosen},
    )


@query(
    "domain_states",
    f"{CLAIMS} SELECT DISTINCT incident_state FROM claims ORDER BY ALL",
)
def domain_states(spark, folder):
    return filters.domain_values(claims(spark, folder, STATE), STATE)


@query(
    "domain_types",
    f"{CLAIMS} SELECT DISTINCT incident_type FROM claims ORDER BY ALL",
)
def domain_types(spark, folder):
    return filters.domain_values(claims(spark, folder, TYPE), TYPE)


@query(
    "selection_count",
    f"{CLAIMS} SELECT count(*) AS claims FROM claims WHERE {CHOSEN}",
)
def selection_count(spark, folder):
    df = claims(spark, folder, STATE, TYPE)
    return filters.selection_size(pages.select_claims(df, STATES, TYPES))


@query(
    "full_weeks",
    f"""{CLAIMS}
SELECT CAST(date_trunc('week', incident_date) AS DATE) AS week_start,
       CAST(min(incident_date) AS DATE) AS first_day,
       CAST(max(incident_date) AS DATE) AS last_day,
       count(*) AS claims
FROM claims GROUP BY 1 HAVING last_day - first_day = 6""",
)
def full_weeks(spark, folder):
    df = claims(spark, folder, "incident_date", TOTAL)
    weeks = run_weeks(spark, df)
    return filters.full_weeks(weeks)


def run_weeks(spark, df):
    return run_query(
        spark,
        """
        SELECT CAST(date_trunc('week', incident_date) AS DATE) AS week_start,
               CAST(min(incident_date) AS DATE) AS first_day,
               CAST(max(incident_date) AS DATE) AS last_day,
               count(*) AS claims
        FROM weekly_claims GROUP BY 1
        """,
        {"weekly_claims": df},
    )


# Events by user and type, with small groups merged, have an OTHER label.
MERGED_EVENTS = """
WITH sized AS (
  SELECT event_id, user_id, event_type, value,
         count(*) OVER (PARTITION BY user_id, event_type) AS n FROM events
),
merged AS (
  SELECT event_id, user_id, value,
         CASE WHEN n >= 10 AND user_id IS NOT NULL AND event_type IS NOT NULL
              THEN event_type ELSE 'Other (small groups)' END AS event_type
  FROM sized
)"""


def merged_events(spark, folder):
    df = read(spark, folder, "events").select(
        "event_id", "user_id", "event_type", "value"
    )
    return summaries.merge_small(df, ("user_id", "event_type"))


@query(
    "rank_without_other",
    f"""{MERGED_EVENTS}
SELECT event_type, count(*) AS events FROM merged
WHERE event_type <> 'Other (small groups)' GROUP BY 1 ORDER BY 2 DESC, 1""",
)
def rank_without_other(spark, folder):
    groups = merged_events(spark, folder).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events")
    )
    named = filters.without_other(groups, "event_type")
    return ranking.ordered(named, "events", "event_type")


@query(
    "min_group_size",
    """
SELECT user_id, event_type, count(*) AS events FROM events
GROUP BY ALL HAVING count(*) >= 20""",
)
def min_group_size(spark, folder):
    groups = read(spark, folder, "events").groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("events")
    )
    return filters.at_least(groups, "events", 20)


STATE_COST = f"""{CLAIMS},
states AS (
  SELECT incident_state, {money("total_claim_amount")} AS cost FROM claims GROUP BY 1
)"""


def _state_cost(spark, folder):
    table = summaries.state_table(
        summaries.summarize(claims(spark, folder))["by_state_type"]
    )
    return table.select(STATE, F.col("total_cost").alias("cost"))


@query(
    "ordered_states",
    f"{STATE_COST} SELECT * FROM states ORDER BY cost DESC, incident_state",
)
def ordered_states(spark, folder):
    return ranking.ordered(_state_cost(spark, folder), "cost", STATE)


@query(
    "top1_state",
    f"{STATE_COST} SELECT * FROM states ORDER BY cost DESC, incident_state LIMIT 1",
)
def top1_state(spark, folder):
    return ranking.top(_state_cost(spark, folder), "cost", STATE)


@query(
    "top3_states",
    f"{STATE_COST} SELECT * FROM states ORDER BY cost DESC, incident_state LIMIT 3",
)
def top3_states(spark, folder):
    return ranking.top(_state_cost(spark, folder), "cost", STATE, n=3)


@query(
    "row_at_maximum",
    f"""{CLAIMS},
groups AS (
  SELECT incident_type, incident_severity, {RATE} AS rate FROM claims GROUP BY ALL
)
SELECT incident_type,
       (SELECT g.incident_severity FROM groups g WHERE g.incident_type = t.incident_type
        ORDER BY g.rate DESC, g.incident_severity LIMIT 1) AS worst_severity,
       (SELECT g.incident_severity FROM groups g WHERE g.incident_type = t.incident_type
        ORDER BY g.rate, g.incident_severity LIMIT 1) AS best_severity
FROM (SELECT DISTINCT incident_type FROM claims) t""",
)
def row_at_maximum(spark, folder):
    df = claims(spark, folder, TYPE, SEVERITY, "fraud_reported")
    groups = df.groupBy(TYPE, SEVERITY).agg(
        F.avg(F.col("fraud_reported").cast("int")).alias("rate")
    )
    rate, severity = F.col("rate"), F.col(SEVERITY)
    return groups.groupBy(TYPE).agg(
        ranking.key_at_max(rate, severity).alias("worst_severity"),
        ranking.key_at_min(rate, severity).alias("best_severity"),
    )


@query(
    "ranked_top",
    f"""{STATE_COST}
SELECT incident_state, cost,
       row_number() OVER (ORDER BY cost DESC, incident_state) = 1 AS is_top
FROM states ORDER BY cost, incident_state DESC""",
)
def ranked_top(spark, folder):
    return ranking.with_top_flag(settle(_state_cost(spark, folder)), STATE, "cost")


@query(
    "share_of_total",
    f"""{STATE_COST}
SELECT incident_state,
       cost / (SELECT {money("total_claim_amount")} FROM claims) AS share
FROM states""",
)
def share_of_total(spark, folder):
    df = claims(spark, folder, STATE, TOTAL)
    groups = settle(df.groupBy(STATE).agg(exact_sum(df, TOTAL).alias("cost")))
    share = ranking.share_of_total(groups, "cost")
    return groups.select(STATE, share.alias("share"))


@query(
    "kpi_compare",
    f"""{with_summaries("by_state_type")},
whole AS (
  SELECT sum(claims) AS n, sum(fraud_claims) AS f, sum(total_claim_amount) AS c
  FROM by_state_type
),
part AS (
  SELECT sum(claims) AS n, sum(fraud_claims) AS f, sum(total_claim_amount) AS c
  FROM by_state_type WHERE {CHOSEN}
)
SELECT format('{{:,}}', part.n) AS total_claims,
       CASE WHEN part.c >= 1e6 THEN '$' || format('{{:,.1f}}', part.c / 1e6) || 'M'
            ELSE '$' || format('{{:,.0f}}', part.c) END AS total_amount,
       format('{{:.1f}}%', 100.0 * (part.f / part.n)) AS fraud_rate,
       '$' || format('{{:,}}', CAST(part.c / part.n AS BIGINT)) AS avg_claim,
       format('{{:.1f}}%', 100.0 * (part.n / whole.n)) || ' of all claims' AS claims_note,
       format('{{:.1f}}%', 100.0 * (part.c / whole.c)) || ' of total cost' AS cost_note,
       format('{{:+.1f}}', 100.0 * (part.f / part.n - whole.f / whole.n))
         || ' pts vs. dataset average' AS rate_note,
       format('{{:+.0f}}', 100.0 * ((part.c / part.n) / (whole.c / whole.n) - 1))
         || '% vs. dataset average' AS avg_note
FROM part, whole""",
)
def kpi_compare(spark, folder):
    table = settle(summaries.summarize(claims(spark, folder))["by_state_type"])
    chosen = pages.select_claims(table, STATES, TYPES)
    return pages.compare_kpis(chosen, table, filtered=True)


@query(
    "kpi_all",
    f"""{with_summaries("by_state_type")}
SELECT format('{{:,}}', sum(claims)) AS total_claims,
       '$' || format('{{:,.1f}}', sum(total_claim_amount) / 1e6) || 'M' AS total_amount,
       format('{{:.1f}}%', 100.0 * (sum(fraud_claims) / sum(claims))) AS fraud_rate,
       '$' || format('{{:,}}', CAST(sum(total_claim_amount) / sum(claims) AS BIGINT))
         AS avg_claim,
       'All claims' AS claims_note, 'All claims' AS cost_note,
       'Dataset average' AS rate_note, 'Dataset average' AS avg_note
FROM by_state_type""",
)
def kpi_all(spark, folder):
    table = settle(summaries.summarize(claims(spark, folder))["by_state_type"])
    return pages.compare_kpis(table, table, filtered=False)


@query(
    "kpi_caption",
    f"""{CLAIMS}
SELECT 'Incidents from ' || strftime(min(incident_date), '%b %-d, %Y') || ' to '
  || strftime(max(incident_date), '%b %-d, %Y') || ' ' || chr(183) || ' '
  || format('{{:,}}', count(*)) || ' of '
  || format('{{:,}}', (SELECT count(*) FROM claims)) || ' claims' AS caption
FROM claims WHERE {CHOSEN}""",
)
def kpi_caption(spark, folder):
    tables = summaries.summarize_at_once(claims(spark, folder))
    whole, days = tables["by_state_type"], tables["by_state_type_day"]
    chosen = [pages.select_claims(t, STATES, TYPES) for t in (whole, days)]
    return pages.caption(chosen[0], whole, chosen[1])
