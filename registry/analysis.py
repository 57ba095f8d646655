"""Analysis queries, summaries and page figures."""

from pyspark.sql import functions as F

from registry.common import (
    CLAIMS,
    COUNT,
    FRAUD,
    RATE,
    SUMMARIES,
    Registry,
    doubles,
    mean_money,
    money,
    with_summaries,
)
from registry.filters import MERGED_EVENTS, merged_events
from sieveframe.bindings import claims, read
from sieveframe.functions.numbers import exact_mean, exact_sum, plain
from sieveframe.plans import pages, summaries
from sieveframe.plans.analysis import run_queries, run_query
from sieveframe.plans.claims import AMOUNTS, DATE, FRAUD as FLAG
from sieveframe.plans.claims import CLAIMS as DOMAIN
from sieveframe.plans.claims import PARTS, SEVERITY, STATE, TOTAL, TYPE
from sieveframe.operators.ranking import ordered
from sieveframe.operators.quantiles import group_quantiles
from sieveframe.sources.scratch import settle

REGISTRY = Registry()
query = REGISTRY.query

# The four analysis files, each over the columns it reads.
NEEDED = {
    "fraud_by_severity": (SEVERITY, FLAG, TOTAL),
    "fraud_by_incident_type": (TYPE, FLAG, TOTAL),
    "claims_by_state": (STATE, TOTAL),
    "claims_by_week": (DATE, TOTAL),
}
# What all four read together.
QUERIED = (STATE, TYPE, SEVERITY, DATE, FLAG, TOTAL)
AVG = f"round({mean_money('total_claim_amount')}) AS avg_amount"
COST = f"CAST({money('total_claim_amount')} AS BIGINT) AS total_amount"


def _fraud_by(name):
    return f"""{CLAIMS}
SELECT {name}, count(*) AS claims, CAST(count_if(fraud_reported) AS INT) AS fraud_claims,
       round(100.0 * {RATE}, 1) AS fraud_pct, {AVG}
FROM claims GROUP BY 1"""


ANALYSIS_SQL = {
    "fraud_by_severity": _fraud_by("incident_severity"),
    "fraud_by_incident_type": _fraud_by("incident_type"),
    "claims_by_state": f"""{CLAIMS}, groups AS (
  SELECT incident_state, count(*) AS claims,
         {money("total_claim_amount")} AS cost, {AVG} FROM claims GROUP BY 1)
SELECT incident_state, claims, CAST(cost AS BIGINT) AS total_amount, avg_amount,
       round(100.0 * cost / sum(cost) OVER (), 1) AS pct_of_total_amount
FROM groups""",
    "claims_by_week": f"""{CLAIMS}
SELECT CAST(date_trunc('week', incident_date) AS DATE) AS week_start,
       CAST(min(incident_date) AS DATE) AS first_day,
       CAST(max(incident_date) AS DATE) AS last_day,
       count(*) AS claims, {COST}, {AVG}
FROM claims GROUP BY 1""",
}


def analysis_query(name):
    def run(spark, folder):
        """One of the SQL files over only the columns it needs."""
        rows = claims(spark, folder, *NEEDED[name])
        text = (DOMAIN.queries / f"{name}.sql").read_text(encoding="utf-8")
        return run_query(spark, text, {"claims": rows})

    return run


for _name, _sql in ANALYSIS_SQL.items():
    REGISTRY.add(_name, analysis_query(_name), _sql)


def as_lines(name, columns):
    """Every cell of a result as one line of text, in SQL."""
    cells = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)
    return f"SELECT '{name}' AS query, concat_ws('|', {cells}) AS line"


SHOWN = {
    "fraud_by_severity": ("incident_severity", "claims", "fraud_claims", "fraud_pct", "avg_amount"),
    "fraud_by_incident_type": ("incident_type", "claims", "fraud_claims", "fraud_pct", "avg_amount"),
    "claims_by_state": ("incident_state", "claims", "total_amount", "avg_amount", "pct_of_total_amount"),
    "claims_by_week": ("week_start", "first_day", "last_day", "claims", "total_amount", "avg_amount"),
}


def lines_of(results):
    """The same in Spark, from result tables by name."""
    out = None
    for name, df in results.items():
        cells = []
        for c in SHOWN[name]:
            double = dict(df.dtypes)[c] == "double"
            text = plain(F.col(c)) if double else F.col(c).cast("string")
            cells.append(F.coalesce(text, F.lit("-")))
        part = df.select(F.lit(name).alias("query"), F.concat_ws("|", *cells).alias("line"))
        out = part if out is None else out.unionAll(part)
    return out


FOLDER_LINES = " UNION ALL ".join(
    f"({as_lines(name, SHOWN[name])} FROM ({sql.removeprefix(CLAIMS)}))"
    if name != "claims_by_state"
    else f"({as_lines(name, SHOWN[name])} FROM (WITH {sql.removeprefix(CLAIMS).lstrip(', ')}))"
    for name, sql in ANALYSIS_SQL.items()
)


@query("sql_folder", f"{CLAIMS} {FOLDER_LINES}")
def sql_folder(spark, folder):
    """The whole folder in one go: every cell of every result."""
    rows = settle(claims(spark, folder, *QUERIED))
    return lines_of(run_queries(spark, DOMAIN.queries, {"claims": rows}))


FINE_SUM = """
SELECT l_returnflag, round(CAST(sum(CAST(l_extendedprice * l_discount AS DECIMAL(18, 4)))
         AS DOUBLE), 4) AS discounts,
       round(CAST(sum(CAST(l_extendedprice * l_discount AS DECIMAL(18, 4))) AS DOUBLE)
         / count(*), 4) AS mean_discount
FROM lineitem GROUP BY l_returnflag"""


@query("fine_sums", FINE_SUM)
def fine_sums(spark, folder):
    """Sums of amounts with four decimals, which no step rounds to cents."""
    amount = F.col("l_extendedprice") * F.col("l_discount")
    df = read(spark, folder, "lineitem").select("l_returnflag", amount.alias("amount"))
    return df.groupBy("l_returnflag").agg(
        F.round(exact_sum(df, "amount").cast("double"), 4).alias("discounts"),
        F.round(exact_mean(df, "amount"), 4).alias("mean_discount"),
    )


def _summary_query(name):
    def run(spark, folder):
        table = summaries.summarize(claims(spark, folder))[name]
        return doubles(table, *(c for c in AMOUNTS if c in table.columns))

    return run


for _name in SUMMARIES:
    REGISTRY.add(
        f"summary_{_name}", _summary_query(_name), CLAIMS + SUMMARIES[_name]
    )


@query(
    "merge_small",
    f"{MERGED_EVENTS} SELECT event_id, user_id, event_type FROM merged",
)
def merge_small(spark, folder):
    return merged_events(spark, folder).select("event_id", "user_id", "event_type")


# Claims whose types are so fine that merging has work to do: one per hour.
FINE = f"""{CLAIMS},
fine AS (
  SELECT * REPLACE (incident_type || ' ' || incident_hour_of_the_day AS incident_type)
  FROM claims
),
sized AS (
  SELECT *, count(*) OVER (PARTITION BY incident_state, incident_type) AS n FROM fine
),
merged AS (
  SELECT * REPLACE (CASE WHEN n >= 10 THEN incident_type
                         ELSE 'Other (small groups)' END AS incident_type)
  FROM sized
)"""


def fine_claims(spark, folder):
    df = claims(
        spark, folder, STATE, TYPE, SEVERITY, DATE, FLAG, *AMOUNTS, "incident_hour_of_the_day"
    )
    fine = F.concat_ws(" ", TYPE, F.col("incident_hour_of_the_day").cast("string"))
    return df.withColumn(TYPE, fine).drop("incident_hour_of_the_day")


def _merged_query(name):
    def run(spark, folder):
        rows = fine_claims(spark, folder)
        table = summaries.summarize_at_once(rows, min_group=10)[name]
        return doubles(table, *(c for c in AMOUNTS if c in table.columns))

    return run


for _name in SUMMARIES:
    REGISTRY.add(
        f"merged_{_name}",
        _merged_query(_name),
        FINE + SUMMARIES[_name].replace("FROM claims", "FROM merged"),
    )


def _quantiles(points):
    value = "total_claim_amount"
    return ", ".join(
        f"round_even(quantile_cont({value}, {p}), 0) AS {name}"
        for name, p in points.items()
    )


@query(
    "amount_stats",
    f"""{CLAIMS}
SELECT incident_type, {_quantiles(summaries.BOX)}
FROM claims WHERE incident_type IS NOT NULL GROUP BY 1""",
)
def amount_stats(spark, folder):
    return summaries.amount_stats(claims(spark, folder, TYPE, TOTAL))


@query(
    "state_percentiles",
    f"""{CLAIMS}
SELECT incident_state, round(quantile_cont(total_claim_amount, 0.01), 4) AS p1,
       round(quantile_cont(total_claim_amount, 0.999), 4) AS p999
FROM claims WHERE incident_state IS NOT NULL GROUP BY 1""",
)
def state_percentiles(spark, folder):
    df = claims(spark, folder, STATE, TOTAL)
    found = group_quantiles(df, STATE, TOTAL, {"p1": 0.01, "p999": 0.999})
    return found.select(STATE, F.round("p1", 4).alias("p1"), F.round("p999", 4).alias("p999"))


def _rate_query(table, name):
    def run(spark, folder):
        summary = summaries.summarize(claims(spark, folder))[table]
        return summaries.fraud_rate_by(summary, name)

    return run


for _table, _name in (
    ("by_state_type", TYPE),
    ("by_state_type", STATE),
    ("by_state_type_severity", SEVERITY),
):
    REGISTRY.add(
        f"rate_by_{_name.removeprefix('incident_')}",
        _rate_query(_table, _name),
        f"""{with_summaries(_table)}
SELECT {_name}, round_even(100.0 * sum(fraud_claims) / sum(claims), 1) AS fraud_pct
FROM {_table} GROUP BY 1""",
    )


@query(
    "kpis",
    f"""{CLAIMS}
SELECT {COUNT} AS claims, {money("total_claim_amount")} AS total_amount,
       {RATE} AS fraud_rate, {mean_money("total_claim_amount")} AS avg_claim,
       strftime(min(incident_date), '%b %-d, %Y') AS first_date,
       strftime(max(incident_date), '%b %-d, %Y') AS last_date
FROM claims""",
)
def kpis(spark, folder):
    return pages.kpis(claims(spark, folder, TOTAL, FLAG, DATE))


@query(
    "weekly_distinct",
    f"""{CLAIMS}
SELECT CAST(date_trunc('week', incident_date) AS DATE) AS week_start,
       {COUNT} AS claims, {money("total_claim_amount")} AS claim_cost,
       count(DISTINCT incident_date) AS days_with_data
FROM claims GROUP BY 1""",
)
def weekly_distinct(spark, folder):
    return pages.weekly(claims(spark, folder, TOTAL, DATE))


SPLIT = ", ".join(f"{money(p)} AS {p.removesuffix('_claim')}" for p in PARTS)


@query("cost_split", f"{CLAIMS} SELECT incident_type, {SPLIT} FROM claims GROUP BY 1")
def cost_split(spark, folder):
    return pages.cost_split(claims(spark, folder, TYPE, *AMOUNTS))


@query(
    "cost_parts",
    f"""{CLAIMS}
SELECT incident_type, {SPLIT} FROM claims WHERE incident_type IS NOT NULL GROUP BY 1""",
)
def cost_parts(spark, folder):
    table = summaries.summarize(claims(spark, folder))["by_state_type"]
    return summaries.cost_parts(table)


def _mean_where(condition):
    return mean_money(f"(CASE WHEN {condition} THEN total_claim_amount END)")


@query(
    "fraud_premium",
    f"""{CLAIMS}
SELECT {FRAUD} AS fraud_claims, {RATE} AS fraud_rate,
       {_mean_where("fraud_reported")} AS avg_fraud_claim,
       {_mean_where("NOT fraud_reported")} AS avg_other_claim,
       {_mean_where("fraud_reported")} / {_mean_where("NOT fraud_reported")} - 1
         AS fraud_premium
FROM claims""",
)
def fraud_premium(spark, folder):
    return pages.fraud_kpis(claims(spark, folder, TOTAL, FLAG))


def _page_rate(name):
    return lambda spark, folder: pages.rate_by(claims(spark, folder, name, FLAG), name)


for _name in (SEVERITY, TYPE):
    REGISTRY.add(
        f"page_rate_by_{_name.removeprefix('incident_')}",
        _page_rate(_name),
        f"""{CLAIMS}
SELECT {_name}, {COUNT} AS claims, {RATE} AS fraud_rate FROM claims GROUP BY 1""",
    )


@query(
    "type_severity",
    f"""{CLAIMS}
SELECT incident_type, incident_severity, {COUNT} AS claims, {RATE} AS fraud_rate,
       CASE incident_severity WHEN 'Trivial Damage' THEN 1 WHEN 'Minor Damage' THEN 2
            WHEN 'Major Damage' THEN 3 ELSE 4 END AS severity_order
FROM claims GROUP BY ALL""",
)
def type_severity(spark, folder):
    return pages.type_by_severity(claims(spark, folder, TYPE, SEVERITY, FLAG))


def _cell(label):
    where = f"FILTER (WHERE incident_severity = '{label}')"
    return (
        f"round_even(100.0 * sum(fraud_claims) {where} / sum(claims) {where}, 0) "
        f'AS "{label}"'
    )


@query(
    "rate_heatmap",
    f"""{with_summaries("by_state_type_severity")}
SELECT incident_type, {", ".join(map(_cell, pages.SEVERITIES))}
FROM by_state_type_severity GROUP BY 1""",
)
def rate_heatmap(spark, folder):
    table = summaries.summarize(claims(spark, folder))["by_state_type_severity"]
    return summaries.rate_heatmap(table)


STATES = f"""{CLAIMS},
groups AS (
  SELECT incident_state, {COUNT} AS claims, {money("total_claim_amount")} AS claim_cost,
         {mean_money("total_claim_amount")} AS avg_claim, {RATE} AS fraud_rate
  FROM claims GROUP BY 1
),
states AS (
  SELECT incident_state, claims, claim_cost,
         claim_cost / (SELECT {money("total_claim_amount")} FROM claims) AS cost_share,
         avg_claim, fraud_rate
  FROM groups
)"""


@query(
    "state_share",
    f"""{STATES}
SELECT * REPLACE (round(cost_share, 12) AS cost_share) FROM states""",
)
def state_share(spark, folder):
    df = pages.by_state(claims(spark, folder, STATE, TOTAL, FLAG))
    return df.withColumn("cost_share", F.round("cost_share", 12))


@query(
    "state_extremes",
    f"""{STATES}
SELECT (SELECT incident_state FROM states ORDER BY claim_cost DESC, incident_state
        LIMIT 1) AS top_state,
       (SELECT format('{{:,}}', claims) FROM states
        ORDER BY claim_cost DESC, incident_state LIMIT 1) AS top_claims,
       (SELECT format('{{:.0f}}%', 100 * max(cost_share)) FROM states) AS top_share,
       (SELECT incident_state FROM states ORDER BY claims, incident_state LIMIT 1)
         AS small_state,
       (SELECT min(claims) FROM states) AS small_claims""",
)
def state_extremes(spark, folder):
    return pages.state_extremes(pages.by_state(claims(spark, folder, STATE, TOTAL, FLAG)))


@query(
    "state_table",
    f"""{with_summaries("by_state_type")}
SELECT incident_state, CAST(sum(claims) AS BIGINT) AS claims,
       round(sum(total_claim_amount), 2) AS total_cost,
       CAST(round_even(round(sum(total_claim_amount), 2) / sum(claims), 0) AS BIGINT)
         AS avg_claim,
       100.0 * sum(fraud_claims) / sum(claims) AS fraud_pct
FROM by_state_type GROUP BY 1""",
)
def state_table(spark, folder):
    table = summaries.summarize(claims(spark, folder))["by_state_type"]
    return ordered(summaries.state_table(table), "total_cost", STATE)


@query(
    "fraud_split",
    f"""{CLAIMS}
SELECT 'Flagged as fraud' AS name, {FRAUD} AS claims FROM claims
UNION ALL
SELECT 'Not flagged', count(*) - {FRAUD} FROM claims""",
)
def fraud_split(spark, folder):
    table = summaries.summarize(claims(spark, folder))["by_state_type"]
    return summaries.fraud_split(table)


@query(
    "basic_aggregates",
    f"""{CLAIMS}
SELECT incident_state, count(DISTINCT incident_date) AS days, {FRAUD} AS fraud_sum,
       {RATE} AS fraud_avg, {COUNT} AS size
FROM claims GROUP BY 1""",
)
def basic_aggregates(spark, folder):
    df = claims(spark, folder, STATE, DATE, FLAG)
    flag = F.col(FLAG).cast("int")
    return df.groupBy(STATE).agg(
        F.count_distinct(DATE).alias("days"),
        F.sum(flag).alias("fraud_sum"),
        F.avg(flag).alias("fraud_avg"),
        F.count(F.lit(1)).alias("size"),
    )
