"""Daily series, rolling means, halves and periods."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from registry.common import CLAIMS, Registry
from sieveframe.bindings import claims, read
from sieveframe.operators import series
from sieveframe.plans import pages, summaries
from sieveframe.plans.claims import DATE, STATE

REGISTRY = Registry()
query = REGISTRY.query

DAILY = f"""{CLAIMS},
counts AS (
  SELECT CAST(incident_date AS DATE) AS day, count(*) AS claims FROM claims GROUP BY 1
),
days AS (
  SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE)
    AS day
  FROM counts
),
daily AS (
  SELECT day, coalesce(claims, 0) AS claims FROM days LEFT JOIN counts USING (day)
)"""

ROLLED = """
CASE WHEN row_number() OVER ({w} ORDER BY day) >= 14
     THEN avg(claims) OVER ({w} ORDER BY day ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)
END AS avg_14d"""


@query("daily_gapfill", f"{DAILY} SELECT * FROM daily")
def daily_gapfill(spark, folder):
    counts = series.count_by_day(claims(spark, folder, DATE), DATE)
    return series.fill_days(counts)


@query(
    "daily_rolling14", f"{DAILY} SELECT day, claims, {ROLLED.format(w='')} FROM daily"
)
def daily_rolling14(spark, folder):
    return pages.daily_claims(claims(spark, folder, DATE))


@query(
    "daily_from_summary",
    f"{DAILY} SELECT day, claims, {ROLLED.format(w='')} FROM daily",
)
def daily_from_summary(spark, folder):
    """The same series from the day summary."""
    table = summaries.summarize(claims(spark, folder))["by_state_type_day"]
    counts = series.count_by_day(table, DATE, n=F.col("claims"))
    return series.daily(counts)


# One series per user; events leave many days out.
PER_USER = """
WITH counts AS (
  SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS claims
  FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL GROUP BY ALL
),
ends AS (SELECT user_id, min(day) AS a, max(day) AS b FROM counts GROUP BY 1),
days AS (
  SELECT user_id,
         CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day
  FROM ends
),
daily AS (
  SELECT user_id, day, coalesce(claims, 0) AS claims
  FROM days LEFT JOIN counts USING (user_id, day)
)"""


def _user_days(spark, folder):
    return series.count_by_day(read(spark, folder, "events"), "ts", ["user_id"])


@query("user_gapfill", f"{PER_USER} SELECT * FROM daily")
def user_gapfill(spark, folder):
    return series.fill_days(_user_days(spark, folder), ["user_id"])


@query(
    "user_rolling14",
    f"""{PER_USER}
SELECT user_id, day, claims, {ROLLED.format(w="PARTITION BY user_id")} FROM daily""",
)
def user_rolling14(spark, folder):
    return series.daily(_user_days(spark, folder), ["user_id"])


HALVES = """
numbered AS (
  SELECT *, row_number() OVER ({w} ORDER BY day) AS k, count(*) OVER ({w}) AS n
  FROM daily
)
SELECT {keys} count(*) AS days,
       avg(claims) FILTER (WHERE k <= n / 2) AS first_half,
       avg(claims) FILTER (WHERE k > n / 2) AS second_half
FROM numbered {group}"""


@query("halves", f"{DAILY}, {HALVES.format(w='', keys='', group='')}")
def halves(spark, folder):
    counts = series.count_by_day(claims(spark, folder, DATE), DATE)
    return series.halves(series.fill_days(counts))


@query(
    "user_halves",
    PER_USER
    + ", "
    + HALVES.format(w="PARTITION BY user_id", keys="user_id,", group="GROUP BY user_id"),
)
def user_halves(spark, folder):
    filled = series.fill_days(_user_days(spark, folder), ["user_id"])
    return series.halves(filled, ["user_id"])


@query(
    "day_numbers",
    f"""{DAILY}
SELECT day, row_number() OVER (ORDER BY day) AS day_number,
       count(*) OVER () AS total_days FROM daily""",
)
def day_numbers(spark, folder):
    filled = series.fill_days(series.count_by_day(claims(spark, folder, DATE), DATE))
    return filled.select(
        "day",
        F.row_number().over(Window.orderBy("day")).cast("bigint").alias("day_number"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("total_days"),
    )


PERIOD = """
CAST(min(d) AS DATE) AS first_day, CAST(max(d) AS DATE) AS last_day,
datediff('day', min(d), max(d)) + 1 AS days,
(datediff('day', min(d), max(d)) + 1) / 30.0 AS months"""


@query(
    "period_length",
    f"{CLAIMS} SELECT {PERIOD.replace('(d)', '(incident_date)')} FROM claims",
)
def period_length(spark, folder):
    found = series.period(claims(spark, folder, DATE), DATE)
    return found.withColumn("days", F.col("days").cast("bigint"))


@query(
    "state_periods",
    f"""{CLAIMS}
SELECT incident_state, {PERIOD.replace('(d)', '(incident_date)')}
FROM claims GROUP BY 1""",
)
def state_periods(spark, folder):
    found = series.period(claims(spark, folder, STATE, DATE), DATE, [STATE])
    return found.withColumn("days", F.col("days").cast("bigint"))
