"""Sources, sinks, stores and the whole run."""

from dataclasses import replace

from pyspark.sql import functions as F

from registry.analysis import (
    ANALYSIS_SQL,
    FINE,
    FOLDER_LINES,
    QUERIED,
    _quantiles,
    fine_claims,
    lines_of,
)
from registry.cleaning import CLEAN
from registry.common import CLAIMS, SUMMARIES, Registry, messy, money
from sieveframe.bindings import claims, read
from sieveframe.operators import rules
from sieveframe.plans import publish, summaries
from sieveframe.plans.analysis import run_queries, run_query
from sieveframe.plans.claims import AMOUNTS, PARTS
from sieveframe.plans.claims import CLAIMS as DOMAIN
from sieveframe.plans.run import ClaimsRun
from sieveframe.sources import csv_files, exports, tables
from sieveframe.sources.scratch import scratch_folder, settle

REGISTRY = Registry()
query = REGISTRY.query

# Orders as untidy text cells. The SQL gives the typed table they must become.
RAW_TYPED = """
SELECT o_orderkey AS "order key",
       CASE WHEN o_orderkey % 10 <> 3 THEN o_orderkey * 3 END AS "gaps",
       CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS "price",
       o_orderdate AS "Order Date",
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS "status",
       CASE WHEN o_orderkey % 2 = 0 THEN 'NA' ELSE 'None, "quoted"' END AS "note",
       o_orderstatus = 'F' AS "done",
       ' ' || o_orderpriority || ' ' AS "priority",
       CAST(NULL AS VARCHAR) AS "nothing",
       CASE WHEN o_orderkey = 0 THEN '1,000' ELSE CAST(o_orderkey AS VARCHAR) END AS "mixed"
FROM orders"""


def raw_cells(spark, folder):
    key, price, day = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderdate")
    return read(spark, folder, "orders").select(
        key.cast("string").alias("order key"),
        F.when(key % 10 == 3, "?")
        .when(key % 10 == 4, F.concat(F.lit("  "), (key * 3).cast("string")))
        .otherwise((key * 3).cast("string"))
        .alias("gaps"),
        F.when(key % 13 != 0, price.cast("string")).alias("price"),
        F.when(key % 3 == 0, F.date_format(day, "yyyyMMdd"))
        .when(key % 3 == 1, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
        .alias("Order Date"),
        F.when(F.col("o_orderstatus") == "P", "?")
        .otherwise(F.col("o_orderstatus"))
        .alias("status"),
        F.when(key % 2 == 0, "NA").otherwise('None, "quoted"').alias("note"),
        F.when(F.col("o_orderstatus") == "F", "True").otherwise("False").alias("done"),
        F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")).alias("priority"),
        F.when(key % 2 == 0, "?").alias("nothing"),
        F.when(key == 0, "1,000").otherwise(key.cast("string")).alias("mixed"),
    )


def write_raw(df, path):
    df.write.options(
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


@query("csv_ingest", RAW_TYPED)
def csv_ingest(spark, folder):
    path = scratch_folder(spark, "raw")
    write_raw(raw_cells(spark, folder), path)
    return csv_files.load_csv(spark, path)


@query("csv_declared_types", RAW_TYPED)
def csv_declared_types(spark, folder):
    """The same file with given types, without the look at the data."""
    path = scratch_folder(spark, "raw")
    write_raw(raw_cells(spark, folder), path)
    types = {
        "order key": "bigint",
        "gaps": "bigint",
        "price": "double",
        "Order Date": "timestamp_ntz",
        "done": "boolean",
    }
    return csv_files.load_csv(spark, path, types)


@query(
    "inbox_tables",
    f"""
SELECT count(*) AS rows, sum("order key")::BIGINT AS keys, count("price") AS prices,
       min("Order Date") AS first_date
FROM ({RAW_TYPED})""",
)
def inbox_tables(spark, folder):
    """All CSV files of a folder; files of other kinds are left alone."""
    path = scratch_folder(spark, "inbox")
    cells = raw_cells(spark, folder)
    write_raw(cells.repartition(3), path)
    cells.select("note").write.mode("append").text(path)
    loaded = csv_files.load_inbox(spark, path)
    every = None
    for df in loaded.values():
        every = df if every is None else every.unionByName(df)
    return every.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("order key").alias("keys"),
        F.count("price").alias("prices"),
        F.min("Order Date").alias("first_date"),
    )


@query("load_and_clean", CLEAN.format(make="replace(auto_make, 'Suburu', 'Subaru')"))
def load_and_clean(spark, folder):
    """A messy CSV file, with line breaks in cells, read and cleaned in one look."""
    path = scratch_folder(spark, "messy")
    write_raw(messy(spark, folder), path)
    return DOMAIN.load_clean(spark, path, multi_line=True)


TYPED = "policy_number, incident_date, incident_type, total_claim_amount, fraud_reported"


def _typed_claims(spark, folder):
    return claims(spark, folder, *TYPED.split(", "))


@query("snapshot_roundtrip", f"{CLAIMS} SELECT {TYPED} FROM claims")
def snapshot_roundtrip(spark, folder):
    df = _typed_claims(spark, folder)
    path = tables.save_snapshot(df, "claims", scratch_folder(spark, "processed"))
    return tables.read_snapshot(spark, path)


def _database(spark):
    """A database of its own in the shared scratch folder."""
    path = scratch_folder(spark, "db")
    name = "db_" + path[-32:]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


@query("store_replace", f"{CLAIMS} SELECT {TYPED} FROM claims WHERE fraud_reported")
def store_replace(spark, folder):
    """Stored twice, then replaced by a part of itself."""
    name = _database(spark)
    df = _typed_claims(spark, folder)
    tables.store_tables(spark, {"claims": df}, name)
    tables.store_tables(spark, {"claims": df}, name)
    own = spark.table(f"{name}.claims").filter("fraud_reported")
    tables.store_tables(spark, {"claims": own}, name)
    return spark.table(f"{name}.claims")


@query("store_snapshot", f"{CLAIMS} SELECT {TYPED} FROM claims WHERE fraud_reported")
def store_snapshot(spark, folder):
    """A table over snapshot files, replaced by one over a later snapshot."""
    name, out = _database(spark), scratch_folder(spark, "processed")
    df = _typed_claims(spark, folder)
    first = tables.save_snapshot(df, "first", out)
    second = tables.save_snapshot(df.filter("fraud_reported"), "second", out)
    tables.store_snapshot(spark, "claims", first, name)
    tables.store_snapshot(spark, "claims", second, name)
    return spark.table(f"{name}.claims")


@query(
    "stored_report",
    """
SELECT 'event unique' AS "check", 'warn' AS severity, count(*) AS failed_rows,
       list(event_id ORDER BY event_id)[1:10] AS failed_index
FROM events WHERE user_id IN
  (SELECT user_id FROM events GROUP BY 1 HAVING count(*) > 1)""",
)
def stored_report(spark, folder):
    """A report with its list of ids through the store."""
    events = read(spark, folder, "events")
    checks = {"event unique": (rules.WARN, rules.unique("user_id"))}
    report = rules.validate(events, checks, "event_id")
    name = _database(spark)
    tables.store_tables(spark, {"validation_report": report}, name)
    return spark.table(f"{name}.validation_report")


def _lines(spark, path, header):
    text = spark.read.text(path)
    return text.filter(F.col("value") != header).select(F.col("value").alias("line"))


@query(
    "export_csv_text",
    f"""{CLAIMS}
SELECT concat_ws(',', policy_number, strftime(incident_date, '%Y-%m-%d'),
       incident_severity, CASE WHEN fraud_reported THEN 'True' ELSE 'False' END,
       coalesce(nullif(incident_type, 'BUILDING'), ''), '" ""x"", y "') AS line
FROM claims""",
)
def export_csv_text(spark, folder):
    """The exact text: ISO dates, True/False, nothing for missing cells."""
    df = claims(
        spark,
        folder,
        "policy_number",
        "incident_date",
        "incident_severity",
        "fraud_reported",
        "incident_type",
    )
    df = df.withColumn("incident_type", F.nullif("incident_type", F.lit("BUILDING")))
    df = df.withColumn("quoted", F.lit(' "x", y '))
    out = scratch_folder(spark, "export")
    [path] = exports.export_csvs({"claims": df}, out)
    return _lines(spark, path, ",".join(df.columns))


@query(
    "save_results_text",
    f"""
SELECT concat_ws(',', week_start, first_day, last_day, claims, total_amount) AS line
FROM ({ANALYSIS_SQL["claims_by_week"]})""",
)
def save_results_text(spark, folder):
    rows = claims(spark, folder, "incident_date", "total_claim_amount")
    sql = (DOMAIN.queries / "claims_by_week.sql").read_text(encoding="utf-8")
    week = run_query(spark, sql, {"claims": rows}).drop("avg_amount")
    [path] = exports.save_results({"week": week}, scratch_folder(spark, "results"))
    return _lines(spark, path, ",".join(week.columns))


@query(
    "save_report_text",
    """
SELECT 'value in range,warn,' || count(*) || ',"['
  || array_to_string(list(event_id ORDER BY event_id)[1:10], ', ') || ']"' AS line
FROM events WHERE NOT coalesce(value BETWEEN 5 AND 50, false)""",
)
def save_report_text(spark, folder):
    checks = {"value in range": (rules.WARN, rules.between("value", 5, 50))}
    report = rules.validate(read(spark, folder, "events"), checks, "event_id")
    path = exports.save_report(report, "events", scratch_folder(spark, "reports"))
    return _lines(spark, path, ",".join(report.columns))


def _published(name, sql):
    def run(spark, folder):
        """Written as CSV behind the checks, and read back with fixed types."""
        rows = settle(fine_claims(spark, folder))
        out = scratch_folder(spark, "published")
        publish.publish_summaries(rows, {}, out, min_group=10)
        return tables.read_published(spark, out, publish.PUBLISHED)[name]

    REGISTRY.add(f"published_{name}", run, FINE + sql)


for _name, _sql in SUMMARIES.items():
    _published(_name, _sql.replace("FROM claims", "FROM merged"))
_published(
    "claim_amount_stats",
    f"SELECT incident_type, {_quantiles(summaries.BOX)} FROM fine GROUP BY 1",
)


@query(
    "publish_check",
    f"""{FINE},
groups AS (
  SELECT incident_state, incident_type, count(*) AS n FROM merged GROUP BY ALL
)
SELECT 'no sensitive columns' AS "check", 0 AS failed_rows
UNION ALL SELECT 'groups large enough', count(*) FROM groups WHERE n < 25
UNION ALL SELECT 'all claims counted', CAST(abs((SELECT count(*) FROM fine)
  - (SELECT sum(n) FROM groups WHERE incident_state IS NOT NULL)) AS BIGINT)
UNION ALL SELECT 'claims without a state', count(*) FROM fine
WHERE incident_state IS NULL""",
)
def publish_check(spark, folder):
    """The report behind the gate, with a limit that some groups miss."""
    rows = settle(fine_claims(spark, folder))
    merged = summaries.summarize_at_once(rows, min_group=10)
    report = summaries.publish_report(merged, rows.count(), min_group=25)
    return report.select("check", "failed_rows")


REFUSING = 10**9


@query(
    "publish_refused",
    f"""{CLAIMS}
SELECT 'groups large enough: ' || count(DISTINCT incident_state) || ' rows, ids []'
         AS reason,
       0 AS files
FROM claims""",
)
def publish_refused(spark, folder):
    """A limit that no merged group reaches: the gate says why, and nothing is written."""
    rows = settle(claims(spark, folder, *QUERIED, *PARTS))
    out = scratch_folder(spark, "published")
    try:
        publish.publish_summaries(rows, {}, out, min_group=REFUSING)
        reason = "published"
    except ValueError as refused:
        reason = str(refused).split("\n", 1)[1]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    written = files.load(out).count() if _exists(spark, out) else 0
    return spark.range(1).select(F.lit(reason).alias("reason"), F.lit(written).alias("files"))


def _exists(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return target.getFileSystem(conf).exists(target)


def _load_summaries(stored):
    def run(spark, folder):
        """From the stored table, or else from the published files."""
        rows = settle(claims(spark, folder))
        name, out = _database(spark), scratch_folder(spark, "published")
        if stored:
            tables.store_tables(spark, {"claims": rows}, name)
        else:
            publish.publish_summaries(rows, {}, out, min_group=1)
        found, kept = tables.load_summaries(
            spark, f"{name}.claims", summaries.summarize, out, publish.PUBLISHED
        )
        if (kept is not None) != stored:
            raise AssertionError("rows belong to the stored table only")
        table = found["by_state_type"]
        return table.withColumns({c: F.col(c).cast("double") for c in AMOUNTS})

    return run


REGISTRY.add(
    "summaries_from_table",
    _load_summaries(True),
    CLAIMS + SUMMARIES["by_state_type"],
)
REGISTRY.add(
    "summaries_from_files",
    _load_summaries(False),
    CLAIMS + SUMMARIES["by_state_type"],
)


RESULT_TYPES = {
    "fraud_by_severity": "incident_severity string, claims long, fraud_claims int, fraud_pct double, avg_amount double",
    "fraud_by_incident_type": "incident_type string, claims long, fraud_claims int, fraud_pct double, avg_amount double",
    "claims_by_state": "incident_state string, claims long, total_amount long, avg_amount double, pct_of_total_amount double",
    "claims_by_week": "week_start date, first_day date, last_day date, claims long, total_amount long, avg_amount double",
}


def exported_lines(spark, out):
    """Every cell of the four exported results, and of some columns of the rows."""
    rows = spark.read.option("header", True).csv(f"{out}/claims_clean.csv")
    part = rows.select(
        F.lit("claims_clean").alias("query"),
        F.concat_ws("|", "policy_number", "incident_date", "incident_severity", "fraud_reported").alias("line"),
    )
    return part.unionAll(lines_of(tables.read_published(spark, out, RESULT_TYPES)))


EXPORTED = f"""{CLAIMS}
SELECT 'claims_clean' AS query, policy_number || '|' || strftime(incident_date, '%Y-%m-%d')
  || '|' || incident_severity || '|' || CASE WHEN fraud_reported THEN 'True' ELSE 'False' END
  AS line FROM claims
UNION ALL {FOLDER_LINES}"""


@query("export_all", EXPORTED)
def export_all(spark, folder):
    """Everything that the export writes, read back."""
    rows = settle(claims(spark, folder))
    results = run_queries(spark, DOMAIN.queries, {"claims": rows})
    out = scratch_folder(spark, "export")
    publish.export_all(rows, results, out)
    return exported_lines(spark, out)


@query("export_step_alone", EXPORTED)
def export_step_alone(spark, folder):
    """Report and export of a stored table by an object that ran no other step."""
    source, out = scratch_folder(spark, "source"), scratch_folder(spark, "run")
    write_raw(claims(spark, folder), source)
    name = _database(spark)
    first = ClaimsRun(spark, source, out, name)
    for step in (first.clean, first.validate, first.store):
        step()
    later = ClaimsRun(spark, source, out, name)
    later.write_report()
    later.export()
    return exported_lines(spark, f"{out}/export")


@query(
    "run_twice",
    "SELECT i AS run, count(*) AS claims FROM orders, range(1, 3) t(i) GROUP BY i",
)
def run_twice(spark, folder):
    """Two whole runs in one session, into the same table."""
    source, name = scratch_folder(spark, "source"), _database(spark)
    write_raw(claims(spark, folder), source)
    out = None
    for i in (1, 2):
        to = scratch_folder(spark, "run")
        ClaimsRun(spark, source, to, name).run()
        rows = spark.read.option("header", True).csv(f"{to}/export/claims_clean.csv")
        part = rows.agg(F.lit(i).cast("long").alias("run"), F.count(F.lit(1)).alias("claims"))
        out = part if out is None else out.unionAll(part)
    return out


@query(
    "nan_export",
    """
SELECT l_orderkey * 8 + l_linenumber || ',' || CASE WHEN l_orderkey % 7 = 0 THEN ''
  WHEN l_orderkey % 7 = 1 THEN 'inf' WHEN l_orderkey % 7 = 2 THEN '-inf'
  ELSE CAST(CAST(l_quantity AS DOUBLE) AS VARCHAR) END AS line
FROM lineitem""",
)
def nan_export(spark, folder):
    """NaN is exported as an empty cell, infinity as inf."""
    key = F.col("l_orderkey")
    number = (
        F.when(key % 7 == 0, float("nan"))
        .when(key % 7 == 1, float("inf"))
        .when(key % 7 == 2, -float("inf"))
        .otherwise(F.col("l_quantity").cast("double"))
    )
    df = read(spark, folder, "lineitem").select(
        (key * 8 + F.col("l_linenumber")).alias("line_id"), number.alias("number")
    )
    out = scratch_folder(spark, "export")
    [path] = exports.export_csvs({"numbers": df}, out)
    return _lines(spark, path, ",".join(df.columns))


@query("whole_run", ANALYSIS_SQL["claims_by_state"])
def whole_run(spark, folder):
    """A claims file through every step; one result read from the export."""
    source, out = scratch_folder(spark, "source"), scratch_folder(spark, "run")
    write_raw(claims(spark, folder), source)
    ClaimsRun(spark, source, out, _database(spark)).run()
    schema = (
        "incident_state string, claims bigint, total_amount bigint, "
        "avg_amount double, pct_of_total_amount double"
    )
    return tables.read_published(spark, f"{out}/export", {"claims_by_state": schema})[
        "claims_by_state"
    ]


@query(
    "run_stops",
    f"""
SELECT count(*) AS claims, {money("o_totalprice")} AS total, 1 AS errors,
       false AS stored FROM orders""",
)
def run_stops(spark, folder):
    """A file whose parts miss the totals stops before the store."""
    source, out = scratch_folder(spark, "source"), scratch_folder(spark, "run")
    bad = claims(spark, folder).withColumn("injury_claim", F.lit(-1.0))
    write_raw(bad.withColumn("vehicle_claim", F.lit(2.0)), source)
    name = _database(spark)
    run = ClaimsRun(spark, source, out, name, domain=_only_parts())
    try:
        run.run()
    except ValueError:
        pass
    errors = run.report.filter("severity = 'error' AND failed_rows > 0").count()
    saved = tables.read_snapshot(spark, run.snapshot)
    return saved.agg(
        F.count(F.lit(1)).alias("claims"),
        F.round(F.sum("total_claim_amount"), 2).alias("total"),
        F.lit(errors).alias("errors"),
        F.lit(spark.catalog.tableExists(f"{name}.claims")).alias("stored"),
    )


def _only_parts():
    check = "claim parts sum to total"
    return replace(DOMAIN, rules={check: DOMAIN.rules[check]})
