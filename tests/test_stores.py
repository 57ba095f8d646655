import datetime as dt
import uuid
from dataclasses import replace

import pytest
from pyspark.errors import ParseException
from pyspark.sql import functions as F

from registry.stores import write_raw
from sieveframe.operators import rules
from sieveframe.plans import publish, summaries
from sieveframe.plans.analysis import run_queries, run_query
from sieveframe.plans.claims import CLAIMS
from sieveframe.plans.run import ClaimsRun, run_steps
from sieveframe.sources import exports, tables
from sieveframe.sources.scratch import (
    scratch_folder,
    scratch_removed,
    settle,
    settle_ordered,
    settle_small,
)


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def text_of(path):
    """The lines of all parts, headers once."""
    from pathlib import Path

    parts = [p.read_text().splitlines() for p in sorted(Path(path).glob("part-*.csv"))]
    return [parts[0][0]] + [line for part in parts for line in part[1:]]


def test_snapshot_keeps_types(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2015, 1, 1), True, None)], "d timestamp_ntz, b boolean, n boolean")
    path = tables.save_snapshot(df, "t", str(tmp_path))
    tables.save_snapshot(df, "t", str(tmp_path))
    back = tables.read_snapshot(spark, path)
    assert path.endswith("/t.parquet")
    assert back.schema == df.schema and back.count() == 1


def test_store_replaces(spark, database):
    parcels = [("P7", 2.5, dt.date(2021, 7, 4)), ("P8", None, None), ("P9", 1.25, None)]
    df = spark.createDataFrame(parcels, "parcel string, kilos double, sent date")
    for _ in range(3):
        tables.store_tables(spark, {"parcels": df, "light": df.filter("kilos < 2")}, database)
    stored = spark.table(f"{database}.parcels")
    assert sorted(map(tuple, stored.collect())) == parcels and stored.dtypes == df.dtypes
    # From its own old content.
    tables.store_tables(spark, {"parcels": stored.filter("sent IS NULL").drop("sent")}, database)
    left = spark.table(f"{database}.parcels")
    assert left.columns == ["parcel", "kilos"] and left.count() == 2
    assert {t.name for t in spark.catalog.listTables(database)} >= {"parcels", "light"}


def test_store_over_a_real_table(spark, database):
    """With the same columns the table is pointed at the new files, else a view replaces it."""
    spark.range(4).write.saveAsTable(f"{database}.crates")
    tables.store_tables(spark, {"crates": spark.range(10, 13)}, database)
    assert sorted(r.id for r in spark.table(f"{database}.crates").collect()) == [10, 11, 12]
    [kept] = spark.catalog.listTables(database, "crates")
    assert kept.tableType != "VIEW"
    other = spark.table(f"{database}.crates").selectExpr("id", "id * 2 AS twice")
    tables.store_tables(spark, {"crates": other}, database)
    assert sorted(map(tuple, spark.table(f"{database}.crates").collect())) == [(10, 20), (11, 22), (12, 24)]
    tables.store_tables(spark, {"crates": spark.range(1)}, database)
    assert spark.table(f"{database}.crates").count() == 1
    assert [t.name for t in spark.catalog.listTables(database) if t.name.startswith("crates")] == ["crates"]


def test_a_table_that_cannot_be_replaced_comes_back(spark, database, tmp_path):
    spark.range(4).write.saveAsTable(f"{database}.bins")
    spark.range(2).write.format("csv").save(str(tmp_path / "no-parquet"))
    with pytest.raises(Exception):
        tables.store_snapshot(spark, "bins", str(tmp_path / "no-parquet"), database)
    assert spark.table(f"{database}.bins").count() == 4


def test_a_table_over_a_snapshot(spark, database, tmp_path):
    paths = [tables.save_snapshot(spark.range(n), f"s{n}", str(tmp_path)) for n in (3, 2)]
    for path, rows in zip(paths, (3, 2)):
        tables.store_snapshot(spark, "claims", path, database)
        assert spark.table(f"{database}.claims").count() == rows
    assert spark.read.parquet(paths[0]).count() == 3  # the old files stay


def test_a_failed_store_leaves_the_old_table(spark, database):
    tables.store_tables(spark, {"claims": spark.range(3)}, database)
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        tables.store_tables(spark, {"claims": broken}, database)
    assert spark.table(f"{database}.claims").count() == 3


def test_store_keeps_the_list_of_ids(spark, database):
    report = rules.validate(
        spark.range(20, 26).withColumn("half", F.floor(F.col("id") / 4)),
        {"halves once": (rules.WARN, rules.unique("half"))},
        "id",
    )
    tables.store_tables(spark, {"validation_report": report}, database)
    row = spark.table(f"{database}.validation_report").first()
    assert tuple(row) == ("halves once", "warn", 6, [20, 21, 22, 23, 24, 25])


def test_export_text(spark, tmp_path):
    df = spark.createDataFrame(
        [
            ("P7", 2.5, [3, 4], dt.date(2021, 7, 4), "left, at \"door\"", False, dt.datetime(2021, 7, 3, 23, 5)),
            ("P8", None, None, None, "  two blanks ", None, None),
            ("", 1e7, [], None, None, True, None),
        ],
        "parcel string, kilos double, shelves array<long>, sent date, note string, paid boolean, seen timestamp_ntz",
    ).coalesce(1)
    [path] = exports.export_csvs({"parcels": df}, str(tmp_path / "not" / "there"))
    assert path.endswith("/parcels.csv")
    assert text_of(path) == [
        "parcel,kilos,shelves,sent,note,paid,seen",
        'P7,2.5,"[3, 4]",2021-07-04,"left, at ""door""",False,2021-07-03',
        "P8,,,,  two blanks ,,",
        ",10000000.0,[],,,True,",
    ]


def test_names_of_results_and_reports(spark, tmp_path):
    [path] = exports.save_results({"total": spark.range(1)}, str(tmp_path))
    assert path.endswith("/analysis_total.csv")
    report = rules.validate(spark.range(2), {"x": (rules.WARN, "id > 0")}, "id")
    path = exports.save_report(report, "t", str(tmp_path))
    assert path.endswith("/validation_t.csv")
    assert text_of(path) == ["check,severity,failed_rows,failed_index", "x,warn,1,[1]"]


def test_a_large_export_has_many_parts(spark, tmp_path):
    from pathlib import Path

    df = spark.range(0, 1000, 1, 4)
    [path] = exports.export_csvs({"t": df}, str(tmp_path))
    assert len(list(Path(path).glob("part-*.csv"))) == 4


def test_run_queries(spark, tmp_path):
    (tmp_path / "b_total.sql").write_text("-- all of it\nSELECT sum(x) AS total FROM t;\n-- end\n")
    (tmp_path / "a_steps.sql").write_text(
        "WITH one AS (SELECT x FROM t), two AS (SELECT x + 1 AS y FROM one) "
        "SELECT y FROM two ORDER BY y DESC"
    )
    (tmp_path / "notes.txt").write_text("ignore me")
    found = run_queries(spark, tmp_path, {"t": spark.range(1, 4).toDF("x")})
    assert list(found) == ["a_steps", "b_total"]
    assert found["b_total"].first().total == 6
    assert [r.y for r in found["a_steps"].collect()] == [4, 3, 2]


@pytest.mark.parametrize(
    "statement",
    ["DROP VIEW t", "CREATE TABLE z AS SELECT 1", "INSERT INTO t VALUES (1)",
     "SELECT 1; DROP VIEW t", "SELECT 1) ; DROP VIEW t; SELECT (1", "SET a=b"],
)
def test_only_queries_run(spark, statement):
    spark.range(1).createOrReplaceTempView("t")
    with pytest.raises(ParseException):
        run_query(spark, statement)
    assert spark.catalog.tableExists("t")


def test_publish_refuses_small_groups(make_claims, tmp_path):
    claims = make_claims(10)
    out = str(tmp_path / "published")
    with pytest.raises(ValueError, match="groups large enough"):
        publish.publish_summaries(claims, {}, out, min_group=50)
    assert not (tmp_path / "published").exists()
    paths = publish.publish_summaries(claims, {"q": claims.groupBy().count()}, out)
    assert [p.rsplit("/", 1)[1] for p in paths] == [
        "by_state_type.csv", "by_state_type_severity.csv", "by_state_type_day.csv",
        "claim_amount_stats.csv", "q.csv",
    ]
    back = tables.read_published(claims.sparkSession, out, publish.PUBLISHED)
    for name, table in back.items():
        assert not CLAIMS.sensitive & set(table.columns)
        assert table.count() > 0, name
    assert back["by_state_type"].agg(F.sum("claims")).first()[0] == 30


def test_publish_refuses_sensitive_results(make_claims, tmp_path):
    claims = make_claims(10)
    leak = {"leak": claims.withColumn("insured_zip", F.lit(1))}
    with pytest.raises(ValueError, match="sensitive"):
        publish.publish_summaries(claims, leak, str(tmp_path / "p"))


def test_load_summaries_without_the_table(spark, make_claims, tmp_path, database):
    claims, out = make_claims(10), str(tmp_path / "published")
    publish.publish_summaries(claims, {}, out)
    args = (f"{database}.claims", summaries.summarize, out, publish.PUBLISHED)
    found, rows = tables.load_summaries(spark, *args)
    assert rows is None and dict(found["by_state_type_day"].dtypes)["incident_date"] == "date"
    tables.store_tables(spark, {"claims": claims}, database)
    found, rows = tables.load_summaries(spark, *args)
    assert rows.count() == 30 and found["by_state_type"].count() == 2


def test_settle_reads_its_own_files(spark):
    df = settle(spark.range(5), "five")
    assert df.count() == 5
    assert all("/sieveframe/five-" in f for f in df.inputFiles())


@pytest.mark.parametrize(
    "master, setting, start",
    [("yarn", "hdfs://shared/", "hdfs://shared/sieveframe/x-"),
     ("local[4]", "/given", "/given/sieveframe/x-"), ("local[4]", None, "/"), ("yarn", None, None)],
)
def test_the_scratch_folder(master, setting, start):
    from types import SimpleNamespace as Fake

    session = Fake(
        conf=Fake(get=lambda key, default: setting), sparkContext=Fake(master=master)
    )
    if start is None:
        with pytest.raises(RuntimeError, match="shared folder"):
            scratch_folder(session, "x")
        return
    one, two = scratch_folder(session, "x"), scratch_folder(session, "x")
    assert one.startswith(start) and one != two
    assert one.rsplit("-", 1)[0] == two.rsplit("-", 1)[0]


def test_steps_stop_at_the_first_failure():
    ran = []

    def fail():
        raise ValueError("no")

    steps = [("clean", lambda: ran.append("clean")), ("validate", fail),
             ("store", lambda: ran.append("store"))]
    with pytest.raises(ValueError):
        run_steps(steps)
    assert ran == ["clean"]
    assert run_steps(steps[:1]) == ["clean"]


def claims_file(spark, make_claims, path, **changes):
    import itertools

    number = itertools.count(1)
    df = make_claims(30).toPandas()
    df["policy_number"] = [next(number) for _ in range(len(df))]
    df["policy_bind_date"] = "2014-01-01"
    df["age"], df["incident_hour_of_the_day"], df["umbrella_limit"] = 30, 5, -1
    df["fraud_reported"] = df["fraud_reported"].map({True: "Y", False: "N"})
    df["auto_make"], df["collision_type"], df["_c39"] = "Suburu", "?", None
    df = df.assign(**changes)
    df.to_csv(path, index=False)
    return str(path)


def test_the_whole_run(spark, make_claims, tmp_path, database):
    source = claims_file(spark, make_claims, tmp_path / "claims.csv")
    run = ClaimsRun(spark, source, str(tmp_path / "out"), database)
    assert run.run() == ["clean", "validate", "store", "analyze", "report", "export"]
    stored = spark.table(f"{database}.claims")
    assert all(run.run_id in path for path in stored.inputFiles())  # not copied
    row = stored.first()
    assert stored.count() == 90 and "c39" not in stored.columns
    assert (row.auto_make, row.collision_type) == ("Subaru", "Not Applicable")
    reports = {p.name for p in (tmp_path / "out" / "reports").iterdir()}
    assert {"validation_claims.csv", "analysis_claims_by_state.csv", "headlines.csv"} <= reports
    exported = {p.name for p in (tmp_path / "out" / "export").iterdir()}
    assert exported == {
        "claims_clean.csv", "claims_by_state.csv", "claims_by_week.csv",
        "fraud_by_incident_type.csv", "fraud_by_severity.csv",
    }
    headline = text_of(tmp_path / "out" / "reports" / "headlines.csv")
    assert any("1 warning checks flagged" in line for line in headline)


def test_an_error_stops_before_the_store(spark, make_claims, tmp_path, database):
    source = claims_file(spark, make_claims, tmp_path / "claims.csv", age=12)
    run = ClaimsRun(spark, source, str(tmp_path / "out"), database)
    with pytest.raises(ValueError, match="age 16-100"):
        run.run()
    assert not spark.catalog.tableExists(f"{database}.claims")
    assert not (tmp_path / "out" / "export").exists()
    with pytest.raises(ValueError):
        run.store()  # the gate holds for a step run alone, too


def test_a_domain_of_its_own(spark):
    plants = replace(
        CLAIMS, table="plants", id_col="id", fills={"kind": "tree"}, fixes={},
        rules={"height": (rules.ERROR, rules.between("height", 0, 100))},
    )
    df = spark.createDataFrame([(1, None, 5), (2, "bush", 500)], "Id long, Kind string, Height int")
    clean = plants.clean(df)
    assert {r.kind for r in clean.collect()} == {"tree", "bush"}
    assert plants.validate(clean).first().failed_index == [2]


def test_write_raw_keeps_spaces(spark, tmp_path):
    write_raw(spark.createDataFrame([(" a ",)], "x string"), str(tmp_path / "r"))
    assert text_of(tmp_path / "r") == ["x", " a "]


def test_publish_refuses_claims_without_a_state(make_claims, tmp_path):
    claims = make_claims(20)
    lost = claims.withColumn("incident_state", F.when(F.col("incident_type") == "Hail", "TX"))
    with pytest.raises(ValueError, match="all claims counted: 20 rows"):
        publish.publish_summaries(lost, {}, str(tmp_path / "p"))
    assert not (tmp_path / "p").exists()


def test_a_store_that_dies_before_the_switch_changes_nothing(spark, database, monkeypatch):
    tables.store_tables(spark, {"t": spark.range(3)}, database)

    def die(*args):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(tables, "store_snapshot", die)
    with pytest.raises(RuntimeError):
        tables.store_tables(spark, {"t": spark.range(5)}, database)
    assert spark.table(f"{database}.t").count() == 3


def test_two_runs_and_late_steps_in_one_session(spark, make_claims, tmp_path):
    """Without a database too; report and export alone find what they need."""
    source = claims_file(spark, make_claims, tmp_path / "claims.csv")
    first = ClaimsRun(spark, source, str(tmp_path / "one"))
    second = ClaimsRun(spark, source, str(tmp_path / "two"))
    try:
        assert len(first.run()) == len(second.run()) == 6
        late = ClaimsRun(spark, source, str(tmp_path / "three"))
        late.write_report()
        late.export()
        for part in ("export/claims_by_week.csv", "reports/headlines.csv"):
            assert text_of(tmp_path / "three" / part) == text_of(tmp_path / "two" / part)
    finally:
        for name in ("claims", "validation_report"):
            spark.sql(f"DROP VIEW IF EXISTS {name}")


def test_settled_results_stay_sorted(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).orderBy(F.desc("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = settle_ordered(df, "sorted")
        assert [r.x for r in kept.collect()] == list(range(999, -1, -1))
        assert kept.columns == ["x"]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_small_tables_need_no_shuffle(spark, monkeypatch):
    """Up to the limit in bytes one task reads a table, a larger one stays as it is."""
    from sieveframe.sources import scratch

    df = spark.range(0, 1000, 1, 4).select((F.col("id") % 7).alias("k"))

    def grouped():
        table = settle_small(df, "groups").groupBy("k").count().orderBy("k")
        return [tuple(r) for r in table.collect()], table._jdf.queryExecution().toString()

    small, plan = grouped()
    assert "Exchange" not in plan
    monkeypatch.setattr(scratch, "_SMALL", 10)
    large, plan = grouped()
    assert "Exchange" in plan
    assert small == large == [(k, 143 if k < 6 else 142) for k in range(7)]
    assert settle_small(df.limit(0), "none").groupBy("k").count().collect() == []


def test_scratch_of_a_block_is_removed(spark):
    from pathlib import Path

    outside = settle(spark.range(2))
    with scratch_removed(spark):
        path = settle(spark.range(3)).inputFiles()[0]
        assert Path(path.removeprefix("file://")).exists()
    assert not Path(path.removeprefix("file://")).exists() and outside.count() == 2


def test_settled_tables_leave_no_shuffle_files(spark, shuffle_files):
    """Neither those of earlier steps nor the session's own setting are touched."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    mine = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    mine.collect()
    was, before = spark.conf.get(setting, None), shuffle_files()
    settled = settle(mine.join(mine.select("k"), "k"), "sevens")
    assert not shuffle_files(unlike=before)
    assert spark.conf.get(setting, None) == was
    assert sum(r["count"] for r in settled.collect()) == 1000
    assert sum(r["count"] for r in mine.collect()) == 1000
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        settle(mine.select(F.expr("1 div (k - k)")), "none")
    assert spark.conf.get(setting, None) == was
