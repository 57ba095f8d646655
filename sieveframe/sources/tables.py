"""Snapshots, stored tables, and the summaries behind a dashboard."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_snapshot(df: DataFrame, name: str, folder: str) -> str:
    """Write <folder>/<name>.parquet, replacing it; types are kept."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def store_tables(
    spark: SparkSession, tables: Mapping[str, DataFrame], database: str | None = None
) -> list[str]:
    """Create or replace each table; storing twice is like storing once.

    The rows are written to a new folder below the database's. Only then does the
    name change over, in one step of the catalog. So a table may be computed from its
    own old content, and a job that dies at any point leaves the old content in place.
    """
    stored = []
    for name, df in tables.items():
        base = spark.catalog.getDatabase(database or spark.catalog.currentDatabase())
        path = f"{base.locationUri.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        stored.append(store_snapshot(spark, name, path, database))
    return stored


def store_snapshot(
    spark: SparkSession, name: str, path: str, database: str | None = None
) -> str:
    """Let a table name stand for files that are already written.

    Nothing is copied. The name is a view over the files, because a view can be put in
    another's place in one step. The files that it showed before stay where they are,
    so give each snapshot a path of its own. If the name is that of a real table, the
    table is pointed at the files, which is one step, too. Only where that can't be, as
    with other columns, the table steps aside for the view, and comes back if there
    can't be one.
    """
    full = f"`{database}`.`{name}`" if database else f"`{name}`"
    view = f"CREATE OR REPLACE VIEW {full} AS SELECT * FROM parquet.`{path}`"
    # A temporary view of the same name is another thing.
    named = database or spark.catalog.currentDatabase()
    if not any(t.name == name.lower() and not t.isTemporary and t.tableType != "VIEW"
               for t in spark.catalog.listTables(named, name)):
        spark.sql(view)
    elif _holds(spark, f"`{named}`.`{name}`", path):
        spark.sql(f"ALTER TABLE `{named}`.`{name}` SET LOCATION '{path}'")
        spark.catalog.refreshTable(f"`{named}`.`{name}`")
    else:
        aside = f"`{named}`.`{name}_{uuid.uuid4().hex}`"
        spark.sql(f"ALTER TABLE `{named}`.`{name}` RENAME TO {aside}")
        try:
            spark.sql(view)
        except Exception:
            spark.sql(f"ALTER TABLE {aside} RENAME TO `{named}`.`{name}`")
            raise
        spark.sql(f"DROP TABLE {aside}")
    return full


def _holds(spark: SparkSession, table: str, path: str) -> bool:
    """Whether a real table is one of plain parquet files with the columns of others."""
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if about.get("Provider", "").lower() != "parquet" or "# Partition Information" in about:
        return False
    return spark.table(table).dtypes == spark.read.parquet(path).dtypes


def load_summaries(
    spark: SparkSession,
    table: str,
    summarize: Callable[[DataFrame], dict[str, DataFrame]],
    folder: str,
    schemas: Mapping[str, str],
) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """Summary tables and the rows behind them.

    From the stored table if there is one. Otherwise from published CSVs, whose
    types are given by ``schemas``; then there are no rows.
    """
    if spark.catalog.tableExists(table):
        rows = spark.table(table)
        return summarize(rows), rows
    return read_published(spark, folder, schemas), None


def read_published(
    spark: SparkSession, folder: str, schemas: Mapping[str, str]
) -> dict[str, DataFrame]:
    """Published CSV tables by name, with fixed types and no look at the data."""
    return {
        name: spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .csv(f"{folder.rstrip('/')}/{name}.csv")
        for name, schema in schemas.items()
    }


def row_count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]
