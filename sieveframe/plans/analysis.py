"""Run a folder of SQL files against a set of tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def run_query(
    spark: SparkSession, text: str, tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """One read-only SQL statement over the named tables and the catalog.

    The text runs as a subquery, where the grammar admits nothing but a query:
    statements that create, change or drop something do not parse there. Each table
    gets a view of a private name, which is dropped as soon as the query is analysed,
    and a WITH clause gives it the name that the text uses.
    """
    body = re.sub(r"(\s|--[^\n]*(\n|$)|;)+$", "", text)
    views = {name: f"_input_{uuid.uuid4().hex}" for name in tables or {}}
    try:
        for name, view in views.items():
            tables[name].createTempView(view)
        steps = [f"`{name}` AS (SELECT * FROM `{view}`)" for name, view in views.items()]
        start = f"WITH {', '.join(steps)}\n" if steps else ""
        return spark.sql(f"{start}SELECT * FROM (\n{body}\n)")
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def run_queries(
    spark: SparkSession,
    folder: str | Path,
    tables: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Every *.sql file of a folder, sorted; results by file name, lazy."""
    return {
        path.stem: run_query(spark, path.read_text(encoding="utf-8"), tables)
        for path in sorted(Path(folder).glob("*.sql"))
    }
