"""CSV exports: ISO dates, True/False, plain numbers, nothing for missing values.

Spark writes each table as a folder <name>.csv of part files with a header.
Nothing is gathered into one file: the parts of a large table are written by
as many tasks as there are partitions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveframe.functions.numbers import plain

_DAY = "yyyy-MM-dd"


def export_csvs(
    tables: Mapping[str, DataFrame], folder: str, prefix: str = ""
) -> list[str]:
    """Write each table as <folder>/<prefix><name>.csv, replacing it."""
    options = {
        "header": True,
        "escape": '"',
        "emptyValue": "",
        "dateFormat": _DAY,
        "timestampFormat": _DAY,
        "timestampNTZFormat": _DAY,
        # The writer would trim text otherwise.
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    paths = []
    for name, df in tables.items():
        path = f"{folder.rstrip('/')}/{prefix}{name}.csv"
        _as_cells(df).write.mode("overwrite").options(**options).csv(path)
        paths.append(path)
    return paths


def save_results(results: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Query results as analysis_<name>.csv."""
    return export_csvs(results, folder, "analysis_")


def save_report(report: DataFrame, name: str, folder: str) -> str:
    """A validation report as validation_<name>.csv; id lists read [0, 1]."""
    return export_csvs({name: report}, folder, "validation_")[0]


def _as_cells(df: DataFrame) -> DataFrame:
    return df.select(*(_cell(f).alias(f.name) for f in df.schema))


def _cell(field: T.StructField) -> Column:
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BooleanType):
        return F.when(col, "True").when(~col, "False")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        number = col.cast("double")
        endless = F.when(number == float("inf"), "inf").when(number == -float("inf"), "-inf")
        return F.when(F.isnan(number), None).otherwise(F.coalesce(endless, plain(number)))
    if isinstance(field.dataType, T.DecimalType) and field.dataType.scale:
        return plain(col.cast("double"))
    if isinstance(field.dataType, T.ArrayType):
        items = F.array_join(col.cast("array<string>"), ", ", "null")
        return F.when(
            col.isNotNull(), F.concat(F.lit("["), items, F.lit("]"))
        )
    return col
