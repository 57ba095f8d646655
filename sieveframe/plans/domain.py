"""What one industry adds to the generic steps."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from sieveframe.operators import cleaning, rules
from sieveframe.sources import csv_files


@dataclass(frozen=True)
class Domain:
    """Fills, value fixes, rules and the query folder of one kind of table."""

    table: str
    id_col: str
    rules: Mapping[str, rules.Rule]
    queries: Path
    fills: Mapping[str, object] = field(default_factory=dict)
    fixes: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    sensitive: frozenset[str] = frozenset()

    def clean(self, df: DataFrame) -> DataFrame:
        """Generic cleaning, then value fixes (which may leave new copies)."""
        return cleaning.replace_values(cleaning.clean(df, self.fills), self.fixes)

    def load_clean(
        self, spark: SparkSession, path: str, multi_line: bool = False
    ) -> DataFrame:
        """The same straight from a CSV file, with one look at it."""
        df = csv_files.load_clean(spark, path, self.fills, multi_line)
        return cleaning.replace_values(df, self.fixes)

    def validate(self, df: DataFrame) -> DataFrame:
        return rules.validate(df, self.rules, self.id_col)
