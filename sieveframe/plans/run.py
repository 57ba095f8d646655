"""The whole way of a claims file: one application, stopped by the first failure."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from sieveframe.operators.rules import raise_on_errors
from sieveframe.plans.analysis import run_queries
from sieveframe.plans.claims import CLAIMS
from sieveframe.plans.domain import Domain
from sieveframe.plans.publish import export_all
from sieveframe.plans.report import headlines, report_facts, section_tables
from sieveframe.session import build_session
from sieveframe.sources.exports import export_csvs, save_report, save_results
from sieveframe.sources.scratch import scratch_removed, settle_ordered
from sieveframe.sources.tables import (
    read_snapshot,
    save_snapshot,
    store_snapshot,
    store_tables,
)

Step = tuple[str, Callable[[], object]]


def run_steps(steps: Iterable[Step]) -> list[str]:
    """Run the steps in order; an exception stops everything after it."""
    done = []
    for name, step in steps:
        step()
        done.append(name)
    return done


@dataclass
class ClaimsRun:
    """Clean, validate, store, analyze, report, export.

    The file is read into a snapshot once, in a folder of its own per run. When
    it has passed the rules, the table is pointed at these files; the rows are
    not written again. The queries run once for report and export. Report and export
    also run alone, in a later session: they take the rows from the store and run the
    queries themselves. Clean, validate and store are given the ``run_id`` they share.
    Intermediate tables are removed at the end of ``run``.
    """

    spark: SparkSession
    source: str
    out: str
    database: str | None = None
    domain: Domain = CLAIMS
    multi_line: bool = False
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    results: dict[str, DataFrame] | None = None
    report: DataFrame | None = None

    def steps(self) -> list[Step]:
        return [
            ("clean", self.clean),
            ("validate", self.validate),
            ("store", self.store),
            ("analyze", self.analyze),
            ("report", self.write_report),
            ("export", self.export),
        ]

    def run(self) -> list[str]:
        with scratch_removed(self.spark):
            try:
                return run_steps(self.steps())
            finally:
                self.results = None

    def clean(self) -> None:
        df = self.domain.load_clean(self.spark, self.source, self.multi_line)
        save_snapshot(df, self.domain.table, self._folder(f"processed/{self.run_id}"))

    def validate(self) -> None:
        self.report = self.domain.validate(self._snapshot())
        save_report(self.report, self.domain.table, self._folder("reports"))
        raise_on_errors(self.report)

    def store(self) -> None:
        if self.report is None:
            self.report = self.domain.validate(self._snapshot())
        raise_on_errors(self.report)
        store_snapshot(self.spark, self.domain.table, self.snapshot, self.database)
        store_tables(self.spark, {"validation_report": self.report}, self.database)

    def analyze(self) -> None:
        save_results(self._results(), self._folder("reports"))

    def write_report(self) -> None:
        validation = self.report
        if validation is None:
            validation = self._table("validation_report")
        raise_on_errors(validation)
        results = self._results()
        tables = section_tables(results, validation)
        named = {f"section_{i}": df for i, df in enumerate(tables.values(), 1)}
        lines = headlines(report_facts(results, validation))
        export_csvs({"headlines": lines, **named}, self._folder("reports"))

    def export(self) -> None:
        rows = self._table(self.domain.table)
        export_all(rows, self._results(), self._folder("export"))

    def _results(self) -> dict[str, DataFrame]:
        """The query results, written once for all steps of this object."""
        if self.results is None:
            rows = self._table(self.domain.table)
            tables = {self.domain.table: rows}
            lazy = run_queries(self.spark, self.domain.queries, tables)
            self.results = {n: settle_ordered(df, n) for n, df in lazy.items()}
        return self.results

    def _folder(self, name: str) -> str:
        return f"{self.out.rstrip('/')}/{name}"

    @property
    def snapshot(self) -> str:
        return f"{self._folder('processed')}/{self.run_id}/{self.domain.table}.parquet"

    def _snapshot(self) -> DataFrame:
        return read_snapshot(self.spark, self.snapshot)

    def _table(self, name: str) -> DataFrame:
        full = f"`{self.database}`.`{name}`" if self.database else f"`{name}`"
        return self.spark.table(full)


def main(source: str, out: str, database: str | None = None) -> None:
    """python -m sieveframe.plans.run <claims file> <output folder> [database]"""
    run = ClaimsRun(build_session("claims"), source, out, database)
    with scratch_removed(run.spark):
        for name, step in run.steps():
            print(f"== {name}")
            step()


if __name__ == "__main__":
    main(*sys.argv[1:])
