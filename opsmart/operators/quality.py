"""Declarative column tests."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import materialize


@dataclass(frozen=True)
class ColumnTest:
    column: str
    kind: str  # not_null, accepted_values, unique
    values: tuple = ()
    severity: str = "error"


def not_null(*columns: str, severity: str = "error") -> list[ColumnTest]:
    return [ColumnTest(c, "not_null", severity=severity) for c in columns]


def accepted_values(column: str, values: Sequence, severity: str = "error") -> list[ColumnTest]:
    return [ColumnTest(column, "accepted_values", tuple(values), severity)]


def unique(*columns: str, severity: str = "error") -> list[ColumnTest]:
    return [ColumnTest(c, "unique", severity=severity) for c in columns]


REPORT = "table_name string, column_name string, test string, severity string, failures bigint, passed boolean"

_FAILING = {
    "not_null": lambda t: F.col(t.column).isNull(),
    "accepted_values": lambda t: F.col(t.column).isNotNull() & ~F.col(t.column).isin(list(t.values)),
}


class Audit:
    """Column tests of a frame whose row-wise failures are counted while the frame is written.

    Write ``frame``, then ask for the ``report`` over what was written: only columns with a ``unique`` test are read again.
    """

    def __init__(self, df: DataFrame, table: str, tests: Sequence[ColumnTest]):
        self.table, self.tests, self.seen = table, list(tests), Observation()
        counts = [F.count_if(_FAILING[t.kind](t)).alias(f"f{i}") for i, t in enumerate(self.tests) if t.kind in _FAILING]
        self.frame = df.observe(self.seen, F.count(F.lit(1)).alias("rows"), *counts)

    def report(self, written: DataFrame) -> DataFrame:
        """One row per test with the number of failures.

        A ``unique`` test counts the values that occur more than once; NULL passes ``unique`` and ``accepted_values``.
        """
        counts, known, repeated = self.seen.get, [], {}
        for i, t in enumerate(self.tests):
            if t.kind == "unique":
                repeated.setdefault(t.column, []).append(t)
            else:
                known.append((self.table, t.column, t.kind, t.severity, counts[f"f{i}"], counts[f"f{i}"] == 0))
        report = written.sparkSession.createDataFrame(known, REPORT)
        for column, tests in repeated.items():
            often = written.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")
            labels = [F.struct(*(F.lit(v).alias(n) for n, v in zip(("table_name", "column_name", "test", "severity"), (self.table, t.column, t.kind, t.severity)))) for t in tests]
            found = often.agg(F.count("*").alias("failures")).select(F.explode(F.array(*labels)).alias("t"), "failures")
            report = report.unionByName(found.select("t.*", "failures", (F.col("failures") == 0).alias("passed")))
        return report


def run_tests(df: DataFrame, table: str, tests: Sequence[ColumnTest]) -> DataFrame:
    """The report over a frame that is computed once: columns with a ``unique`` test are kept, the others only counted."""
    audit = Audit(df, table, tests)
    kept = list(dict.fromkeys(t.column for t in tests if t.kind == "unique"))
    if kept:
        return audit.report(materialize(audit.frame.select(*kept)))
    audit.frame.write.format("noop").mode("overwrite").save()
    return audit.report(df)


def failed_errors(report: DataFrame) -> DataFrame:
    """Tests that must stop a run; warnings are left out."""
    return report.filter((F.col("severity") == "error") & ~F.col("passed"))
