"""The checks a table declares: all that look at single rows are one pass.

That pass is the write itself when ``Checks.write`` stores the table: the counts
ride along as observed metrics. Only unique keys and relationships need a look of
their own. Reports have the rows of ``quality``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quotelake.operators import quality

REPORT = "check string, `table` string, `column` string, severity string, failures bigint"


class Checks:
    """Checks of one table, declared one after the other."""

    def __init__(self, table: str):
        self.table = table
        self._rows: list[tuple[str, str, str, Column]] = []
        self._sets: list = []

    def _row(self, check: str, column: str, severity: str, failures: Column) -> Checks:
        self._rows.append((check, column, severity, failures))
        return self

    def not_null(self, *columns: str, severity: str = "error") -> Checks:
        for name in columns:
            self._row("not_null", name, severity, F.count_if(F.col(name).isNull()))
        return self

    def accepted(self, column: str, values: Sequence[str], severity: str = "error") -> Checks:
        """Null is no value, so it passes."""
        unknown = F.count_if(~F.col(column).isin(*values))
        return self._row("accepted_values", column, severity, unknown)

    def holds(self, column: str, expression: Column, severity: str = "error") -> Checks:
        """Unknown counts as passed."""
        return self._row("expression_is_true", column, severity, F.count_if(~expression))

    def at_least(self, rows: int, severity: str = "error") -> Checks:
        missing = F.greatest(F.lit(rows) - F.count(F.lit(1)), F.lit(0))
        return self._row("minimum_rows", "rows", severity, missing)

    def unique(self, *keys: str, severity: str = "error") -> Checks:
        self._sets.append(lambda df: quality.unique(df, self.table, keys, severity))
        return self

    def related(
        self, column: str, parent: DataFrame, parent_key: str, severity: str = "error"
    ) -> Checks:
        self._sets.append(
            lambda df: quality.relationships(df, self.table, column, parent, parent_key, severity)
        )
        return self

    def _metrics(self) -> list[Column]:
        return [
            F.coalesce(failures, F.lit(0)).cast("bigint").alias(f"m{i}")
            for i, (*_, failures) in enumerate(self._rows)
        ]

    def report(self, df: DataFrame) -> DataFrame:
        """The checks of a table that is there already."""
        parts = [check(df) for check in self._sets]
        if self._rows:
            found = F.array(
                *[
                    F.struct(
                        F.lit(check).alias("check"),
                        F.lit(self.table).alias("table"),
                        F.lit(column).alias("column"),
                        F.lit(severity).alias("severity"),
                        F.col(f"m{i}").alias("failures"),
                    )
                    for i, (check, column, severity, _) in enumerate(self._rows)
                ]
            )
            parts.insert(0, df.agg(*self._metrics()).select(F.inline(found)))
        return quality.combine(*parts)

    def write(self, df: DataFrame, path: str) -> DataFrame:
        """Store the table and give the report; its rows are read once, while written.

        The metrics belong to the tasks that write, whose results count once.
        """
        spark, seen = df.sparkSession, Observation(f"checks of {self.table}")
        observed = df.observe(seen, *self._metrics()) if self._rows else df
        observed.write.mode("overwrite").parquet(path)
        stored = spark.read.schema(df.schema).parquet(path)
        parts = [check(stored) for check in self._sets]
        if self._rows:
            counts = seen.get
            rows = [
                (check, self.table, column, severity, counts[f"m{i}"])
                for i, (check, column, severity, _) in enumerate(self._rows)
            ]
            parts.insert(0, spark.createDataFrame(rows, REPORT))
        return quality.combine(*parts)
