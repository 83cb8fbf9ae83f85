"""Data checks. Every check gives rows (check, table, column, severity, failures)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.operators.incremental import latest_day_only
from quotelake.operators.ranges import Clock, since


class QualityError(RuntimeError):
    """A check of severity ``error`` found failures."""


def _report(counts: DataFrame, check: str, table: str, severity: str) -> DataFrame:
    """One row with a count per column, turned into one row per check."""
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(check).alias("check"),
                    F.lit(table).alias("table"),
                    F.lit(name).alias("column"),
                    F.lit(severity).alias("severity"),
                    F.coalesce(F.col(f"`{name}`"), F.lit(0)).cast("bigint").alias("failures"),
                )
                for name in counts.columns
            ]
        )
    )
    return counts.select(rows.alias("_row")).select("_row.*")


def not_null(df: DataFrame, table: str, columns: Sequence[str], severity: str = "error"):
    """Null counts of all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _report(counts, "not_null", table, severity)


def unique(df: DataFrame, table: str, keys: Sequence[str], severity: str = "error"):
    """Number of keys that occur more than once; keys with a null part do not count."""
    repeated = (
        df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    )
    name = ",".join(keys)
    return _report(repeated.agg(F.count("*").alias(name)), "unique", table, severity)


def accepted_values(
    df: DataFrame, table: str, column: str, values: Sequence[str], severity: str = "error"
):
    counts = df.agg(F.count_if(~F.col(column).isin(*values)).alias(column))
    return _report(counts, "accepted_values", table, severity)


def relationships(
    child: DataFrame,
    table: str,
    column: str,
    parent: DataFrame,
    parent_key: str,
    severity: str = "error",
):
    """Child rows whose non-null key has no parent.

    Child keys are counted first; the join then sees each key once, however
    many rows it has.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_fk"))
        .agg(F.count("*").alias("_n"))
    )
    known = parent.select(F.col(parent_key).alias("_pk"))
    orphans = keys.join(known, F.col("_fk") == F.col("_pk"), "left_anti")
    return _report(orphans.agg(F.sum("_n").alias(column)), "relationships", table, severity)


def expression_is_true(
    df: DataFrame, table: str, column: str, expression: Column, severity: str = "error"
):
    """Rows for which the expression is false; unknown counts as passed."""
    counts = df.agg(F.count_if(~expression).alias(column))
    return _report(counts, "expression_is_true", table, severity)


def ohlc_gate(prices: DataFrame, loaded_at: str, table: str = "prices"):
    """On the latest load day: rows with high below low, and rows without a close."""
    counts = latest_day_only(prices, loaded_at).agg(
        F.count_if(F.col("high") < F.col("low")).alias("high"),
        F.count_if(F.col("close").isNull()).alias("close"),
    )
    return _report(counts, "ohlc_gate", table, "error")


def load_verification(rows: DataFrame, loaded_at: str, source: Column, symbol: str) -> DataFrame:
    """Rows and symbols per source on the latest load day."""
    return (
        latest_day_only(rows, loaded_at)
        .groupBy(source.alias("source"))
        .agg(F.count("*").alias("records"), F.countDistinct(symbol).alias("symbols"))
    )


def minimum_rows(rows: DataFrame, table: str, least: int, severity: str = "error") -> DataFrame:
    """Fails by the number of rows missing to ``least``."""
    counts = rows.agg(F.greatest(F.lit(least) - F.count("*"), F.lit(0)).alias("rows"))
    return _report(counts, "minimum_rows", table, severity)


def freshness(
    rows: DataFrame, time: str, company: str, as_of: Clock, span: str = "1 hour"
) -> DataFrame:
    """Rows, companies and the newest time in the last ``span``."""
    return since(rows, time, as_of, span).agg(
        F.count("*").alias("records"),
        F.countDistinct(company).alias("companies"),
        F.max(time).alias("latest"),
    )


def freshness_check(
    rows: DataFrame, table: str, time: str, as_of: Clock, span: str = "1 hour"
) -> DataFrame:
    """One failure when nothing arrived in the last ``span``."""
    counts = since(rows, time, as_of, span).agg(
        F.when(F.count("*") == 0, 1).otherwise(0).alias(time)
    )
    return _report(counts, "freshness", table, "error")


def coverage(df: DataFrame, column: str) -> DataFrame:
    """Rows, rows with a value, and their share in percent."""
    return df.agg(
        F.count("*").alias("rows"),
        F.count(column).alias("filled"),
        F.try_divide(F.lit(100.0) * F.count(column), F.count("*")).alias("pct"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row (table_name, rows) per table."""
    merged = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        merged = one if merged is None else merged.unionByName(one)
    return merged


def combine(*reports: DataFrame) -> DataFrame:
    merged = reports[0]
    for other in reports[1:]:
        merged = merged.unionByName(other)
    return merged


def require(report: DataFrame) -> DataFrame:
    """Raise when a check of severity ``error`` failed; gives the report back."""
    failed = report.filter("failures > 0 AND severity = 'error'").collect()
    if failed:
        lines = [f"{r['check']} {r['table']}.{r['column']}: {r['failures']}" for r in failed]
        raise QualityError("; ".join(lines))
    return report
