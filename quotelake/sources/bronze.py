"""Bronze rows: CSV rows kept as one VARIANT per row, with where and when they came from."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.sources.files import FILE_NAME, symbol_of

INGEST_SYMBOL = "_ingest_symbol"


def envelope(
    rows: DataFrame, file_name: Column, batch_ts: datetime | Column, symbol: Column | None = None
) -> DataFrame:
    """(file_name, load_ts, raw): the row as one object, null where a cell is missing."""
    cells = [F.col(f"`{c}`") for c in rows.columns if c != FILE_NAME]
    if symbol is not None:
        cells.append(symbol.alias(INGEST_SYMBOL))
    stamp = batch_ts if isinstance(batch_ts, Column) else F.lit(batch_ts)
    return rows.select(
        file_name.alias(FILE_NAME),
        stamp.cast("timestamp").alias("load_ts"),
        F.to_variant_object(F.struct(*cells)).alias("raw"),
    )


def _member(name: str) -> Column:
    """A member of the raw object as text; a name may hold any signs."""
    path = f"$['{name}']" if "." in name or "[" in name else f"$.{name}"
    return F.try_variant_get("raw", path, "string")


def members(
    rows: DataFrame, names: Sequence[str], keep: Sequence[str] = (), also: dict[str, str] | None = None
) -> DataFrame:
    """Members of the raw object as text columns, null when absent.

    The caller casts the text. ``also`` names a second spelling of a member, read
    where the first is missing. Each member is looked up by its name: building an
    object of all of them in between costs several times as much, more than a
    filter that Spark moves down to the object and that looks its member up again.
    """
    second = also or {}
    return rows.select(
        *keep,
        *[
            (
                F.coalesce(_member(name), _member(second[name]))
                if name in second
                else _member(name)
            ).alias(name)
            for name in names
        ],
    )


def real_symbols(price_files: DataFrame, finance_files: DataFrame) -> DataFrame:
    """Distinct symbols that have a price file or a statement file."""
    prices = price_files.select(symbol_of(F.col(FILE_NAME)).alias("symbol")).distinct()
    statements = finance_files.select(
        symbol_of(F.col(FILE_NAME), "_finance.csv").alias("symbol")
    ).distinct()
    return prices.unionByName(statements).distinct()


def companies_with_data(companies: DataFrame, symbols: DataFrame) -> DataFrame:
    """Companies whose symbol has data; the symbol column is found in any case."""
    column = next((c for c in companies.columns if c.lower() == "symbol"), None)
    if column is None:
        raise ValueError(f"no symbol column among {companies.columns}")
    known = symbols.select(F.col("symbol").alias("_real"))
    return companies.join(
        known, F.upper(F.trim(F.col(f"`{column}`"))) == F.col("_real"), "left_semi"
    )
