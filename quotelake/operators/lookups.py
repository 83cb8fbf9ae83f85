"""Joins that attach keys and attributes, and reports of what did not match.

None of them forces a broadcast: the size of a lookup table is not known here,
so Spark decides from the measured size and splits skewed partitions otherwise.
The large side always stands left, where such a split is possible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich(facts: DataFrame, lookup: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """LEFT lookup: all facts, with the lookup's columns or null."""
    return facts.join(lookup.select(key, *columns), key, "left")


def resolve(
    rows: DataFrame, lookup: DataFrame, key: Column, lookup_key: str, value: str
) -> DataFrame:
    """INNER lookup of one id; rows without a match are dropped."""
    pairs = lookup.select(F.col(lookup_key).alias("_lookup_key"), F.col(value).alias(value))
    return rows.join(pairs, key == F.col("_lookup_key"), "inner").drop("_lookup_key")


def unmatched(rows: DataFrame, lookup: DataFrame, key: Column, lookup_key: str) -> DataFrame:
    """Rows whose non-null key is missing from the lookup."""
    known = lookup.select(F.col(lookup_key).alias("_lookup_key"))
    return rows.filter(key.isNotNull()).join(known, key == F.col("_lookup_key"), "left_anti")


def active_only(rows: DataFrame, symbols: DataFrame, key: Column, symbol: str) -> DataFrame:
    """Rows whose key is among the symbols."""
    known = symbols.select(F.col(symbol).alias("_symbol"))
    return rows.join(known, key == F.col("_symbol"), "left_semi")


def distinct_union(column: str, *frames: DataFrame) -> DataFrame:
    """Distinct values of ``column`` over several tables.

    Each table is reduced by itself first, so repeated keys do not travel.
    """
    sets = [frame.select(column).distinct() for frame in frames]
    merged = sets[0]
    for other in sets[1:]:
        merged = merged.unionByName(other)
    return merged.distinct()


def effective_join(
    members: DataFrame, prices: DataFrame, key: str, day: str, effective: str
) -> DataFrame:
    """Prices of each member from its effective day on; the key stays an equi join."""
    joined = prices.join(members.withColumnRenamed(key, "_member"), F.col(key) == F.col("_member"))
    return joined.filter(F.col(day) >= F.col(effective)).drop("_member")
