"""Sharding by extendible hashing.

A row's address is a string of hash bits. A bucket is a prefix of addresses; it
splits on the next bit only when its bytes exceed the limit, so the directory is
deep only where buckets are full. Depths are found from sizes of prefixes,
``STEP`` bits at a time: rows of settled buckets drop out, the rest goes deeper.
Rows whose key alone exceeds the limit go on with the bits of a hash of their
row number, so a hot key is spread over as many shards as it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import staged

BITS = 60
STEP = 12


def address(key: Column) -> Column:
    """60 hash bits of a key as a long; a null key counts as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _leaves(levels: DataFrame, top: int, bottom: int, limit: int) -> DataFrame:
    """Settled buckets among prefixes of ``top`` to ``bottom`` bits with their sizes.

    A bucket exists at the top, or below a parent that was too large; it is
    settled when it fits or holds one row.
    """
    parents = levels.where((F.col("bytes") > limit) & (F.col("rows") > 1)).select(
        "base", (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up")
    )
    inner = levels.where(F.col("depth") > top).withColumn("up", F.expr("shiftright(prefix, 1)"))
    made = inner.join(parents, ["base", "depth", "up"], "left_semi").drop("up")
    made = made.unionByName(levels.where(F.col("depth") == top))
    return made.where((F.col("bytes") <= limit) | (F.col("rows") == 1))


def _descend(rows: DataFrame, limit: int) -> tuple[list[DataFrame], DataFrame | None]:
    """Placed rows per step, and the rows that all bits of ``h`` could not place."""
    placed, top = [], 0
    while top < BITS:
        bottom = min(top + STEP, BITS)
        celled = rows.withColumn("cell", F.expr(f"shiftright(h, {BITS - bottom})"))
        cells = celled.groupBy("base", "cell").agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("rows")
        )
        cells = staged(cells, "cells")
        above = cells.select(
            "*", F.explode(F.sequence(F.lit(top), F.lit(bottom))).alias("depth")
        ).withColumn("prefix", F.expr(f"shiftright(cell, {bottom} - depth)"))
        levels = above.groupBy("base", "depth", "prefix").agg(
            F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")
        )
        leaves = _leaves(staged(levels, "levels"), top, bottom, limit).select(
            "base",
            "depth",
            "prefix",
            F.col("bytes").alias("shard_bytes"),
            F.col("rows").alias("shard_rows"),
        )
        # The directory: which bucket each cell in use points at (null: goes deeper).
        entries = cells.select("base", "cell").join(
            above.select("base", "cell", "depth", "prefix").join(
                leaves, ["base", "depth", "prefix"]
            ),
            ["base", "cell"],
            "left",
        )
        entries = staged(entries, "directory")
        looked = celled.join(entries, ["base", "cell"]).drop("cell")
        placed.append(looked.where(F.col("prefix").isNotNull()))
        if entries.where(F.col("prefix").isNull()).isEmpty():
            return placed, None
        rows = looked.where(F.col("prefix").isNull()).select(*rows.columns)
        top = bottom
    return placed, rows


def assign_shards(docs: DataFrame, limit: int) -> DataFrame:
    """(doc_id, bytes, shard, depth, shard_bytes, shard_rows, fits) of every row.

    ``shard`` is the bucket's prefix in bits ("" when all fits one shard). Rows of
    one doc_id share a shard unless they exceed the limit together; then their
    own bits follow after a colon. Only a single row above the limit does not fit. A null text
    has 0 bytes; a null doc_id is a key like others; other columns are not read;
    an empty table gives no rows.
    """
    rows = staged(
        docs.select(
            "doc_id",
            F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
            F.lit("").alias("base"),
            address(F.col("doc_id")).alias("h"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )
    placed, rest = _descend(rows, limit)
    if rest is not None:  # every bit of the key is used: on with the row's own bits
        own = rest.withColumn("base", F.concat(F.lpad(F.bin("h"), BITS, "0"), F.lit(":")))
        more, left = _descend(own.withColumn("h", address(F.col("row"))), limit)
        placed += more
        if left is not None:
            raise ValueError("rows with equal addresses of 120 bits")
    found = placed[0]
    for part in placed[1:]:
        found = found.unionByName(part)
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(
        F.lpad(F.bin("prefix"), F.col("depth"), F.lit("0"))
    )
    return found.select(
        "doc_id",
        "bytes",
        F.concat("base", bits).alias("shard"),
        F.col("depth").cast("int").alias("depth"),
        "shard_bytes",
        "shard_rows",
        (F.col("shard_bytes") <= limit).alias("fits"),
    )


def write_shards(docs: DataFrame, limit: int, path: str) -> None:
    """Write documents as one folder per shard; doc_id has to be a key here."""
    shards = assign_shards(docs, limit).select("doc_id", "shard")
    docs.join(shards, "doc_id").write.partitionBy("shard").parquet(path)
