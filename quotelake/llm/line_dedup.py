"""Line dedup over levelled sorted runs of line hashes.

A batch is hashed once. Its distinct keys meet the stored runs in merge anti
joins (a run is bucketed and sorted by hash, so only the batch is shuffled), and
the keys the runs do not hold become a run of their own. When a level has
``fanout`` runs they are rewritten as one run of the next level, so a key is
rewritten once per level and a batch joins a logarithmic number of runs.

The driver keeps paths of runs only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm.common import BLANKS, free_prefix, lower_ascii, staged, staged_path

MIN_KEY = 10
LAST = 9223372036854775807  # stands for a null doc_id: after all others


def line_key(line: Column) -> Column:
    """Lines are equal when they are after trimming white space and lower-casing A-Z."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def lines_of(text: Column) -> Column:
    """A text split at every newline; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed_lines(docs: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """(d, t, pos, h1, h2) of each line long enough to count; 128 bits identify a key."""
    key = line_key(F.col("line"))
    return (
        docs.select(
            F.coalesce(F.col("doc_id"), F.lit(LAST)).alias("d"),
            F.xxhash64("text").alias("t"),
            F.posexplode(lines_of(F.col("text"))).alias("pos", "line"),
        )
        .select("d", "t", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_key)
        .select(
            "d",
            "t",
            "pos",
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit("second"), F.col("key")).alias("h2"),
        )
    )


class LineRuns:
    """The levelled store of one corpus, below the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = 2, buckets: int | None = None):
        self.spark = spark
        self.fanout = fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def add(self, lines: DataFrame) -> DataFrame:
        """Store the batch's new keys; gives (d, t, pos) of the lines to drop.

        A key that an earlier batch brought loses all its lines; a key new in
        this batch keeps those of the smallest ``d``.
        """
        fresh = lines.groupBy("h1", "h2").agg(F.min("d").alias("first"))
        for name in [run for level in self.levels for run in level]:
            fresh = fresh.join(self.spark.table(name), ["h1", "h2"], "left_anti")
        path = self._write(fresh)
        # Read as plain files, both sides are shuffled and a hot line can be split.
        kept = self.spark.read.schema(fresh.schema).parquet(path)
        return (
            lines.join(kept, ["h1", "h2"], "left")
            .where(F.col("first").isNull() | (F.col("d") > F.col("first")))
            .select("d", "t", "pos")
        )

    def _write(self, run: DataFrame, level: int = 0) -> str:
        name, path = f"line_run_{uuid.uuid4().hex}", staged_path(self.spark, "line-run")
        (
            run.write.format("parquet")
            .bucketBy(self.buckets, "h1", "h2")
            .sortBy("h1", "h2")
            .option("path", path)
            .saveAsTable(name)
        )
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged = self.spark.table(full[0])
            for other in full[1:]:  # keys of runs differ, so nothing has to be joined
                merged = merged.unionByName(self.spark.table(other))
            self._write(merged, level + 1)
            for other in full:
                self.spark.sql(f"DROP TABLE {other}")  # the entry; the files are external
        return path


def batch_bounds(docs: DataFrame, batches: int) -> list[int]:
    """Upper ends of doc_id ranges with about as many documents each."""
    steps = [i / batches for i in range(1, batches)]
    found = docs.select(F.percentile_approx("doc_id", F.array(*map(F.lit, steps)), 1000)).first()[0]
    return sorted(set(found or []))


def dropped_lines(docs: DataFrame, batches: int = 4, fanout: int = 2, min_key: int = MIN_KEY):
    """(d, t, dropped): sorted line positions to drop, for documents that lose lines.

    Documents arrive in ascending doc_id batches, so the first holder of a key is
    the smallest doc_id. A null doc_id comes after all others; rows with one
    doc_id count as one document.
    """
    spark = docs.sparkSession
    number = F.lit(0)
    for bound in batch_bounds(docs, batches):
        number = number + (F.col("d") > bound).cast("int")
    lines = staged(hashed_lines(docs, min_key).withColumn("batch", number), "lines", "batch")
    store, drops = LineRuns(spark, fanout), None
    for batch in range(batches):
        found = store.add(lines.where(F.col("batch") == batch).drop("batch"))
        drops = found if drops is None else drops.unionByName(found)
    return drops.groupBy("d", "t").agg(F.array_sort(F.collect_set("pos")).alias("dropped"))


def dedup_lines(docs: DataFrame, batches: int = 4, fanout: int = 2, min_key: int = MIN_KEY):
    """All columns of ``docs`` with ``text`` less repeated lines, and n_lines, n_dropped.

    Null or empty text: one empty line, kept; the text becomes empty. Lines whose
    key has fewer than ``min_key`` code points are never dropped. Only doc_id and
    text are read; other columns, whatever their names, pass through. An empty
    table gives an empty table.
    """
    p = free_prefix(docs.columns)
    lines, ends, dropped = F.col(f"{p}lines"), F.col(f"{p}ends"), F.col(f"{p}dropped")
    drops = dropped_lines(docs, batches, fanout, min_key).select(
        F.col("d").alias(f"{p}d"), F.col("t").alias(f"{p}t"), F.col("dropped").alias(f"{p}dropped")
    )
    joined = docs.join(
        drops,
        (F.coalesce(docs["doc_id"], F.lit(LAST)) == F.col(f"{p}d"))
        & (F.xxhash64(docs["text"]) == F.col(f"{p}t")),
        "left",
    )
    split = joined.withColumn(f"{p}lines", lines_of(F.col("text")))
    edges = split.withColumn(
        f"{p}ends", F.concat(F.array(F.lit(-1)), dropped, F.array(F.size(lines)))
    )
    # The lines between two dropped ones are a slice: linear in the lines.
    kept = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.size(dropped)),
            lambda k: F.slice(lines, F.get(ends, k) + 2, F.get(ends, k + 1) - F.get(ends, k) - 1),
        )
    )
    text = F.when(dropped.isNull(), F.coalesce(F.col("text"), F.lit(""))).otherwise(
        F.array_join(kept, "\n")
    )
    passed = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    return edges.select(
        *passed,
        text.alias("text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(dropped), F.lit(0)).cast("long").alias("n_dropped"),
    )
