"""File scans: all-text CSV, file ledger, recent files, routing, inventory."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Sequence
from datetime import datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.operators.latest import first_rows_per

FILE_NAME = "file_name"

# Which table a file feeds, by words in its path; first hit wins.
ROUTES = (
    (("company", "list"), "company"),
    (("price", "ohlc"), "stock_price"),
    (("financial",), "financial"),
)


def symbol_of(path: Column, suffix: str = ".csv") -> Column:
    """Symbol from a file path: last part without the suffix, trimmed, upper case."""
    last = F.element_at(F.split(path, "/"), -1)
    plain = F.url_decode(F.replace(last, F.lit("+"), F.lit("%2B")))
    return F.upper(F.trim(F.replace(plain, F.lit(suffix), F.lit(""))))


def readable_paths(names: Iterable[str]) -> list[str]:
    """File names as listed (percent-encoded) to paths a reader takes literally."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(name)) for name in names]


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """One row per file: file_name, bytes, modified. File contents are not read.

    Files of no bytes are not listed.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
        .select(
            F.col("_metadata.file_path").alias(FILE_NAME),
            F.col("length").alias("bytes"),
            F.col("modificationTime").alias("modified"),
        )
    )


def _first_lines(spark: SparkSession, paths: str | list[str], options: dict) -> DataFrame:
    """(file, header line): row ids grow along a file, so the smallest is its first line."""
    reader = spark.read.option("recursiveFileLookup", True)
    for name, value in options.items():
        reader = reader.option(name, value)
    lines = (
        reader.text(paths)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("line"),
            F.regexp_replace("value", "^\\ufeff", "").alias("value"),
        )
        .filter("start = 0")
    )
    return lines.groupBy("file").agg(F.min_by("value", "line").alias("header"))


def scan_csv_text(
    spark: SparkSession,
    paths: str | list[str],
    modified_after: datetime | None = None,
    glob: str = "*.csv",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """All CSV files as text columns plus ``file_name``; missing cells are null.

    Files are grouped by their header line, because columns may differ between
    files; each group is one scan with an explicit schema. Columns a group lacks
    are null. Empty files give no rows. With ``columns`` all files are taken to
    have that layout, which saves the pass over their first lines.
    """
    options: dict = {"pathGlobFilter": glob}
    if modified_after is not None:
        options["modifiedAfter"] = modified_after.strftime("%Y-%m-%dT%H:%M:%S")
    if columns is not None:
        return _scan_layout(spark, paths, columns, options)
    first = _first_lines(spark, paths, options)
    layouts = first.groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    merged = None
    for layout in layouts:
        if not (layout["header"] or "").strip():
            continue
        names = column_names(next(csv.reader([layout["header"]])))
        # With one layout the folder itself is scanned; else the files of the group.
        source = paths if len(layouts) == 1 else readable_paths(layout["files"])
        rows = _scan_layout(spark, source, names, options)
        merged = rows if merged is None else merged.unionByName(rows, allowMissingColumns=True)
    if merged is None:
        return spark.createDataFrame([], T.StructType([T.StructField(FILE_NAME, T.StringType())]))
    return merged


def _scan_layout(
    spark: SparkSession, paths: str | list[str], columns: Sequence[str], options: dict
) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.csv(paths).withColumn(FILE_NAME, F.col("_metadata.file_path"))


def column_names(cells: Sequence[str | None]) -> list[str]:
    """Header cells as column names; blank ones are named by position, repeated ones numbered."""
    names: list[str] = []
    for i, cell in enumerate(cells):
        name = (cell or "").lstrip("\ufeff").strip() or f"column_{i}"
        while name in names:
            name = f"{name}_{i}"
        names.append(name)
    return names


def scan_csv_typed(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV under a declared schema; cells of another type become null."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .csv(paths)
    )


def new_files(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files whose name the target does not hold yet."""
    return files.join(loaded.select(FILE_NAME).distinct(), FILE_NAME, "left_anti")


def recent_files(
    files: DataFrame, as_of: datetime, since_days: int, suffix: str = ".csv"
) -> DataFrame:
    """Files with the suffix that changed in the last ``since_days`` days."""
    cut = F.lit(as_of - timedelta(days=since_days))
    return files.filter(F.col(FILE_NAME).endswith(suffix) & (F.col("modified") > cut))


def route(path: Column) -> Column:
    """Target table by words in the path, null when none fits."""
    lowered = F.lower(path)
    target = F.lit(None).cast("string")
    for words, table in reversed(ROUTES):
        hit = F.lit(False)
        for word in words:
            hit = hit | lowered.contains(word)
        target = F.when(hit, table).otherwise(target)
    return target


def file_status(files: DataFrame, loaded: DataFrame, rows: DataFrame) -> DataFrame:
    """(status, files): skipped as already loaded, empty, or processed."""
    known = loaded.select(FILE_NAME).distinct().withColumn("_known", F.lit(True))
    filled = rows.select(FILE_NAME).distinct().withColumn("_filled", F.lit(True))
    status = (
        F.when(F.col("_known"), "skipped").when(F.col("_filled"), "processed").otherwise("empty")
    )
    return (
        files.select(FILE_NAME)
        .join(known, FILE_NAME, "left")
        .join(filled, FILE_NAME, "left")
        .groupBy(status.alias("status"))
        .agg(F.count("*").alias("files"))
    )


def inventory(files: DataFrame, root: str) -> DataFrame:
    """Files, bytes, file types and first five names per folder below ``root``."""
    below = F.regexp_replace(F.col(FILE_NAME), r"^[a-z0-9]+:/+", "/")
    below = F.substring(below, F.lit(len("/" + root.strip("/")) + 2), F.length(below))
    folder = F.regexp_extract(below, "^(.*)/[^/]*$", 1)
    name = F.element_at(F.split(below, "/"), -1)
    per_file = files.select(
        F.when(folder == "", "root").otherwise(folder).alias("prefix"),
        name.alias("name"),
        "bytes",
        F.nullif(F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)), F.lit("")).alias("ext"),
    )
    sample = (
        first_rows_per(per_file.select("prefix", "name"), ["prefix"], ["name"], 5)
        .groupBy("prefix")
        .agg(F.sort_array(F.collect_list("name")).alias("sample"))
    )
    totals = per_file.groupBy("prefix").agg(
        F.count("*").alias("files"),
        F.sum("bytes").alias("bytes"),
        F.sort_array(F.collect_set("ext")).alias("extensions"),
    )
    return totals.join(sample, "prefix")


def expected_prefixes(listing: DataFrame, expected: Sequence[str]) -> DataFrame:
    """(prefix, files, found) for every expected prefix, in one pass over the folders."""
    wanted = [p.strip("/") for p in expected]
    counts = listing.agg(
        *[
            F.coalesce(F.sum(F.when(F.startswith("prefix", F.lit(p)), F.col("files"))), F.lit(0))
            .cast("bigint")
            .alias(f"_{i}")
            for i, p in enumerate(wanted)
        ]
    )
    rows = [
        F.struct(F.lit(p).alias("prefix"), F.col(f"_{i}").alias("files"))
        for i, p in enumerate(wanted)
    ]
    return (
        counts.select(F.explode(F.array(*rows)).alias("_row"))
        .select("_row.*")
        .withColumn("found", F.col("files") > 0)
    )


def require_prefixes(status: DataFrame) -> DataFrame:
    """Raise when an expected prefix holds no files."""
    missing = [r["prefix"] for r in status.filter(~F.col("found")).collect()]
    if missing:
        raise FileNotFoundError(f"no files below: {', '.join(sorted(missing))}")
    return status
