"""Bronze ingest as a file stream: the checkpoint is the ledger, one pass over the files.

Spark's file source lists a folder, hands new files to a batch and notes them in
the checkpoint, so no list of files or names is kept here. A batch is written to
its own folder, which a repeated batch replaces. Files may differ in their columns:
cells are read by position, and each file's header line, which comes first, names
the cells that follow it in the same task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.sources.bronze import INGEST_SYMBOL
from quotelake.sources.files import FILE_NAME, column_names, symbol_of

WIDTH = 32  # cells a line may have; the reader's work grows with it
BATCH = "batch_id"
BRONZE = f"{FILE_NAME} string, load_ts timestamp, raw variant, {BATCH} bigint"
LARGE_FILE = 64 << 20  # bytes from which a file is worth several tasks
_NOT_PLAIN = r'["\r\x00]|^[\x00-\x20]+$'
FOREVER = "36500d"  # a file that comes late with an old time is new all the same


def _positional(width: int) -> str:
    # The last column is never read. A reader that leaves a column out pads short lines
    # itself; else every cell that a line lacks is an exception of its own.
    return ", ".join(f"c{i} string" for i in range(width + 2))


def _with_header(source):
    """Rows (file, cells) to (file, names, cells): a file's first row names the others."""
    current, names, n = None, pa.array([], pa.string()), 0
    for batch in source:
        files, cells = batch.columns
        # A file is read by one task in order, so its rows are neighbours.
        same = pa.compute.equal(files.slice(1), files.slice(0, len(files) - 1))
        starts = [0, *(np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1)]
        for first, last in zip(starts, [*starts[1:], len(files)]):
            if first == last:
                continue
            name = files[first].as_py()
            if name != current:
                header = cells[first].as_py()
                if header[-1] is not None:
                    raise ValueError(f"{name} has more than {len(header) - 1} columns")
                while header and header[-1] is None:
                    header.pop()
                current, names = name, pa.array(column_names(header), pa.string())
                n, first = len(names), first + 1
            if first < last and n:
                size = last - first
                offsets = pa.array(np.arange(0, (size + 1) * n, n, dtype=np.int32))
                repeated = names.take(pa.array(np.tile(np.arange(n), size)))
                yield pa.RecordBatch.from_arrays(
                    [
                        files.slice(first, size),
                        pa.ListArray.from_arrays(offsets, repeated),
                        cells.slice(first, size),
                    ],
                    [FILE_NAME, "names", "cells"],
                )


def named_cells(lines: DataFrame, width: int = WIDTH) -> DataFrame:
    """(file_name, cells) with a map of the cells by their column, null where empty."""
    positions = lines.select(
        F.col("_metadata.file_path").alias(FILE_NAME),
        F.array(*[f"c{i}" for i in range(width + 1)]).alias("cells"),
    )
    headed = positions.mapInArrow(
        _with_header, f"{FILE_NAME} string, names array<string>, cells array<string>"
    )
    cells = F.slice("cells", F.lit(1), F.size("names"))
    return headed.select(FILE_NAME, F.map_from_arrays("names", cells).alias("cells"))


def _layout(reader, glob: str, width: int):
    """Cells by position; a file is one task's work, so quoted cells may hold line breaks.

    One column too many is declared, which has to be dropped.
    """
    return (
        reader.schema(_positional(width))
        .option("header", False)
        .option("multiLine", True)
        .option("columnPruning", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
    )


def csv_lines(
    spark: SparkSession,
    folder: str,
    modified_after: datetime | None = None,
    glob: str = "*.csv",
    width: int = WIDTH,
) -> DataFrame:
    """The lines of the CSV files below a folder, for ``named_cells``."""
    reader = _layout(spark.read, glob, width)
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after.strftime("%Y-%m-%dT%H:%M:%S"))
    return reader.csv(folder).drop(f"c{width + 1}")


def _plain_files(lines: DataFrame, large: DataFrame) -> dict[str, list[str]]:
    """Header line to the names of those large files that may be read in pieces.

    Such a file has no quotes, so no cell holds a line break, and nothing else that
    a reader of pieces takes in another way: lone carriage returns and lines of blanks.
    Only files of more than ``LARGE_FILE`` bytes are listed, so their names are few.
    """
    names = [r[FILE_NAME] for r in large.select(FILE_NAME).collect()]
    if not names:
        return {}
    text = lines.filter(F.col("_metadata.file_path").isin(names)).select(
        F.col("_metadata.file_path").alias(FILE_NAME),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    first = F.min_by("value", F.when((F.col("start") == 0) & (F.col("value") != ""), F.col("line")))
    found = text.groupBy(FILE_NAME).agg(
        first.alias("header"), F.max(F.col("value").rlike(_NOT_PLAIN)).alias("odd")
    )
    plain: dict[str, list[str]] = {}
    for row in found.filter(~F.col("odd") & F.col("header").isNotNull()).collect():
        plain.setdefault(row["header"], []).append(row[FILE_NAME])
    return plain


def file_cells(
    spark: SparkSession,
    folder: str,
    modified_after: datetime | None = None,
    glob: str = "*.csv",
    width: int = WIDTH,
) -> DataFrame:
    """(file_name, cells) of the CSV files below a folder, as ``named_cells`` gives them.

    A large file without quotes is read in pieces by several tasks, any other by one.
    """
    options = {"recursiveFileLookup": True, "pathGlobFilter": glob}
    if modified_after is not None:
        options["modifiedAfter"] = modified_after.strftime("%Y-%m-%dT%H:%M:%S")
    listed = spark.read.format("binaryFile").options(**options).load(folder)
    large = listed.filter(F.col("length") > LARGE_FILE).select(
        F.col("_metadata.file_path").alias(FILE_NAME)
    )
    text = spark.read.options(lineSep="\n", **options).text(folder)
    whole = csv_lines(spark, folder, modified_after, glob, width)
    plain = _plain_files(text, large)
    path = F.col("_metadata.file_path")
    done = [name for names in plain.values() for name in names]
    rows = named_cells(whole.filter(~path.isin(done)) if done else whole, width)
    for header, names in plain.items():
        cells = [c or None for c in header.split(",")][: width + 1]
        if len(cells) > width and cells[-1] is not None:
            raise ValueError(f"{names[0]} has more than {width} columns")
        while cells and cells[-1] is None:
            cells.pop()
        if not cells:
            continue
        columns = [f"c{i}" for i in range(len(cells))]
        pieces = (
            spark.read.schema(", ".join(f"{c} string" for c in columns))
            .options(header=True, lineSep="\n", **options)
            .csv(folder)
        )
        keys = F.array(*[F.lit(c) for c in column_names(cells)])
        rows = rows.unionByName(
            pieces.filter(path.isin(names)).select(
                path.alias(FILE_NAME), F.map_from_arrays(keys, F.array(*columns)).alias("cells")
            )
        )
    return rows


def csv_stream(
    spark: SparkSession,
    folder: str,
    glob: str = "*.csv",
    files_per_batch: int | None = None,
    width: int = WIDTH,
) -> DataFrame:
    """The CSV files below a folder as a stream of (file_name, cells).

    A file with more than ``width`` columns stops the stream.
    """
    reader = _layout(spark.readStream, glob, width).option("maxFileAge", FOREVER)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return named_cells(reader.csv(folder).drop(f"c{width + 1}"), width)


def cell(cells: Column, name: str) -> Column:
    """The cell of a column, by its name or else by its name in any case."""
    alike = F.filter(F.map_entries(cells), lambda e: F.lower(e["key"]) == name.lower())
    return F.coalesce(F.try_element_at(cells, F.lit(name)), F.get(alike, 0)["value"])


def bronze_rows(
    rows: DataFrame, batch_ts: datetime | Column, suffix: str | None = ".csv"
) -> DataFrame:
    """(file_name, load_ts, raw); with a suffix the object also has the file's symbol."""
    cells = F.col("cells")
    if suffix is not None:
        own = F.create_map(F.lit(INGEST_SYMBOL), symbol_of(F.col(FILE_NAME), suffix))
        cells = F.map_concat(F.map_filter(cells, lambda k, _: k != INGEST_SYMBOL), own)
    stamp = batch_ts if isinstance(batch_ts, Column) else F.lit(batch_ts)
    return rows.select(
        FILE_NAME, stamp.cast("timestamp").alias("load_ts"), F.to_variant_object(cells).alias("raw")
    )


def with_known_symbol(rows: DataFrame, symbols: DataFrame) -> DataFrame:
    """Rows whose symbol cell, trimmed and in upper case, is one of the symbols."""
    known = symbols.select(F.col("symbol").alias("_real"))
    return rows.join(
        known, F.upper(F.trim(cell(F.col("cells"), "symbol"))) == F.col("_real"), "left_semi"
    )


def bronze_sink(
    table: str, shape: Callable[[DataFrame], DataFrame]
) -> Callable[[DataFrame, int], None]:
    """A batch writer: each batch is a folder of the table, replaced when repeated."""

    def write(batch: DataFrame, batch_id: int) -> None:
        shape(batch).write.mode("overwrite").parquet(f"{table.rstrip('/')}/{BATCH}={batch_id}")

    return write


def read_bronze(spark: SparkSession, table: str) -> DataFrame:
    """The rows of all batches: (file_name, load_ts, raw, batch_id)."""
    return spark.read.schema(BRONZE).parquet(table)


def _remove(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def ingest(
    spark: SparkSession,
    folder: str,
    table: str,
    ledger: str,
    batch_ts: datetime,
    suffix: str | None = ".csv",
    symbols: DataFrame | None = None,
    full_refresh: bool = False,
    files_per_batch: int | None = None,
    width: int = WIDTH,
) -> list[int]:
    """Load the CSV files that are new since the last run, and stop; gives its batches.

    ``ledger`` is the checkpoint folder of this table. A run that broke off is
    taken up where it stopped; the batch it was in is written anew. With
    ``full_refresh`` table and ledger start over. With ``symbols`` (S-8) only rows
    whose symbol cell is among them are kept, and files do not name a symbol.
    """
    if full_refresh:
        # The table first: if the run breaks off here, the ledger goes next time.
        _remove(spark, table)
        _remove(spark, ledger)

    batches: list[int] = []

    def shape(batch: DataFrame) -> DataFrame:
        if symbols is not None:
            return bronze_rows(with_known_symbol(batch, symbols), batch_ts, None)
        return bronze_rows(batch, batch_ts, suffix)

    write = bronze_sink(table, shape)

    def store(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        batches.append(batch_id)

    stream = (
        csv_stream(spark, folder, files_per_batch=files_per_batch, width=width)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", ledger)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return batches


def _plain(path: Column) -> Column:
    """A file's name with one slash after its scheme: readers and ledger differ there."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def noted_files(spark: SparkSession, ledger: str) -> DataFrame:
    """(file_name, batch_id) of all files the ledger has noted, also those of no bytes.

    The file source notes a file as a line of JSON; a compacted note repeats older ones.
    """
    entry = F.from_json("value", "path string, batchId bigint")
    lines = spark.read.text(f"{ledger.rstrip('/')}/sources/0").filter(F.startswith("value", F.lit("{")))
    return (
        lines.select(entry.alias("e"))
        .groupBy(_plain(F.col("e.path")).alias(FILE_NAME))
        .agg(F.min("e.batchId").alias(BATCH))
    )


def load_status(
    spark: SparkSession, table: str, ledger: str, batches: Sequence[int]
) -> DataFrame:
    """(status, files) as a run saw them that wrote these batches.

    Skipped files were noted by another run; of the others those that gave rows
    are processed and the rest is empty: of no bytes, or with nothing below the
    header, or with no row that was kept.
    """
    noted = noted_files(spark, ledger)
    loaded = read_bronze(spark, table).select(_plain(F.col(FILE_NAME)).alias(FILE_NAME))
    filled = loaded.distinct().withColumn("_filled", F.lit(True))
    status = (
        F.when(~F.col(BATCH).isin(*batches) if batches else F.lit(True), "skipped")
        .when(F.col("_filled"), "processed")
        .otherwise("empty")
    )
    return (
        noted.join(filled, FILE_NAME, "left")
        .groupBy(status.alias("status"))
        .agg(F.count("*").alias("files"))
    )
