"""Declared checks: one pass for rows, the same report while writing."""

import pytest
from pyspark.sql import functions as F

from quotelake.operators import declared, quality


def table(spark):
    return spark.createDataFrame(
        [(1, "A", 5), (1, "B", None), (2, None, -1), (None, "C", 0)], "id int, kind string, n int"
    )


def checks(spark):
    parent = spark.createDataFrame([(1,), (3,)], "id int")
    return (
        declared.Checks("t")
        .not_null("id", "kind")
        .accepted("kind", ["A", "B"], "warn")
        .holds("n", F.col("n") >= 0)
        .at_least(6)
        .unique("id")
        .related("id", parent, "id")
    )


EXPECTED = {
    ("not_null", "t", "id", "error", 1),
    ("not_null", "t", "kind", "error", 1),
    ("accepted_values", "t", "kind", "warn", 1),
    ("expression_is_true", "t", "n", "error", 1),
    ("minimum_rows", "t", "rows", "error", 2),
    ("unique", "t", "id", "error", 1),
    ("relationships", "t", "id", "error", 1),
}


def test_report_and_write_find_the_same(spark, tmp_path):
    rows = table(spark)
    assert {tuple(r) for r in checks(spark).report(rows).collect()} == EXPECTED
    written = checks(spark).write(rows, f"{tmp_path}/t")
    assert {tuple(r) for r in written.collect()} == EXPECTED
    assert spark.read.parquet(f"{tmp_path}/t").count() == 4
    with pytest.raises(quality.QualityError, match="minimum_rows t.rows: 2"):
        quality.require(written)


def test_checks_of_no_rows(spark, tmp_path):
    rows = table(spark).limit(0)
    for report in (checks(spark).report(rows), checks(spark).write(rows, f"{tmp_path}/t")):
        found = {(r["check"], r["column"]): r["failures"] for r in report.collect()}
        assert found.pop(("minimum_rows", "rows")) == 6
        assert set(found.values()) == {0}


def test_row_checks_are_one_scan(spark, tmp_path):
    path = f"{tmp_path}/rows"
    table(spark).write.parquet(path)
    plan = checks(spark).report(spark.read.parquet(path))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 3  # all row checks, the unique key, the relationship
