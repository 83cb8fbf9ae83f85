"""Merges, watermarks, retention, dense ids, checks."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quotelake.operators import dense_ids, incremental, latest, lookups, quality
from quotelake.plans import dimensions
from quotelake.session import scratch_path
from quotelake.sources import loaders, sinks


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_latest_breaks_ties_by_the_other_columns(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, "y"), ("a", 0, "z"), (None, 5, "n")], "k string, t int, v string"
    )
    assert rows_of(latest.latest_by(df, ["k"], ["t"])) == [("a", 1, "y"), (None, 5, "n")]
    assert rows_of(latest.earliest_by(df, ["k"], ["t"])) == [("a", 0, "z"), (None, 5, "n")]
    assert latest.latest_unordered(df, ["k"], ["t", "v"]).count() == 2


def test_merge_twice_is_merge_once(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    updates = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "id int, v string, t int")
    once = incremental.merge_upsert(target, updates, ["id"], ["t"])
    assert rows_of(once) == [(1, "a"), (2, "d"), (3, "e")]
    assert rows_of(incremental.merge_upsert(once, updates, ["id"], ["t"])) == rows_of(once)


def test_merge_columns_sets_null_and_keeps_the_rest(spark):
    target = spark.createDataFrame(
        [("a", "A", "x"), ("b", "B", "y")], "symbol string, name string, other string"
    )
    updates = spark.createDataFrame([("a", None), ("c", "C")], "symbol string, name string")
    merged = incremental.merge_columns(target, updates, "symbol", ["name"])
    assert rows_of(merged) == [("a", None, "x"), ("b", "B", "y"), ("c", "C", None)]
    only = incremental.merge_columns(target, updates, "symbol", ["name"], insert=False)
    assert rows_of(only) == [("a", None, "x"), ("b", "B", "y")]


def test_watermark_of_an_empty_target_lets_all_pass(spark):
    rows = spark.createDataFrame([(datetime(2024, 1, d),) for d in (1, 2, 3)], "t timestamp")
    assert incremental.newer_than_target(rows, rows.limit(0), "t").count() == 3
    assert incremental.newer_than_target(rows, rows.limit(0).union(rows), "t").count() == 0
    some = rows.filter("t < '2024-01-03'")
    assert incremental.newer_than_target(rows, some, "t").count() == 1


def price_table(spark, path):
    rows = spark.createDataFrame(
        [(s, date(2024, 1, d), d * 1.0) for s in "ab" for d in range(1, 6)],
        "symbol string, trade_date date, close double",
    )
    incremental.write_partitions(rows, path, "trade_date", ["symbol"])
    return rows


def test_upsert_rewrites_only_touched_partitions(spark):
    path = scratch_path(spark, "upsert")
    price_table(spark, path)
    before = {r["file_name"] for r in files_by_day(spark, path) if r["day"] != date(2024, 1, 5)}
    updates = spark.createDataFrame(
        [("a", date(2024, 1, 5), 50.0), ("c", date(2024, 1, 5), 7.0), ("a", date(2024, 1, 6), 6.0)],
        "symbol string, trade_date date, close double",
    )
    for _ in range(2):
        incremental.upsert_table(spark, path, updates, ["symbol", "trade_date"], "trade_date")
        got = spark.read.parquet(path)
        assert got.count() == 12
        assert got.filter("symbol = 'a' AND trade_date = '2024-01-05'").first()["close"] == 50.0
    after = {r["file_name"] for r in files_by_day(spark, path)}
    assert before <= after
    with pytest.raises(ValueError):
        incremental.upsert_table(spark, path, updates, ["symbol"], "trade_date")


def files_by_day(spark, path):
    return (
        spark.read.parquet(path)
        .select(F.col("_metadata.file_path").alias("file_name"), F.col("trade_date").alias("day"))
        .distinct()
        .collect()
    )


def test_archive_moves_days_once_and_keeps_late_rows(spark):
    path, archive = scratch_path(spark, "live"), scratch_path(spark, "archive")
    price_table(spark, path)
    for _ in range(2):
        incremental.archive_table(spark, path, archive, "trade_date", date(2024, 1, 5), 2)
        assert spark.read.parquet(path).count() == 6
        assert spark.read.parquet(archive).count() == 4
    late = spark.createDataFrame(
        [("z", date(2024, 1, 1), 1.0)], "symbol string, trade_date date, close double"
    )
    incremental.write_partitions(late, path, "trade_date")
    assert incremental.archive_table(spark, path, archive, "trade_date", date(2024, 1, 6), 2) == 2
    assert spark.read.parquet(archive).count() == 7
    assert spark.read.parquet(path).agg(F.min("trade_date")).first()[0] == date(2024, 1, 4)


def test_dense_ids_over_ranges(spark):
    names = spark.range(1000).select(
        F.concat(F.when(F.col("id") % 3 == 0, "Name").otherwise("é"), F.col("id")).alias("n")
    )
    numbered = {r["n"]: r["id"] for r in dense_ids.dense_ids(names, "n", "id").collect()}
    ordered = sorted(numbered, key=lambda n: n.encode())
    assert [numbered[n] for n in ordered] == list(range(1, 1001))
    assert dense_ids.dense_ids(names.limit(0), "n", "id").count() == 0


def test_upsert_keeps_rows_without_a_partition_value(spark):
    path, schema = scratch_path(spark, "upsert"), "id int, p string"
    rows = spark.createDataFrame([(1, None), (2, "x")], schema)
    incremental.write_partitions(rows, path, "p")
    for _ in range(2):
        updates = spark.createDataFrame([(3, None), (1, None)], schema)
        incremental.upsert_table(spark, path, updates, ["id", "p"], "p")
        assert rows_of(spark.read.parquet(path)) == [(1, None), (2, "x"), (3, None)]


def test_upsert_of_text_partitions_and_new_columns(spark):
    path = scratch_path(spark, "upsert")
    rows = spark.createDataFrame([(1, "01", 1.0), (2, "02", 2.0)], "id int, p string, v double")
    incremental.write_partitions(rows, path, "p")
    updates = spark.createDataFrame([(1, "01", "new")], "id int, p string, extra string")
    incremental.upsert_table(spark, path, updates, ["id", "p"], "p")
    got = spark.read.schema("id int, p string, v double, extra string").parquet(path)
    got = got.select("id", "p", "v", "extra")
    assert rows_of(got) == [(1, "01", None, "new"), (2, "02", 2.0, None)]


def test_archive_repeats_a_broken_run_without_doubling(spark):
    path, archive = scratch_path(spark, "live"), scratch_path(spark, "archive")
    price_table(spark, path)
    live = spark.read.parquet(path).count()
    with pytest.MonkeyPatch.context() as patch:  # the first run copies and then dies
        patch.setattr(
            type(spark.read.parquet(path)), "toLocalIterator", lambda *a, **k: 1 / 0
        )
        with pytest.raises(ZeroDivisionError):
            incremental.archive_table(spark, path, archive, "trade_date", date(2024, 1, 5), 2)
    assert spark.read.parquet(path).count() == live
    incremental.archive_table(spark, path, archive, "trade_date", date(2024, 1, 6), 2)
    assert spark.read.parquet(path).count() + spark.read.parquet(archive).count() == live


def test_lookups(spark):
    facts = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    known = spark.createDataFrame([("a", 10)], "k string, id int")
    assert rows_of(lookups.enrich(facts, known, "k", ["id"])) == [
        ("a", 1, 10), ("b", 2, None), (None, 3, None)
    ]
    named = facts.withColumnRenamed("k", "name")
    assert rows_of(lookups.resolve(named, known, F.col("name"), "k", "id")) == [("a", 1, 10)]
    assert rows_of(lookups.unmatched(facts, known, F.col("k"), "k")) == [("b", 2)]


def test_calendar_and_constant_dimensions(spark):
    days = dimensions.date_dimension(dimensions.day_rows(spark))
    ends = days.agg(F.min("date"), F.max("date"), F.count("*")).first()
    assert ends == (date(2000, 1, 1), date(2049, 12, 18), 18250)
    row = days.filter("date = '2025-12-05'").first()
    assert (row["day_name"], row["is_weekend"], row["fiscal_year"], row["fiscal_quarter"],
            row["season"], row["year_quarter"], row["date_id"]) == (
        "Fri", True, 2026, 3, "Winter", "2025-4", 20251205)
    assert rows_of(dimensions.currency_dimension(spark)) == [
        (1, "EGP", "Egyptian Pound", "E£", True), (2, "USD", "US Dollar", "$", True)]
    assert rows_of(dimensions.sample_first(dimensions.sample_ids(spark))) == [(1,)]
    assert loaders.index_rows(spark).count() == 3


def test_checks(spark):
    child = spark.createDataFrame(
        [(1, "A"), (1, "B"), (None, None), (9, "C")], "id int, kind string"
    )
    parent = spark.createDataFrame([(1,)], "id int")
    report = quality.combine(
        quality.not_null(child, "child", ["id", "kind"]),
        quality.unique(child, "child", ["id"]),
        quality.accepted_values(child, "child", "kind", ["A", "B"]),
        quality.relationships(child, "child", "id", parent, "id", "warn"),
        quality.expression_is_true(child, "child", "id", F.col("id") < 5),
    )
    assert [r["failures"] for r in report.collect()] == [1, 1, 1, 1, 1, 1]
    with pytest.raises(quality.QualityError, match="not_null child.id: 1"):
        quality.require(report)
    quality.require(report.filter("severity = 'warn'"))


def test_gates(spark):
    rows = spark.createDataFrame(
        [(2.0, 1.0, 1.0, datetime(2024, 1, 2, 5)), (1.0, 2.0, None, datetime(2024, 1, 2, 9)),
         (0.0, 9.0, None, datetime(2024, 1, 1))],
        "high double, low double, close double, load_ts timestamp",
    )
    assert [r["failures"] for r in quality.ohlc_gate(rows, "load_ts").collect()] == [1, 1]
    assert quality.minimum_rows(rows, "p", 100).first()["failures"] == 97
    stale = quality.freshness_check(rows, "p", "load_ts", datetime(2024, 1, 3))
    assert stale.first()["failures"] == 1


def test_company_and_price_loaders(spark):
    company = spark.createDataFrame(
        [(1, "A", "Old", None, Decimal(5))],
        "company_id int, symbol string, company_name string, sector string,"
        " market_cap decimal(20,2)",
    )
    updates = spark.createDataFrame([("A", "New"), ("B", "Bee")], "symbol string, company_name string")
    merged = loaders.upsert_companies(company, updates, ["company_name"])
    assert rows_of(merged) == [
        (1, "A", "New", "Unknown", Decimal("0.00")), (2, "B", "Bee", "Unknown", Decimal("0.00"))
    ]
    with pytest.raises(loaders.MissingColumns):
        loaders.upsert_companies(company, updates.drop("company_name"), ["symbol"])
    listed = spark.createDataFrame([(" a ",), ("zz",)], "Symbol string")
    members = loaders.load_membership(listed, company, 2, date(2024, 1, 1), loaders.EQUAL)
    assert rows_of(members.select("company_id", "weight")) == [(1, Decimal("50.0000"))]
    assert rows_of(loaders.unlisted_symbols(listed, company)) == [("ZZ",)]


def test_unreadable_prices_are_kept_apart(spark):
    company = spark.createDataFrame([(1, "A")], "company_id int, symbol string")
    rows = spark.createDataFrame(
        [
            ("A", "2024-01-02", "1.5", "2"),
            ("A", "n/a", "1.5", "2"),
            ("A", "2024-01-03", "one", "2"),
            ("A", "2024-01-04", None, "many"),
        ],
        "symbol string, trade_date string, close string, volume string",
    )
    loaded = loaders.load_prices(rows, company, datetime(2024, 1, 5))
    assert [(r["trade_date"].day, r["volume"]) for r in loaded.orderBy("trade_date").collect()] == [
        (2, 2), (4, 0)
    ]
    assert loaders.rejected_prices(rows).count() == 2


def test_a_symbol_listed_twice_is_one_member(spark):
    company = spark.createDataFrame([(1, "A")], "company_id int, symbol string")
    listed = spark.createDataFrame([("A",), (" a",)], "Symbol string")
    members = loaders.load_membership(listed, company, 2, date(2024, 1, 1), loaders.EQUAL)
    assert rows_of(members.select("company_id", "weight")) == [(1, Decimal("50.0000"))]


def test_materialize_modes(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    more = spark.createDataFrame([(2, "c", True), (3, "d", False)], "id int, v string, flag boolean")
    sinks.materialize(rows, "mat_view", sinks.VIEW)
    assert spark.table("mat_view").count() == 2
    sinks.materialize(rows, "mat_table", sinks.INCREMENTAL, ["id"])
    got = sinks.materialize(more, "mat_table", sinks.INCREMENTAL, ["id"])
    assert rows_of(got) == [(1, "a", None), (2, "c", True), (3, "d", False)]
    spark.sql("DROP TABLE mat_table")
    path = scratch_path(spark, "clustered")
    sinks.recluster(more, path, ["id"])
    assert spark.read.parquet(path).count() == 2
