"""Ids that continue and stay; tables loaded in batches."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quotelake import schemas
from quotelake.operators import stable_ids
from quotelake.operators.incremental import merge_columns
from quotelake.operators.stable_ids import append_batch, continue_ids, read_batches
from quotelake.sources import loaders

NOW = datetime(2024, 2, 1)
KEYED = schemas._schema("id bigint, k string, day int, v string")


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k string, day int, v string")


def test_ids_continue_without_gaps(spark):
    known = spark.createDataFrame([(7,), (3,), (None,)], "id bigint")
    many = spark.range(1000).select(F.concat(F.lit("n"), F.col("id") % 900).alias("name"))
    ids = continue_ids(many, ["name"], "id", known).orderBy("id").collect()
    assert [r.id for r in ids] == list(range(8, 1008))
    assert [r.name for r in ids] == sorted(r.name for r in ids)
    first = continue_ids(many, ["name"], "id", known.limit(0)).agg(F.min("id"), F.max("id"))
    assert tuple(first.first()) == (1, 1000)
    with pytest.raises(ValueError, match="column id already"):
        continue_ids(known, ["id"], "id", known)


def test_batches_keep_their_ids(spark, tmp_path):
    path = str(tmp_path / "table")

    def load(batch, *values):
        table = append_batch(
            path, batch, rows(spark, *values), KEYED, "id", ["k", "day"], ["k", "day"], ["v"]
        )
        assert table.schema.names == KEYED.names
        return sorted(map(tuple, table.collect()))

    first = load(1, ("b", 1, "x"), ("a", 1, "x"), ("a", 1, "y"), (None, None, "n"))
    assert first == [(1, None, None, "n"), (2, "a", 1, "y"), (3, "b", 1, "x")]
    # Known keys are left alone, null ones too; new ones go on.
    second = load(2, ("a", 1, "z"), (None, None, "m"), ("a", 0, "w"))
    assert second == [*first, (4, "a", 0, "w")]
    assert load(2, ("a", 1, "z"), (None, None, "m"), ("a", 0, "w")) == second
    assert load(3) == second
    assert load(1, ("b", 1, "x"), ("a", 1, "x"), ("a", 1, "y"), (None, None, "n")) == first
    assert read_batches(spark, path, KEYED).count() == 4


def test_loaded_tables_have_all_their_columns(spark, tmp_path):
    company = spark.createDataFrame([("A", 5), ("B", 6)], "symbol string, company_id int")
    daily = spark.createDataFrame(
        [("A", "2024-01-02", "2.5"), ("A", "2024-01-02", "2.6"), ("X", "2024-01-02", "1")],
        "symbol string, trade_date string, close string",
    )
    stored = loaders.append_prices(
        f"{tmp_path}/p", 1, daily, company, NOW, latest=["close_price"]
    )
    assert stored.schema.names == schemas.STOCK_PRICE.names
    (row,) = stored.collect()
    assert (row.price_id, row.company_id, float(row.close_price)) == (1, 5, 2.6)
    names = [f.name for f in schemas.MARKET_SNAPSHOT_CSV.fields]
    cells = [("A One", *["1"] * 9, "S", "Buy")] * 2 + [("B", *["2"] * 9, None, None)]
    snapshot = spark.createDataFrame(cells, schemas.MARKET_SNAPSHOT_CSV)
    assert snapshot.columns == names
    stats = loaders.append_market_stats(f"{tmp_path}/s", 1, snapshot, company, NOW, NOW)
    assert stats.schema.names == schemas.MARKET_STAT.names
    assert [(r.stat_id, r.company_id) for r in stats.orderBy("stat_id").collect()] == [
        (1, 5), (2, 5), (3, 6)]
    listed = spark.createDataFrame([("a",), (" B ",), ("b",)], "Symbol string")
    member = loaders.load_membership(listed, company, 1, NOW.date())
    table = loaders.append_memberships(f"{tmp_path}/m", 1, member)
    assert table.schema.names == schemas.INDEX_MEMBERSHIP.names
    assert {(r.membership_id, r.company_id) for r in table.collect()} == {(1, 5), (2, 6)}


def test_new_companies_get_ids_and_defaults(spark):
    old = [(4, "A", "One"), (9, "C", "Three"), (5, None, "Nameless")]
    company = spark.createDataFrame(
        [(*r, *[None] * 8) for r in old], schemas.COMPANY
    )
    updates = spark.createDataFrame(
        [("D", "Four", 1), ("B", "Two", 1), ("A", "Uno", 1), ("A", "Eins", 2), (None, "Still", 1)],
        "symbol string, company_name string, seq int",
    )
    merged = loaders.upsert_companies(company, updates, ["seq"], NOW)
    assert merged.schema.names == schemas.COMPANY.names
    got = {(r.company_id, r.symbol, r.company_name, r.is_active, r.created_at) for r in merged.collect()}
    assert got == {
        (4, "A", "Eins", None, None),
        (9, "C", "Three", None, None),
        (5, None, "Still", None, None),
        (10, "B", "Two", True, NOW),
        (11, "D", "Four", True, NOW),
    }


def test_updates_without_a_key_are_not_inserted_again(spark):
    target = spark.createDataFrame([(None, "x"), ("a", "x")], "k string, v string")
    updates = spark.createDataFrame([(None, "y"), ("b", "y")], "k string, v string")
    once = merge_columns(target, updates, "k", ["v"])
    twice = merge_columns(once, updates, "k", ["v"])
    expected = {(None, "y"), ("a", "x"), ("b", "y")}
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in twice.collect()} == expected
    assert twice.count() == 3


def test_rows_to_append_are_shuffled_once_for_key_and_known_keys(spark):
    kind = "k bigint, v bigint"
    rows = spark.createDataFrame([(1, 1), (1, 3), (2, 5), (None, 7), (3, 1)], kind)
    known = spark.createDataFrame([(2, 1), (None, 9)], kind)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = stable_ids._latest_unknown(rows, known, ["k"], ["v"])
        assert sorted(tuple(r) for r in new.collect()) == [(1, 3), (3, 1)]
        plan = new._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Join" not in plan


def test_ids_over_several_columns_follow_their_order(spark):
    rows = spark.range(1000).selectExpr("id % 7 as a", "CAST(id AS string) as b")
    known = spark.createDataFrame([(10,)], "n bigint")
    numbered = stable_ids.continue_ids(rows, ["a", "b"], "n", known).orderBy("n").collect()
    assert [r["n"] for r in numbered] == list(range(11, 1011))
    assert [(r["a"], r["b"]) for r in numbered] == sorted((r["a"], r["b"]) for r in numbered)


def test_market_statistics_are_cleaned_once_a_batch(spark, tmp_path):
    """Cutting the rows into ranges reads them twice; their text is cleaned before that."""
    names = ["Symbol", "Price", "Change %", "Volume", "Rel Volume", "Market cap", "P/E",
             "EPS dil TTM", "EPS dil growth TTM YoY", "Div yield % TTM", "Sector",
             "Analyst Rating"]
    read = spark.sparkContext.accumulator(0)

    def count(source):
        for batch in source:
            read.add(batch.num_rows)
            yield batch

    row = ["a Company", "1.5", "−1%", "2K", "1", "3 M", "-", "1", "1", "1", "x", None]
    wanted = ", ".join(f"`{n}` string" for n in names)
    rows = spark.createDataFrame([row] * 40, wanted).mapInArrow(count, wanted)
    company = spark.createDataFrame([("A", 7)], "symbol string, company_id int")
    company = F.broadcast(company)
    table = loaders.append_market_stats(str(tmp_path / "t"), 1, rows, company, NOW, NOW)
    assert read.value == 40
    got = table.orderBy("stat_id").collect()
    assert [r.stat_id for r in got] == list(range(1, 41))
    assert {(r.company_id, float(r.price), r.volume, r.market_cap) for r in got} == {
        (7, 1.5, 2000, 3000000)}
