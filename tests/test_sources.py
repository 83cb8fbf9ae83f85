"""File scans, bronze load, message shapes."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quotelake.sources import bronze, files, ingest, loaders, messages

BATCH = datetime(2024, 2, 1)


def write(folder, name, text):
    path = os.path.join(str(folder), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)
    return path


@pytest.fixture
def landing(tmp_path):
    write(tmp_path, "TVH/abuk.csv", "date,close\nSun 07 Dec '25,1.5\nMon 08 Dec '25,\n")
    write(tmp_path, "TVH/COMI [1]+ .csv", "close,volume,date\n2.5,4.39 M,Sun 07 Dec '25\n")
    write(tmp_path, "TVH/EMPT.csv", "date,close\n")
    write(tmp_path, "TVH/zero.csv", "")
    write(tmp_path, "TVH/notes.txt", "not,a,price\n1,2,3\n")
    write(tmp_path, "finances/abuk_finance.csv", "Quarter,eps\nQ4 '24,1\n")
    return tmp_path


def test_scan_joins_files_with_different_headers(spark, landing):
    rows = files.scan_csv_text(spark, f"{landing}/TVH")
    assert set(rows.columns) == {"date", "close", "volume", "file_name"}
    got = {(r["date"], r["close"], r["volume"]) for r in rows.collect()}
    assert got == {
        ("Sun 07 Dec '25", "1.5", None),
        ("Mon 08 Dec '25", None, None),
        ("Sun 07 Dec '25", "2.5", "4.39 M"),
    }


def test_ingest_notes_files_and_repeats_safely(spark, landing, tmp_path):
    table, ledger = str(tmp_path / "bronze"), str(tmp_path / "ledger")

    def load(ts, **options):
        batches = ingest.ingest(spark, f"{landing}/TVH", table, ledger, ts, **options)
        status = ingest.load_status(spark, table, ledger, batches)
        return {r["status"]: r["files"] for r in status.collect()}

    def rows():
        return ingest.read_bronze(spark, table)

    # One of the empty files has a header, the other no bytes.
    assert load(BATCH, files_per_batch=1) == {"processed": 2, "empty": 2}
    assert rows().count() == 3
    text = bronze.members(rows(), ["_ingest_symbol", "close", "volume"], ["load_ts"])
    assert {r["_ingest_symbol"] for r in text.collect()} == {"ABUK", "COMI [1]+"}
    assert text.filter("close IS NULL").count() == 1
    assert load(BATCH + timedelta(days=1)) == {"skipped": 4}
    old = write(landing, "TVH/new.csv", "date,close\nSun 07 Dec '25,9\n")
    os.utime(old, (0, 0))  # an old time does not hide a new file
    assert load(BATCH + timedelta(days=1)) == {"skipped": 4, "processed": 1}
    assert rows().count() == 4
    assert load(BATCH + timedelta(days=2), full_refresh=True) == {"processed": 3, "empty": 2}
    assert rows().count() == 4


def test_ingest_writes_a_broken_batch_anew(spark, landing, tmp_path):
    table, ledger = str(tmp_path / "bronze"), str(tmp_path / "ledger")
    ingest.ingest(spark, f"{landing}/TVH", table, ledger, BATCH, files_per_batch=1)
    before = ingest.read_bronze(spark, table).count()
    # The run broke off after its last batch was written and before it was noted.
    last = max(os.listdir(f"{ledger}/commits"), key=lambda n: int(n) if n.isdigit() else -1)
    for name in (last, f".{last}.crc"):
        os.remove(f"{ledger}/commits/{name}")
    ingest.ingest(spark, f"{landing}/TVH", table, ledger, BATCH + timedelta(days=1))
    rows = ingest.read_bronze(spark, table)
    assert rows.count() == before == 3
    assert rows.filter(F.col("load_ts") > F.lit(BATCH)).select("batch_id").distinct().count() <= 1


def test_cells_are_named_by_each_files_own_header(spark, tmp_path):
    write(tmp_path, "in/a.csv", "\ufeffx, ,x\n1,2,3\n4\n")
    write(tmp_path, "in/b.csv", 'x,_ingest_symbol\n"two\nlines",mine\n,\n')
    write(tmp_path, "in/c.csv", "x")
    ingest.ingest(spark, f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/l", BATCH)
    rows = ingest.read_bronze(spark, f"{tmp_path}/t").select(F.to_json("raw").alias("r"))
    assert {r["r"] for r in rows.collect()} == {
        '{"_ingest_symbol":"A","column_1":"2","x":"1","x_2":"3"}',
        '{"_ingest_symbol":"A","column_1":null,"x":"4","x_2":null}',
        '{"_ingest_symbol":"B","x":"two\\nlines"}',
        '{"_ingest_symbol":"B","x":null}',
    }


def test_too_many_columns_stop_the_load(spark, tmp_path):
    write(tmp_path, "in/a.csv", ",".join(f"c{i}" for i in range(200)) + "\n1\n")
    args = (spark, f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/l", BATCH)
    with pytest.raises(Exception, match="more than 32 columns"):
        ingest.ingest(*args)
    ingest.ingest(*args, width=200)
    assert ingest.read_bronze(spark, f"{tmp_path}/t").count() == 1


def test_short_lines_are_padded_by_the_reader(spark, tmp_path):
    """Cells a line lacks cost nothing: such a line is not taken for a malformed one."""
    write(tmp_path, "in/a.csv", 'x,y,z\n1\n"two\nlines",2\n,,3\n')
    strict = spark.read.option("mode", "FAILFAST")
    lines = ingest._layout(strict, "*.csv", 8).csv(f"{tmp_path}/in").drop("c9")
    want = [("x", "y", "z"), ("1", None, None), ("two\nlines", "2", None), (None, None, "3")]
    assert [tuple(r)[:3] for r in lines.collect()] == want
    assert ingest.csv_lines(spark, f"{tmp_path}/in", width=8).columns == [f"c{i}" for i in range(9)]


def test_ingest_reads_the_files_once(spark, landing):
    """One scan, no exchange: the header comes with the rows it names."""
    from quotelake.sources.files import FILE_NAME

    lines = spark.read.schema(ingest._positional(8)).option("multiLine", True).csv(f"{landing}/TVH")
    plan = ingest.bronze_rows(ingest.named_cells(lines, 8), BATCH)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Exchange" not in text and FILE_NAME in plan.columns


def test_companies_are_kept_when_they_have_files(spark, landing):
    symbols = bronze.real_symbols(
        files.list_files(spark, f"{landing}/TVH", "*.csv"),
        files.list_files(spark, f"{landing}/finances", "*.csv"),
    )
    assert {r[0] for r in symbols.collect()} == {"ABUK", "COMI [1]+", "EMPT"}
    companies = spark.createDataFrame([(" abuk",), ("NONE",)], "Symbol string")
    assert bronze.companies_with_data(companies, symbols).count() == 1


def test_missing_cells_stay_as_null_members(spark):
    rows = spark.createDataFrame([("a", None)], "x string, y string")
    raw = bronze.envelope(rows, F.lit("f"), BATCH).select(F.to_json("raw")).first()[0]
    assert raw == '{"x":"a","y":null}'


def test_members_are_looked_up_without_a_generator(spark):
    rows = spark.sql(
        """SELECT 1 AS k, parse_json('{"a":"x","b":1.50,"p.q":{"c":null},"B":"s","it''s":"?"}') AS raw
        UNION ALL SELECT 2, parse_json('{"a":null,"B":"s"}')
        UNION ALL SELECT 3, parse_json('[1]') UNION ALL SELECT 4, parse_json('null')
        UNION ALL SELECT 5, CAST(NULL AS VARIANT)"""
    )
    got = bronze.members(rows, ["a", "b", "p.q", "it's", "none"], ["k"], {"b": "B"})
    nothing = [(k, *[None] * 5) for k in (3, 4, 5)]
    assert sorted(map(tuple, got.collect())) == [
        (1, "x", "1.5", '{"c":null}', "?", None), (2, None, "s", None, None, None), *nothing]
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()


def test_recent_files_and_routes(spark, landing):
    old = write(landing, "TVH/old.csv", "date,close\n")
    os.utime(old, (0, 0))
    listing = files.list_files(spark, f"{landing}/TVH")
    recent = files.recent_files(listing, datetime.now() + timedelta(minutes=1), 1)
    names = {r["file_name"].rsplit("/", 1)[1] for r in recent.collect()}
    assert "old.csv" not in names and "abuk.csv" in names and "notes.txt" not in names
    since = files.scan_csv_text(spark, f"{landing}/TVH", datetime.now() - timedelta(days=1))
    assert since.count() == 3
    paths = ["x/Company.csv", "x/price_list.csv", "x/OHLC.csv", "x/financials.csv", "x/other.csv"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string")
    got = {r["p"]: r["t"] for r in rows.select("p", files.route(F.col("p")).alias("t")).collect()}
    assert list(got.values()) == ["company", "company", "stock_price", "financial", None]


def test_inventory_and_expected_prefixes(spark, landing):
    listing = files.inventory(files.list_files(spark, str(landing)), str(landing))
    rows = {r["prefix"]: r for r in listing.collect()}
    assert rows["TVH"]["files"] == 4 and rows["TVH"]["extensions"] == ["csv", "txt"]
    assert len(rows["TVH"]["sample"]) == 4
    status = files.expected_prefixes(listing, ["TVH/", "finances", "companies/"])
    assert {r["prefix"]: r["found"] for r in status.collect()} == {
        "TVH": True, "finances": True, "companies": False}
    with pytest.raises(FileNotFoundError, match="companies"):
        files.require_prefixes(status)


def test_market_stats_from_snapshot(spark):
    header = ["Symbol", "Price", "Change %", "Volume", "Rel Volume", "Market cap", "P/E",
              "EPS dil TTM", "EPS dil growth TTM YoY", "Div yield % TTM", "Sector",
              "Analyst Rating"]
    row = ["comi Commercial Bank", "85.5 EGP", "−1.2%", "4.39 M", "1.1", "1.5 B", "—", "-",
           "+3%", "2%", " Finance ", None]
    blank = ["  "] + [None] * 11
    rows = spark.createDataFrame([row, blank], ",".join(f"`{h}` string" for h in header))
    company = spark.createDataFrame([("COMI", 7)], "symbol string, company_id int")
    got = loaders.load_market_stats(rows, company, BATCH).collect()
    assert len(got) == 1
    assert got[0][:1] + got[0][2:] == (
        7, 85.5, -1.2, 4390000, 1.1, 1500000000, None, None, 3.0, 2.0, "Finance", None)


def test_statement_rows_keep_eight_quarters(spark):
    quarters = [f"Q{i}" for i in range(1, 11)] + ["TTM"]
    values = [str(i) for i in range(1, 9)] + ["99"]
    rows = spark.createDataFrame(
        [("A", quarters, values, [])],
        "symbol string, quarters array<string>, net_income array<string>, eps array<string>",
    )
    got = messages.statement_rows(rows, ["symbol"], ["net_income", "eps"]).collect()
    assert [(r["quarter"], r["net_income"], r["eps"]) for r in got] == [
        (f"Q{i + 2}", str(i), None) for i in range(1, 9)]


def test_messages(spark):
    bars = spark.createDataFrame(
        [("A", "2025-12-07", 1.0, 2.0, 0.5, 1.5, 10, None)],
        "symbol string, date string, open double, high double, low double, close double,"
        " volume int, adjusted_close double",
    )
    message = messages.bar_messages(bars, BATCH)
    row = message.first()
    assert row["datetime"] == "2025-12-07T16:00:00" and row["adjusted_close"] == 1.5
    point = messages.tagged_points(message, BATCH).first()
    assert point["time"] == datetime(2025, 12, 7, 16) and point["symbol"] == "A"
    links = spark.createDataFrame(
        [(2, "b", "/x"), (1, "a", "/x"), (3, "c", "/y")], "position int, text string, url string"
    )
    assert {tuple(r) for r in messages.first_links(links).collect()} == {
        (1, "a", "/x"), (3, "c", "/y")}


def test_typed_scan_and_known_layout(spark, tmp_path):
    from quotelake.schemas import DAILY_PRICE_CSV

    write(tmp_path, "prices/a.csv", "symbol,trade_date,open,high,low,close,volume\nA,2024-01-02,1,x,,2.5,7\n")
    typed = files.scan_csv_typed(spark, f"{tmp_path}/prices", DAILY_PRICE_CSV)
    assert tuple(typed.first()) == ("A", "2024-01-02", 1.0, None, None, 2.5, 7)
    company = spark.createDataFrame([("A", 5)], "symbol string, company_id int")
    loaded = loaders.load_prices(typed, company, BATCH).first()
    assert (loaded["company_id"], float(loaded["high_price"]), loaded["volume"]) == (5, 2.5, 7)
    known = files.scan_csv_text(
        spark, f"{tmp_path}/prices", columns=["symbol", "trade_date", "open", "high"]
    )
    assert known.first()["high"] == "x"
