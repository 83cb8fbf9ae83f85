"""A job over recent files: routes, files it cannot load, repeated runs."""

import os
from datetime import datetime

from pyspark.sql import functions as F
from test_sources import write

from quotelake.sources import batch_job, ingest

NOW, CUT = datetime(2024, 2, 1), datetime(2024, 1, 1)


def drop(folder):
    write(folder, "in/Company.csv", "symbol,company_name\nB,Bee\nA,Aye\n")
    write(folder, "in/list2.csv", "symbol,company_name,sector,market_cap\nA,Ay,Banks,1.5\n")
    write(folder, "in/price_a.csv", "symbol,trade_date,close,open\nA,2024-01-02,2.5,\nA,bad,1,1\n")
    write(folder, "in/OHLC.csv", "trade_date,close,symbol\n2024-01-02,9,B\n2024-01-02,9,NONE\n")
    write(folder, "in/price_b.csv", "symbol,trade_date\nA,2024-01-03\n")
    write(folder, "in/financial.csv", "symbol\nA\n")
    old = write(folder, "in/price_old.csv", "symbol,trade_date,close\nA,2020-01-02,1\n")
    os.utime(old, (0, 0))
    return f"{folder}/in"


def run(spark, folder, root, batch):
    rows = batch_job.load_recent(spark, folder, root, batch, NOW, CUT).collect()
    return {r["file_name"].rsplit("/", 1)[1]: (r["status"], r["rows"], r["rejected"]) for r in rows}


def tables(spark, root):
    company = batch_job.companies(spark, root).collect()
    prices = batch_job.stock_prices(spark, root).collect()
    return (
        {(r.company_id, r.symbol, r.company_name, r.sector) for r in company},
        {(r.price_id, r.company_id, str(r.trade_date), float(r.close_price)) for r in prices},
    )


def test_files_are_routed_and_bad_ones_reported(spark, tmp_path):
    folder, root = drop(tmp_path), str(tmp_path / "tables")
    report = run(spark, folder, root, 1)
    assert report == {
        "Company.csv": ("loaded", 2, 0),
        "list2.csv": ("loaded", 1, 0),
        "price_a.csv": ("loaded", 2, 1),
        "OHLC.csv": ("loaded", 2, 0),
        "price_b.csv": ("missing columns", 1, 0),
        "financial.csv": ("no table", 1, 0),
    }
    loaded = tables(spark, root)
    assert loaded == (
        {(1, "A", "Ay", "Banks"), (2, "B", "Bee", "Unknown")},
        {(1, 1, "2024-01-02", 2.5), (2, 2, "2024-01-02", 9.0)},
    )
    # The same job again, and as a later one: ids stay, nothing is doubled.
    assert run(spark, folder, root, 1) == report and tables(spark, root) == loaded
    write(tmp_path, "in/price_c.csv", "symbol,trade_date,close\nB,2024-01-01,4\nB,2024-01-02,7\n")
    run(spark, folder, root, 2)
    company, prices = tables(spark, root)
    assert company == loaded[0] and prices == loaded[1] | {(3, 2, "2024-01-01", 4.0)}


def test_large_plain_files_are_read_in_pieces(spark, tmp_path, monkeypatch):
    header = "symbol, trade_date,close,,\n"
    lines = "".join(f"S{i},2024-01-02,{i}.5,x,y,z\n" if i % 3 else f"S{i},,\n\n" for i in range(3000))
    write(tmp_path, "in/price_a.csv", "\n" + header + lines + header)
    write(tmp_path, "in/price_b.csv", header + "A,,1\n")
    write(tmp_path, "in/price_c.csv", 'symbol,trade_date\n"A\nB",2024-01-03\n' + "C,1\n" * 3000)
    write(tmp_path, "in/price_d.csv", "symbol,trade_date\n  \n" + "D,1\r\n" * 3000)
    write(tmp_path, "in/price_e.csv", ",,\n" + "1,2,3\n" * 3000)

    def rows():
        found = ingest.file_cells(spark, f"{tmp_path}/in")
        return found, sorted(str((r[0], sorted(r[1].items()))) for r in found.collect())

    whole = rows()[1]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        monkeypatch.setattr(ingest, "LARGE_FILE", 1000)
        found, pieces = rows()
        scans = found.filter(F.col("file_name").endswith("price_a.csv"))
        tasks = scans.select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(whole) > 9000 and pieces == whole
    assert tasks > 1
