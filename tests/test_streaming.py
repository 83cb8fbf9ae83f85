"""Streams end to end: several batches, repeated batches, bad messages."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quotelake.streaming import live, ticks

START = datetime(2024, 1, 7, 8, 0)


def message(i, ticker, **changes):
    body = {
        "ticker": ticker, "company_name": ticker.lower(), "price": 10.0 + i, "open": 1.0,
        "high": 2.0, "low": 0.5, "volume": 100 + i, "price_change": 0.1,
        "price_change_percent": 0.5, "currency": "EGP",
        "timestamp": (START + timedelta(seconds=40 * i)).isoformat(), "source": "t",
        "exchange": "EGX", "is_mock": True, "market_status": "OPEN",
    }
    return json.dumps({**body, **changes})


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()
    for part in range(3):
        lines = [message(i, "AB"[i % 2]) for i in range(part * 20, part * 20 + 20)]
        if part == 1:
            lines += ["{not json", message(5, "A", timestamp="yesterday"),
                      message(45, "C", timestamp="2024-01-07T10:30:00+02:00")]
        path = folder / f"part{part}.json"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + part, 1_700_000_000 + part))
    return folder


def run(spark, inbox, out):
    decoded = ticks.decode_ticks(ticks.file_messages(spark, str(inbox), files_per_batch=1))
    query = ticks.start_tick_stream(
        decoded, ticks.tick_sink(f"{out}/table", f"{out}/rejected"), f"{out}/state", None
    )
    query.awaitTermination()
    return ticks.read_ticks(spark, f"{out}/table")


def test_stream_equals_batch_and_bad_messages_are_kept_apart(spark, inbox, tmp_path):
    table = run(spark, inbox, tmp_path)
    batch = ticks.valid_ticks(ticks.decode_ticks(spark.read.text(str(inbox))))
    got = table.drop("batch_id", "trade_date").select(*batch.columns)
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    assert table.count() == 61 and table.select("batch_id").distinct().count() == 3
    rejected = spark.read.parquet(f"{tmp_path}/rejected")
    texts = sorted(r["_malformed"] for r in rejected.collect())
    assert texts == sorted(["{not json", message(5, "A", timestamp="yesterday")])
    offset = table.filter("ticker = 'C'").first()["time"]
    assert offset == datetime(2024, 1, 7, 8, 30)


def test_repeated_batch_changes_nothing(spark, inbox, tmp_path):
    before = run(spark, inbox, tmp_path).count()
    again = ticks.decode_ticks(spark.read.text(f"{inbox}/part0.json"))
    ticks.tick_sink(f"{tmp_path}/table", f"{tmp_path}/rejected")(again, 0)
    assert ticks.read_ticks(spark, f"{tmp_path}/table").count() == before


def test_failing_sink_stops_the_stream(spark, inbox, tmp_path):
    def broken(batch, batch_id):
        raise RuntimeError("no database")

    decoded = ticks.decode_ticks(ticks.file_messages(spark, str(inbox)))
    with pytest.raises(Exception, match="no database"):
        ticks.start_tick_stream(decoded, broken, f"{tmp_path}/state", None).awaitTermination()


def test_live_statistics_drop_repeated_ticks(spark, inbox, tmp_path):
    (inbox / "copy.json").write_text((inbox / "part2.json").read_text())
    stream = ticks.valid_ticks(ticks.decode_ticks(ticks.file_messages(spark, str(inbox))))
    stats = live.rolling_statistics(live.once_per_tick(stream), delay=None)
    query = (
        stats.writeStream.outputMode("append").format("parquet")
        .option("path", f"{tmp_path}/stats").option("checkpointLocation", f"{tmp_path}/s")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/stats")
    rows = ticks.valid_ticks(ticks.decode_ticks(spark.read.text(str(inbox)))).distinct()
    newest = rows.agg(F.max("time")).first()[0]
    want = live.rolling_statistics(rows, delay=None).filter(
        F.col("window_end") <= F.lit(newest - timedelta(minutes=5))
    )
    assert got.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_latest_state_is_read_from_the_state_store(spark, inbox, tmp_path):
    def run_state():
        stream = ticks.valid_ticks(
            ticks.decode_ticks(ticks.file_messages(spark, str(inbox), files_per_batch=1))
        )
        live.start_latest_state(stream, f"{tmp_path}/state", None).awaitTermination()
        rows = live.read_latest_state(spark, f"{tmp_path}/state").collect()
        return sorted((r["ticker"], r["price"]) for r in rows)

    assert run_state() == [("A", 68.0), ("B", 69.0), ("C", 55.0)]
    # A restart goes on with the state: an older tick changes nothing, a newer one does.
    (inbox / "more.json").write_text(
        "\n".join([message(1, "A"), message(80, "B"), message(2, "D")]) + "\n"
    )
    assert run_state() == [("A", 68.0), ("B", 90.0), ("C", 55.0), ("D", 12.0)]


def day_message(i, day, ticker="A"):
    return message(i, ticker, timestamp=(START + timedelta(days=day, seconds=i)).isoformat())


@pytest.fixture
def days(spark, tmp_path):
    """Three batches over three days; each day has ticks of two batches."""
    folder = tmp_path / "days"
    folder.mkdir()
    for part, both in enumerate(((0, 1), (1, 2), (2, 0))):
        path = folder / f"part{part}.json"
        path.write_text("\n".join(day_message(10 * part + i, d) for i in range(4) for d in both))
        os.utime(path, (1_700_000_000 + part, 1_700_000_000 + part))
    return folder


def stream_days(spark, folder, out):
    decoded = ticks.decode_ticks(ticks.file_messages(spark, str(folder), files_per_batch=1))
    query = ticks.start_tick_stream(
        decoded, ticks.tick_sink(f"{out}/table", f"{out}/rejected"), f"{out}/state", None
    )
    query.awaitTermination()
    return query


def folders(path):
    return sorted(d for d in os.listdir(path) if "=" in d)


def test_days_before_the_watermark_are_closed(spark, days, tmp_path):
    query = stream_days(spark, days, tmp_path)
    table = f"{tmp_path}/table"
    assert len(folders(f"{table}/open/trade_date=2024-01-08")) == 2
    before = sorted(map(tuple, ticks.read_ticks(spark, table).collect()))
    assert ticks.watermark_day(query) == datetime(2024, 1, 9).date()
    closed = ticks.close_days(spark, table, ticks.watermark_day(query))
    assert [str(d) for d in closed] == ["2024-01-07", "2024-01-08"]
    assert folders(f"{table}/open") == ["trade_date=2024-01-09"]
    assert folders(f"{table}/closed") == ["trade_date=2024-01-07", "trade_date=2024-01-08"]
    assert sorted(map(tuple, ticks.read_ticks(spark, table).collect())) == before
    day = ticks.read_ticks_of(spark, table, closed[1])
    assert day.count() == 8
    assert all("closed/trade_date=2024-01-08" in f for f in day.inputFiles())
    assert ticks.close_days(spark, table, ticks.watermark_day(query)) == []
    assert ticks.read_ticks_of(spark, table, START.date() - timedelta(days=9)).count() == 0


def test_closing_survives_breaks_repeats_and_late_ticks(spark, days, tmp_path):
    import shutil

    stream_days(spark, days, tmp_path)
    table, end = f"{tmp_path}/table", datetime(2024, 2, 1).date()
    shutil.copytree(f"{table}/open", f"{tmp_path}/open-before")
    before = sorted(map(tuple, ticks.read_ticks(spark, table).collect()))
    ticks.close_days(spark, table, end)
    # A run that broke off before it deleted, or batches repeated after their day was closed.
    shutil.copytree(f"{tmp_path}/open-before", f"{table}/open", dirs_exist_ok=True)
    assert sorted(map(tuple, ticks.read_ticks(spark, table).collect())) == before
    ticks.close_days(spark, table, end)
    assert folders(f"{table}/open") == []
    assert sorted(map(tuple, ticks.read_ticks(spark, table).collect())) == before
    # A late tick of a closed day comes with a later batch.
    (days / "late.json").write_text(day_message(99, 0, "Z"))
    stream_days(spark, days, tmp_path)
    assert ticks.read_ticks(spark, table).count() == len(before) + 1
    ticks.close_days(spark, table, end)
    rows = ticks.read_ticks_of(spark, table, START.date())
    assert rows.filter("ticker = 'Z'").count() == 1 and rows.count() == 9
    assert ticks.read_ticks(spark, table).count() == len(before) + 1


def test_keyed_messages_round_trip(spark):
    rows = spark.createDataFrame([("A", 1.5)], "ticker string, price double")
    sent = ticks.keyed_messages(rows)
    assert sent.columns == ["key", "value"]
    assert ticks.decode_ticks(sent).first()["price"] == 1.5


def test_tick_table_has_one_folder_per_day(spark, tmp_path):
    from quotelake.sources.sinks import write_ticks

    rows = spark.createDataFrame(
        [("A", START, 1.0), ("B", START + timedelta(days=1), 2.0)],
        "ticker string, time timestamp, price double",
    )
    path = f"{tmp_path}/ticks"
    write_ticks(rows, path)
    assert sorted(d for d in os.listdir(path) if "=" in d) == [
        "trade_date=2024-01-07", "trade_date=2024-01-08"]
    assert spark.read.parquet(path).filter("trade_date = '2024-01-08'").count() == 1
