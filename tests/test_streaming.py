import datetime as dt

import pytest
from pyspark.sql import functions as F

import market_fixtures as fx
from barworks.operators import dims
from barworks.operators.gold import silver_to_gold
from barworks.plans.state import WatermarkTable
from barworks.sources import read_fact
from barworks.streaming import stream_daily_bars, stream_ingest, stream_late_ticks


@pytest.fixture(scope="module")
def quarter(bars):
    return bars.filter(F.col("trade_date").between(F.lit("1998-01-01").cast("date"), F.lit("1998-03-31").cast("date")))


def test_files_arrive_in_two_rounds_and_a_replay_changes_nothing(spark, quarter, rows, tmp_path):
    feed, where = str(tmp_path / "feed"), lambda name: str(tmp_path / name)
    early, late = fx.date_slices(quarter, ["1998-02-16"])

    def follow(checkpoint):
        stream_ingest(spark, feed, where("fact"), where("state"), where(checkpoint), max_files_per_trigger=1,
                      gold_path=where("gold"), lookback_days=10,
                      listed=lambda session: dims.listings_in(read_fact(session, where("fact")))).awaitTermination()

    for piece in (early, late):
        fx.raw_feed(piece).drop("Dividends").coalesce(1).write.mode("append").parquet(feed)
        follow("checkpoint")
    table = lambda: rows(fx.plain(read_fact(spark, where("fact")), *quarter.columns))
    once = table()
    assert once == rows(quarter)
    full = silver_to_gold(quarter)
    assert rows(read_fact(spark, where("gold")), *sorted(full.columns)) == rows(full)
    marks = WatermarkTable(spark, where("state")).read()
    last = quarter.groupBy("symbol", "exchange_code").agg(F.max("trade_date").alias("watermark"))
    assert rows(marks) == rows(last)
    follow("another-checkpoint")
    assert table() == once


def test_bad_batch_stops_the_stream(spark, quarter, tmp_path):
    feed, where = str(tmp_path / "feed"), lambda name: str(tmp_path / name)
    fx.raw_feed(quarter.withColumn("low_price", -F.col("low_price"))).drop("Dividends").write.parquet(feed)
    with pytest.raises(Exception, match="critical quality checks failed"):
        stream_ingest(spark, feed, where("fact"), where("state"), where("checkpoint")).awaitTermination()


def test_an_open_day_keeps_growing(spark, rows, tmp_path):
    ticks_path, where = str(tmp_path / "ticks"), lambda name: str(tmp_path / name)
    schema = "symbol string, exchange_code string, ts timestamp_ntz, px double, seq long"

    def arrive(*ticks):
        made = [("A", "NSE", dt.datetime(2024, 1, day, hour), px, seq) for day, hour, px, seq in ticks]
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(ticks_path)
        stream_daily_bars(spark, spark.readStream.schema(schema).parquet(ticks_path), "ts", "px", "seq",
                          where("bars"), where("checkpoint")).awaitTermination()
        return [(r.trade_date.day, r.open_price, r.high_price, r.low_price, r.close_price, r.volume)
                for r in read_fact(spark, where("bars")).orderBy("trade_date").collect()]

    assert arrive((1, 9, 10.0, 1), (1, 10, 12.0, 2)) == [(1, 10.0, 12.0, 10.0, 12.0, 2)]
    assert arrive((1, 11, 8.0, 3), (2, 9, 9.0, 4)) == [(1, 10.0, 12.0, 8.0, 8.0, 3), (2, 9.0, 9.0, 9.0, 9.0, 1)]


def test_repeated_and_late_ticks(spark, tmp_path):
    """A feed read again in overlapping files, across restarts; a tick is in a bar or among the late ones."""
    ticks_path, where = str(tmp_path / "ticks"), lambda name: str(tmp_path / name)
    schema = "symbol string, exchange_code string, ts timestamp_ntz, px double, seq long"

    def arrive(*ticks):
        made = [("A", "NSE", dt.datetime(2024, 1, day, hour), px, seq) for day, hour, px, seq in ticks]
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(ticks_path)
        stream = lambda: spark.readStream.schema(schema).parquet(ticks_path)
        query = stream_daily_bars(spark, stream(), "ts", "px", "seq", where("bars"), where("checkpoint"), watermark="2 days", tick_id="seq")
        query.awaitTermination()
        stream_late_ticks(spark, stream(), "ts", where("late"), where("late-checkpoint"), watermark="2 days").awaitTermination()
        bars = {r.trade_date.day: (r.open_price, r.high_price, r.close_price, r.volume) for r in read_fact(spark, where("bars")).collect()}
        return bars, sorted(r.seq for r in spark.read.schema(schema).parquet(where("late")).collect())

    assert arrive((1, 9, 10.0, 1), (1, 10, 12.0, 2), (1, 9, 10.0, 1)) == ({1: (10.0, 12.0, 12.0, 2)}, [])
    assert arrive((1, 10, 12.0, 2), (1, 11, 8.0, 3), (4, 9, 9.0, 4)) == ({1: (10.0, 12.0, 8.0, 3), 4: (9.0, 9.0, 9.0, 1)}, [])
    # The 2nd at 9:00 is the watermark now: that tick and older ones are late, the next hour is not.
    bars, late = arrive((1, 12, 99.0, 5), (2, 9, 7.0, 6), (2, 10, 6.0, 7), (4, 9, 9.0, 4))
    assert bars == {1: (10.0, 12.0, 8.0, 3), 2: (6.0, 6.0, 6.0, 1), 4: (9.0, 9.0, 9.0, 1)} and late == [5, 6]


def test_bars_without_a_listing_are_kept_once_each(spark, tmp_path):
    ticks_path, where = str(tmp_path / "ticks"), lambda name: str(tmp_path / name)
    schema = "symbol string, exchange_code string, ts timestamp_ntz, px double, seq long"

    def arrive(checkpoint, *ticks):
        made = [(symbol, "NSE", dt.datetime(2024, 1, day, 9), 1.0, seq) for symbol, day, seq in ticks]
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(ticks_path)
        stream_daily_bars(spark, spark.readStream.schema(schema).parquet(ticks_path), "ts", "px", "seq", where("bars"), where(checkpoint),
                          quarantine_path=where("q")).awaitTermination()
        return sorted(r.trade_date.day for r in spark.read.parquet(where("q")).collect())

    assert arrive("one", (None, 1, 1), ("A", 1, 2)) == [1]
    # A new checkpoint numbers its batches from 0 again and meets the old bar once more.
    assert arrive("two", (None, 2, 3)) == [1, 2]
    assert read_fact(spark, where("bars")).count() == 1
