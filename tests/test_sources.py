import datetime as dt

import pytest
from pyspark.sql import functions as F

from barworks import sources
from barworks.functions import base_symbol, exchange_from_suffix, fiscal_quarter, fiscal_year, round_stable, split_list
from barworks.schemas import BAR_COLUMNS, RAW_BARS
from barworks.sources import normalize_bars, read_parts

DAY = dt.datetime(2026, 3, 5)


def test_normalise_one_bar(spark):
    raw = spark.createDataFrame([(" tcs.ns ", DAY, 3800.0, 3850.0, 3780.0, 3842.0, 1_000_000)], RAW_BARS)
    out = sources.normalize_bars(raw)
    assert out.columns == BAR_COLUMNS
    row = out.first()
    assert (row.symbol, row.exchange_code, row.trade_date) == ("TCS", "NSE", dt.date(2026, 3, 5))
    assert (row.daily_range, row.change_pct, row.volume) == (70.0, 1.1053, 1_000_000)
    assert row.source == "yfinance"


def test_zoned_feed_is_dated_by_the_exchange(spark):
    raw = spark.createDataFrame([("TCS.NS", 1.0, 2.0, 0.5, 1.5, 10)], "ticker string, Open double, High double, Low double, Close double, Volume bigint")
    zoned = raw.withColumn("Date", F.expr("timestamp'2026-03-05 00:00:00+05:30'"))
    assert str(normalize_bars(zoned).first().trade_date) == "2026-03-05"
    assert str(normalize_bars(zoned, feed_timezone="UTC").first().trade_date) == "2026-03-04"
    plain = raw.withColumn("Date", F.expr("timestamp_ntz'2026-03-05 00:00:00'"))
    assert str(normalize_bars(plain).first().trade_date) == "2026-03-05"


def test_suffixes(spark):
    df = spark.createDataFrame([("INFY.BO",), ("tcs.ns",), ("AAPL",), ("A.NSE",)], "t string")
    got = [tuple(r) for r in df.select(base_symbol("t"), exchange_from_suffix("t")).collect()]
    assert got == [("INFY", "BSE"), ("TCS", "NSE"), ("AAPL", "UNKNOWN"), ("A.NSE", "UNKNOWN")]


def test_normalise_keeps_only_what_the_feed_sent(spark):
    raw = spark.createDataFrame([("TCS.NS", DAY, 1.0)], "ticker string, Date timestamp_ntz, Close double")
    assert sources.normalize_bars(raw).columns == ["symbol", "exchange_code", "trade_date", "close_price", "source"]


def test_normalise_empty(spark):
    assert sources.normalize_bars(spark.createDataFrame([], RAW_BARS)).count() == 0


def test_union_skips_failed_frames_and_fills_columns(spark):
    a = spark.createDataFrame([("A", 1)], "symbol string, volume long")
    b = spark.createDataFrame([("B",)], "symbol string")
    assert sorted(map(tuple, sources.union_frames([a, None, b]).collect())) == [("A", 1), ("B", None)]
    assert sources.union_frames([None]) is None


def test_many_files_are_one_scan(spark, tmp_path, plan):
    paths = []
    for name in ("A", "B", "C"):
        paths.append(str(tmp_path / name))
        spark.createDataFrame([(name, DAY, 1.0, 1.0, 1.0, 1.0, 1)], RAW_BARS).write.parquet(paths[-1])
    df = sources.read_bar_files(spark, paths)
    assert df.count() == 3 and plan(df).count("FileScan") == 1


def test_zero_open_is_guarded(spark):
    df = spark.createDataFrame([(0.0, 2.0, 1.0, 1.5), (100.0, 110.0, 95.0, 105.0)],
                               "open_price double, high_price double, low_price double, close_price double")
    four = sources.with_bar_metrics(df).collect()
    assert [r.change_pct for r in four] == [None, 5.0]
    two = sources.with_bar_metrics(df, 2, 0.0, change_from_open=True).collect()
    assert [(r.daily_range, r.change_from_open, r.change_pct) for r in two] == [(1.0, 1.5, 0.0), (15.0, 5.0, 5.0)]


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.675,), (-2.675,), (1.005,), (-0.0001,), (None,)], "x double")
    got = [r[0] for r in df.select(round_stable("x", 2)).collect()]
    assert got == [2.68, -2.68, 1.01, 0.0, None] and str(got[3]) == "0.0"


def test_quick_rounding_is_the_rounding_of_the_text(spark):
    """Ties, their neighbours, odd and large values: the same double as F.round gives; most go without it."""
    odd = [None, 0.0, -0.0, float("nan"), float("inf"), float("-inf"), 1e300, -1e300, 1.005, -1.005, 1e-320, 123456789.125, 1e8 + 0.005, 2.0 ** 53]
    df = spark.createDataFrame([(v,) for v in odd], "x double").unionByName(
        spark.range(-40000, 40000).select(F.explode(F.array(F.col("id") / 200, F.col("id") / 20000, F.col("id") / 30, F.col("id") * 12345.6789)).alias("x")))
    for scale in (0, 2, 4):
        text = F.round(F.col("x") + F.signum("x") * F.lit(1e-9), scale) + F.lit(0.0)
        assert df.filter(~round_stable("x", scale).eqNullSafe(text)).isEmpty()
    assert "floor" in str(round_stable("x", 2)).lower()


def test_bars_from_ticks_order(spark):
    ticks = spark.createDataFrame(
        [("A", "NSE", dt.date(2024, 1, 1), 3, 5.0), ("A", "NSE", dt.date(2024, 1, 1), 1, 7.0),
         ("A", "NSE", dt.date(2024, 1, 1), 2, 9.0)],
        "symbol string, exchange_code string, trade_date date, seq long, px double")
    bar = sources.bars_from_ticks(ticks, "px", "seq").first()
    assert (bar.open_price, bar.high_price, bar.low_price, bar.close_price, bar.volume) == (7.0, 9.0, 5.0, 5.0, 3)


def test_ticks_combine_before_the_shuffle(spark, plan):
    ticks = spark.range(10).selectExpr("'A' symbol", "'NSE' exchange_code", "date'2024-01-01' trade_date", "id seq", "double(id) px")
    text = plan(sources.bars_from_ticks(ticks, "px", "seq"))
    assert "partial_min_by" in text and "SortAggregate" not in text


def test_resample(spark):
    days = [(dt.date(2024, 1, d), float(d)) for d in (1, 5, 8, 31)] + [(dt.date(2024, 2, 1), 50.0)]
    df = spark.createDataFrame([("A", "NSE", d, p, p + 1, p - 1, p, 10) for d, p in days],
                               "symbol string, exchange_code string, trade_date date, open_price double, "
                               "high_price double, low_price double, close_price double, volume long")
    month = {r.period_start: r for r in sources.resample_bars(df, "1mo").collect()}
    january = month[dt.date(2024, 1, 1)]
    assert (january.open_price, january.close_price, january.high_price, january.low_price, january.volume) == (1.0, 31.0, 32.0, 0.0, 40)
    weeks = sorted(r.period_start for r in sources.resample_bars(df, "1wk").collect())
    assert weeks == [dt.date(2024, 1, 1), dt.date(2024, 1, 8), dt.date(2024, 1, 29)]
    assert sources.resample_bars(df, "1d") is df
    with pytest.raises(ValueError):
        sources.resample_bars(df, "1y")


def test_sql_with_parameters_and_limit(spark, plan):
    spark.createDataFrame([("Alice", 1), ("Bob", 2)], "name string, value int").createOrReplaceTempView("people")
    got = sources.run_sql(spark, "SELECT * FROM people WHERE name = :who", {"who": "x' OR '1'='1"})
    assert got.count() == 0
    limited = sources.run_sql(spark, "SELECT * FROM people", limit=1)
    assert limited.count() == 1 and "Limit" in plan(limited)


def test_catalog_probes_and_star_schema(spark, tmp_path):
    sources.create_star_schema(spark, "star_test", str(tmp_path))
    sources.create_star_schema(spark, "star_test", str(tmp_path))
    assert sources.table_exists(spark, "star_test.fact_stock_prices")
    assert not sources.table_exists(spark, "star_test.nothing")
    names = {r.table_name for r in sources.list_tables(spark, "star_test").collect()}
    assert {"dim_exchange", "dim_symbol", "dim_date", "fact_stock_prices"} <= names
    spark.sql("INSERT INTO star_test.dim_exchange (exchange_id, exchange_code, exchange_name) VALUES (1, 'NSE', 'x')")
    row = spark.table("star_test.dim_exchange").first()
    assert (row.country, row.currency, row.timezone) == ("India", "INR", "Asia/Kolkata")
    counts = {r.table_name: r.row_count for r in sources.database_counts(spark, "star_test").collect()}
    assert counts == {"dim_exchange": 1, "dim_symbol": 0, "dim_date": 0, "fact_stock_prices": 0}


def test_scan_prunes_columns(spark, plan):
    df = sources.scan_bronze(spark, "/root/testdata/sf0.001/lineitem.parquet", columns=["l_suppkey", "l_quantity"])
    text = plan(df.filter(F.col("l_quantity") > 10))
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in text
    assert "GreaterThan(l_quantity,10.0)" in text


def test_fiscal_calendar_and_lists(spark):
    df = spark.createDataFrame([(dt.date(2026, 3, 5),), (dt.date(2026, 4, 1),), (dt.date(2026, 12, 31),)], "d date")
    assert [tuple(r) for r in df.select(fiscal_year("d"), fiscal_quarter("d")).collect()] == [(2026, 4), (2027, 1), (2027, 3)]
    assert spark.range(1).select(split_list(F.lit(" TCS.NS, ,INFY.NS,"))).first()[0] == ["TCS.NS", "INFY.NS"]


def test_parts_and_their_outcomes(spark, tmp_path):
    """Good, empty, cut short, foreign and absent files in one scan; names that need escapes."""
    root = tmp_path / "feed"
    raw = spark.createDataFrame([("S1.NS", 1.0), ("S1.NS", 2.0)], "ticker string, Open double")
    for name, df in (("a b+c%.parquet", raw), ("sub/deep/x", raw), ("sub/empty", raw.limit(0))):
        df.coalesce(1).write.parquet(str(root / name))
    whole = next((root / "sub/deep/x").glob("part-*")).read_bytes()
    (root / "cut.parquet").write_bytes(whole[:len(whole) // 2])
    (root / "nothing.parquet").write_bytes(b"")
    (root / "text.parquet").write_text("not parquet at all")
    expected = spark.createDataFrame([(p,) for p in ("a b+c%.parquet", "sub/deep", "sub/empty", "cut.parquet", "nothing.parquet", "text.parquet", "gone", "gone")], "part string")
    bars, outcomes = read_parts(spark, str(root), expected)
    assert bars.count() == 4 and set(bars.columns) == {f.name for f in RAW_BARS}
    got = {r.part: (r.status, r.row_count, r.files) for r in outcomes.collect()}
    assert got.pop("nothing.parquet")[:2] == ("empty", 0)
    assert got == {"a b+c%.parquet": ("loaded", 2, 1), "sub/deep": ("loaded", 2, 1), "sub/empty": ("empty", 0, 1), "cut.parquet": ("corrupt", 0, 1),
                   "text.parquet": ("corrupt", 0, 1), "gone": ("missing", 0, 0)}
    every = read_parts(spark, str(root))[1].collect()
    assert sorted(r.status for r in every if "nothing" not in r.part) == ["corrupt", "corrupt", "empty", "loaded", "loaded"]
    assert {r.reason for r in every if r.status == "loaded"} == {""}
