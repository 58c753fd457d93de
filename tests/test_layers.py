import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from barworks.operators import analytics, gold, ranks, silver, summary
from barworks.schemas import BAR_KEY
from barworks.session import write_and_reread

SCHEMA = ("symbol string, exchange_code string, trade_date string, open_price string, high_price string, "
          "low_price string, close_price string, volume string, loaded_at timestamp")


def raw(spark, *bars):
    base = dict(symbol="A", exchange_code="NSE", trade_date="2024-01-01", open_price="1", high_price="2",
                low_price="1", close_price="1.5", volume="10", loaded_at=dt.datetime(2024, 1, 1))
    return spark.createDataFrame([tuple({**base, **b}.values()) for b in bars], SCHEMA)


def test_bad_values_become_null_and_are_filtered(spark):
    df = raw(spark, dict(close_price="n/a"), dict(trade_date="bad"), dict(symbol=None), dict(close_price="NaN"),
             dict(close_price=None), dict(symbol="B", open_price="oops", volume="x"))
    out = silver.bronze_to_silver(df).collect()
    assert [(r.symbol, r.open_price, r.volume) for r in out] == [("B", None, None)]


def test_late_bad_copy_does_not_delete_the_good_row(spark):
    df = raw(spark, dict(), dict(close_price=None, loaded_at=dt.datetime(2024, 1, 2)))
    assert [r.close_price for r in silver.bronze_to_silver(df).collect()] == [1.5]


def test_last_loaded_copy_wins_and_ties_are_deterministic(spark):
    later = dt.datetime(2024, 1, 3)
    df = raw(spark, dict(close_price="1"), dict(close_price="2", loaded_at=later), dict(close_price="3", loaded_at=later))
    for n in (1, 3, 7):
        assert [r.close_price for r in silver.bronze_to_silver(df.repartition(n)).collect()] == [3.0]


def test_copies_are_reduced_before_the_shuffle(spark, plan):
    text = plan(silver.dedupe_bars(raw(spark, dict())))
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text


def test_same_symbol_on_two_exchanges_is_not_mixed(spark, bars):
    df = spark.createDataFrame(
        [("A", x, dt.date(2024, 1, d), 1.0, c, 10) for x, d, c in
         [("NSE", 1, 100.0), ("BSE", 1, 10.0), ("NSE", 2, 110.0), ("BSE", 2, 9.0)]],
        "symbol string, exchange_code string, trade_date date, open_price double, close_price double, volume long")
    got = {(r.exchange_code, r.trade_date.day): r.daily_return_pct for r in gold.silver_to_gold(df).collect()}
    assert got == {("NSE", 1): None, ("BSE", 1): None, ("NSE", 2): 10.0, ("BSE", 2): -10.0}


def test_zero_previous_close_gives_no_return(spark):
    df = spark.createDataFrame([("A", "NSE", dt.date(2024, 1, d), c, 1) for d, c in [(1, 0.0), (2, 5.0), (3, 10.0)]],
                               "symbol string, exchange_code string, trade_date date, close_price double, volume long")
    got = gold.silver_to_gold(df).orderBy("trade_date").collect()
    assert [r.daily_return_pct for r in got] == [None, None, 100.0]
    assert [r.volatility_30d for r in got] == [None, None, None]
    assert [r.ma_7d for r in got] == [0.0, 2.5, 5.0]


def test_gold_does_not_depend_on_input_order(bars, rows):
    one = gold.silver_to_gold(bars)
    other = gold.silver_to_gold(bars.repartition(13, "volume"))
    assert rows(one) == rows(other)


def test_indicators_share_one_shuffle_and_one_sort(bars, plan):
    text = plan(gold.listing_indicators(bars))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 1
    assert text.count("stddev_samp(") == 1 and text.count("avg(") == 2
    assert "Python" not in text


def test_ranks_equal_window_functions_with_ties_nulls_and_negatives(spark, rows):
    df = spark.range(5000).select(
        F.col("id").alias("n"), (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 2 == 0, F.lit(0))
        .otherwise(F.pmod(F.hash("id"), F.lit(900)).cast("bigint") * 40_000_003 - 9_000_000_000).cast("bigint").alias("v"))
    day = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    want = df.select("n", F.dense_rank().over(day).cast("bigint").alias("r"))
    assert rows(ranks.volume_rank(df, ["g"], "v", "r").select("n", "r")) == rows(want)

    keyed = df.filter("v is not null").withColumn("k", ranks.rank_key("v"))
    both = ranks.attach_ranks(keyed, ranks.value_ranks(keyed, ["g"], "k"), ["g"], "k",
                              {"rank_desc": "down", "rank_asc": "up"})
    up = Window.partitionBy("g").orderBy("v")
    want = keyed.select("n", F.rank().over(day).cast("bigint").alias("down"), F.rank().over(up).cast("bigint").alias("up"))
    assert rows(both.select("n", "down", "up")) == rows(want)


def test_no_window_holds_a_whole_day_of_rows(bars, plan):
    text = plan(ranks.volume_rank(bars))
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert windows and all("_range" in line for line in windows)


def test_gold_delta_equals_full_rebuild(bars, rows):
    day = lambda t: F.lit(t).cast("date")
    hit = F.col("trade_date").between(day("1998-03-01"), day("1998-03-10"))
    before = bars.filter(~(hit & (F.col("symbol") == "S3")))
    after = bars.withColumns({
        "close_price": F.when(hit, F.col("close_price") * 2).otherwise(F.col("close_price")),
        "volume": F.when(hit, F.col("volume") + 5).otherwise(F.col("volume"))})
    old, changed = gold.silver_to_gold(before), after.filter(hit).select(*BAR_KEY)
    full = gold.silver_to_gold(after)
    since = "1998-02-20"
    listed = bars.groupBy("symbol", "exchange_code").agg(F.min("trade_date").alias("listed_date"))
    young = listed.withColumn("listed_date", day("1998-02-25"))
    assert gold.short_listings(after, changed, since, listed).count() > 0
    assert gold.short_listings(after, changed, since, young).isEmpty()
    assert gold.short_listings(after, changed, "1990-01-01").isEmpty()
    older = gold.short_listings(after, changed, since)
    for bound in ({}, {"since": since, "older": older}, {"since": "1990-01-01"}):
        delta = gold.gold_delta(after, old, changed, **bound)
        merged = old.join(delta, BAR_KEY, "left_anti").unionByName(delta)
        assert rows(merged) == rows(full)
        assert delta.count() < full.count() / 2


def test_delta_windows_read_only_rows_near_a_change(spark, bars):
    """As by brute force: at most 30 rows lie between a kept row and a changed one; hits follow their change."""
    places = {("S1", 70), ("S1", 71), ("S1", 200), ("S2", 0), ("S3", 149), ("S4", 5), ("S4", 14)}
    days = {"S1": 250, "S2": 90, "S3": 150, "S4": 15, "S5": 40}
    rows = [(s, "NSE", n, 1 if (s, n) in places else None) for s, count in days.items() for n in range(count)]
    history = spark.createDataFrame(rows, "symbol string, exchange_code string, n int, _changed int").withColumn(
        "trade_date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("n")))
    got = {(r.symbol, r.n, r._hit) for r in gold.near_changes(history).collect()}
    changes = lambda s: [c for name, c in places if name == s]
    assert got == {(s, n, any(0 <= n - c <= 30 for c in changes(s))) for s, count in days.items() for n in range(count)
                   if any(-30 <= n - c <= 30 for c in changes(s))}


def test_written_ranks_meet_rows_where_they_are(bars, plan, rows, tmp_path):
    volumes = bars.select(*BAR_KEY, "volume")
    written = write_and_reread(ranks.volume_ranks(volumes), str(tmp_path / "ranks"))
    out = ranks.volume_rank(volumes, ranks=written)
    assert rows(out) == rows(ranks.volume_rank(volumes))
    assert "_volume_key" not in "".join(line for line in plan(out).splitlines() if "hashpartitioning" in line)


def test_return_and_averages_share_one_window_step(bars, plan):
    """The long average and the volatility read one frame; before, each was a step of its own with its own."""
    steps = [line for line in plan(gold.listing_indicators(bars)).splitlines() if "windowspecdefinition" in line]
    assert any("stddev_samp" in line and "avg(" in line for line in steps)


def test_summary_variants(bars, rows):
    g = gold.silver_to_gold(bars)
    a = summary.daily_summary(g)
    b = summary.daily_summary(g, spread=summary.return_volatility())
    assert a.count() == b.count() and "avg_volatility" in a.columns and "return_volatility" in b.columns


def test_latest_bars_is_one_scan_with_partial_aggregation(bars, plan, rows):
    out = analytics.latest_bars(bars)
    text = plan(out)
    assert text.count("FileScan") == 1 and "partial_max_by" in text and "Window" not in text
    last = bars.groupBy("symbol", "exchange_code").agg(F.max("trade_date").alias("trade_date"))
    assert rows(out) == rows(bars.join(last, BAR_KEY))


def test_listing_filter_reaches_the_scan(bars, plan):
    text = plan(analytics.day_over_day(bars, "S1", "NSE", rows=30))
    assert "EqualTo(symbol,S1)" in text and "EqualTo(exchange_code,NSE)" in text
    assert "high_price" not in text
    assert analytics.day_over_day(bars, "S1", "NSE", rows=30).count() == 30


def test_latest_days_are_cut_before_the_shuffle(bars, plan, rows):
    for query, n, reach in ((analytics.day_over_day, 30, 31), (analytics.moving_averages, 60, 89)):
        cut = query(bars, rows=n)
        assert f"row_number(), {reach}, Partial" in plan(cut)
        newest = Window.partitionBy("symbol", "exchange_code").orderBy(F.col("trade_date").desc())
        whole = query(bars).withColumn("n", F.row_number().over(newest)).filter(F.col("n") <= n).drop("n")
        assert rows(cut) == rows(whole)


def test_reports_are_ordered_and_top_n_needs_no_full_sort(bars, plan):
    stats = analytics.price_stats(bars)
    top = analytics.report(stats, "price_stats", 5)
    assert "TakeOrderedAndProject(limit=5" in plan(top)
    shown = [r.avg_close_price for r in analytics.report(stats, "price_stats").collect()]
    assert shown == sorted(shown, reverse=True) and [r.avg_close_price for r in top.collect()] == shown[:5]


def test_gainers_losers_keep_ties(spark):
    df = spark.createDataFrame(
        [("S%d" % i, "NSE", dt.date(2024, 1, 1), 1.0, c) for i, c in enumerate([5.0, 5.0, 5.0, 1.0, -2.0, None])],
        "symbol string, exchange_code string, trade_date date, close_price double, change_pct double")
    got = sorted((r.change_pct, r.gain_rank, r.loss_rank) for r in analytics.gainers_losers(df, k=1).collect())
    assert got == [(-2.0, 5, 1), (5.0, 1, 3), (5.0, 1, 3), (5.0, 1, 3)]


def test_monthly_returns_are_hash_aggregated(bars, plan):
    text = plan(analytics.monthly_returns(bars))
    assert "SortAggregate" not in text and "Window" not in text


def test_ranks_use_the_whole_value_and_nan_is_missing(spark):
    rows = [("A", 1.00001), ("B", 1.00002), ("C", float("nan")), ("D", None), ("E", -2.0), ("F", 1e300), ("G", float("inf"))]
    df = spark.createDataFrame([(s, "NSE", dt.date(2024, 1, 1), 1.0, c) for s, c in rows],
                               "symbol string, exchange_code string, trade_date date, close_price double, change_pct double")
    got = {r.symbol: (r.gain_rank, r.loss_rank) for r in analytics.gainers_losers(df).collect()}
    assert got == {"G": (1, 5), "F": (2, 4), "B": (3, 3), "A": (4, 2), "E": (5, 1)}
    volumes = df.select("trade_date", "symbol", F.col("change_pct").alias("volume"))
    assert {r.symbol: r.volume_rank for r in ranks.volume_rank(volumes).collect()} == {"G": 1, "F": 2, "B": 3, "A": 4, "E": 5, "C": 6, "D": 6}
    exact = df.filter("symbol IN ('A', 'B', 'E')").withColumn("change_pct", F.col("change_pct").cast("decimal(18,6)"))
    assert {r.symbol: r.gain_rank for r in analytics.gainers_losers(exact).collect()} == {"B": 1, "A": 2, "E": 3}


def test_latest_days_share_one_order(bars, plan):
    for df in (analytics.day_over_day(bars, rows=30), analytics.moving_averages(bars, rows=60)):
        assert "trade_date#" in plan(df) and "trade_date ASC" not in plan(df)


def test_cross_signals(spark):
    df = spark.createDataFrame([("A", "NSE", dt.date(2024, 1, d), a, b) for d, a, b in
                                [(1, 1.0, 2.0), (2, 3.0, 2.0), (3, 2.0, 2.0), (4, 1.0, 2.0)]],
                               "symbol string, exchange_code string, trade_date date, ma_7d double, ma_30d double")
    got = [(r.trade_date.day, r.signal) for r in gold.moving_average_cross(df).orderBy("trade_date").collect()]
    assert got == [(2, "golden"), (4, "death")]
