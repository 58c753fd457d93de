import datetime as dt

import pytest
from pyspark.sql import functions as F

import market_fixtures as fx
from barworks.operators import dims, incremental, upsert
from barworks.operators import gaps as gap_ops
from barworks.operators.quality import QualityGateError
from barworks.plans import sql as sql_plans
from barworks.plans import tables
from barworks.plans.gaps import GapTable
from barworks.plans.load import load_batch, run_incremental
from barworks.plans.medallion import run_medallion
from barworks.plans.state import WatermarkTable
from barworks.schemas import BAR_KEY
from barworks.session import path_exists, shared_dir, write_and_reread
from barworks.sources import read_fact

SF = "/root/testdata/sf0.001"


def day(text):
    return F.lit(text).cast("date")


def fact(bars):
    from barworks.sources import with_bar_metrics
    return tables.to_fact(with_bar_metrics(bars).withColumn("source", F.lit("feed")), "2024-01-01 00:00:00")


@pytest.fixture(scope="module")
def bars(bars, spark, tmp_path_factory):
    """A year of the bars: fewer months to write, same logic."""
    year = bars.filter(F.col("trade_date").between(day("1998-01-01"), day("1998-12-31")))
    return write_and_reread(year, str(tmp_path_factory.mktemp("year") / "bars"))


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_upsert_updates_inserts_and_is_idempotent(bars, rows):
    target = bars.filter(F.col("trade_date") < day("1998-09-01"))
    batch = bars.filter(F.col("trade_date") >= day("1998-04-01")).withColumn("close_price", F.col("close_price") + 1)
    once = upsert.upsert_bars(target, batch)
    assert once.count() == bars.count()
    assert rows(upsert.upsert_bars(once, batch)) == rows(once)
    counts = upsert.upsert_counts(target, batch).first()
    assert counts.inserted + counts.updated == counts.affected == batch.count()


def test_upsert_settles_duplicates_in_the_batch(spark):
    schema = "symbol string, exchange_code string, trade_date date, close_price double, loaded_at timestamp"
    d = dt.date(2024, 1, 1)
    batch = spark.createDataFrame([("A", "NSE", d, 1.0, dt.datetime(2024, 1, 1)), ("A", "NSE", d, 2.0, dt.datetime(2024, 1, 2))], schema)
    out = upsert.upsert_bars(spark.createDataFrame([], schema), batch).collect()
    assert [r.close_price for r in out] == [2.0]


def test_insert_absent_never_updates(spark):
    a = spark.createDataFrame([("NSE", "old")], "exchange_code string, exchange_name string")
    out = dims.dim_exchange(a, dims.exchange_seed(spark).select("exchange_code", "exchange_name"))
    assert {r.exchange_code: r.exchange_name for r in out.collect()} == {"NSE": "old", "BSE": "Bombay Stock Exchange"}


def test_table_slices_and_replays_equal_one_load(spark, bars, rows, tmp_path):
    path, whole = str(tmp_path / "fact"), fact(bars)
    pieces = fx.date_slices(whole, ["1998-04-01", "1998-09-01"])
    for piece in [*pieces, pieces[1]]:
        tables.upsert_table(spark, path, piece)
    assert rows(read_fact(spark, path)) == rows(whole)


def test_only_touched_months_are_rewritten(spark, bars, tmp_path):
    path = str(tmp_path / "fact")
    tables.upsert_table(spark, path, fact(bars))
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "fact").iterdir() if p.is_dir()}
    touched = tables.upsert_table(spark, path, fact(bars.filter(F.col("trade_date") == day("1998-05-04"))))
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "fact").iterdir() if p.is_dir()}
    assert touched == [dt.date(1998, 5, 1)]
    assert {k for k in after if after[k] != before[k]} == {"trade_month=1998-05-01"}


def test_new_keys_are_appended_and_a_torn_append_is_repaired(spark, bars, rows, tmp_path):
    path = str(tmp_path / "fact")
    month = fact(bars.filter(F.trunc("trade_date", "MM") == day("1998-05-01")))
    early, late = fx.date_slices(month, ["1998-05-15"])
    tables.upsert_table(spark, path, early)
    files = lambda: {p.name for p in (tmp_path / "fact").rglob("*.parquet")}
    before = files()
    tables.upsert_table(spark, path, late.filter("exchange_code = 'NSE'"))
    assert before < files()
    tables.upsert_table(spark, path, late)
    assert not before & files()
    assert rows(read_fact(spark, path)) == rows(month)


def test_interrupted_copy_is_finished_by_the_next_run(spark, bars, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    first, second = fx.date_slices(fact(bars), ["1998-07-01"])
    second = second.unionByName(first.filter(F.col("trade_date") >= day("1998-06-01")))
    tables.upsert_table(spark, path, first)

    def dies(*args):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(tables, "_apply", dies)
        with pytest.raises(RuntimeError):
            tables.upsert_table(spark, path, second)
    assert tables.recover(spark, path) is True
    assert rows(read_fact(spark, path)) == rows(fact(bars))
    assert tables.recover(spark, path) is False


def test_half_written_stage_is_dropped(spark, bars, rows, tmp_path):
    path = str(tmp_path / "fact")
    first, second = fx.date_slices(fact(bars), ["1998-07-01"])
    tables.upsert_table(spark, path, first)
    tables._write(second.withColumn("trade_month", F.trunc("trade_date", "MM")), tables._stage_path(spark, path))
    assert tables.recover(spark, path) is False
    assert rows(read_fact(spark, path)) == rows(first)


def test_fact_scan_prunes_months(spark, bars, plan, tmp_path):
    path = str(tmp_path / "fact")
    tables.upsert_table(spark, path, fact(bars))
    df = read_fact(spark, path, since="1998-10-15", until="1998-11-10")
    assert "trade_month" in plan(df).split("PartitionFilters: [")[1].split("]")[0]
    assert {r[0] for r in df.select(F.trunc("trade_date", "MM")).distinct().collect()} == {dt.date(1998, 10, 1), dt.date(1998, 11, 1)}


def test_incremental_extract_bounds(spark):
    bars = spark.createDataFrame(
        [(s, x, dt.date(2024, 1, d)) for s, x in [("A", "NSE"), ("A", "BSE"), ("B", "NSE")] for d in range(1, 11)],
        "symbol string, exchange_code string, trade_date date")
    state = spark.createDataFrame([("A", "NSE", "2024-01-07"), ("B", "NSE", "junk")], "symbol string, exchange_code string, watermark string")
    days = lambda df, s, x: sorted(r.trade_date.day for r in df.filter((F.col("symbol") == s) & (F.col("exchange_code") == x)).collect())
    out = incremental.incremental_extract(bars, state, "2024-01-10")
    assert days(out, "A", "NSE") == [8, 9]
    assert days(out, "A", "BSE") == days(out, "B", "NSE") == list(range(1, 10))
    out = incremental.incremental_extract(bars, state, "2024-01-10", period="5d")
    assert days(out, "A", "NSE") == [8, 9] and days(out, "A", "BSE") == [5, 6, 7, 8, 9]
    out = incremental.incremental_extract(bars, state, "2024-01-10", lookback_days=2)
    assert days(out, "A", "NSE") == [6, 7, 8, 9]
    assert days(incremental.incremental_extract(bars, state, "2024-01-08"), "A", "NSE") == []
    empty = state.limit(0)
    assert days(incremental.incremental_extract(bars, empty, "2024-01-10", period="1d"), "A", "NSE") == [9]


def test_periods(spark):
    bars = spark.sql("select explode(sequence(date'2023-01-01', date'2024-06-30')) trade_date")
    first = lambda p: incremental.period_extract(bars, "2024-06-30", p).agg(F.min("trade_date")).first()[0]
    assert [str(first(p)) for p in ("1d", "5d", "1mo", "3mo", "6mo", "1y", "max")] == [
        "2024-06-29", "2024-06-25", "2024-05-30", "2024-03-30", "2023-12-30", "2023-06-30", "2023-01-01"]
    with pytest.raises(ValueError):
        incremental.period_extract(bars, "2024-06-30", "2w")


def test_watermark_table(spark, tmp_path):
    store = WatermarkTable(spark, str(tmp_path / "state"))
    assert store.read().count() == 0 and store.get("A", "NSE") is None and store.get("A", "NSE", "x") == "x"
    loaded = lambda d: spark.createDataFrame([("A", "NSE", d), ("A", "BSE", d)], "symbol string, exchange_code string, trade_date date")
    store.advance(loaded(dt.date(2024, 6, 15)))
    store.advance(loaded(dt.date(2024, 6, 1)))
    assert store.get("A", "NSE") == dt.date(2024, 6, 15)
    store.delete("A", "NSE")
    assert store.get("A", "NSE") is None and store.get("A", "BSE") == dt.date(2024, 6, 15)
    store.set("A", "NSE", "2024-01-01")
    assert WatermarkTable(spark, store.path).get("A", "NSE") == dt.date(2024, 1, 1)
    other = WatermarkTable(spark, store.path)
    store.compact()
    assert store.read().count() == other.read().count() == 2 and other._log().count() == 2
    store.reset()
    assert store.read().count() == 0
    store.advance(loaded(dt.date(2023, 1, 1)))
    assert store.get("A", "BSE") == dt.date(2023, 1, 1)


def dated(spark, rows):
    schema = "symbol string, trade_date string, open_price double, high_price double, low_price double, close_price double, volume string"
    return spark.createDataFrame([(s, d, p, p, p, p, v) for s, d, p, v in rows], schema)


def test_a_quarantined_day_is_read_again_and_nothing_is_overwritten(spark, tmp_path):
    q, args = str(tmp_path / "q"), (str(tmp_path / "fact"), str(tmp_path / "state"))
    first = dated(spark, [("A", "2024-01-01", 1.0, "5"), ("A", "2024-01-02", 1.0, "x"), ("A", "2024-01-03", 1.0, "5"), ("B", "2024-01-03", 1.0, "5")])
    run = lambda df: run_incremental(spark, df.withColumn("exchange_code", F.lit("NSE")).withColumn("trade_date", F.col("trade_date").cast("date")),
                                     *args, as_of="2024-01-05", period="max", quarantine_path=q)
    assert run(first).rows_quarantined == 1
    marks = {r.symbol: r.watermark for r in WatermarkTable(spark, args[1]).read().collect()}
    assert marks == {"A": dt.date(2024, 1, 3), "B": dt.date(2024, 1, 3)}
    assert [(r.symbol, r.gaps) for r in GapTable(spark, args[1]).read().collect()] == [("A", [(dt.date(2024, 1, 2), dt.date(2024, 1, 2))])]
    assert run(first).rows_quarantined == 1 and spark.read.parquet(q).count() == 1
    mended = dated(spark, [("A", "2024-01-02", 2.0, "6"), ("A", "2024-01-03", 1.0, "5"), ("B", "2024-01-03", 1.0, "5")])
    result = run(mended)
    assert (result.rows_inserted, result.rows_updated, result.rows_quarantined) == (1, 0, 0) and spark.read.parquet(q).count() == 1
    assert read_fact(spark, args[0]).count() == 4
    assert WatermarkTable(spark, args[1]).get("A", "NSE") == dt.date(2024, 1, 3) and GapTable(spark, args[1]).days().isEmpty()
    assert run(dated(spark, [("A", "2024-01-04", 1.0, "y")])).rows_quarantined == 1 and spark.read.parquet(q).count() == 2


def test_a_bad_day_holds_back_only_itself(spark, tmp_path):
    """Loads of 3, 6 and 9 days with one bad day read the new days and the gap, and keep the bad row once."""
    q, args = str(tmp_path / "q"), (str(tmp_path / "fact"), str(tmp_path / "state"))
    feed = lambda bad: dated(spark, [("A", f"2024-01-{k:02}", 1.0, "x" if k in bad else "5") for k in range(1, 13)]).withColumn(
        "exchange_code", F.lit("NSE")).withColumn("trade_date", F.col("trade_date").cast("date"))
    run = lambda bad, to: run_incremental(spark, feed(bad), *args, as_of=f"2024-01-{to:02}", period="max", quarantine_path=q)
    results = [run({2}, to) for to in (4, 7, 10)]
    assert [r.rows_in for r in results] == [3, 4, 4] and [r.rows_updated for r in results] == [0, 0, 0]
    assert spark.read.parquet(q).count() == 1
    gaps = GapTable(spark, args[1])
    # A correction that is bad again opens no second gap; a day of good rows that turns bad does.
    assert run({2, 10, 11}, 13).rows_quarantined == 3
    assert [r.gaps for r in gaps.read().collect()] == [[(dt.date(2024, 1, 2), dt.date(2024, 1, 2)), (dt.date(2024, 1, 10), dt.date(2024, 1, 11))]]
    gaps.release(first="2024-01-11")
    assert run({11}, 13).rows_in == 2 and gaps.days().isEmpty()
    assert run({11}, 13).rows_in == 0 and read_fact(spark, args[0]).count() == 11
    WatermarkTable(spark, args[1]).reset()
    assert run(set(), 13).rows_in == 12
    gaps.release(spark.createDataFrame([("A", "NSE")], "symbol string, exchange_code string"))
    assert gaps.days().isEmpty()


def test_gaps_are_read_once_and_within_bounds(spark, plan):
    days = lambda *d: spark.createDataFrame([("A", "NSE", dt.date(2024, 1, k)) for k in d], "symbol string, exchange_code string, trade_date date")
    bars, state = days(*range(1, 15)), incremental.watermark_candidates(days(8))
    gaps = gap_ops.as_intervals(days(2, 3, 5, 8))
    assert gaps.first().gaps == [(dt.date(2024, 1, 2), dt.date(2024, 1, 3)), (dt.date(2024, 1, 5),) * 2, (dt.date(2024, 1, 8),) * 2]
    read = lambda **o: sorted(r.trade_date.day for r in incremental.incremental_extract(bars, state, "2024-01-11", gaps=gaps, **o).collect())
    assert read() == [2, 3, 5, 8, 9, 10]
    assert read(lookback_days=4) == [2, 3, 5, 6, 7, 8, 9, 10]
    assert read(period="5d") == [2, 3, 5, 8, 9, 10]
    assert [r.trade_date.day for r in incremental.incremental_extract(bars, state.limit(0), "2024-01-11", period="5d", gaps=gaps).orderBy("trade_date").collect()] == [2, 3, 5, 6, 7, 8, 9, 10]
    after = gap_ops.gap_advance(days(2, 3, 5, 8), days(3, 9), days(9, 10).withColumn("symbol", F.when(F.col("trade_date") < "2024-01-20", F.col("symbol"))))
    assert sorted(r.trade_date.day for r in after.collect()) == [2, 5, 8, 10]


def test_a_move_that_stops_half_way_is_finished(spark, bars, rows, tmp_path, monkeypatch):
    """Months are moved one by one: after a stop some are new and some old, and the next run moves the rest."""
    path, moved = str(tmp_path / "fact"), []
    tables.upsert_table(spark, path, fact(bars))
    batch = fact(bars.withColumn("close_price", F.col("close_price") + 1))
    move = tables.replace_path

    def some(session, source, target):
        if len(moved) == 3:
            raise RuntimeError("stopped")
        moved.append(target)
        move(session, source, target)

    with monkeypatch.context() as m:
        m.setattr(tables, "replace_path", some)
        with pytest.raises(RuntimeError):
            tables.upsert_table(spark, path, batch)
    assert tables.recover(spark, path) is True and not path_exists(spark, tables._stage_path(spark, path))
    assert rows(read_fact(spark, path), *sorted(batch.columns)) == rows(batch, *sorted(batch.columns))


def test_days_are_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "summary")
    schema = "trade_date date, part string, n long"
    frame = lambda *r: spark.createDataFrame([(dt.date(2024, m, k), part, n) for m, k, part, n in r], schema)
    tables.create_table(spark, path, frame((1, 1, "a", 1), (1, 1, "b", 1), (1, 2, "a", 1), (2, 1, "a", 1), (3, 1, "a", 1)))
    days = frame((1, 1, "", 0), (2, 1, "", 0)).select("trade_date")
    assert len(tables.replace_days(spark, path, frame((1, 1, "a", 5), (2, 1, "c", 6)), days)) == 2
    assert sorted((r.trade_date.month, r.trade_date.day, r.part, r.n) for r in read_fact(spark, path).collect()) == [
        (1, 1, "a", 5), (1, 2, "a", 1), (2, 1, "c", 6), (3, 1, "a", 1)]
    assert tables.replace_days(spark, path, frame(), days.limit(0)) == []


def test_torn_first_loads_are_repeated(spark, bars, rows, tmp_path):
    path = str(tmp_path / "fact")
    (tmp_path / "fact" / "_temporary" / "0").mkdir(parents=True)
    assert not tables.has_data(spark, path)
    tables.upsert_table(spark, path, fact(bars.limit(50)))
    assert read_fact(spark, path).count() == 50
    assert tables._stage_path(spark, path) == tables._stage_path(spark, "file:" + path + "/")


def test_rows_without_a_key_and_infinite_prices_are_refused(spark, bars, tmp_path):
    metrics = str(tmp_path / "metrics")
    with pytest.raises(QualityGateError):
        load_batch(spark, bars.limit(3).withColumn("close_price", F.lit(-1.0)), str(tmp_path / "no"), metrics_path=metrics)
    assert [r.status for r in spark.read.parquet(metrics).collect()] == ["FAILED"]
    with pytest.raises(ValueError, match="without symbol"):
        tables.upsert_table(spark, str(tmp_path / "fact"), fact(bars.limit(3)).withColumn("symbol", F.lit(None).cast("string")))
    with pytest.raises(Exception, match="open_price is infinite"):
        fact(bars.limit(3).withColumn("open_price", F.lit(float("inf")))).collect()


def test_a_failing_select_leaves_the_table(spark):
    sql_plans.create_table_as(spark, "kept_table", "SELECT 1 AS a")
    with pytest.raises(Exception):
        sql_plans.create_table_as(spark, "kept_table", "SELECT raise_error('no') AS a")
    assert spark.table("kept_table").collect()[0].a == 1


def test_a_table_with_a_location_is_replaced_when_the_new_one_is_whole(spark, tmp_path):
    place = tmp_path / "placed"
    for value in (1, 2):
        sql_plans.create_table_as(spark, "placed_table", f"SELECT {value} AS a", location=str(place))
    with pytest.raises(Exception):
        sql_plans.create_table_as(spark, "placed_table", "SELECT raise_error('no') AS a", location=str(place))
    assert spark.table("placed_table").collect()[0].a == 2
    assert [len(list(f.glob("part-*"))) for f in place.iterdir() if list(f.glob("part-*"))] == [1]


def test_load_batch_moves_the_watermark_only_after_success(spark, bars, tmp_path):
    f, s = str(tmp_path / "fact"), str(tmp_path / "state")
    broken = bars.withColumn("close_price", F.when(F.col("symbol") == "S1", -1.0).otherwise(F.col("close_price")))
    with pytest.raises(QualityGateError):
        load_batch(spark, broken, f, s)
    assert not path_exists(spark, f) and not path_exists(spark, s)
    result = load_batch(spark, broken, f, s, quarantine_path=str(tmp_path / "q"), batch_id=7)
    bad = bars.filter("symbol = 'S1'").count()
    assert (result.rows_in, result.rows_quarantined, result.rows_loaded) == (bars.count(), bad, bars.count() - bad)
    assert spark.read.parquet(str(tmp_path / "q" / "batch_id=7")).count() == bad
    assert WatermarkTable(spark, s).read().count() == 20 and GapTable(spark, s).days().count() == bad
    assert load_batch(spark, bars.limit(0), f, s).rows_in == 0
    assert load_batch(spark, bars, f, s, dry_run=True).rows_loaded == 0
    assert read_fact(spark, f).count() == bars.count() - bad


def test_incremental_runs_equal_one_full_load(spark, bars, rows, tmp_path):
    f, s = str(tmp_path / "fact"), str(tmp_path / "state")
    for as_of in ("1998-04-01", "1998-09-01", "1998-09-01", "1999-01-01"):
        run_incremental(spark, bars, f, s, as_of, period="max", loaded_at="2024-01-01 00:00:00")
    got = fx.plain(read_fact(spark, f), *bars.columns)
    assert rows(got) == rows(bars)


def test_medallion_tables_and_metrics(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS layers")
    out = run_medallion(spark, fx.dirty_bronze(spark, SF), database="layers", dim_symbol=fx.listings(spark, SF))
    metrics = {r.layer: (r.rows, r.status) for r in out["run_metrics"].collect()}
    assert metrics["silver"] == metrics["gold"] == (out["gold"].count(), "OK")
    assert {"_silver_loaded_at", "_source", "_gold_loaded_at"} <= set(out["gold"].columns)
    assert spark.table("layers.gold_sector_summary").count() == out["sector"].count() > 0
    kept = []
    with pytest.raises(Exception):
        run_medallion(spark, fx.dirty_bronze(spark, SF), database="no_such_db", metrics=kept)
    assert kept[0][3] == "FAILED" and kept[0][4]


def test_sql_layers_as_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sqllayers")
    fx.dirty_bronze(spark, SF).createOrReplaceTempView("bronze_rows")
    s = sql_plans.create_table_as(spark, "sqllayers.silver", sql_plans.silver_select("bronze_rows"))
    g = sql_plans.create_table_as(spark, "sqllayers.gold", sql_plans.gold_select("sqllayers.silver"))
    t = sql_plans.create_table_as(spark, "sqllayers.summary", sql_plans.summary_select("sqllayers.gold"))
    assert s.count() == g.count() and t.count() > 0
    assert s.select(*BAR_KEY).distinct().count() < s.count()


def test_dimension_of_listings(spark):
    fact_rows = spark.createDataFrame([("A", "NSE", dt.date(2024, 1, 1)), ("B", "NSE", dt.date(2024, 1, 2))],
                                      "symbol string, exchange_code string, trade_date date")
    existing = dims.listings_in(fact_rows.filter("symbol = 'A'")).withColumn("sector", F.lit("old"))
    described = spark.createDataFrame([("A", "NSE", "new")], "symbol string, exchange_code string, sector string")
    got = {r.symbol: (r.sector, r.symbol_id) for r in dims.dim_symbol_scd1(existing, described, fact_rows).collect()}
    assert got["A"][0] == "new" and got["B"][0] == ""
    again = {r.symbol: r.symbol_id for r in dims.listings_in(fact_rows.repartition(5)).collect()}
    assert again == {k: v[1] for k, v in got.items()}


def test_default_calendar(spark):
    days = dims.dim_date(spark)
    assert days.count() == 4018
    row = days.filter("date_key = date'2026-03-05'").first()
    assert (row.day_name, row.day_of_week, row.month_name, row.fiscal_year, row.fiscal_quarter) == ("Thu", 4, "Mar", 2026, 4)
    ends = days.filter("is_quarter_end and year = 2024").orderBy("date_key").collect()
    assert [str(r.date_key) for r in ends] == ["2024-03-31", "2024-06-30", "2024-09-30", "2024-12-31"]
    holiday = spark.createDataFrame([(dt.date(2026, 3, 5),)], "d date")
    assert not dims.dim_date(spark, holidays=holiday).filter("date_key = date'2026-03-05'").first().is_trading_day


def test_keys_the_suite_found_unique_are_not_counted_again(bars, tmp_path, monkeypatch):
    from barworks.plans import load
    settled = []
    monkeypatch.setattr(load, "upsert_table", lambda *a, settle=True, **k: settled.append(settle) or tables.upsert_table(*a, settle=settle, **k))
    few = bars.filter("symbol IN ('S1', 'S2')")
    load_batch(bars.sparkSession, few, str(tmp_path / "fact"))
    load_batch(bars.sparkSession, few.unionByName(few), str(tmp_path / "fact"))
    load_batch(bars.sparkSession, few, str(tmp_path / "fact"), checks=[])
    assert settled == [False, True, True]
    assert read_fact(bars.sparkSession, str(tmp_path / "fact")).count() == few.count()


def test_missing_state_is_read_without_python_tasks(spark, plan, tmp_path):
    for frame in (GapTable(spark, str(tmp_path / "none")).days(), WatermarkTable(spark, str(tmp_path / "none")).read()):
        assert frame.isEmpty() and "ExistingRDD" not in plan(frame)
