import datetime as dt

import pytest
from pyspark.sql import functions as F

from barworks.operators import contracts
from barworks.operators import quality as q

BAR = ("symbol string, exchange_code string, trade_date date, open_price double, high_price double, "
       "low_price double, close_price double, volume long")


def bars(spark, n=5, **first):
    out = []
    for i in range(n):
        row = dict(symbol="TCS", exchange_code="NSE", trade_date=dt.date(2024, 1, 1 + i), open_price=3800.0,
                   high_price=3900.0, low_price=3700.0, close_price=3850.0, volume=1_000_000)
        out.append(tuple({**row, **(first if i == 0 else {})}.values()))
    return spark.createDataFrame(out, BAR)


def one(df, check):
    return q.run_suite(df, [check]).first()


def table(spark, rows):
    return spark.createDataFrame(rows, "symbol string, price double, volume long, trade_date string")


BASE = [("TCS", 3800.0, 100000, "2024-01-01"), ("INFY", 1500.0, 200000, "2024-01-01"), ("RELIANCE", 2400.0, 150000, "2024-01-01")]


def test_not_null(spark):
    assert one(table(spark, BASE), q.not_null("price")).passed
    bad = one(table(spark, [*BASE, (None, float("nan"), 1, None)]), q.not_null("price"))
    assert (bad.passed, bad.failed_rows, bad.checked_rows, bad.failed_pct) == (False, 1, 4, 25.0)
    missing = one(table(spark, BASE), q.not_null("nope"))
    assert not missing.passed and "nope" in missing.detail
    assert one(table(spark, []), q.not_null("price")).passed


def test_unique_counts_extra_rows_and_nulls_as_equal(spark):
    assert one(table(spark, BASE), q.unique("symbol")).passed
    assert one(table(spark, [*BASE, BASE[0]]), q.unique("symbol")).failed_rows == 1
    assert one(table(spark, [(None, 1.0, 1, None), (None, 2.0, 2, None)]), q.unique("symbol")).failed_rows == 1
    assert one(table(spark, [*BASE, ("TCS", 1.0, 1, "2024-01-02")]), q.unique(["symbol", "trade_date"])).passed


def test_in_range_is_inclusive_and_ignores_missing(spark):
    df = table(spark, [("A", -100.0, 1, None), ("B", 0.0, 2, None), ("C", float("nan"), 3, None), ("D", None, 4, None), ("E", 10.0, 5, None)])
    assert one(df, q.in_range("price", 0)).failed_rows == 1
    both = one(df, q.in_range("price", 0, 9))
    assert (both.failed_rows, both.checked_rows) == (2, 3)
    assert one(df, q.in_range("volume", 1, 5)).passed
    assert one(df, q.in_range("symbol", 0)).checked_rows == 0


def test_row_count_freshness_schema_custom(spark):
    df = table(spark, BASE)
    assert one(df, q.row_count_between(1, 3)).passed
    assert not one(df, q.row_count_between(4)).passed
    assert not one(df, q.row_count_between(1, 2)).passed
    assert one(df, q.freshness("trade_date", "2024-01-04")).passed
    assert not one(df, q.freshness("trade_date", "2024-01-05")).passed
    assert not one(table(spark, [("A", 1.0, 1, "junk")]), q.freshness("trade_date", "2024-01-04")).passed
    assert one(df, q.schema_match(["symbol", "price"])).passed
    lost = one(df, q.schema_match(["symbol", "zeta", "alpha"]))
    assert (lost.passed, lost.detail) == (False, "missing columns: alpha, zeta")
    assert one(df, q.custom_check("m", F.max("price") < 5000)).passed
    assert not one(df, q.custom_check("m", F.max("price") < 5)).passed
    broken = one(df, q.custom_check("m", F.max("not_there") < 5))
    assert not broken.passed and "could not run" in broken.detail


def test_bar_suite_and_gate(spark):
    assert len(q.bar_suite()) == 11
    assert all(r.passed for r in q.enforce(bars(spark), q.bar_suite()))
    assert q.enforce(bars(spark, 0), q.bar_suite()) == []
    for first in (dict(symbol=None), dict(close_price=-100.0), dict(close_price=float("nan"))):
        with pytest.raises(q.QualityGateError):
            q.enforce(bars(spark, **first), q.bar_suite())
    with pytest.raises(q.QualityGateError) as e:
        q.enforce(bars(spark), q.bar_suite(max_rows=3))
    assert e.value.failed == ["row_count(1..3)"]


def test_a_check_that_raises_fails_alone(spark):
    risky = q.custom_check("raises", F.max(F.col("symbol").cast("int")) > 0)
    with pytest.raises(q.QualityGateError) as e:
        q.enforce(bars(spark), [*q.bar_suite(), risky])
    assert e.value.failed == ["raises"]


def test_warnings_do_not_halt(spark):
    twice = bars(spark).unionByName(bars(spark))
    results = q.enforce(twice, q.bar_suite())
    assert [r.check_name for r in results if not r.passed] == ["unique(symbol+exchange+date)"]
    row = q.suite_summary(q.run_suite(twice, q.bar_suite(), "s")).first()
    assert tuple(row) == ("s", 11, 10, 1, 0, "PASSED")


def test_suite_reads_the_data_once_per_kind_of_check(spark, tmp_path, plan):
    path = str(tmp_path / "b")
    bars(spark).write.parquet(path)
    text = plan(q.run_suite(spark.read.parquet(path), q.bar_suite()))
    assert text.count("FileScan") == 2


def test_counts_do_not_depend_on_partitioning(spark):
    df = bars(spark, 20, symbol=None)
    got = {tuple(map(tuple, q.run_suite(df.repartition(n), q.bar_suite()).orderBy("check_no").collect())) for n in (1, 4, 9)}
    assert len(got) == 1


def test_bar_contract(spark):
    rows = [(" tcs ", None, "2024-01-01", "100", "110", "95", "105", None),
            ("A", "NSE", "2024-01-01", "-1", "110", "95", "105", 1),
            ("A", "NSE", "2024-01-01", "100", "90", "95", "105", -5),
            (None, "NSE", "bad", "x", "110", "95", "NaN", 1)]
    df = spark.createDataFrame(rows, "symbol string, exchange_code string, trade_date string, open_price string, "
                                     "high_price string, low_price string, close_price string, volume long")
    got = contracts.row_contract_bars(df).collect()
    assert (got[0].symbol, got[0].exchange_code, got[0].volume, got[0].violations) == ("TCS", "NSE", 0, [])
    assert got[1].violations == ["open_price_negative"]
    assert got[2].violations == ["volume_negative", "high_below_low"]
    assert got[3].violations == ["symbol_missing", "trade_date_missing", "open_price_missing", "close_price_missing"]
    strict = contracts.row_contract_bars(df, strict=True).collect()
    assert strict[2].violations[-2:] == ["open_outside_range", "close_outside_range"]
    valid, bad = contracts.split_valid(contracts.row_contract_bars(df))
    assert (valid.count(), bad.count()) == (1, 3)
    counts = {r.reason: r.row_count for r in contracts.quarantine_counts(contracts.row_contract_bars(df)).collect()}
    assert counts["high_below_low"] == 1 and len(counts) == 7


def test_symbol_contract(spark):
    df = spark.createDataFrame([("tcs", "nse"), ("", "NSE"), ("X", "NYSE"), (None, None)], "symbol string, exchange_code string")
    got = [(r.symbol, r.exchange_code, r.violations) for r in contracts.row_contract_symbols(df).collect()]
    assert got == [("TCS", "NSE", []), ("", "NSE", ["symbol_empty"]), ("X", "NYSE", ["exchange_unknown"]),
                   (None, "NSE", ["symbol_empty"])]
