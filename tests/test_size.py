"""Steps whose cost must not multiply with the input: what is parsed, sorted or read more often than needed."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

import market_fixtures as fx
from barworks.operators import contracts
from barworks.plans import listings, tables
from barworks.plans.load import load_batch
from barworks.plans.medallion import run_medallion
from barworks.session import write_and_reread
from barworks.sources import read_fact, read_parts, with_bar_metrics


def test_a_contract_parses_every_value_once(spark, plan):
    text = "symbol string, exchange_code string, trade_date string, open_price string, high_price string, low_price string, close_price string, volume string"
    dirty = spark.createDataFrame([("s1", "NSE", "2024-01-02", "1", "2", "1", "n/a", "1.0")], text)
    for frame in (*contracts.split_valid(contracts.row_contract_bars(dirty)), contracts.quarantine_counts(contracts.row_contract_bars(dirty))):
        physical = plan(frame.select("*"))
        for c in ("trade_date", "open_price", "close_price"):
            assert physical.count(f"try_cast({c}#") <= 1


@pytest.mark.parametrize("kind, given, volume, broken", [
    ("string", "12", 12, False), ("string", "12.0", 12, False), ("string", "1.5", None, True), ("string", "x", None, True),
    ("string", "Infinity", None, True), ("string", "NaN", 0, False), ("string", None, 0, False), ("double", 7.0, 7, False),
    ("double", float("nan"), 0, False), ("double", 0.5, None, True), ("bigint", 2 ** 53 + 1, 2 ** 53 + 1, False), ("bigint", None, 0, False)])
def test_volumes_under_the_contract(spark, kind, given, volume, broken):
    bar = spark.createDataFrame([(given,)], f"volume {kind}").select(
        F.lit("S1").alias("symbol"), F.lit("2024-01-02").alias("trade_date"),
        *[F.lit(1.0).alias(c) for c in ("open_price", "high_price", "low_price", "close_price")], "volume")
    row = contracts.row_contract_bars(bar).first()
    assert row["volume"] == volume and ("volume_unparsable" in row["violations"]) == broken
    assert row.__fields__ == [*bar.columns, "exchange_code", "source", "violations"]


def test_outcomes_open_every_file_once(spark, tmp_path, plan):
    for n in range(3):
        spark.range(n + 1).select(F.lit("s1.ns").alias("ticker")).coalesce(1).write.parquet(f"{tmp_path}/in/part{n}")
    expected = spark.createDataFrame([("part0",), ("part2",), ("part9",)], "part string")
    _, outcomes = read_parts(spark, f"{tmp_path}/in", expected)
    assert sorted(map(tuple, outcomes.select("part", "status", "row_count").collect())) == [
        ("part0", "loaded", 1), ("part2", "loaded", 3), ("part9", "missing", 0)]
    assert f"{tmp_path}/in" not in plan(outcomes)


def _fact(bars):
    return tables.to_fact(with_bar_metrics(bars).withColumn("source", F.lit("feed")), "2024-01-01 00:00:00")


def test_a_batch_without_copies_is_not_sorted_to_settle_it(spark, bars, rows, tmp_path, monkeypatch):
    settled, settle = [], tables.dedupe_bars
    monkeypatch.setattr(tables, "dedupe_bars", lambda *a, **k: settled.append(1) or settle(*a, **k))
    path, fact, counts = str(tmp_path / "fact"), _fact(bars), {}
    tables.upsert_table(spark, path, fact.filter("trade_date < '1997-01-01'"), counts=counts)
    tables.upsert_table(spark, path, fact.filter("trade_date >= '1996-12-01'"), counts=counts)
    assert not settled and counts["updated"] == fact.filter("trade_date BETWEEN '1996-12-01' AND '1996-12-31'").count()
    assert rows(read_fact(spark, path), *fact.columns) == rows(fact, *fact.columns)
    twice = fact.filter("trade_date < '1996-01-01'").withColumn("volume", F.col("volume") + 1)
    twice = twice.unionByName(twice.withColumn("volume", F.col("volume") + 1))
    tables.upsert_table(spark, path, twice, counts=counts)
    assert settled and counts == {"updated": twice.count() // 2, "inserted": 0}
    want = fact.withColumn("volume", F.col("volume") + F.when(F.col("trade_date") < "1996-01-01", 2).otherwise(0))
    assert rows(read_fact(spark, path), *fact.columns) == rows(want, *fact.columns)


def test_buckets_grow_with_the_rows():
    assert listings.bucket_count(0) == listings.bucket_count(1000) == 8
    for rows in (10 ** 7, 10 ** 8, 10 ** 9):
        assert rows / listings.bucket_count(rows) <= listings.BUCKET_ROWS


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(k).getName() for k in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def _gone(spark, before):
    """Whether no shuffle files stay but those of before; they are removed beside the run."""
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            return True
        time.sleep(0.1)
    return False


def _packed(path):
    files = [p.name for p in path.rglob("*.parquet")]
    return files and all(".zstd." in n for n in files)


def test_a_load_leaves_no_shuffle_files(spark, bars, tmp_path):
    before, flag = _shuffle_files(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    asked = spark.conf.get(flag)
    load_batch(spark, _fact(bars), f"{tmp_path}/fact", f"{tmp_path}/state", f"{tmp_path}/bad", "one", gold_path=f"{tmp_path}/gold")
    assert _gone(spark, before) and spark.conf.get(flag) == asked
    assert _packed(tmp_path / "fact") and _packed(tmp_path / "gold")


def test_layers_leave_no_shuffle_files_and_stamps_do_not_travel(spark, bars, tmp_path):
    before = _shuffle_files(spark)
    layers = run_medallion(spark, _fact(bars), root=str(tmp_path))
    assert _gone(spark, before) and _packed(tmp_path / "silver_stock_prices") and _packed(tmp_path / "gold_stock_analytics")
    assert layers["silver"].columns[-2:] == ["_silver_loaded_at", "_source"] and layers["gold"].columns[-1] == "_gold_loaded_at"
    assert layers["gold"].filter("_gold_loaded_at IS NULL OR _source <> 'barworks'").isEmpty()


def _twice(fact):
    """Each row and a later copy, which is to win."""
    return fact.unionByName(fact.withColumns({"volume": F.col("volume") + 1, "loaded_at": F.col("loaded_at") + F.expr("interval 1 day")}))


def test_copies_are_settled_by_the_shuffle_that_lays_out(spark, bars, rows, plan, tmp_path, monkeypatch):
    plans, write = [], tables._write
    monkeypatch.setattr(tables, "_write", lambda df, *a: plans.append(plan(df)) or write(df, *a))
    path, fact, counts = str(tmp_path / "fact"), _fact(bars), {}
    batch = write_and_reread(_twice(fact), str(tmp_path / "batch"))
    want = rows(fact.withColumn("volume", F.col("volume") + 1), *[c for c in fact.columns if c != "loaded_at"])
    for updated in (0, fact.count()):
        tables.upsert_table(spark, path, batch, counts=counts)
        assert plans[-1].count("Exchange") == 1 and "Join" not in plans[-1]
        assert counts == {"updated": updated, "inserted": fact.count() - updated}
        assert rows(read_fact(spark, path), *[c for c in fact.columns if c != "loaded_at"]) == want


def test_rows_the_batch_does_not_name_stay(spark, bars, rows, tmp_path):
    path, fact, counts = str(tmp_path / "fact"), _fact(bars), {}
    tables.upsert_table(spark, path, fact)
    part = _twice(fact.filter("exchange_code = 'NSE'"))
    tables.upsert_table(spark, path, write_and_reread(part, str(tmp_path / "batch")), counts=counts)
    assert counts == {"updated": part.count() // 2, "inserted": 0}
    named = [c for c in fact.columns if c != "loaded_at"]
    want = fact.withColumn("volume", F.col("volume") + F.when(F.col("exchange_code") == "NSE", 1).otherwise(0))
    assert rows(read_fact(spark, path), *named) == rows(want, *named)


def test_many_copies_of_a_key_are_ranked_before_they_meet(spark, bars, rows, plan, tmp_path, monkeypatch):
    plans, write = [], tables._write
    monkeypatch.setattr(tables, "_write", lambda df, *a: plans.append(plan(df)) or write(df, *a))
    path, fact = str(tmp_path / "fact"), _fact(bars.limit(40))
    one = fact.limit(1).crossJoin(spark.range(1, 100)).withColumn("volume", F.col("volume") + F.col("id")).drop("id")
    batch = write_and_reread(fact.unionByName(one), str(tmp_path / "batch"))
    tables.upsert_table(spark, path, batch)
    assert "Partial" in plans[-1] and read_fact(spark, path).count() == batch.select("symbol", "exchange_code", "trade_date").distinct().count()


def test_lines_meet_before_they_are_bars(spark, rows, plan, tmp_path):
    line = dict(l_orderkey=1, l_partkey=1, l_suppkey=1, l_linenumber=1, l_quantity=2.0, l_extendedprice=10.0, l_discount=0.1, l_tax=0.2,
                l_linestatus="O", l_shipdate=dt.datetime(1998, 3, 1))
    given = [line, line, {**line, "l_orderkey": 2, "l_extendedprice": 8.0, "l_tax": None}, {**line, "l_suppkey": 2, "l_linenumber": None},
             {**line, "l_suppkey": None, "l_linestatus": None}, {**line, "l_suppkey": 3, "l_shipdate": None, "l_quantity": None}]
    kinds = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
             "l_discount double, l_tax double, l_linestatus string, l_shipdate timestamp_ntz")
    names = [k.split()[0] for k in kinds.split(", ")]
    spark.createDataFrame([tuple(g[n] for n in names) for g in given], kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    made = fx.lineitem_bars(spark, str(tmp_path))
    text = plan(made)
    assert text.count("Exchange") == 1 and text.index("partial_min_by") < text.index("Exchange") and "tick_order" not in text[text.index("Exchange"):]
    got = {(r.symbol, r.exchange_code, r.trade_date and str(r.trade_date)): [x if x is None else float(x) for x in r[3:]] for r in made.collect()}
    assert got == {
        ("S1", "NSE", "1998-03-01"): [9.0, 12.0, 7.2, 8.0, 6.0], ("S2", "NSE", "1998-03-01"): [None, 12.0, 9.0, None, 2.0],
        (None, "BSE", "1998-03-01"): [9.0, 12.0, 9.0, 10.0, 2.0], ("S3", "NSE", None): [9.0, 12.0, 9.0, 10.0, None]}
