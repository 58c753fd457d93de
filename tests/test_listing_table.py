import pytest
from pyspark.sql import functions as F

from barworks.functions.dates import MONTH_COLUMN as MONTH
from barworks.operators import analytics, dims, gold
from barworks.plans import listings, tables
from barworks.schemas import BAR_KEY, LISTING
from barworks.session import settings, write_and_reread
from barworks.sources import month_bounds, save_layer, with_bar_metrics


@pytest.fixture
def fact(spark, bars, tmp_path):
    made = tables.to_fact(with_bar_metrics(bars).withColumn("source", F.lit("feed")), "2024-01-01 00:00:00")
    return write_and_reread(made, str(tmp_path / "given"))


@pytest.fixture
def stored(spark, fact, tmp_path):
    made = []

    def make(df):
        name = f"listing_fact_{len(made)}_{abs(hash(str(tmp_path)))}"
        made.append(name)
        listings.create_listing_table(spark, name, str(tmp_path / f"table{len(made)}"), df, 8)
        return name

    yield make
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_upserts_equal_the_plain_merge(spark, fact, stored, tmp_path, rows):
    old, new = fact.filter("trade_date < '1997-01-01'"), fact.filter("trade_date >= '1997-01-01'")
    name = stored(old)
    touched = listings.upsert_listing_table(spark, name, new)
    assert touched == sorted({d.replace(day=1) for d, in new.select("trade_date").distinct().collect()})
    assert rows(spark.table(name), *fact.columns) == rows(fact, *fact.columns)
    # Corrections of one month, a key that is not there yet, and a copy of it.
    late = fact.filter("trade_date BETWEEN '1996-03-01' AND '1996-03-31'").withColumn("volume", F.col("volume") + 5)
    extra = late.limit(1).withColumn("symbol", F.lit("NEW"))
    batch = write_and_reread(late.unionByName(extra).unionByName(extra), str(tmp_path / "batch"))
    for _ in range(2):
        listings.upsert_listing_table(spark, name, batch)
        want = fact.join(late.select(*BAR_KEY), BAR_KEY, "left_anti").unionByName(late).unionByName(
            batch.filter("symbol = 'NEW'").distinct())
        assert rows(spark.table(name), *fact.columns) == rows(want, *fact.columns)
    # Every file holds the listings of its bucket only, so the buckets still tell the truth.
    file_bucket = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)\.c", 1).cast("int")
    wrong = spark.table(name).filter(file_bucket != F.pmod(F.hash(*LISTING), F.lit(8)))
    assert wrong.isEmpty()


def test_empty_batch_and_rows_without_a_key(spark, fact, stored, rows):
    name = stored(fact)
    assert listings.upsert_listing_table(spark, name, fact.limit(0)) == []
    with pytest.raises(ValueError, match="without"):
        listings.upsert_listing_table(spark, name, fact.limit(1).withColumn("symbol", F.lit(None).cast("string")))
    assert rows(spark.table(name), *BAR_KEY) == rows(fact, *BAR_KEY)


def test_interrupted_rewrite_is_finished_by_the_next_load(spark, fact, stored, tmp_path, rows, monkeypatch):
    name = stored(fact)
    late = write_and_reread(fact.filter("trade_date BETWEEN '1996-03-01' AND '1996-04-30'").withColumn(
        "volume", F.col("volume") + 5), str(tmp_path / "late"))
    with monkeypatch.context() as broken:
        broken.setattr(tables, "replace_path", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            listings.upsert_listing_table(spark, name, late)
    assert listings.upsert_listing_table(spark, name, fact.limit(0)) == []
    want = fact.join(late.select(*BAR_KEY), BAR_KEY, "left_anti").unionByName(late)
    assert rows(spark.table(name), *fact.columns) == rows(want, *fact.columns)


def test_windows_by_listing_do_not_shuffle_the_table(spark, fact, stored, plan, rows):
    table = spark.table(stored(fact)).drop(MONTH)
    assert "Exchange" not in plan(gold.listing_indicators(table))
    assert "Exchange" not in plan(analytics.moving_averages(table))
    assert rows(analytics.moving_averages(table)) == rows(analytics.moving_averages(fact))


def test_merge_shuffles_the_batch_only(spark, fact, stored, plan):
    target = spark.table(stored(fact)).drop(MONTH)
    with settings(spark, {"spark.sql.shuffle.partitions": "32"}), settings(spark, listings.co_located(8)):
        text = plan(listings.merged(target, fact.limit(50)))
    above_target = text[:text.index("Bucketed: true")].rsplit("FullOuter", 1)[1]
    assert "Exchange" not in above_target and "SelectedBucketsCount: 8 out of 8" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_filtered_calendar_prunes_months(spark, fact, tmp_path, plan, rows):
    path, days = str(tmp_path / "months"), dims.dim_date_covering(fact)
    save_layer(fact, path=path)
    calendar = write_and_reread(days, str(tmp_path / "calendar")).filter("fiscal_year = 1997 AND fiscal_quarter = 2")
    by_month = analytics.trading_days(spark.read.parquet(path), calendar)
    assert "dynamicpruning" in plan(by_month)
    assert rows(by_month) == rows(analytics.trading_days(fact, calendar)) != []


def test_month_bounds_come_from_footers(spark, bars, tmp_path, plan, rows):
    path = str(tmp_path / "bounds")
    save_layer(bars.unionByName(bars.limit(1).withColumn("trade_date", F.lit(None).cast("date"))), path=path)
    found = month_bounds(spark, path)
    assert "PushedAggregation: [COUNT(*), MIN(trade_date), MAX(trade_date)]" in plan(found)
    want = bars.groupBy(F.trunc("trade_date", "MM").alias(MONTH)).agg(
        F.count("*").alias("row_count"), F.min("trade_date").alias("first_day"), F.max("trade_date").alias("last_day"))
    assert rows(found.filter(f"{MONTH} IS NOT NULL")) == rows(want)
    assert found.filter(f"{MONTH} IS NULL").select("row_count", "first_day").collect() == [(1, None)]
