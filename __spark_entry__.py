"""Registered queries: one per operator, each over whole tables, with its check in SQL."""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import market_fixtures as fx  # noqa: E402
import oracle_queries  # noqa: E402
from barworks.operators import analytics, contracts, dims, gold, incremental, quality, silver, summary, upsert  # noqa: E402
from barworks.operators.ranks import volume_rank, volume_ranks  # noqa: E402
from barworks.plans import sql as sql_plans  # noqa: E402
from barworks.plans.gaps import GapTable  # noqa: E402
from barworks.plans.listings import bucket_count, create_listing_table, upsert_listing_table  # noqa: E402
from barworks.plans.load import load_batch, run_incremental  # noqa: E402
from barworks.plans.medallion import run_medallion  # noqa: E402
from barworks.plans.state import WatermarkTable  # noqa: E402
from barworks.plans.tables import to_fact, upsert_table  # noqa: E402
from barworks.schemas import BAR_KEY, LISTING, PRICES  # noqa: E402
from barworks.session import scratch_path, write_and_reread  # noqa: E402
from barworks.sources import (  # noqa: E402
    bars_from_ticks, create_star_schema, list_tables, month_bounds, normalize_bars, read_fact, read_parts, resample_bars,
    run_sql, save_layer, scan_bronze, table_counts, union_frames, with_bar_metrics,
)
from barworks.streaming import stream_daily_bars, stream_ingest, stream_late_ticks  # noqa: E402

BAR_OUT = [*BAR_KEY, *PRICES, "volume"]
GOLD_OUT = [*BAR_KEY, "close_price", "ma_7d", "ma_30d", "daily_return_pct", "volatility_30d", "volume_rank"]
CHECK_OUT = ["check_no", "check_name", "severity", "passed", "failed_rows", "checked_rows", "failed_pct"]


def _day(text):
    return F.lit(text).cast("date")


def _written(df):
    """For inputs that a plan reads more than once: write once, read columns."""
    return write_and_reread(df, scratch_path(df.sparkSession, "input"))


def _silver(spark, sf):
    return silver.bronze_to_silver(fx.dirty_bronze(spark, sf))


# ---- scans and sources -------------------------------------------------------

def scan_bronze_query(spark, sf):
    df = scan_bronze(spark, f"{sf}/lineitem.parquet",
                     columns=["l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"])
    return df.select("l_suppkey", F.col("l_shipdate").cast("date").alias("trade_date"),
                     F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"))


def normalize_bars_query(spark, sf):
    return normalize_bars(fx.raw_feed(fx.lineitem_bars(spark, sf)))


def normalize_zoned(spark, sf):
    """The feed with zoned timestamps: midnight of the exchange, whatever the session's zone."""
    feed = fx.raw_feed(fx.lineitem_bars(spark, sf))
    instant = F.convert_timezone(F.lit("Asia/Kolkata"), F.current_timezone(), "Date").cast("timestamp")
    return normalize_bars(feed.withColumn("Date", instant))


def union_symbol_frames(spark, sf):
    bars = fx.typed_bars(spark, sf)
    nse = bars.filter("exchange_code = 'NSE'").select(*BAR_KEY, "close_price", "volume")
    bse = bars.filter("exchange_code = 'BSE'").select(*BAR_KEY, "close_price")
    return union_frames([nse, None, bse]).withColumn("volume", F.coalesce("volume", F.lit(-1)))


def file_outcomes(spark, sf):
    """Bars in a folder for each supplier: two of the folders are empty, one holds no bar files, some are not there."""
    root = scratch_path(spark, "parts")
    feed = fx.raw_feed(fx.lineitem_bars(spark, sf)).drop("Dividends")
    slot = F.upper(F.regexp_extract("ticker", "(?i)(s[0-9]+)", 1))
    feed.withColumn("slot", slot).filter(~slot.isin("S3", "S5", "S7")).repartition("slot").write.partitionBy("slot").parquet(root)
    for part in ("S3", "S7"):
        feed.limit(0).write.parquet(f"{root}/slot={part}")
    feed.select("ticker").distinct().coalesce(1).write.text(f"{root}/slot=S5")
    expected = fx.table(spark, sf, "supplier").select(F.concat(F.lit("slot=S"), "s_suppkey").alias("part"))
    more = spark.range(-2, 0).select(F.concat(F.lit("slot=S"), "id").alias("part"))
    bars, outcomes = read_parts(spark, root, expected.unionByName(more))
    total = bars.agg(F.lit("all").alias("part"), F.lit("").alias("status"), F.count(F.lit(1)).alias("row_count"))
    return outcomes.select("part", "status", "row_count").unionByName(total)


def table_list(spark, sf):
    counts = {}
    for name in fx.TABLES:
        fx.table(spark, sf, name).createOrReplaceTempView(f"given_{name}")
        counts[f"given_{name}"] = spark.table(f"given_{name}")
    views = list_tables(spark).filter(F.col("table_name").isin(list(counts)))
    return views.join(table_counts(counts), "table_name")


def month_bounds_query(spark, sf):
    path = scratch_path(spark, "bounds")
    save_layer(fx.typed_bars(spark, sf), path=path)
    return month_bounds(spark, path)


def param_query(spark, sf):
    fx.fact_bars(spark, sf).createOrReplaceTempView("fact_for_query")
    return run_sql(
        spark,
        "SELECT symbol, exchange_code, count(*) AS up_days, max(change_pct) AS best_change "
        "FROM fact_for_query WHERE change_pct > :least GROUP BY symbol, exchange_code",
        {"least": 0.5})


def star_schema_load(spark, sf):
    database = "star_" + scratch_path(spark, "db").rsplit("-", 1)[1]
    create_star_schema(spark, database, scratch_path(spark, "star"))
    bars = _written(fx.fact_bars(spark, sf))
    fact = to_fact(bars).withColumn("trade_month", F.trunc("trade_date", "MM"))
    frames = {
        "fact_stock_prices": fact,
        "dim_date": dims.dim_date_covering(fact),
        "dim_exchange": dims.exchanges_in(fact),
        "dim_symbol": dims.listings_in(fact),
    }
    for table, df in frames.items():
        df.createOrReplaceTempView(f"load_{table}")
        columns = ", ".join(df.columns)
        spark.sql(f"INSERT INTO {database}.{table} ({columns}) SELECT {columns} FROM load_{table}")
    stored = {table: spark.table(f"{database}.{table}") for table in frames}
    days = stored["dim_date"].select(F.col("date_key").alias("trade_date"), "day_name", "fiscal_year", "is_trading_day")
    joined = (stored["fact_stock_prices"].join(days, "trade_date")
              .join(stored["dim_exchange"].select("exchange_code", "exchange_name"), "exchange_code")
              .join(stored["dim_symbol"].select(*LISTING, "listed_date"), LISTING))
    return fx.plain(joined, *BAR_OUT, "change_pct", "day_name", "fiscal_year", "is_trading_day", "exchange_name", "listed_date")


# ---- silver and contracts ----------------------------------------------------

def silver_cast(spark, sf):
    return silver.silver_cast(fx.dirty_bronze(spark, sf)).select(*BAR_OUT)


def derived_columns_2dp(spark, sf):
    df = with_bar_metrics(_silver(spark, sf), scale=2, zero_open=0.0, change_from_open=True)
    return df.select(*BAR_KEY, "daily_range", "change_from_open", "change_pct")


def _contract(spark, sf):
    late = F.when(F.col("loaded_at").cast("date") > F.col("trade_date").try_cast("date"), 1).otherwise(0)
    return contracts.row_contract_bars(fx.dirty_bronze(spark, sf, more=True)).withColumn("late_copy", late.cast("bigint"))


def row_contract_bars(spark, sf):
    return _contract(spark, sf).select(
        "symbol", "exchange_code", F.coalesce(F.col("trade_date").cast("string"), F.lit("none")).alias("trade_date"),
        "volume", "late_copy", F.array_join("violations", ",").alias("violations"))


def row_contract_symbols(spark, sf):
    code = F.pmod("c_custkey", F.lit(3))
    records = fx.table(spark, sf, "customer").select(
        F.when(F.pmod("c_custkey", F.lit(10)) == 0, "  ").otherwise(F.concat(F.lit(" "), F.lower("c_name"))).alias("symbol"),
        F.when(code == 0, " nse ").when(code == 1, "bse").otherwise("nyse").alias("exchange_code"))
    checked = contracts.row_contract_symbols(records)
    return checked.withColumn("violations", F.array_join("violations", ","))


def valid_bars(spark, sf):
    valid, _ = contracts.split_valid(_contract(spark, sf))
    return valid.select(*BAR_OUT, "late_copy")


# ---- gold --------------------------------------------------------------------

def _indicator(column):
    def query(spark, sf):
        return gold.listing_indicators(fx.typed_bars(spark, sf)).select(*BAR_KEY, column)
    return query


def avg_volume_7d(spark, sf):
    bars = fx.typed_bars(spark, sf)
    averaged = gold.with_rounded(bars, {"avg_volume_7d": (gold.moving_average("volume", 7), 0)})
    return averaged.select(*BAR_KEY, "avg_volume_7d")


def volume_rank_query(spark, sf):
    return volume_rank(fx.typed_bars(spark, sf).select(*BAR_KEY, "volume"))


def gold_query(spark, sf):
    bars = _written(_silver(spark, sf).select(*BAR_OUT))
    return gold.silver_to_gold(bars, ranks=_written(volume_ranks(bars))).select(*GOLD_OUT)


def _indicators(spark, sf):
    return gold.listing_indicators(_silver(spark, sf))


def silver_sql(spark, sf):
    fx.dirty_bronze(spark, sf).createOrReplaceTempView("bronze_for_sql")
    return spark.sql(sql_plans.silver_select("bronze_for_sql"))


def gold_sql(spark, sf):
    fx.typed_bars(spark, sf).createOrReplaceTempView("silver_for_sql")
    return spark.sql(sql_plans.gold_select("silver_for_sql")).select(
        *BAR_KEY, "close_price", "ma_7d", "ma_30d", "daily_return_pct", "volume_rank")


def daily_summary_sql(spark, sf):
    gold_df = _indicators(spark, sf)
    gold_df.createOrReplaceTempView("gold_for_sql")
    return spark.sql(sql_plans.summary_select("gold_for_sql"))


def _medallion(spark, sf):
    return run_medallion(spark, fx.dirty_bronze(spark, sf), root=scratch_path(spark, "medallion"))


def medallion_counts(spark, sf):
    metrics = _medallion(spark, sf)["run_metrics"]
    return metrics.select("layer", F.col("rows").alias("row_count"))


def gold_refresh(spark, sf):
    before = _written(fx.typed_bars(spark, sf))
    hit = F.col("trade_date").between(_day("1998-03-01"), _day("1998-03-05"))
    after = before.withColumns({
        "close_price": F.col("close_price") + F.when(hit, 1.0).otherwise(0.0),
        "volume": F.col("volume") + F.when(hit, 7).otherwise(0)})
    old = _written(gold.silver_to_gold(before, ranks=_written(volume_ranks(before))))
    changed = _written(after.filter(hit).select(*BAR_KEY))
    since = F.date_sub(changed.agg(F.min("trade_date")).scalar(), 90)
    older = gold.short_listings(after, changed, since)
    delta = gold.gold_delta(after, old, changed, since=since, older=older)
    return upsert.merge_rows(old, delta, BAR_KEY).select(*GOLD_OUT)


def summary_refresh(spark, sf):
    """The daily and the sector summary kept up to date by three loads: history, corrections with new days, one listing's day alone."""
    base = scratch_path(spark, "summary-refresh")
    bars, dim = _written(fx.fact_bars(spark, sf)), _written(fx.listings(spark, sf))
    hit = F.col("trade_date").between(_day("1998-03-01"), _day("1998-03-05"))
    fixed = bars.filter(hit).withColumn("close_price", F.col("close_price") + 1)
    old, new = fx.date_slices(bars, ["2001-06-01"])
    one = new.filter("symbol = 'S1'").withColumn("volume", F.col("volume") + 7)
    summaries = {f"{base}/daily": summary.daily_summary, f"{base}/sector": lambda g: summary.sector_daily_summary(g, dim)}
    for number, batch in enumerate([old, new.unionByName(fixed), one]):
        load_batch(spark, batch, f"{base}/fact", f"{base}/state", f"{base}/quarantine", number,
                   gold_path=f"{base}/gold", lookback_days=90, summaries=summaries)
    daily = read_fact(spark, f"{base}/daily").withColumnRenamed("exchange_code", "part")
    return daily.unionByName(read_fact(spark, f"{base}/sector").withColumnRenamed("sector", "part"))


def medallion_clean(spark, sf):
    layers = run_medallion(spark, fx.dirty_bronze(spark, sf, more=True), root=scratch_path(spark, "medallion"), contract=True)
    return layers["summary"]


def ctas_silver(spark, sf):
    """The silver text as a table, made twice: the second time it replaces the first."""
    database = "ctas_" + scratch_path(spark, "db").rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, database)}'")
    fx.dirty_bronze(spark, sf).createOrReplaceTempView("bronze_for_ctas")
    sql_plans.create_table_as(spark, f"{database}.silver", "SELECT 1 AS old")
    return sql_plans.create_table_as(spark, f"{database}.silver", sql_plans.silver_select("bronze_for_ctas"))


# ---- dimensions --------------------------------------------------------------

def dim_exchange(spark, sf):
    known = dims.exchange_seed(spark, {"NSE": dims.EXCHANGE_NAMES["NSE"]})
    return dims.dim_exchange(known, dims.exchanges_in(fx.lineitem_bars(spark, sf))).select(
        "exchange_code", "exchange_name", "country", "currency", "timezone")


def dim_symbol_scd1(spark, sf):
    bars = fx.lineitem_bars(spark, sf)
    existing = dims.listings_in(bars.filter(F.col("trade_date") < _day("1996-01-01")))
    return dims.dim_symbol_scd1(existing, fx.listings(spark, sf), bars).select(
        *LISTING, "company_name", "sector", "industry", "listed_date")


def trading_days(spark, sf):
    fact = fx.fact_bars(spark, sf)
    return fx.plain(analytics.trading_days(fact, dims.dim_date_covering(fact)))


def one_fiscal_quarter(spark, sf):
    """The rollup of one quarter of a stored calendar: the months of the fact are pruned at run time."""
    path = scratch_path(spark, "fact")
    save_layer(fx.fact_bars(spark, sf), path=path)
    fact = scan_bronze(spark, path)
    days = _written(dims.dim_date_covering(fact)).filter("fiscal_year = 1997 AND fiscal_quarter = 2")
    return fx.plain(analytics.trading_days(fact, days))


# ---- quality -----------------------------------------------------------------

def _suite(checks, source=None):
    def query(spark, sf):
        # Suites that also count distinct values aggregate twice.
        distinct = any(c.distinct for c in checks()) and not all(c.distinct for c in checks())
        given = _written if distinct else lambda df: df
        df = silver.silver_cast(given(fx.dirty_bronze(spark, sf))) if source is None else source(spark, sf)
        return quality.run_suite(df, checks(), "bars").select(*CHECK_OUT)
    return query


def qc_suite_summary(spark, sf):
    df = silver.silver_cast(_written(fx.dirty_bronze(spark, sf)))
    return quality.suite_summary(quality.run_suite(df, quality.bar_suite(), "bars"))


# ---- incremental -------------------------------------------------------------

def _state(bars):
    return incremental.watermark_candidates(
        bars.filter((F.col("exchange_code") == "NSE") & (F.col("trade_date") < _day("1997-01-01"))))


def incremental_extract(spark, sf):
    bars = fx.typed_bars(spark, sf)
    return incremental.incremental_extract(bars, _state(bars), "1999-01-01", period="1y").select(*BAR_KEY, "close_price")


def watermark_advance(spark, sf):
    bars = fx.typed_bars(spark, sf)
    loaded = bars.filter(F.col("trade_date") >= _day("1996-06-01"))
    return incremental.watermark_advance(_state(bars), loaded)


def watermark_reset(spark, sf):
    bars = fx.typed_bars(spark, sf)
    state = incremental.watermark_candidates(bars)
    return incremental.watermark_reset(state, state.filter("exchange_code = 'BSE'"))


def _upsert_sides(spark, sf):
    fact = _written(fx.fact_bars(spark, sf)).withColumn("close_price", F.col("close_price").cast("double"))
    target = fact.filter(F.col("trade_date") < _day("1999-01-01"))
    batch = fact.filter(F.col("trade_date") >= _day("1997-01-01")).withColumn("close_price", F.col("close_price") + 1)
    return target, batch


def _listing_table(spark, sf):
    """The table in buckets of listings, after the loads and corrections of upsert_table."""
    table = "fact_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    fact = _written(to_fact(fx.fact_bars(spark, sf)))
    first, *more = fx.date_slices(fact, ["1997-01-01", "1999-01-01"])
    create_listing_table(spark, table, scratch_path(spark, "listings"), first, bucket_count(fact.count()))
    late = fact.filter(F.col("trade_date") >= _day("1997-01-01")).withColumns({
        "close_price": (F.col("close_price") + 1).cast("decimal(18,4)")})
    for piece in (*more, late):
        upsert_listing_table(spark, table, piece)
    return spark.table(table)


def listing_table_upsert(spark, sf):
    return fx.plain(_listing_table(spark, sf), *BAR_KEY, "close_price", "volume")


def listing_table_averages(spark, sf):
    return fx.plain(analytics.moving_averages(_listing_table(spark, sf)))


def upsert_table_query(spark, sf):
    """Load in date slices through the partitioned table, then apply corrections."""
    path = scratch_path(spark, "fact")
    fact = _written(to_fact(fx.fact_bars(spark, sf)))
    for piece in fx.date_slices(fact, ["1997-01-01", "1999-01-01"]):
        upsert_table(spark, path, piece)
    late = fact.filter(F.col("trade_date") >= _day("1997-01-01")).withColumns({
        "close_price": (F.col("close_price") + 1).cast("decimal(18,4)")})
    upsert_table(spark, path, late)
    return fx.plain(read_fact(spark, path), *BAR_KEY, "close_price", "volume")


def _dirt(spark, sf):
    dirty = fx.dirty_bronze(spark, sf, more=True)
    late = F.col("loaded_at").cast("date") > F.col("trade_date").try_cast("date")
    return dirty.withColumn("late_copy", F.when(late, 1).otherwise(0).cast("bigint"))


def _load_dirt(spark, dirty, base, name="same-name", **options):
    load_batch(spark, dirty, f"{base}/fact", f"{base}/state", f"{base}/quarantine", name, **options)


def load_quarantine(spark, sf):
    """What a load sets aside, after two more of the same name: a replay, and one of other rows."""
    base = scratch_path(spark, "dirty-load")
    dirty = _written(_dirt(spark, sf))
    _load_dirt(spark, dirty, base)
    _load_dirt(spark, dirty, base)
    load_batch(spark, contracts.split_valid(contracts.row_contract_bars(dirty))[0], f"{base}/fact", None, f"{base}/quarantine", "same-name")
    return spark.read.parquet(f"{base}/quarantine").select(
        F.coalesce("symbol", F.lit("none")).alias("symbol"), "exchange_code",
        F.coalesce(F.col("trade_date").cast("string"), F.lit("none")).alias("trade_date"), "late_copy",
        F.array_join("violations", ",").alias("violations"))


def run_metrics(spark, sf):
    """What is stored about a load with dirt and its repetition."""
    base = scratch_path(spark, "dirty-load")
    dirty = _written(_dirt(spark, sf))
    for name in ("run-1", "run-2"):
        _load_dirt(spark, dirty, base, name, metrics_path=f"{base}/metrics")
    return spark.read.parquet(f"{base}/metrics").select("batch_id", "rows_in", "rows_quarantined", "rows_inserted", "rows_updated", "status")


def watermark_table(spark, sf):
    """The stored watermarks after a load with dirt: bad days are passed, as gaps."""
    base = scratch_path(spark, "dirty-load")
    _load_dirt(spark, _dirt(spark, sf), base)
    return WatermarkTable(spark, f"{base}/state").read()


def gap_watermarks(spark, sf):
    """Three loads of a feed with bad days: they read the new days and the open gaps. Between the last two the gaps
    of one exchange before 1998 are given up, and the feed corrects every other bad day."""
    base = scratch_path(spark, "gap-loads")
    bars = _written(fx.fact_bars(spark, sf))
    days = F.datediff("trade_date", _day("1992-01-01"))
    bad = (F.substring("symbol", 2, 9).cast("bigint") * 31 + days) % 17 < 2

    def load(as_of, still_bad):
        feed = bars.withColumn("close_price", F.when(still_bad, -F.col("close_price")).otherwise(F.col("close_price")))
        run_incremental(spark, feed, f"{base}/fact", f"{base}/state", as_of, period="max",
                        quarantine_path=f"{base}/quarantine", metrics_path=f"{base}/metrics")

    gaps = GapTable(spark, f"{base}/state")
    load("1997-01-01", bad)
    load("1999-01-01", bad)
    gaps.release(bars.filter("exchange_code = 'BSE'").select(*LISTING).distinct(), last="1997-12-31")
    load("2001-01-01", bad & (days % 2 == 0))
    marks = WatermarkTable(spark, f"{base}/state").read().join(gaps.read(), LISTING, "left")
    spans = F.transform("gaps", lambda g: F.concat_ws("/", g["first"].cast("string"), g["last"].cast("string")))
    listings = marks.select(*LISTING, F.col("watermark").cast("string").alias("watermark"),
                            F.coalesce(F.array_join(spans, ","), F.lit("")).alias("gaps"),
                            *[F.lit(None).cast("bigint").alias(c) for c in ("rows_in", "rows_quarantined", "rows_updated")])
    runs = spark.read.parquet(f"{base}/metrics").select(
        F.concat(F.lit("load "), "batch_id").alias("symbol"), F.lit("").alias("exchange_code"), F.lit(None).cast("string").alias("watermark"),
        F.lit("").alias("gaps"), "rows_in", "rows_quarantined", "rows_updated")
    return listings.unionByName(runs)


# ---- streaming ---------------------------------------------------------------

def stream_ingest_query(spark, sf):
    """Raw bar files, one folder of them per date slice and each of few months, followed to the end."""
    base = scratch_path(spark, "stream-ingest")
    feed = fx.raw_feed(fx.lineitem_bars(spark, sf)).drop("Dividends")
    cut = F.when(F.col("Date") < _day("1997-01-01"), 1).when(F.col("Date") < _day("1999-01-01"), 2).otherwise(3)
    feed = feed.withColumns({"slice": cut, "month": F.trunc("Date", "MM")})
    feed.hint("rebalance", "month").drop("month").write.partitionBy("slice").parquet(f"{base}/in")
    query = stream_ingest(spark, f"{base}/in", f"{base}/fact", f"{base}/state", f"{base}/checkpoint",
                          quarantine_path=f"{base}/quarantine", max_files_per_trigger=8)
    query.awaitTermination()
    return fx.plain(read_fact(spark, f"{base}/fact"), *BAR_OUT, "daily_range", "change_pct")


def incremental_gold_query(spark, sf):
    """Two batches through check, upsert and gold refresh: the second one brings
    new days and corrects old ones."""
    base = scratch_path(spark, "incremental-gold")
    bars = _written(fx.fact_bars(spark, sf))
    hit = F.col("trade_date").between(_day("1998-03-01"), _day("1998-03-05"))
    fixed = bars.filter(hit).withColumns({
        "close_price": F.col("close_price") + 1, "volume": F.col("volume") + 7})
    old, new = fx.date_slices(bars, ["2001-06-01"])
    for number, batch in enumerate([old, new.unionByName(fixed)]):
        load_batch(spark, batch, f"{base}/fact", f"{base}/state", f"{base}/quarantine", number,
                   gold_path=f"{base}/gold", lookback_days=90)
    return read_fact(spark, f"{base}/gold").select(*GOLD_OUT)


def stream_daily_bars_query(spark, sf):
    base = scratch_path(spark, "stream-bars")
    schema = fx.table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    ticks = events.select(
        F.col("event_type").alias("symbol"),
        F.when(F.col("user_id") % 2 == 0, "NSE").otherwise("BSE").alias("exchange_code"),
        "ts", F.col("value").cast("decimal(12,2)").alias("px"), "event_id")
    stream_daily_bars(spark, ticks, "ts", "px", "event_id", f"{base}/bars", f"{base}/checkpoint").awaitTermination()
    return fx.plain(read_fact(spark, f"{base}/bars"), *BAR_OUT)


def _arriving(spark, sf, base):
    schema = fx.arriving_ticks(spark, sf, f"{base}/ticks")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", fx.ARRIVAL_FILES).parquet(f"{base}/ticks")


def stream_ticks_replayed(spark, sf):
    """Bars of a feed that delivers a third of its ticks twice and a few of them weeks late."""
    base = scratch_path(spark, "stream-replayed")
    stream_daily_bars(spark, _arriving(spark, sf, base), "ts", "px", "event_id", f"{base}/bars", f"{base}/checkpoint",
                      watermark="7 days", tick_id="event_id").awaitTermination()
    return fx.plain(read_fact(spark, f"{base}/bars"), *BAR_OUT)


def stream_late_ticks_query(spark, sf):
    """What of the same feed came too late, by the micro-batch it came with."""
    base = scratch_path(spark, "stream-late")
    stream_late_ticks(spark, _arriving(spark, sf, base), "ts", f"{base}/late", f"{base}/checkpoint", watermark="7 days").awaitTermination()
    return spark.read.parquet(f"{base}/late").select("event_id", "symbol", "exchange_code", F.col("batch_id").cast("bigint").alias("batch_id"))


def stream_metrics(spark, sf):
    """One stored row for each micro-batch of bar files: four years of files that arrive one after the other, some bars negative."""
    base = scratch_path(spark, "stream-metrics")
    bars = _written(fx.lineitem_bars(spark, sf).filter(F.year("trade_date").between(1996, 1999)))
    feed = fx.raw_feed(bars).drop("Dividends").withColumn("Low", F.when(F.col("Volume") % 10 == 0, -F.col("Low")).otherwise(F.col("Low")))
    for year in range(1996, 2000):
        feed.filter(F.year("Date") == year).write.mode("append").parquet(f"{base}/in")
        stream_ingest(spark, f"{base}/in", f"{base}/fact", f"{base}/state", f"{base}/checkpoint", quarantine_path=f"{base}/quarantine",
                      metrics_path=f"{base}/metrics").awaitTermination()
    return spark.read.parquet(f"{base}/metrics").select(
        "batch_id", "rows_in", "rows_quarantined", "rows_loaded", "rows_inserted", "rows_updated", "status")


# ---- registry ----------------------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    sf = "/root/testdata/sf0.001"
    return summary.daily_summary(gold.silver_to_gold(_silver(spark, sf)))


def _training_data():
    """The queries of the optional subpackage, where it is installed."""
    if importlib.util.find_spec("barworks.llm") is None or importlib.util.find_spec("barworks.llm.queries") is None:
        return None
    from barworks.llm import queries as llm
    return llm


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    llm = _training_data()
    return {**_own_queries(), **(llm.queries() if llm else {})}


def _own_queries():
    return {
        "scan_bronze": scan_bronze_query,
        "normalize_bars": normalize_bars_query,
        "normalize_zoned": normalize_zoned,
        "union_symbol_frames": union_symbol_frames,
        "file_outcomes": file_outcomes,
        "bars_from_ticks": lambda s, sf: fx.plain(bars_from_ticks(fx.event_ticks(s, sf), "px", "event_id")),
        "resample_weekly": lambda s, sf: resample_bars(fx.typed_bars(s, sf), "1wk"),
        "resample_monthly": lambda s, sf: resample_bars(fx.typed_bars(s, sf), "1mo"),
        "month_bounds": month_bounds_query,
        "table_counts": lambda s, sf: table_counts({t: fx.table(s, sf, t) for t in fx.TABLES}),
        "table_list": table_list,
        "param_query": param_query,
        "star_schema_load": star_schema_load,
        "silver_cast": silver_cast,
        "silver_filter": lambda s, sf: silver.silver_filter(silver.silver_cast(fx.dirty_bronze(s, sf))).select(*BAR_OUT),
        "dedupe_bars": lambda s, sf: silver.dedupe_bars(
            silver.silver_filter(silver.silver_cast(fx.dirty_bronze(s, sf)))).select(*BAR_KEY, "close_price", "open_price"),
        "bronze_to_silver": lambda s, sf: _silver(s, sf).select(*BAR_OUT, "daily_range", "change_pct", "source"),
        "derived_columns": lambda s, sf: fx.fact_bars(s, sf).select(*BAR_KEY, "daily_range", "change_pct"),
        "derived_columns_2dp": derived_columns_2dp,
        "row_contract_bars": row_contract_bars,
        "row_contract_symbols": row_contract_symbols,
        "quarantine_counts": lambda s, sf: contracts.quarantine_counts(_contract(s, sf)),
        "valid_bars": valid_bars,
        "q1_price_stats": lambda s, sf: analytics.price_stats(fx.fact_bars(s, sf)),
        "q1_top_20": lambda s, sf: analytics.report(analytics.price_stats(fx.fact_bars(s, sf)), "price_stats", 20),
        "q2_latest_price": lambda s, sf: fx.plain(analytics.latest_bars(fx.fact_bars(s, sf).drop("loaded_at"))),
        "q3_day_over_day": lambda s, sf: analytics.day_over_day(fx.typed_bars(s, sf)),
        "q3_latest_30": lambda s, sf: analytics.day_over_day(fx.typed_bars(s, sf), rows=30),
        "q3_one_listing": lambda s, sf: analytics.day_over_day(fx.typed_bars(s, sf), "S1", "NSE", rows=30),
        "q4_one_listing": lambda s, sf: analytics.moving_averages(fx.typed_bars(s, sf), "S1", "NSE", rows=60),
        "q4_moving_averages": lambda s, sf: analytics.moving_averages(fx.typed_bars(s, sf)),
        "q4_latest_60": lambda s, sf: analytics.moving_averages(fx.typed_bars(s, sf), rows=60),
        "q5_gainers_losers": lambda s, sf: analytics.gainers_losers(_written(fx.fact_bars(s, sf))),
        "monthly_returns": lambda s, sf: analytics.monthly_returns(fx.fact_bars(s, sf)),
        "q6_sector_monthly": lambda s, sf: analytics.sector_monthly(fx.fact_bars(s, sf), fx.listings(s, sf)),
        "q7_trading_days": trading_days,
        "q7_one_fiscal_quarter": one_fiscal_quarter,
        "ingest_counts": lambda s, sf: analytics.ingest_counts(fx.lineitem_bars(s, sf)),
        "watermark_candidates": lambda s, sf: incremental.watermark_candidates(fx.lineitem_bars(s, sf)),
        "ma_7d": _indicator("ma_7d"),
        "ma_30d": _indicator("ma_30d"),
        "daily_return": _indicator("daily_return_pct"),
        "volatility_30d": _indicator("volatility_30d"),
        "avg_volume_7d": avg_volume_7d,
        "volume_rank": volume_rank_query,
        "ma_cross": lambda s, sf: gold.moving_average_cross(gold.listing_indicators(fx.typed_bars(s, sf))).select(
            *BAR_KEY, "ma_7d", "ma_30d", "signal"),
        "gold": gold_query,
        "daily_summary": lambda s, sf: summary.daily_summary(_indicators(s, sf)),
        "daily_summary_sql": daily_summary_sql,
        "sector_daily_summary": lambda s, sf: summary.sector_daily_summary(_indicators(s, sf), fx.listings(s, sf)),
        "silver_sql": silver_sql,
        "gold_sql": gold_sql,
        "medallion_run": lambda s, sf: _medallion(s, sf)["summary"],
        "medallion_counts": medallion_counts,
        "medallion_clean": medallion_clean,
        "ctas_silver": ctas_silver,
        "load_quarantine": load_quarantine,
        "watermark_table": watermark_table,
        "run_metrics": run_metrics,
        "gap_watermarks": gap_watermarks,
        "gold_refresh": gold_refresh,
        "summary_refresh": summary_refresh,
        "dim_date": lambda s, sf: fx.plain(dims.dim_date_covering(fx.lineitem_bars(s, sf)).drop("is_month_end", "is_quarter_end")),
        "dim_date_flags": lambda s, sf: dims.dim_date_covering(fx.lineitem_bars(s, sf)).select("date_key", "is_month_end", "is_quarter_end"),
        "dim_exchange": dim_exchange,
        "dim_symbol_scd1": dim_symbol_scd1,
        "qc_not_null": _suite(lambda: [quality.not_null(c) for c in ("symbol", "trade_date", "close_price")]),
        "qc_unique": _suite(lambda: [quality.unique("trade_date")]),
        "qc_unique_composite": _suite(lambda: [quality.unique(BAR_KEY, quality.WARN, "unique(symbol+exchange+date)")]),
        "qc_in_range": _suite(lambda: [*[quality.in_range(c, min_val=0) for c in (*PRICES, "volume")],
                                       quality.in_range("volume", 0, 100)]),
        "qc_row_count": _suite(lambda: [quality.row_count_between(1), quality.row_count_between(1, 100)]),
        "qc_freshness": _suite(lambda: [quality.freshness("trade_date", "2024-02-01", n) for n in (3, 0)], fx.event_bars),
        "qc_schema": _suite(lambda: [quality.schema_match(BAR_OUT, quality.WARN),
                                     quality.schema_match(["symbol", "volume", "isin"]), quality.row_count_between(1)]),
        "qc_custom": _suite(lambda: [quality.custom_check(
            "no_future_dates", F.max("trade_date") <= _day("2000-01-01"), columns=["trade_date"])]),
        "qc_bar_suite": _suite(quality.bar_suite),
        "qc_suite_summary": qc_suite_summary,
        "incremental_extract": incremental_extract,
        "period_extract": lambda s, sf: incremental.period_extract(fx.typed_bars(s, sf), "1998-06-30", "3mo").select(*BAR_KEY, "close_price"),
        "watermark_advance": watermark_advance,
        "watermark_reset": watermark_reset,
        "upsert_bars": lambda s, sf: upsert.upsert_bars(*_upsert_sides(s, sf)).select(*BAR_KEY, "close_price"),
        "upsert_counts": lambda s, sf: upsert.upsert_counts(*_upsert_sides(s, sf)),
        "insert_absent": lambda s, sf: upsert.insert_absent(*_upsert_sides(s, sf), BAR_KEY).select(*BAR_KEY, "close_price"),
        "upsert_table": upsert_table_query,
        "listing_table_upsert": listing_table_upsert,
        "listing_table_averages": listing_table_averages,
        "incremental_gold": incremental_gold_query,
        "stream_ingest": stream_ingest_query,
        "stream_daily_bars": stream_daily_bars_query,
        "stream_ticks_replayed": stream_ticks_replayed,
        "stream_late_ticks": stream_late_ticks_query,
        "stream_metrics": stream_metrics,
    }


def oracle_sql() -> dict[str, str]:
    llm = _training_data()
    return {**oracle_queries.oracle_sql(fx.TABLES), **(llm.oracle_sql() if llm else {})}
