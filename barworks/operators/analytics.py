"""Analytical questions over the fact table and its dimensions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from barworks.functions.dates import MONTH_COLUMN, month_start
from barworks.functions.numeric import guarded_ratio, is_missing, pct_change, round_stable
from barworks.operators.gold import LONG_ROWS, SHORT_ROWS, moving_average, previous_close, with_rounded
from barworks.operators.ranks import attach_ranks, rank_key, value_ranks
from barworks.schemas import LISTING

# How each answer is shown: columns, largest first where marked with "-".
REPORT_ORDER = {
    "price_stats": ["-avg_close_price", "symbol", "exchange_code"],
    "latest_bars": ["symbol", "exchange_code"],
    "day_over_day": ["-trade_date", "symbol", "exchange_code"],
    "moving_averages": ["-trade_date", "symbol", "exchange_code"],
    "gainers_losers": ["-trade_date", "gain_rank", "exchange_code", "symbol"],
    "sector_monthly": ["-month_start", "-avg_sector_return_pct", "sector"],
    "trading_days": ["-year", "-month_number"],
    "daily_summary": ["trade_date", "exchange_code"],
}


def report(df, question, rows=None):
    """An answer in display order, optionally its first rows only.

    With ``rows`` each task keeps that many candidates and no full sort happens.
    """
    order = [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last()
             for c in REPORT_ORDER[question]]
    ordered = df.orderBy(*order)
    return ordered if rows is None else ordered.limit(rows)


def _close():
    return F.col("close_price").cast("double")


def with_listing_attributes(df, dim_symbol, attributes):
    """Join listing attributes, skipping listings without a sector.

    The dimension grows with the number of listings, so the join strategy is
    left to adaptive execution, which broadcasts only below its size threshold.
    """
    dim = dim_symbol.select(*LISTING, *attributes)
    if "sector" in attributes:
        dim = dim.filter(F.col("sector").isNotNull() & (F.col("sector") != ""))
    return df.join(dim, LISTING, "inner")


def _for_listing(fact, symbol, exchange_code):
    if symbol is not None:
        fact = fact.filter(F.col("symbol") == symbol)
    if exchange_code is not None:
        fact = fact.filter(F.col("exchange_code") == exchange_code)
    return fact


def price_stats(fact):
    """Q1: trading days, close statistics and volume per listing."""
    return fact.groupBy(*LISTING).agg(
        F.count(F.lit(1)).alias("total_trading_days"),
        round_stable(F.avg(_close()), 2).alias("avg_close_price"),
        round_stable(F.min(_close()), 2).alias("min_close_price"),
        round_stable(F.max(_close()), 2).alias("max_close_price"),
        F.sum("volume").cast("bigint").alias("total_volume"),
    )


def latest_bars(fact):
    """Q2: the whole latest row of each listing, in one scan.

    The aggregate keeps one candidate per listing and task, so only those are
    shuffled; a self-join would read the table twice and shuffle it.
    """
    others = [c for c in fact.columns if c not in (*LISTING, "trade_date")]
    return fact.groupBy(*LISTING).agg(
        F.max("trade_date").alias("trade_date"),
        *[F.max_by(c, "trade_date").alias(c) for c in others],
    ).select(*fact.columns)


def _newest_first():
    return Window.partitionBy(*LISTING).orderBy(F.col("trade_date").desc())


def _latest_rows(df, rows):
    """The latest rows of each listing, numbered in ``_nth``. The limit also applies
    before the shuffle, so each task sends at most that many rows of a listing."""
    return df.withColumn("_nth", F.row_number().over(_newest_first())).filter(F.col("_nth") <= rows)


def day_over_day(fact, symbol=None, exchange_code=None, rows=None):
    """Q3: previous close and change per listing; ``rows`` keeps the latest n days.

    Filters on the listing reach the scan. With ``rows``, only as many days as the
    answer reads (one more than it shows) take part in the windows, and all of
    them look back along one descending order.
    """
    picked = _for_listing(fact, symbol, exchange_code).select(
        *LISTING, "trade_date", _close().alias("close_price"))
    previous = previous_close()
    if rows is not None:
        picked = _latest_rows(picked, rows + 1)
        previous = F.lead("close_price", 1).over(_newest_first())
    changed = picked.withColumn("prev_close", previous)
    if rows is not None:
        changed = changed.filter(F.col("_nth") <= rows).drop("_nth")
    return changed.withColumns({
        "daily_change": F.col("close_price") - F.col("prev_close"),
        "daily_change_pct": pct_change("close_price", "prev_close", 2),
    })


def moving_averages(fact, symbol=None, exchange_code=None, rows=None):
    """Q4: 7 and 30 row averages of close and 7 row average of volume.

    With ``rows``, only the days shown and the 29 before them are shuffled, and
    the frames reach forward along the descending order of the cut.
    """
    picked = _for_listing(fact, symbol, exchange_code).select(
        *LISTING, "trade_date", _close().alias("close_price"), "volume")
    average = moving_average
    if rows is not None:
        picked = _latest_rows(picked, rows + LONG_ROWS - 1)
        average = lambda c, n: F.avg(F.col(c).cast("double")).over(_newest_first().rowsBetween(0, n - 1))
    averaged = with_rounded(picked, {
        "ma_7day": (average("close_price", SHORT_ROWS), 2),
        "ma_30day": (average("close_price", LONG_ROWS), 2),
        "avg_volume_7day": (average("volume", SHORT_ROWS), 0),
    }).drop("volume")
    return averaged if rows is None else averaged.filter(F.col("_nth") <= rows).drop("_nth")


def gainers_losers(fact, k=5):
    """Q5: rows ranked among the k largest gains or losses of a day and exchange.

    Both ranks come from one count per distinct change, so no task ever sorts a
    whole day; only the surviving changes are joined back to rows.
    """
    group = ["trade_date", "exchange_code"]
    kind = dict(fact.dtypes)["change_pct"]
    keyed = fact.filter(~is_missing("change_pct", kind)).select(
        *LISTING, "trade_date", _close().alias("close_price"),
        F.col("change_pct").cast("double").alias("change_pct"),
        rank_key("change_pct", kind).alias("_change_key"),
    )
    ranks = value_ranks(keyed, group, "_change_key").filter(
        (F.col("rank_desc") <= k) | (F.col("rank_asc") <= k))
    ranked = attach_ranks(
        keyed, ranks, group, "_change_key",
        {"rank_desc": "gain_rank", "rank_asc": "loss_rank"}, how="inner")
    return ranked.select(*LISTING, "trade_date", "close_price", "change_pct", "gain_rank", "loss_rank")


def monthly_returns(fact):
    """First and last close of each listing and month, and the change between.

    A plain aggregate with fixed-width buffers: no sort, no window, no distinct.
    """
    return fact.groupBy(*LISTING, month_start("trade_date").alias("month_start")).agg(
        F.min_by(_close(), F.col("trade_date")).alias("month_open"),
        F.max_by(_close(), F.col("trade_date")).alias("month_close"),
    ).withColumn("monthly_return_pct", pct_change("month_close", "month_open", 2))


def sector_monthly(fact, dim_symbol):
    """Q6: monthly returns by sector. Bars are reduced to months before the join."""
    joined = with_listing_attributes(monthly_returns(fact), dim_symbol, ["sector"])
    return joined.groupBy("sector", "month_start").agg(
        F.count_distinct("symbol").alias("stocks_in_sector"),
        round_stable(F.avg("monthly_return_pct"), 2).alias("avg_sector_return_pct"),
        round_stable(F.min("monthly_return_pct"), 2).alias("worst_stock_return_pct"),
        round_stable(F.max("monthly_return_pct"), 2).alias("best_stock_return_pct"),
    )


def trading_days(fact, dim_date):
    """Q7: rollup by month and fiscal quarter over the calendar's working days.

    Both distinct counts come from one hash aggregation per symbol and month:
    its rows are the distinct symbols, and the days of a month fit in the bits
    of a long. Counting distinct values directly would expand every bar to three.

    A fact that still has its month column is also joined on the month, so a filter
    on the calendar (one fiscal quarter) skips the other months at run time.
    """
    days = dim_date.filter(~F.col("is_weekend")).select(
        "date_key", "month_name", "month_number", "year", "fiscal_quarter", month_start("date_key").alias("_month"))
    group = ["month_name", "year", "fiscal_quarter", "month_number"]
    by_month = [MONTH_COLUMN] if MONTH_COLUMN in fact.columns else []
    bars = fact.select("symbol", "trade_date", _close().alias("close_price"), "volume", *by_month)
    same = [F.col("trade_date") == F.col("date_key")] + [F.col(c) == F.col("_month") for c in by_month]
    joined = bars.join(days, same, "inner")
    day_bit = F.expr("shiftleft(1L, dayofmonth(trade_date) - 1)")
    by_symbol = joined.groupBy("symbol", *group).agg(
        F.bit_or(day_bit).alias("_days"),
        F.sum("close_price").alias("_close_sum"),
        F.count("close_price").alias("_closes"),
        F.sum("volume").alias("_volume"),
    )
    return by_symbol.groupBy(*group).agg(
        F.bit_count(F.bit_or("_days")).cast("bigint").alias("trading_days"),
        F.count("symbol").alias("stocks_traded"),
        round_stable(guarded_ratio(F.sum("_close_sum"), F.sum("_closes")), 2).alias("avg_close_across_all"),
        F.sum("_volume").cast("bigint").alias("total_volume"),
    )


def ingest_counts(df):
    """Rows, symbols and listings of a batch, from one row per listing."""
    per_listing = df.groupBy(*LISTING).agg(F.count(F.lit(1)).alias("_rows"))
    return per_listing.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        F.count_distinct("symbol").alias("symbol_count"),
        F.count(F.lit(1)).alias("listing_count"),
    )
