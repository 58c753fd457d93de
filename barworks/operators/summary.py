"""Daily summaries of the gold layer. Partial aggregation on both sides of the shuffle."""

from pyspark.sql import functions as F

from barworks.functions.numeric import round_stable
from barworks.operators.analytics import with_listing_attributes


def _summary(df, group, spread):
    return df.filter(F.col("daily_return_pct").isNotNull()).groupBy(*group).agg(
        round_stable(F.avg("daily_return_pct"), 4).alias("avg_return_pct"),
        round_stable(F.avg(F.col("close_price").cast("double")), 2).alias("avg_close_price"),
        F.sum("volume").cast("bigint").alias("total_volume"),
        F.count(F.lit(1)).alias("stock_count"),
        spread,
    )


def average_volatility():
    return round_stable(F.avg("volatility_30d"), 4).alias("avg_volatility")


def return_volatility():
    return round_stable(F.stddev_samp("daily_return_pct"), 4).alias("return_volatility")


def daily_summary(gold, group=("trade_date", "exchange_code"), spread=None):
    """Per day and exchange: returns, close, volume, count and mean volatility.

    Pass ``spread=return_volatility()`` for the spread of returns across stocks
    instead of the mean of their own volatilities. The result is unordered; a
    table has no order and a display can ask for one.
    """
    return _summary(gold, group, average_volatility() if spread is None else spread)


def sector_daily_summary(gold, dim_symbol):
    """The same summary per day and sector."""
    return _summary(with_listing_attributes(gold, dim_symbol, ["sector"]),
                    ("trade_date", "sector"), average_volatility())
