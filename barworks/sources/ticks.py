"""Ticks to daily bars, and daily bars to longer frames."""

from pyspark.sql import functions as F

from barworks.functions.dates import month_start
from barworks.sources.bars import with_bar_metrics


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def bar_aggregates(price, tick_order, open_price=None, high=None, low=None, volume=None):
    """The five aggregates of a bar.

    All of them combine on the map side, so a symbol that holds a third of the
    ticks reaches the shuffle as one row per task and day. A single ordering
    column keeps the aggregation buffers fixed width (hash aggregation); several
    are compared as a struct.
    """
    price = _col(price)
    order = [_col(c) for c in ([tick_order] if not isinstance(tick_order, (list, tuple)) else tick_order)]
    order = order[0] if len(order) == 1 else F.struct(*order)
    pick = lambda c: price if c is None else _col(c)
    return [
        F.min_by(pick(open_price), order).alias("open_price"),
        F.max(pick(high)).alias("high_price"),
        F.min(pick(low)).alias("low_price"),
        F.max_by(price, order).alias("close_price"),
        (F.count(F.lit(1)) if volume is None else F.sum(_col(volume))).alias("volume"),
    ]


def bars_from_ticks(ticks, price, tick_order, keys=("symbol", "exchange_code", "trade_date"), **parts):
    """Aggregate ticks to one bar per key. ``parts`` as in :func:`bar_aggregates`."""
    return ticks.groupBy(*keys).agg(*bar_aggregates(price, tick_order, **parts))


def resample_bars(bars, frame, keys=("symbol", "exchange_code")):
    """Daily bars to weekly (Monday start) or monthly bars, labelled by first day."""
    if frame == "1d":
        return bars
    starts = {"1wk": F.trunc("trade_date", "week"), "1mo": month_start("trade_date")}
    if frame not in starts:
        raise ValueError(f"frame must be one of 1d, 1wk, 1mo, got {frame!r}")
    grouped = bars.withColumn("period_start", starts[frame]).groupBy(*keys, "period_start").agg(
        F.min_by("open_price", "trade_date").alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", "trade_date").alias("close_price"),
        F.sum("volume").alias("volume"),
        F.count(F.lit(1)).alias("trading_days"),
    )
    return with_bar_metrics(grouped)
