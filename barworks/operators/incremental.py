"""Per-listing high-water marks: what to extract, and how far a load got."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from barworks.functions.dates import date_bounded, safe_date
from barworks.operators.gaps import gap_days
from barworks.schemas import LISTING

# Load periods, as (unit, amount) back from the reference day.
PERIODS = {
    "1d": ("day", 1),
    "5d": ("day", 5),
    "1mo": ("month", 1),
    "3mo": ("month", 3),
    "6mo": ("month", 6),
    "1y": ("month", 12),
    "max": None,
}


def period_start(as_of, period):
    """First day of a period that ends at ``as_of``; null for the whole history."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {', '.join(PERIODS)}, got {period!r}")
    if PERIODS[period] is None:
        return F.lit(None).cast("date")
    unit, amount = PERIODS[period]
    day = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return F.date_sub(day, amount) if unit == "day" else F.add_months(day, -amount)


def period_extract(bars, as_of, period="1mo"):
    """Full mode: all rows of the period, whatever was loaded before."""
    start = period_start(as_of, period)
    return date_bounded(bars, None if PERIODS[period] is None else start, as_of)


def incremental_extract(bars, state, as_of, period="max", lookback_days=0, gaps=None):
    """Rows after each listing's watermark and before ``as_of``, and those of its open gaps.

    A listing without a watermark takes the whole ``period``. ``lookback_days``
    re-reads that many days before the watermark to pick up late corrections.

    The scan is bounded by ``as_of`` and, unless the period is the whole
    history, by the oldest day any listing can still need: a scalar subquery
    that skips months and row groups. The state is joined without a broadcast
    hint because it grows with the number of listings. ``gaps`` (symbol, exchange_code,
    intervals) is a second, narrow branch: its scan is bounded by the first and the last open day.
    """
    as_of = F.lit(as_of).cast("date")
    marks = state.select(*LISTING, safe_date("watermark").alias("_mark"))
    if lookback_days:
        marks = marks.withColumn("_mark", F.date_sub("_mark", lookback_days))
    start = period_start(as_of, period)
    oldest = None
    if PERIODS[period] is not None:
        oldest = marks.agg(F.least(F.date_add(F.min("_mark"), 1), start)).scalar()
    fresh = F.when(F.col("_mark").isNotNull(), F.col("trade_date") > F.col("_mark")).otherwise(
        F.coalesce(F.col("trade_date") >= start, F.lit(True)))
    candidates = date_bounded(bars, oldest, F.date_sub(as_of, 1))
    new = candidates.join(marks, LISTING, "left").filter(fresh).drop("_mark")
    if gaps is None:
        return new
    days = gap_days(gaps)
    between = date_bounded(bars, days.agg(F.min("trade_date")).scalar(), days.agg(F.max("trade_date")).scalar())
    missed = between.join(days, [*LISTING, "trade_date"], "left_semi").join(marks, LISTING, "left").filter(~fresh).drop("_mark")
    return new.unionByName(missed.filter(F.col("trade_date") < as_of))


def watermark_candidates(loaded):
    """The last date of each listing in a loaded batch."""
    return loaded.groupBy(*LISTING).agg(F.max("trade_date").alias("watermark"))


def watermark_advance(state, loaded):
    """The state after a successful load; a watermark never moves back."""
    return state.select(*LISTING, "watermark").unionByName(watermark_candidates(loaded)).groupBy(
        *LISTING).agg(F.max("watermark").alias("watermark"))


def watermark_reset(state, listings=None):
    """Forget some listings (those in ``listings``) or all of them."""
    if listings is None:
        return state.limit(0)
    return state.join(listings.select(*LISTING), LISTING, "left_anti")
