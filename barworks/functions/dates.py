"""Column helpers for dates and fiscal calendars."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def safe_date(c):
    """The value as a date; unparsable text becomes null instead of an error."""
    return _col(c).try_cast("date")


def month_start(c):
    return F.trunc(_col(c), "MM")


def fiscal_year(c, start_month=4):
    """Fiscal year named after the calendar year in which it ends."""
    c = _col(c)
    if start_month == 1:
        return F.year(c)
    return F.year(c) + F.when(F.month(c) >= start_month, 1).otherwise(0)


def fiscal_quarter(c, start_month=4):
    months_in = F.pmod(F.month(_col(c)) - F.lit(start_month), F.lit(12))
    return (F.floor(months_in / 3) + 1).cast("int")


MONTH_COLUMN = "trade_month"


def date_bounded(df, since=None, until=None):
    """Rows between two days (inclusive; columns, dates or scalar subqueries).

    Where the frame still has its month partition column, the bounds are applied
    to it as well, so whole months are skipped before a file is opened.
    """
    bounds = [(since, lambda c, day: c >= day), (until, lambda c, day: c <= day)]
    for day, compare in bounds:
        if day is None:
            continue
        day = day if isinstance(day, Column) else F.lit(day)
        df = df.filter(compare(F.col("trade_date"), day.cast("date")))
        if MONTH_COLUMN in df.columns:
            df = df.filter(compare(F.col(MONTH_COLUMN), month_start(day.cast("date"))))
    return df
