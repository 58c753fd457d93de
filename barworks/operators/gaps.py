"""Open gaps: days of a listing that a load saw but could not take, as intervals beside its high mark."""

from pyspark.sql import functions as F

from barworks.schemas import BAR_KEY, LISTING


def as_intervals(days):
    """(symbol, exchange_code, gaps) from the open days: sorted (first, last) intervals of days in a row.

    A listing's array is never longer than its days. The ends come from set
    differences of the days with themselves, moved by one day.
    """
    found = days.groupBy(*LISTING).agg(F.collect_set("trade_date").alias("days"))
    firsts = F.array_sort(F.array_except("days", F.transform("days", lambda d: F.date_add(d, 1))))
    lasts = F.array_sort(F.array_except("days", F.transform("days", lambda d: F.date_sub(d, 1))))
    return found.select(*LISTING, F.zip_with(firsts, lasts, lambda a, b: F.struct(a.alias("first"), b.alias("last"))).alias("gaps"))


def gap_days(gaps):
    """The days of the intervals, one a row."""
    each = gaps.select(*LISTING, F.explode("gaps").alias("gap"))
    return each.select(*LISTING, F.explode(F.sequence("gap.first", "gap.last")).alias("trade_date"))


def missed_days(good, bad):
    """Days that bad rows name and no good row of the same batch brings.

    Bad rows without a symbol or a date name no listing or day.
    """
    named = bad.filter("symbol IS NOT NULL AND exchange_code IS NOT NULL AND trade_date IS NOT NULL").select(*BAR_KEY).distinct()
    return named.join(good.select(*BAR_KEY), BAR_KEY, "left_anti")


def gap_advance(open_days, good, bad):
    """The open days after a load: closed where a good row came, opened where only bad ones did."""
    left = open_days.select(*BAR_KEY).join(good.select(*BAR_KEY), BAR_KEY, "left_anti")
    return left.unionByName(missed_days(good, bad)).distinct()
