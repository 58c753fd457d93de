"""Column helpers for ticker text."""

from pyspark.sql import functions as F

# Ticker suffix of each exchange.
SUFFIX_EXCHANGE = {".NS": "NSE", ".BO": "BSE"}


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def clean_upper(c):
    return F.upper(F.trim(_col(c)))


def exchange_from_suffix(ticker):
    """Exchange code from the ticker suffix, UNKNOWN where there is none."""
    ticker = clean_upper(ticker)
    found = None
    for suffix, code in SUFFIX_EXCHANGE.items():
        hit = ticker.endswith(suffix)
        found = F.when(hit, code) if found is None else found.when(hit, code)
    return found.otherwise("UNKNOWN")


def base_symbol(ticker):
    """The ticker without its exchange suffix."""
    endings = "|".join(s.lstrip(".") for s in SUFFIX_EXCHANGE)
    return F.regexp_replace(clean_upper(ticker), rf"\.({endings})$", "")


def split_list(c):
    """A comma separated list as an array of trimmed, non-empty items."""
    return F.filter(F.transform(F.split(_col(c), ","), lambda item: F.trim(item)), lambda item: item != "")
