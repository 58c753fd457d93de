"""Calendar, exchange and listing dimensions."""

import datetime as dt

from pyspark.sql import functions as F

from barworks.functions.dates import fiscal_quarter, fiscal_year
from barworks.operators.upsert import insert_absent
from barworks.schemas import EXCHANGE_NAMES, LISTING

DEFAULT_START, DEFAULT_END = dt.date(2020, 1, 1), dt.date(2030, 12, 31)


def calendar_columns(day, fiscal_start_month=4):
    """Calendar attributes of a date column, in dimension order."""
    day = F.col(day) if isinstance(day, str) else day
    weekday = (F.weekday(day) + 1).cast("int")
    month_end = F.last_day(day) == day
    return {
        "day_of_week": weekday,
        "day_name": F.date_format(day, "EEE"),
        "day_of_month": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "week_of_year": F.weekofyear(day),
        "month_number": F.month(day),
        "month_name": F.date_format(day, "MMM"),
        "quarter": F.quarter(day),
        "year": F.year(day),
        "is_weekend": weekday >= 6,
        "is_trading_day": weekday < 6,
        "is_month_end": month_end,
        "is_quarter_end": month_end & (F.month(day) % 3 == 0),
        "fiscal_year": fiscal_year(day, fiscal_start_month),
        "fiscal_quarter": fiscal_quarter(day, fiscal_start_month),
    }


def _with_holidays(calendar, holidays):
    if holidays is None:
        return calendar
    off = holidays.select(F.col(holidays.columns[0]).alias("date_key")).distinct().withColumn("_off", F.lit(True))
    return calendar.join(off, "date_key", "left").withColumn(
        "is_trading_day", F.col("is_trading_day") & F.col("_off").isNull()).drop("_off")


def dim_date(spark, start=DEFAULT_START, end=DEFAULT_END, fiscal_start_month=4, holidays=None):
    """One row per day from ``start`` to ``end`` (4,018 by default)."""
    first, last = _as_date(start), _as_date(end)
    return _calendar(spark, first, max(0, (last - first).days + 1), fiscal_start_month, holidays)


def _as_date(day):
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(str(day))


def _calendar(spark, first, days, fiscal_start_month, holidays):
    """Day numbers dealt over tasks, not one long array in one row."""
    numbered = spark.range(days).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("date_key"))
    return _with_holidays(numbered.withColumns(calendar_columns("date_key", fiscal_start_month)), holidays)


def dim_date_covering(fact, fiscal_start_month=4, holidays=None):
    """The calendar from the first to the last trade date of a table (found by one aggregate)."""
    lo, hi = fact.agg(F.min("trade_date"), F.max("trade_date")).first()
    first = dt.date(1970, 1, 1) if lo is None else lo
    return _calendar(fact.sparkSession, first, 0 if lo is None else (hi - lo).days + 1, fiscal_start_month, holidays)


def surrogate_id(*natural_key):
    """A key that is the same on every run, unlike a running number."""
    return F.xxhash64(*[F.col(c) for c in natural_key])


def exchange_seed(spark, names=EXCHANGE_NAMES):
    """The known exchanges with their default attributes (fixed values of the model)."""
    rows = [(code, name, "India", "INR", "Asia/Kolkata") for code, name in names.items()]
    seed = spark.createDataFrame(
        rows, "exchange_code string, exchange_name string, country string, currency string, timezone string")
    return seed.withColumn("exchange_id", surrogate_id("exchange_code"))


def dim_exchange(existing, seed):
    """Insert the seed where its code is missing; never update what is there."""
    return insert_absent(existing, seed, ["exchange_code"])


def exchanges_in(fact):
    """Exchange codes seen in the data, named by their own code until seeded."""
    return fact.select("exchange_code").distinct().select(
        "exchange_code",
        F.col("exchange_code").alias("exchange_name"),
        F.lit("India").alias("country"), F.lit("INR").alias("currency"),
        F.lit("Asia/Kolkata").alias("timezone"),
        surrogate_id("exchange_code").alias("exchange_id"),
    )


def listings_in(fact):
    """New listing rows for the dimension, attributes empty until described."""
    return fact.groupBy(*LISTING).agg(F.min("trade_date").alias("listed_date")).select(
        surrogate_id(*LISTING).alias("symbol_id"), *LISTING,
        *[F.lit("").alias(c) for c in ("company_name", "sector", "industry", "isin")],
        F.lit(True).alias("is_active"), "listed_date",
    )


def dim_symbol_scd1(existing, described, fact):
    """Listing dimension, type 1: new listings are added, attributes overwritten.

    ``described`` carries the current attributes per listing; they replace the
    stored ones and no history is kept. Of several descriptions of a listing the
    largest (by attributes, in order) holds. Listings nobody describes keep theirs.
    """
    with_new = insert_absent(existing, listings_in(fact), LISTING)
    attributes = [c for c in ("company_name", "sector", "industry", "isin", "is_active") if c in described.columns]
    current = described.groupBy(*LISTING).agg(F.max(F.struct(*attributes)).alias("_now"))
    updated = with_new.join(current, LISTING, "left").withColumns(
        {c: F.when(F.col("_now").isNotNull(), F.col(f"_now.{c}")).otherwise(F.col(c)) for c in attributes})
    return updated.select(*with_new.columns)
