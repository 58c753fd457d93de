"""Explicit schemas and key columns. Nothing in the library infers a schema."""

from pyspark.sql import types as T

LISTING = ["symbol", "exchange_code"]
BAR_KEY = ["symbol", "exchange_code", "trade_date"]
PRICES = ["open_price", "high_price", "low_price", "close_price"]

# Column names, exchange codes and time frames of the data model.
BAR_COLUMNS = [
    "symbol", "exchange_code", "trade_date",
    "open_price", "high_price", "low_price", "close_price",
    "volume", "daily_range", "change_pct", "source",
]
EXCHANGES = ["NSE", "BSE"]
EXCHANGE_NAMES = {
    "NSE": "National Stock Exchange of India",
    "BSE": "Bombay Stock Exchange",
}
TIME_FRAMES = ["1d", "1wk", "1mo"]
MARKET_STATUSES = ["OPEN", "CLOSED", "PRE_MARKET", "POST_MARKET"]
DATA_SOURCES = ["snowflake", "yfinance", "nse_api", "manual"]
FEED_SOURCE, RECORD_SOURCE = "yfinance", "snowflake"
FEED_TIMEZONE = "Asia/Kolkata"

_PRICE = T.DecimalType(18, 4)

FACT_BARS = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("exchange_code", T.StringType(), False),
    T.StructField("trade_date", T.DateType(), False),
    T.StructField("open_price", _PRICE),
    T.StructField("high_price", _PRICE),
    T.StructField("low_price", _PRICE),
    T.StructField("close_price", _PRICE),
    T.StructField("volume", T.LongType()),
    T.StructField("daily_range", _PRICE),
    T.StructField("change_pct", T.DecimalType(10, 4)),
    T.StructField("source", T.StringType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
])

# Raw bar files: one row per ticker and day, names as the bar feed spells them.
RAW_BARS = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("Date", T.TimestampNTZType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.LongType()),
])

DIM_EXCHANGE = T.StructType([
    T.StructField("exchange_id", T.LongType(), False),
    T.StructField("exchange_code", T.StringType(), False),
    T.StructField("exchange_name", T.StringType(), False),
    T.StructField("country", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

DIM_SYMBOL = T.StructType([
    T.StructField("symbol_id", T.LongType(), False),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("company_name", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("isin", T.StringType()),
    T.StructField("exchange_code", T.StringType(), False),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("listed_date", T.DateType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

DIM_DATE = T.StructType([
    T.StructField("date_key", T.DateType(), False),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("day_name", T.StringType()),
    T.StructField("day_of_month", T.IntegerType()),
    T.StructField("day_of_year", T.IntegerType()),
    T.StructField("week_of_year", T.IntegerType()),
    T.StructField("month_number", T.IntegerType()),
    T.StructField("month_name", T.StringType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("is_weekend", T.BooleanType()),
    T.StructField("is_trading_day", T.BooleanType()),
    T.StructField("is_month_end", T.BooleanType()),
    T.StructField("is_quarter_end", T.BooleanType()),
    T.StructField("fiscal_year", T.IntegerType()),
    T.StructField("fiscal_quarter", T.IntegerType()),
])

WATERMARK_LOG = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("exchange_code", T.StringType()),
    T.StructField("epoch", T.LongType()),
    T.StructField("watermark", T.DateType()),
])

GAP_LOG = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("exchange_code", T.StringType()),
    T.StructField("trade_date", T.DateType()),
    T.StructField("turn", T.LongType()),
    T.StructField("is_open", T.BooleanType()),
])
