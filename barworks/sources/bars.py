"""From the feed's spelling of a bar to the library's own."""

from pyspark.sql import functions as F

from barworks.functions.dates import safe_date
from barworks.functions.numeric import pct_change, round_stable
from barworks.functions.text import base_symbol, exchange_from_suffix
from barworks.schemas import BAR_COLUMNS, FEED_SOURCE, FEED_TIMEZONE, RAW_BARS

# Column names of the bar feed.
FEED_COLUMNS = {
    "Date": "trade_date",
    "Open": "open_price",
    "High": "high_price",
    "Low": "low_price",
    "Close": "close_price",
    "Volume": "volume",
}


def with_bar_metrics(df, scale=4, zero_open=None, change_from_open=False):
    """Add daily_range and change_pct (and optionally change_from_open).

    ``zero_open`` is the percentage reported for a bar that opened at 0; by
    default that bar has none.
    """
    high, low = F.col("high_price").cast("double"), F.col("low_price").cast("double")
    opened, closed = F.col("open_price").cast("double"), F.col("close_price").cast("double")
    added = {
        "daily_range": round_stable(high - low, scale),
        "change_pct": pct_change(closed, opened, scale, zero_open),
    }
    if change_from_open:
        added["change_from_open"] = round_stable(closed - opened, scale)
    return df.withColumns(added)


def normalize_bars(raw, ticker="ticker", source=FEED_SOURCE, feed_timezone=FEED_TIMEZONE):
    """Rename, split the ticker into symbol and exchange, derive, keep 11 columns.

    Columns the feed did not send are left out rather than invented. A zoned
    timestamp is dated in ``feed_timezone``, whatever the session's zone is; a
    plain timestamp, a date or a text carries its own day.
    """
    present = {c.lower(): c for c in raw.columns}
    renames = {present[k.lower()]: v for k, v in FEED_COLUMNS.items() if k.lower() in present}
    df = raw.withColumnsRenamed(renames)
    df = df.withColumns({
        "exchange_code": exchange_from_suffix(ticker),
        "symbol": base_symbol(ticker),
        "source": F.lit(source),
    })
    if "trade_date" in df.columns:
        if dict(df.dtypes)["trade_date"] == "timestamp":
            local = F.col("trade_date").cast("timestamp_ntz")
            df = df.withColumn("trade_date", F.convert_timezone(F.current_timezone(), F.lit(feed_timezone), local))
        df = df.withColumn("trade_date", safe_date("trade_date"))
    if {"open_price", "high_price", "low_price", "close_price"} <= set(df.columns):
        df = with_bar_metrics(df)
    return df.select(*[c for c in BAR_COLUMNS if c in df.columns])


def union_frames(frames):
    """Stack per-symbol frames by name, skipping the ones that failed (None)."""
    frames = [f for f in frames if f is not None]
    if not frames:
        return None
    while len(frames) > 1:  # in pairs: the plan is as deep as the logarithm of the frames
        pairs = [frames[k:k + 2] for k in range(0, len(frames), 2)]
        frames = [p[0] if len(p) == 1 else p[0].unionByName(p[1], allowMissingColumns=True) for p in pairs]
    return frames[0]


def read_bar_files(spark, paths, fmt="parquet", schema=RAW_BARS):
    """Many per-symbol files as one scan: one plan node however many paths."""
    return spark.read.format(fmt).schema(schema).load(list(paths))
