"""Bronze to silver: safe casts, null filter, one row per natural key."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from barworks.functions.dates import safe_date
from barworks.functions.numeric import is_missing, safe_double, safe_long
from barworks.schemas import BAR_KEY, PRICES


def silver_cast(bronze):
    """Date, double and long columns; a value that does not parse becomes null."""
    casts = {"trade_date": safe_date("trade_date"), "volume": safe_long("volume")}
    casts.update({c: safe_double(c) for c in PRICES})
    return bronze.withColumns({c: e for c, e in casts.items() if c in bronze.columns})


def silver_filter(df):
    """Drop rows without a symbol, a date or a close (NaN is no close either)."""
    return df.filter(
        F.col("symbol").isNotNull()
        & F.col("trade_date").isNotNull()
        & ~is_missing("close_price", dict(df.dtypes)["close_price"])
    )


def dedupe_bars(df, keys=BAR_KEY, latest="loaded_at"):
    """One deterministic row per key: the last loaded, then the largest values.

    The rank limit of one is applied before the shuffle as well as after it
    (WindowGroupLimit, partial and final), so a key with a huge number of copies
    sends one row per task, not all of them.
    """
    rest = sorted(c for c in df.columns if c not in keys and c != latest)
    order = ([latest] if latest in df.columns else []) + rest
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_nth", F.row_number().over(newest)).filter(F.col("_nth") == 1).drop("_nth")


def bronze_to_silver(bronze, keys=BAR_KEY, latest="loaded_at"):
    """Cast, filter, then dedupe: a late copy with a bad close cannot win."""
    return dedupe_bars(silver_filter(silver_cast(bronze)), keys, latest)


def bronze_to_silver_distinct(bronze):
    """The variant that only removes rows equal in every output column."""
    columns = [
        "symbol", "exchange_code", "trade_date", *PRICES, "volume",
        "daily_range", "change_pct", "source",
    ]
    typed = silver_filter(silver_cast(bronze)).withColumns(
        {"daily_range": safe_double("daily_range"), "change_pct": safe_double("change_pct")}
    )
    return typed.select(*columns).distinct()


def stamp(df, layer, source=None):
    """Metadata columns, added when a layer is written rather than inside it."""
    df = df.withColumn(f"_{layer}_loaded_at", F.current_timestamp())
    return df if source is None else df.withColumn("_source", F.lit(source))
