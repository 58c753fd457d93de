"""Row contracts: one pass that names every rule a row breaks.

Instead of raising on the first bad record, a contract adds ``violations``
(array of rule names); the split into valid rows and quarantine follows from it.
"""

from pyspark.sql import functions as F

from barworks.functions.dates import safe_date
from barworks.functions.numeric import is_infinite, is_missing, safe_double
from barworks.functions.text import clean_upper
from barworks.schemas import EXCHANGES, PRICES, RECORD_SOURCE


def _violations(rules):
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))


def _parsed(df, default_source):
    """The bars with every text parsed, each value once.

    The values come out of a generator of one row. A filter on what is derived from them stops there; through
    a projection it would take the casts along and run them again for every rule that reads them.
    """
    given = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    volume = given("volume")
    parsed = {
        "exchange_code": F.coalesce(given("exchange_code"), F.lit("NSE")),
        "volume": F.lit(None).cast("bigint"),
        "source": F.coalesce(given("source"), F.lit(default_source)),
        "symbol": clean_upper("symbol"),
        "trade_date": safe_date("trade_date"),
        **{c: safe_double(c) for c in PRICES},
    }
    extra = {"_given": volume.isNotNull(), "_number": volume.try_cast("double"), "_long": volume.try_cast("bigint")}
    columns = [*df.columns, *[c for c in parsed if c not in df.columns]]
    values = F.struct(*[c.alias(f"_parsed_{name}") for name, c in parsed.items()], *[c.alias(name) for name, c in extra.items()])
    rows = df.select(*[c for c in df.columns if c not in parsed], F.inline(F.array(values)))
    return rows.select(*[F.col(f"_parsed_{c}").alias(c) if c in parsed else F.col(c) for c in columns], *extra)


def row_contract_bars(df, default_source=RECORD_SOURCE, strict=False):
    """Coerce a bar and list the rules it breaks.

    Required: symbol, trade_date, four prices. Prices and volume may not be
    negative, prices must be finite, and high may not be below low. An absent
    volume is 0; one that is no whole number is named and stays null. ``strict``
    also asks that open and close lie between low and high.
    """
    df = _parsed(df, default_source)
    given = F.col("_given") & ~F.coalesce(F.isnan("_number"), F.lit(False))
    whole = F.when(F.col("_number") == F.floor("_number"), F.coalesce("_long", F.col("_number").try_cast("bigint")))
    unparsable = given & whole.isNull()
    df = df.withColumns({"_no_volume": unparsable, "volume": F.when(~unparsable, F.coalesce(F.when(given, whole), F.lit(0).cast("bigint")))})
    rules = {
        "symbol_missing": F.col("symbol").isNull(),
        "trade_date_missing": F.col("trade_date").isNull(),
    }
    for c in PRICES:
        rules[f"{c}_missing"] = is_missing(c)
    for c in [*PRICES, "volume"]:
        rules[f"{c}_negative"] = F.col(c) < 0
    for c in PRICES:
        rules[f"{c}_not_finite"] = is_infinite(c)
    rules["volume_unparsable"] = F.col("_no_volume")
    rules["high_below_low"] = F.col("high_price") < F.col("low_price")
    if strict:
        rules["open_outside_range"] = ~F.col("open_price").between(F.col("low_price"), F.col("high_price"))
        rules["close_outside_range"] = ~F.col("close_price").between(F.col("low_price"), F.col("high_price"))
    return df.withColumn("violations", _violations(rules)).drop("_no_volume", "_given", "_number", "_long")


def row_contract_symbols(df, exchanges=EXCHANGES):
    """Coerce a listing record: symbol not blank, exchange one of the known codes."""
    exchange = F.col("exchange_code") if "exchange_code" in df.columns else F.lit(None).cast("string")
    df = df.withColumns({
        "symbol": clean_upper("symbol"),
        "exchange_code": F.coalesce(clean_upper(exchange), F.lit("NSE")),
    })
    rules = {
        "symbol_empty": F.coalesce(F.col("symbol"), F.lit("")) == "",
        "exchange_unknown": ~F.col("exchange_code").isin(list(exchanges)),
    }
    return df.withColumn("violations", _violations(rules))


def split_valid(checked):
    """(valid rows without the column, quarantined rows with it)."""
    is_valid = F.size("violations") == 0
    return checked.filter(is_valid).drop("violations"), checked.filter(~is_valid)


def quarantine_counts(checked):
    """Rows per broken rule; a row that breaks two rules counts under both."""
    return checked.select(F.explode("violations").alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("row_count"))
