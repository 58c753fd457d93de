"""Bars and listings derived from the test tables.

The test tables hold no bars, so every registered query first derives some, on
Spark, from whole tables. These are adapters for checking, not operators.
"""

from functools import reduce

from pyspark.sql import functions as F

from barworks.schemas import PRICES
from barworks.sources.bars import with_bar_metrics
from barworks.sources.ticks import bars_from_ticks

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df, *columns):
    """Only dates, strings, booleans, longs and doubles, as a value check wants them."""
    kinds = {"decimal": "double", "float": "double", "int": "bigint", "smallint": "bigint"}
    picked = []
    for name, kind in df.dtypes:
        if columns and name not in columns:
            continue
        target = kinds.get(kind.split("(")[0])
        picked.append(F.col(name).cast(target).alias(name) if target else F.col(name))
    return df.select(*picked)


def lineitem_bars(spark, sf_dir):
    """Daily bars: one symbol per supplier, exchange by line status."""
    # Prices are longs of 1/10000, as a decimal made from a double goes through its text: cents by percent.
    cents, discount, tax = [F.floor(F.col(c) * 100 + 0.5) for c in ("l_extendedprice", "l_discount", "l_tax")]
    # Order, line, part, price in cents and discount in hundredths, as the digits of one
    # number of fixed width: it sorts like the five and lets Spark aggregate by hash.
    # The digits are put together as two longs of 18, which meet in one decimal.
    order, line, part = [F.col(c).cast("bigint") for c in ("l_orderkey", "l_linenumber", "l_partkey")]
    high = (order * 100 + line) * 10 + F.floor(part / 10 ** 8)
    low = (F.pmod(part, F.lit(10 ** 8)) * 10 ** 8 + F.col("cents")) * 100 + F.col("discount")
    tick_order = (high.cast("decimal(19,0)") * F.lit(10 ** 18).cast("decimal(19,0)") + low.cast("decimal(19,0)")).cast("decimal(38,0)")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", (F.col("l_linestatus") == "O").alias("is_open"), F.col("l_shipdate").cast("date").alias("trade_date"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", cents.alias("cents"), discount.alias("discount"), tax.alias("tax"))
    # Lines meet before they are aggregated: few share a supplier and a day, and a line is smaller than what its bar is made of.
    lines = lines.withColumn("l_quantity", F.col("l_quantity").cast("bigint")).repartition("l_suppkey", "is_open", "trade_date")
    ticks = lines.select(
        "l_suppkey", "is_open", "trade_date",
        (F.col("cents") * 100).alias("px"),
        (F.col("cents") * (100 - F.col("discount"))).alias("discounted"),
        (F.col("cents") * (100 + F.col("tax"))).alias("taxed"),
        F.col("l_quantity").alias("quantity"),
        tick_order.alias("tick_order"),
    )
    bars = bars_from_ticks(
        ticks, "px", "tick_order",
        keys=("l_suppkey", "is_open", "trade_date"),
        open_price="discounted", high="taxed", low="discounted", volume="quantity")
    unit = F.lit("0.0001").cast("decimal(4,4)")
    prices = [(F.col(c).cast("decimal(18,0)") * unit).cast("decimal(18,4)").alias(c) for c in PRICES]
    return bars.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        F.when(F.col("is_open"), "NSE").otherwise("BSE").alias("exchange_code"),
        "trade_date", *prices, "volume")


def fact_bars(spark, sf_dir):
    """The bars with their derived columns, source and load time."""
    return with_bar_metrics(lineitem_bars(spark, sf_dir)).withColumns({
        "source": F.lit("feed"), "loaded_at": F.col("trade_date").cast("timestamp_ntz")})


def typed_bars(spark, sf_dir):
    """Silver-typed bars without dirt: double prices."""
    return plain(lineitem_bars(spark, sf_dir))


def event_ticks(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.when(F.col("user_id") % 2 == 0, "NSE").otherwise("BSE").alias("exchange_code"),
        "ts", F.col("ts").cast("date").alias("trade_date"),
        F.col("value").cast("decimal(12,2)").alias("px"), "event_id")


def event_bars(spark, sf_dir):
    return bars_from_ticks(event_ticks(spark, sf_dir), "px", "event_id")


def listings(spark, sf_dir):
    """One described listing per supplier and exchange: name, nation, region."""
    described = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    return described.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"),
        F.explode(F.array(F.lit("NSE"), F.lit("BSE"))).alias("exchange_code"),
        F.col("s_name").alias("company_name"), F.col("n_name").alias("industry"),
        F.col("r_name").alias("sector"))


def dirty_bronze(spark, sf_dir, more=False):
    """The fact bars with every kind of dirt, chosen by plain integer arithmetic.

    ``more`` adds what only the row contract names: volumes as text, some of them no
    whole number, infinite prices and missing symbols.
    """
    bars = fact_bars(spark, sf_dir)
    supplier = F.expr("cast(substring(symbol, 2) as bigint)")
    days = F.datediff("trade_date", F.lit("1995-01-01").cast("date"))
    kind = F.col("kind")
    copies = F.when(kind.isin(2, 3), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = lambda c: F.col(c).cast("string")
    spread = bars.withColumn("kind", ((supplier * 31 + days) % 100).cast("int")).withColumn(
        "copy", F.explode(copies))
    second = F.col("copy") == 1
    close = (
        F.when(kind == 0, None)
        .when(kind == 1, "n/a")
        .when((kind == 2) & second, (F.col("close_price") + 1).cast("decimal(18,4)").cast("string"))
        .when((kind == 3) & second, None)
        .when(kind == 9, "NaN")
        .otherwise(text("close_price")))
    dirty = spread.select(
        "kind", F.when(kind == 7, F.concat(F.lit(" "), F.lower("symbol"), F.lit(" "))).otherwise(F.col("symbol")).alias("symbol"),
        "exchange_code",
        F.when(kind == 8, "bad").otherwise(text("trade_date")).alias("trade_date"),
        F.when(kind == 4, "0").otherwise(text("open_price")).alias("open_price"),
        F.when(kind == 5, text("low_price")).otherwise(text("high_price")).alias("high_price"),
        F.when(kind == 5, text("high_price")).otherwise(text("low_price")).alias("low_price"),
        close.alias("close_price"),
        F.when(kind == 6, -F.col("volume")).otherwise(F.col("volume")).alias("volume"),
        "daily_range", "change_pct", "source",
        F.when(second, F.col("loaded_at") + F.expr("interval 1 day")).otherwise(F.col("loaded_at")).alias("loaded_at"))
    if more:
        volume = F.when(kind == 10, "x").when(kind == 11, "1.5").when(kind == 12, F.concat(text("volume"), F.lit(".0")))
        dirty = dirty.withColumns({
            "volume": F.when(kind != 13, F.coalesce(volume, text("volume"))),
            "open_price": F.when(kind == 14, "Infinity").otherwise(F.col("open_price")),
            "symbol": F.when(kind != 15, F.col("symbol"))})
    return dirty.drop("kind")


def raw_feed(bars):
    """Bars as the feed spells them: suffixed ticker in odd case, capitalised columns."""
    suffix = F.when(F.col("exchange_code") == "NSE", ".ns").otherwise(".bo")
    double = lambda c: F.col(c).cast("double")
    return bars.select(
        F.concat(F.lit(" "), F.lower("symbol"), suffix).alias("ticker"),
        F.col("trade_date").cast("timestamp_ntz").alias("Date"),
        double("open_price").alias("Open"), double("high_price").alias("High"),
        double("low_price").alias("Low"), double("close_price").alias("Close"),
        F.col("volume").alias("Volume"), F.lit(0.0).alias("Dividends"))


def date_slices(bars, cuts):
    """Disjoint date slices of a frame, in order."""
    edges = [None, *cuts, None]
    slices = []
    for lo, hi in zip(edges, edges[1:]):
        wanted = [F.col("trade_date") >= F.lit(lo).cast("date")] if lo else []
        wanted += [F.col("trade_date") < F.lit(hi).cast("date")] if hi else []
        slices.append(bars.filter(reduce(lambda a, b: a & b, wanted)))
    return slices


ARRIVALS, ARRIVAL_FILES = 5, 4


def arriving_ticks(spark, sf_dir, path):
    """The event ticks as files of five arrivals of six days each, one micro-batch each with ARRIVAL_FILES files a trigger.

    Every third tick arrives again with the next arrival; every 50th of the first six days is
    withheld until the last one. Returns the schema.
    """
    ticks = event_ticks(spark, sf_dir).drop("trade_date")
    own = F.least(F.floor((F.dayofmonth("ts") - 1) / 6), F.lit(ARRIVALS - 1))
    withheld = (own == 0) & (F.col("event_id") % 50 == 0)
    for arrival in range(ARRIVALS):
        again = (own == arrival - 1) & (F.col("event_id") % 3 == 0)
        part = ticks.filter(~withheld & ((own == arrival) | again) | (withheld & F.lit(arrival == ARRIVALS - 1)))
        part.repartition(ARRIVAL_FILES).write.mode("append").parquet(path)
    return ticks.schema
