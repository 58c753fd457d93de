"""Catalog probes, ad-hoc SQL and table writers."""

from functools import reduce

from pyspark.sql import functions as F

from barworks import schemas
from barworks.functions.dates import month_start
from barworks.session import PACKED, settings, tidy

STAR_SCHEMA = {
    "dim_exchange": (schemas.DIM_EXCHANGE, None),
    "dim_symbol": (schemas.DIM_SYMBOL, None),
    "dim_date": (schemas.DIM_DATE, None),
    "fact_stock_prices": (schemas.FACT_BARS, "trade_month"),
}

# Column defaults of the star schema.
COLUMN_DEFAULTS = {
    ("dim_exchange", "country"): "'India'",
    ("dim_exchange", "currency"): "'INR'",
    ("dim_exchange", "timezone"): "'Asia/Kolkata'",
    ("dim_symbol", "company_name"): "''",
    ("dim_symbol", "sector"): "''",
    ("dim_symbol", "industry"): "''",
    ("dim_symbol", "isin"): "''",
    ("dim_symbol", "is_active"): "true",
    ("dim_date", "is_trading_day"): "true",
    ("dim_date", "is_month_end"): "false",
    ("dim_date", "is_quarter_end"): "false",
    ("fact_stock_prices", "volume"): "0",
    ("fact_stock_prices", "source"): f"'{schemas.FEED_SOURCE}'",
}


def create_star_schema(spark, database, location=None):
    """Create the fact table and its dimensions where they do not exist yet."""
    place = f" LOCATION '{location}/{database}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for table, (schema, partition) in STAR_SCHEMA.items():
        columns = []
        for field in schema:
            default = COLUMN_DEFAULTS.get((table, field.name))
            columns.append(
                f"{field.name} {field.dataType.simpleString()}"
                + ("" if field.nullable else " NOT NULL")
                + (f" DEFAULT {default}" if default else "")
            )
        if partition:
            columns.append(f"{partition} date")
        split = f" PARTITIONED BY ({partition})" if partition else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({', '.join(columns)}) USING parquet{split}"
        )


def table_exists(spark, name):
    return spark.catalog.tableExists(name)


def list_tables(spark, database=None):
    """Tables and views of a database as rows (table_name, table_type)."""
    shown = spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")
    return shown.select(
        F.col("tableName").alias("table_name"),
        F.when(F.col("isTemporary"), "VIEW").otherwise("TABLE").alias("table_type"),
    )


def table_counts(frames):
    """One row per named table: (table_name, row_count). Parquet answers from footers."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


def month_bounds(spark, path, day="trade_date"):
    """(trade_month, row_count, first_day, last_day) of a table partitioned by month, from file footers alone.

    The V2 reader answers counts, minima and maxima by partition from the footers, so no
    column is read. Rows without a day have no month: they are counted, without bounds.
    """
    # Only V2 scans look at this one, when they are optimised; the other decides which reader a path gets.
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    others = [s for s in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if s.strip() != "parquet"]
    with settings(spark, {"spark.sql.sources.useV1SourceList": ",".join(others)}):
        table = spark.read.parquet(path)
    dated, undated = table.filter("trade_month IS NOT NULL"), table.filter("trade_month IS NULL")
    rows = F.count(F.lit(1)).alias("row_count")
    # A file without any day has no minimum in its footer, so it must not be asked for one.
    none = F.lit(None).cast("date")
    return dated.groupBy("trade_month").agg(rows, F.min(day).alias("first_day"), F.max(day).alias("last_day")).unionByName(
        undated.groupBy("trade_month").agg(rows).withColumns({"first_day": none, "last_day": none}))


def database_counts(spark, database):
    """Row counts of every table of a database; only its table names reach the driver."""
    names = [r["table_name"] for r in list_tables(spark, database).filter("table_type = 'TABLE'").collect()]
    return table_counts({n: spark.table(f"{database}.{n}") for n in names})


def run_sql(spark, statement, args=None, limit=None):
    """Ad-hoc SQL with named markers (``:name``); the limit is part of the plan."""
    df = spark.sql(statement, args=args or {})
    return df if limit is None else df.limit(limit)


def save_layer(df, table=None, path=None, fmt="parquet", by_month="trade_date", finish=None):
    """Overwrite a layer, a catalog table or a plain path, partitioned by month.

    ``finish`` is a function of the frame that adds columns which need not travel through the shuffle, constants say.

    The rebalance hint lets adaptive execution size the output files: small
    months are merged and a month far larger than the rest is split over many
    tasks instead of being written by one. Sorting inside the files keeps a
    listing's rows together, so readers of one listing skip row groups.
    """
    if by_month is not None:
        df = df.withColumn("trade_month", month_start(by_month)).hint("rebalance", F.col("trade_month"))
        if "symbol" in df.columns:
            df = df.sortWithinPartitions("trade_month", "symbol", by_month)
    if finish is not None:
        df = finish(df)
    writer = df.write.format(fmt).mode("overwrite").options(**(PACKED if fmt == "parquet" else {}))
    if by_month is not None:
        writer = writer.partitionBy("trade_month")
    with tidy(df.sparkSession):
        if table is None:
            writer.save(path)
        else:
            (writer.option("path", path) if path else writer).saveAsTable(table)


def load_layer(spark, table=None, path=None, fmt="parquet"):
    df = spark.table(table) if table is not None else spark.read.format(fmt).load(path)
    return df.drop("trade_month")
