"""A fact table in buckets of listings: upserts and listing windows without an exchange of the fact.

The table is partitioned by month, and every month is cut into the same buckets by
listing. One task reads a bucket over all months, so windows by listing find their
rows together, and an upsert shuffles only the batch, to the buckets of the table.
Months are replaced through the redo log of ``plans.tables``. Choose the number of buckets
so that one bucket of a month makes a file of a good size. A listing lies in one bucket
whole, as it does in any window by listing: one row a day.
"""

import uuid

from pyspark.sql import functions as F

from barworks.functions.dates import MONTH_COLUMN as MONTH
from barworks.functions.dates import month_start
from barworks.operators.silver import dedupe_bars
from barworks.plans.tables import batch_span, recover, replace_months
from barworks.schemas import BAR_KEY, LISTING
from barworks.session import settings


# A task holds one bucket while it sorts, so this and not the table bounds its memory.
BUCKET_ROWS = 1_000_000


def bucket_count(rows, least=8):
    """Buckets for a table that will hold so many rows: a task's share does not grow with the table."""
    return max(least, -(-rows // BUCKET_ROWS))


def co_located(buckets):
    """Settings under which a join on listing and day takes the buckets as they are.

    It may use a partitioning by listing alone, and does not shuffle for more tasks.
    """
    return {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.shuffle.partitions": str(buckets),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(buckets)}


def _write(df, table, path, buckets):
    """Write bucketed files to a folder; the table that Spark wants for it goes, its files stay."""
    name = f"{table}_stage_{uuid.uuid4().hex[:12]}"
    (df.withColumn(MONTH, month_start("trade_date")).write.partitionBy(MONTH).bucketBy(buckets, *LISTING)
     .sortBy(*LISTING, "trade_date").format("parquet").option("path", path).saveAsTable(name))
    df.sparkSession.sql(f"DROP TABLE {name}")


def _buckets(spark, table):
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Num Buckets'").first()
    if found is None:
        raise ValueError(f"{table} is not bucketed by listing")
    return int(found.data_type)


def _location(spark, table):
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first().data_type


def _registered(spark, table):
    """The table with the months that are in its folder now."""
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def create_listing_table(spark, table, path, df, buckets):
    """Create the table from ``df``: its one shuffle by listing. Fails where the table exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != MONTH)
    listing = ", ".join(LISTING)
    spark.sql(f"CREATE TABLE {table} ({columns}, {MONTH} date) USING parquet PARTITIONED BY ({MONTH}) "
              f"CLUSTERED BY ({listing}) SORTED BY ({listing}, trade_date) INTO {buckets} BUCKETS LOCATION '{path}'")
    recover(spark, path)
    laid_out = df.drop(MONTH).repartition(buckets, *LISTING)
    replace_months(spark, path, lambda stage: _write(laid_out, table, stage, buckets))
    return _registered(spark, table)


def merged(target, source, keys=BAR_KEY):
    """Rows of both sides, the source's where both hold a key. One outer join, so every task writes one bucket.

    ``source`` holds one row per key, and no key is null; a column it lacks becomes null in its rows.
    """
    given = source.select(*[(F.col(c) if c in source.columns else F.lit(None)).cast(t).alias(f"_new_{c}") for c, t in target.dtypes])
    on = [F.col(k) == F.col(f"_new_{k}") for k in keys]
    new = F.col(f"_new_{keys[0]}").isNotNull()
    return target.join(given, on, "full_outer").select(
        *[F.when(new, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in target.columns])


def upsert_listing_table(spark, table, source, keys=BAR_KEY):
    """Upsert a batch that is already written somewhere; duplicates in it are settled first.

    Keys the table does not hold are appended, in its buckets. A batch that updates rows
    rewrites its months, each once. Returns the months touched.
    """
    path, buckets = _location(spark, table), _buckets(spark, table)
    if recover(spark, path):
        _registered(spark, table)
    months, first, last = batch_span(source, keys)
    if not months:
        return []
    columns = [c for c in spark.table(table).columns if c != MONTH]
    target = spark.table(table).filter(F.col(MONTH).isin(months)).drop(MONTH)
    settled = dedupe_bars(source, keys)
    with settings(spark, co_located(buckets)):
        same_days = target.filter(F.col("trade_date").between(F.lit(first), F.lit(last)))
        known = same_days.select(*keys).join(source.select(*keys), list(keys), "left_semi")
        if known.isEmpty():
            fresh = settled.select(*[(F.col(c) if c in settled.columns else F.lit(None)).alias(c) for c in columns])
            fresh.withColumn(MONTH, month_start("trade_date")).repartition(buckets, *LISTING).write.mode("append").insertInto(table)
        else:
            rows = merged(target, settled, keys)
            replace_months(spark, path, lambda stage: _write(rows, table, stage, buckets))
    _registered(spark, table)
    return months
