"""Reading the bronze layer."""

from barworks.functions.dates import MONTH_COLUMN, date_bounded


def scan_bronze(spark, path=None, *, fmt="parquet", query=None, columns=None, schema=None, **options):
    """Read raw bars from any Spark source.

    ``fmt`` is any installed connector. Database connectors take the statement
    to push down in ``query``; file formats push column pruning and filters
    through the plan instead, so nothing needs to be written as SQL.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if query is not None:
        reader = reader.option("query", query)
    df = reader.load(path) if path is not None else reader.load()
    return df.select(*columns) if columns else df


def read_fact(spark, path, since=None, until=None, keep_month=False):
    """A month-partitioned bar table, bounded on both sides where possible.

    With ``keep_month`` the partition column stays, so that operators can prune
    by dates they only know at run time.
    """
    df = date_bounded(spark.read.parquet(path), since, until)
    return df if keep_month else df.drop(MONTH_COLUMN)
