"""Bronze to silver to gold to daily summary, each layer written and re-read."""

import contextlib
import time

from pyspark.sql import Observation
from pyspark.sql import functions as F

from barworks.functions.dates import MONTH_COLUMN as MONTH, date_bounded
from barworks.operators.contracts import row_contract_bars, split_valid
from barworks.operators.gold import gold_delta, short_listings, silver_to_gold
from barworks.operators.ranks import volume_ranks
from barworks.operators.silver import bronze_to_silver, silver_cast, stamp
from barworks.operators.summary import daily_summary, sector_daily_summary
from barworks.plans.tables import create_table, has_data, replace_days, upsert_table
from barworks.schemas import BAR_KEY
from barworks.session import delete_path, scratch_path, write_and_reread
from barworks.sources.catalog import load_layer, save_layer
from barworks.sources.scan import read_fact

# Table names of the layers.
LAYERS = {
    "silver": "silver_stock_prices",
    "gold": "gold_stock_analytics",
    "summary": "gold_daily_summary",
    "sector": "gold_sector_summary",
}

RUN_METRICS = "layer string, rows bigint, seconds double, status string, error string"


def _target(layer, database, root):
    if root is not None:
        return {"path": f"{root.rstrip('/')}/{LAYERS[layer]}"}
    return {"table": f"{database}.{LAYERS[layer]}" if database else LAYERS[layer]}


def _write(spark, layer, df, target, metrics, **options):
    """Write a layer, counting its rows inside the same job."""
    seen, started = Observation(f"{layer}-rows"), time.time()
    try:
        save_layer(df.observe(seen, F.count(F.lit(1)).alias("rows")), **target, **options)
    except Exception as exc:
        metrics.append((layer, None, time.time() - started, "FAILED", str(exc)))
        raise
    metrics.append((layer, seen.get["rows"], time.time() - started, "OK", ""))
    return load_layer(spark, **target, fmt=options.get("fmt", "parquet"))


@contextlib.contextmanager
def written_ranks(silver):
    """The volume ranks of a layer as a scratch table, for the plans that run inside."""
    stage = scratch_path(silver.sparkSession, "volume-ranks")
    try:
        yield write_and_reread(volume_ranks(silver), stage)
    finally:
        delete_path(silver.sparkSession, stage)


def run_medallion(spark, bronze, database=None, root=None, dim_symbol=None, fmt="parquet", source="barworks", metrics=None,
                  contract=False):
    """Build all layers; returns them with ``run_metrics`` (one row per layer).

    With ``contract``, bars pass the row contract first: spellings of one symbol
    become one listing, and rows that break a rule are returned as ``quarantine``
    instead of entering silver.

    Layers are catalog tables, or plain paths under ``root``. Each one is read
    back before the next is built, so no layer computes an earlier one again.
    Pass a list as ``metrics`` to keep the rows of a run that fails.
    """
    metrics = [] if metrics is None else metrics
    out = {}
    if contract:
        bronze, out["quarantine"] = split_valid(row_contract_bars(bronze))
    out["silver"] = _write(spark, "silver", bronze_to_silver(bronze), _target("silver", database, root), metrics, fmt=fmt,
                           finish=lambda df: stamp(df, "silver", source))
    with written_ranks(out["silver"]) as ranks:
        out["gold"] = _write(spark, "gold", silver_to_gold(out["silver"], ranks=ranks), _target("gold", database, root), metrics, fmt=fmt,
                             finish=lambda df: stamp(df, "gold"))
    out["summary"] = _write(
        spark, "summary", daily_summary(out["gold"]), _target("summary", database, root), metrics,
        fmt=fmt, by_month=None)
    if dim_symbol is not None:
        out["sector"] = _write(
            spark, "sector", sector_daily_summary(out["gold"], dim_symbol),
            _target("sector", database, root), metrics, fmt=fmt, by_month=None)
    out["run_metrics"] = spark.createDataFrame(metrics, RUN_METRICS)
    return out


GOLD_INPUT = [*BAR_KEY, "open_price", "high_price", "low_price", "close_price", "volume"]


def refresh_gold(spark, fact_path, gold_path, changed, lookback_days=None, listed=None, summaries=None):
    """Bring the gold table up to date after ``changed`` keys were upserted.

    The fact table holds one row per key, so it serves as silver once cast. With
    ``lookback_days`` the scan starts that many days before the first change. A
    listing with fewer than 30 rows in that time needs its older months too; they
    are scanned only if there is such a listing. ``listed`` (symbol,
    exchange_code, listed_date: the listing dimension) tells young listings
    apart, whose older months hold nothing; a listing it does not name is looked
    up. The result equals a full rebuild. ``summaries`` ({path: function of gold rows}) are
    brought up to date with it, see :func:`refresh_summary`.
    """
    silver = silver_cast(read_fact(spark, fact_path, keep_month=True)).select(*GOLD_INPUT, MONTH)
    if not has_data(spark, gold_path):
        silver = silver.drop(MONTH)
        with written_ranks(silver) as ranks:
            create_table(spark, gold_path, silver_to_gold(silver, ranks=ranks))
        for path, summarise in (summaries or {}).items():
            create_table(spark, path, summarise(read_fact(spark, gold_path)))
        return None
    since = older = None
    if lookback_days is not None:
        since = F.date_sub(changed.agg(F.min("trade_date")).scalar(), lookback_days)
        older = short_listings(silver, changed, since, listed)
        if older.isEmpty():
            older = None
    gold = read_fact(spark, gold_path, keep_month=True)
    stage = scratch_path(spark, "gold-delta")
    try:
        delta = write_and_reread(gold_delta(silver, gold, changed, since=since, older=older), stage)
        months = upsert_table(spark, gold_path, delta, settle=False)
        for path, summarise in (summaries or {}).items():
            refresh_summary(spark, gold_path, path, delta.select("trade_date").distinct(), summarise)
        return months
    finally:
        delete_path(spark, stage)


def refresh_summary(spark, gold_path, path, days, summarise):
    """Recompute a table of aggregates per day for ``days`` only, and put them in place of what it held for these.

    ``summarise`` turns gold rows into the aggregates, with ``trade_date`` among the
    groups. Only the months of these days are read and written. A table that is not there yet is built.
    """
    gold = read_fact(spark, gold_path, keep_month=True)
    if not has_data(spark, path):
        return create_table(spark, path, summarise(gold.drop(MONTH)))
    bounds = days.agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))
    touched = date_bounded(gold, bounds.select("lo").scalar(), bounds.select("hi").scalar()).join(days, "trade_date", "left_semi")
    return replace_days(spark, path, summarise(touched.drop(MONTH)), days)
