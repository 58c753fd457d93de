"""Extract, check, load and only then advance: the incremental job."""

import datetime as dt
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Observation
from pyspark.sql import functions as F

from barworks.operators.contracts import row_contract_bars, split_valid
from barworks.operators.incremental import incremental_extract, period_extract
from barworks.operators.quality import bar_suite, enforce
from barworks.plans.gaps import GapTable, set_aside
from barworks.plans.medallion import refresh_gold
from barworks.plans.state import WatermarkTable
from barworks.plans.tables import to_fact, upsert_table
from barworks.schemas import BAR_KEY, LISTING
from barworks.session import delete_path, scratch_path, tidy, write_and_reread
from barworks.sources.bars import with_bar_metrics


@dataclass
class LoadResult:
    rows_in: int
    rows_loaded: int
    rows_quarantined: int
    months: list
    checks: list
    seconds: float
    success: bool = True
    message: str = ""
    rows_inserted: int = 0
    rows_updated: int = 0


RUN_METRICS = ("batch_id string, started_at timestamp, rows_in bigint, rows_quarantined bigint, rows_loaded bigint, "
               "rows_inserted bigint, rows_updated bigint, seconds double, status string, message string")


def _record(spark, path, batch_id, started, result):
    """One row of the stored run metrics."""
    row = (str(batch_id), dt.datetime.fromtimestamp(started), result.rows_in, result.rows_quarantined, result.rows_loaded,
           result.rows_inserted, result.rows_updated, result.seconds, "OK" if result.success else "FAILED", result.message)
    spark.createDataFrame([row], RUN_METRICS).coalesce(1).write.mode("append").parquet(path)


def load_batch(spark, bars, fact_path, state_path=None, quarantine_path=None, batch_id=None,
               checks=None, loaded_at=None, dry_run=False, gold_path=None, lookback_days=None,
               listed=None, metrics_path=None, summaries=None):
    """Check a batch of bars and upsert it; with a ``metrics_path`` the outcome, good or bad, is stored as a row there."""
    started = time.time()
    batch_id = uuid.uuid4().hex if batch_id is None else batch_id
    try:
        with tidy(spark):
            result = _load(spark, bars, fact_path, state_path, quarantine_path, batch_id, checks, loaded_at, dry_run, gold_path, lookback_days, listed, summaries)
    except Exception as exc:
        if metrics_path is not None:
            _record(spark, metrics_path, batch_id, started, LoadResult(0, 0, 0, [], [], time.time() - started, False, str(exc)))
        raise
    if metrics_path is not None:
        _record(spark, metrics_path, batch_id, started, result)
    return result


def _load(spark, bars, fact_path, state_path, quarantine_path, batch_id, checks, loaded_at, dry_run, gold_path, lookback_days, listed, summaries):
    """The load itself.

    The batch is written once to the shared folder and read back from there by
    every later step. With a ``quarantine_path``, rows that break a contract are
    set aside and the rest is loaded; without one, the quality suite sees every
    row and a critical failure stops the load. Quarantined rows are kept once each, by
    their content (see :func:`barworks.plans.gaps.set_aside`). The watermark moves only after
    the upsert, so a run that dies in between is simply repeated. A day of which only
    bad rows came is recorded as a gap before the watermark passes it: later runs read it again,
    until a good row closes it or ``GapTable.release`` gives it up. With a
    ``gold_path``, the gold rows that the batch affects are brought up to date
    before the watermark moves, and with them ``summaries`` ({path: function of gold rows}: the
    days the batch touches are summarised anew). ``listed`` is a function of the session that
    gives the listing dimension of everything loaded so far (symbol,
    exchange_code, listed_date); it spares the refresh from looking for older
    rows of young listings.
    """
    started = time.time()
    stage = scratch_path(spark, f"batch-{batch_id}")
    checked = row_contract_bars(bars)
    if "daily_range" not in checked.columns or "change_pct" not in checked.columns:
        checked = with_bar_metrics(checked)
    try:
        seen = Observation(f"batch-{batch_id}")
        broken = F.size("violations") > 0
        digest = F.sum(F.when(broken, F.xxhash64(*checked.columns)).cast("decimal(38,0)"))
        counted = checked.observe(seen, F.count(F.lit(1)).alias("all"), F.count_if(broken).alias("bad"),
                                  F.coalesce(digest, F.lit(0).cast("decimal(38,0)")).cast("string").alias("digest"))
        checked, sizes = write_and_reread(counted, stage), seen.get
        if sizes["all"] == 0:
            return LoadResult(0, 0, 0, [], [], time.time() - started, message="nothing to load")
        bad_rows = 0
        good, bad = checked.drop("violations"), None
        if quarantine_path is not None and sizes["bad"]:
            good, bad = split_valid(checked)
            bad_rows = sizes["bad"]
            set_aside(spark, bad, quarantine_path, batch_id, sizes["digest"])
        checks = bar_suite() if checks is None else checks
        results = enforce(good, checks, "bar_load")
        if dry_run:
            return LoadResult(sizes["all"], 0, bad_rows, [], results, time.time() - started, message="dry run")
        counts = {}
        months = upsert_table(spark, fact_path, to_fact(good, loaded_at), settle=not _known_unique(checks, results), counts=counts)
        if gold_path is not None:
            known = None if listed is None else _with_new_listings(listed(spark), good)
            refresh_gold(spark, fact_path, gold_path, good.select(*BAR_KEY), lookback_days, known, summaries)
        if state_path is not None:
            GapTable(spark, state_path).settle(good, bad)
            WatermarkTable(spark, state_path).advance(good if bad is None else seen_days(good, bad))
        return LoadResult(sizes["all"], sizes["all"] - bad_rows, bad_rows, months, results, time.time() - started,
                          rows_inserted=counts.get("inserted", 0), rows_updated=counts.get("updated", 0))
    finally:
        delete_path(spark, stage)


def _known_unique(checks, results):
    """Whether the suite has already counted the keys of the batch and found none twice."""
    return any(c.distinct and sorted(c.columns) == sorted(BAR_KEY) and r["passed"] for c, r in zip(checks, results))


def seen_days(good, bad):
    """The days a batch brought, taken or not; bad rows without a symbol or a date name none."""
    return good.select(*BAR_KEY).unionByName(bad.filter("symbol IS NOT NULL AND trade_date IS NOT NULL").select(*BAR_KEY))


def _with_new_listings(listed, batch):
    """The listing dimension with the listings that this batch brings for the first time."""
    new = batch.groupBy(*LISTING).agg(F.min("trade_date").alias("listed_date"))
    known = listed.select(*LISTING, "listed_date")
    return known.unionByName(new.join(known, LISTING, "left_anti"))


def run_incremental(spark, feed, fact_path, state_path, as_of, period="1mo", incremental=True,
                    reread_days=0, **options):
    """Extract what is new in ``feed`` (or a whole period) and load it.

    A run reads the days after each listing's watermark and its open gaps. The batch is
    named after ``as_of``.
    """
    if incremental:
        state, gaps = WatermarkTable(spark, state_path).read(), GapTable(spark, state_path).read()
        batch = incremental_extract(feed, state, as_of, period, reread_days, gaps)
    else:
        batch = period_extract(feed, as_of, period)
    options.setdefault("batch_id", str(as_of))
    return load_batch(spark, batch, fact_path, state_path, **options)
