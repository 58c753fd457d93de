"""Silver to gold: rolling indicators per listing and volume rank per day.

Windows by listing are safe from skew without splitting: silver holds one row
per listing and date, so one window partition can never exceed the number of
days in the history (some 36,500 rows for a century). A day, in contrast, can
hold any number of listings; its rank is computed in ``ranks``.
"""

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from barworks.functions.dates import MONTH_COLUMN, date_bounded
from barworks.functions.numeric import pct_change, round_stable
from barworks.operators.ranks import volume_rank
from barworks.schemas import BAR_KEY, LISTING

SHORT_ROWS, LONG_ROWS = 7, 30


def by_listing(partition_cols=LISTING, order="trade_date"):
    return Window.partitionBy(*partition_cols).orderBy(order)


def rolling(rows, partition_cols=LISTING):
    """The current row and the ``rows - 1`` before it."""
    return by_listing(partition_cols).rowsBetween(1 - rows, 0)


def moving_average(column, rows, partition_cols=LISTING):
    return F.avg(F.col(column).cast("double")).over(rolling(rows, partition_cols))


def previous_close(partition_cols=LISTING):
    return F.lag(F.col("close_price").cast("double"), 1).over(by_listing(partition_cols))


def with_rounded(df, windows):
    """Add window results, given as {name: (expression, scale)}, rounded.

    Rounding mentions its argument twice, so it reads a finished column: written
    around the window itself, every frame would be evaluated twice.
    """
    df = df.withColumns({f"_{name}": window for name, (window, _) in windows.items()})
    df = df.withColumns({name: round_stable(f"_{name}", scale) for name, (_, scale) in windows.items()})
    return df.drop(*[f"_{name}" for name in windows])


def listing_indicators(silver, partition_cols=LISTING):
    """Moving averages, return and volatility: one shuffle, one sort.

    Volatility reads the rounded return, so the return comes first, from a window step of
    its own on the same partitioning and order. The long average and the volatility then share one frame.
    """
    returned = silver.withColumn("_previous", previous_close(partition_cols))
    returned = returned.withColumn("daily_return_pct", pct_change("close_price", "_previous", 4)).drop("_previous")
    spread = F.stddev_samp("daily_return_pct").over(rolling(LONG_ROWS, partition_cols))
    averaged = with_rounded(returned, {
        "ma_7d": (moving_average("close_price", SHORT_ROWS, partition_cols), 2),
        "ma_30d": (moving_average("close_price", LONG_ROWS, partition_cols), 2),
        "volatility_30d": (spread, 4),
    })
    added = ["ma_7d", "ma_30d", "daily_return_pct", "volatility_30d"]
    return averaged.select(*[c for c in averaged.columns if c not in added], *added)


def silver_to_gold(silver, partition_cols=LISTING, ranks=None):
    """Indicators and the volume rank; ``ranks`` as in :func:`barworks.operators.ranks.volume_rank`."""
    return volume_rank(listing_indicators(silver, partition_cols), ranks=ranks)


def moving_average_cross(df, partition_cols=LISTING):
    """Days on which the short average crosses the long one: golden up, death down."""
    spread = F.signum(F.col("ma_7d") - F.col("ma_30d"))
    crossed = df.withColumn("_side", spread).withColumn(
        "_before", F.lag("_side", 1).over(by_listing(partition_cols)))
    signal = F.when((F.col("_before") <= 0) & (F.col("_side") > 0), "golden").when(
        (F.col("_before") >= 0) & (F.col("_side") < 0), "death")
    return crossed.withColumn("signal", signal).filter(F.col("signal").isNotNull()).drop("_side", "_before")


def _first_changes(changed, partition_cols):
    return changed.groupBy(*partition_cols).agg(F.min("trade_date").alias("_first"))


def short_listings(silver, changed, since, listed=None, partition_cols=LISTING):
    """Changed listings whose windows reach behind ``since``.

    These have fewer than 30 rows between ``since`` and their first change, and
    may have older ones. ``listed`` (listing, listed_date) rules out those that
    started after ``since``.
    """
    cols = list(partition_cols)
    firsts = _first_changes(changed, cols)
    since = since if isinstance(since, Column) else F.lit(since).cast("date")
    before = date_bounded(silver, since=since).select(*cols, "trade_date").join(firsts, cols).filter(
        F.col("trade_date") < F.col("_first")).groupBy(*cols).agg(F.count(F.lit(1)).alias("_rows"))
    short = firsts.join(before, cols, "left").filter(F.coalesce("_rows", F.lit(0)) < LONG_ROWS)
    if listed is not None:
        known = listed.select(*cols, "listed_date")
        short = short.join(known, cols, "left").filter(F.coalesce(F.col("listed_date") < since, F.lit(True)))
    return short.select(*cols)


def touched_history(silver, changed, partition_cols=LISTING, since=None, older=None):
    """Rows of the changed listings, reaching back far enough for the windows.

    Without ``since`` this is their whole history. With it, only rows from that
    day on are read (a pruned scan when silver is partitioned by month), plus
    everything of the listings in ``older``, see :func:`short_listings`.
    """
    cols = list(partition_cols)
    touched = _first_changes(changed, cols).select(*cols)
    if since is None:
        return silver.join(touched, cols, "left_semi")
    since = since if isinstance(since, Column) else F.lit(since).cast("date")
    recent = date_bounded(silver, since=since).join(touched, cols, "left_semi")
    if older is None:
        return recent
    return recent.unionByName(
        date_bounded(silver, until=F.date_sub(since, 1)).join(older, cols, "left_semi"))


def near_changes(history, partition_cols=LISTING):
    """The rows with at most 30 rows between them and a changed one, with ``_hit``: one that is changed or follows a change.

    A hit row's windows read 30 rows before it, which lie no farther than that from its change.
    So the sliding windows need no other rows. Positions of the changes come from frames that grow by a row at a time.
    """
    rows = by_listing(partition_cols)
    whole = Window.partitionBy(*partition_cols)
    placed = history.withColumn("_row", F.row_number().over(rows))
    change = F.when(F.col("_changed") == 1, F.col("_row"))
    placed = placed.withColumns({
        "_before": F.max(change).over(rows.rowsBetween(Window.unboundedPreceding, 0)), "_last": F.max(change).over(whole)})
    # The last change up to 30 rows ahead; a listing that ends before them has no later one than its last.
    placed = placed.withColumn("_ahead", F.when(F.lead("_row", LONG_ROWS).over(rows).isNull(), F.col("_last")).otherwise(
        F.lead("_before", LONG_ROWS).over(rows)))
    hit = F.coalesce(F.col("_row") - F.col("_before") <= LONG_ROWS, F.lit(False))
    return placed.withColumn("_hit", hit).filter(F.col("_hit") | (F.col("_ahead") > F.col("_row"))).drop(
        "_row", "_before", "_last", "_ahead")


def gold_delta(silver, gold, changed, partition_cols=LISTING, since=None, older=None):
    """The gold rows that must be rewritten after ``changed`` silver keys.

    ``silver`` already contains the change. A row's indicators read at most 30
    earlier rows of its listing, so a change at position p alters p..p+30. Every
    row of a changed day also gets a new volume rank. The result holds exactly
    these rows, ready for an upsert into gold. ``since`` and ``older`` bound the
    history that is read, see :func:`touched_history`; for the ranks only the
    months between the first and the last changed day are read.
    """
    bounds = changed.agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))
    span = {"since": bounds.select("lo").scalar(), "until": bounds.select("hi").scalar()}
    keys = changed.select(*BAR_KEY).distinct()
    days = changed.select("trade_date").distinct()

    history = touched_history(silver, changed, partition_cols, since, older).join(
        keys.withColumn("_changed", F.lit(1)), BAR_KEY, "left")
    fresh = listing_indicators(near_changes(history, partition_cols), partition_cols).filter("_hit").drop("_hit", "_changed")

    on_days = lambda df: date_bounded(df, **span).join(days, "trade_date", "left_semi")
    today = volume_rank(on_days(silver).select(*BAR_KEY, "volume"))
    new_rank = today.select(*BAR_KEY, F.col("volume_rank").alias("_new_rank"))

    old_rank = date_bounded(gold, since=span["since"]).select(*BAR_KEY, "volume_rank")
    fresh = fresh.drop(MONTH_COLUMN).join(old_rank, BAR_KEY, "left")
    same_day = on_days(gold).join(fresh.select(*BAR_KEY), BAR_KEY, "left_anti")
    rows = fresh.unionByName(same_day.select(*fresh.columns))
    return rows.join(new_rank, BAR_KEY, "left").withColumn(
        "volume_rank", F.coalesce("_new_rank", "volume_rank")).drop("_new_rank")
