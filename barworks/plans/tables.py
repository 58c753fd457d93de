"""Upserts into a month-partitioned parquet table.

Parquet has no MERGE. A batch of new keys is appended. The first load, and one
that also updates rows, writes the months it touches in two steps: the merged
months are first written in full to a stage beside the table, then moved in place of
the table's partitions: each month is written once. The stage is a redo log. If a
run dies during the move, the next one finds the finished stage and moves what is left
of it before doing anything else, so no partition stays half replaced.
Concurrent writers of one table are out of scope; a table format with MERGE has
them.
"""

import math
from functools import reduce

from pyspark.sql import Observation
from pyspark.sql import functions as F

from barworks.functions.dates import MONTH_COLUMN as MONTH
from barworks.functions.dates import month_start
from barworks.operators.silver import dedupe_bars
from barworks.operators.upsert import merge_rows
from barworks.functions.numeric import is_infinite
from barworks.schemas import BAR_KEY, FACT_BARS, PRICES
from barworks.session import PACKED, any_file, delete_path, folders_in, path_exists, qualified_path, replace_path, tidy, touch_path

# A batch in which a key comes so often at most is settled where its months are laid out, a million rows of a month a task.
FEW_COPIES, SLICE_ROWS = 16, 1_000_000


def to_fact(df, loaded_at=None):
    """Project a batch onto the fact schema; the load time is the writer's."""
    if loaded_at is not None:
        df = df.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp_ntz"))
    elif "loaded_at" not in df.columns:
        df = df.withColumn("loaded_at", F.localtimestamp())
    columns = []
    for field in FACT_BARS:
        value = F.col(field.name) if field.name in df.columns else F.lit(None)
        # An absurd percentage becomes null; an absurd price must not pass unnoticed.
        if field.name in PRICES and dict(df.dtypes).get(field.name) in ("double", "float"):
            value = F.when(is_infinite(value), F.raise_error(F.lit(f"{field.name} is infinite")).cast("double")).otherwise(value)
        typed = value.try_cast(field.dataType) if field.name == "change_pct" else value.cast(field.dataType)
        columns.append(typed.alias(field.name))
    return df.select(*columns)


def _stage_path(spark, path):
    return f"{qualified_path(spark, path)}.upsert-stage"


def has_data(spark, path):
    """Whether the table has committed files: a folder of a load that died in its commit has none."""
    return any_file(spark, f"{path.rstrip('/')}/{MONTH}=*/part-*")


def batch_months(df, keys):
    """The months of a batch with their rows, first and last day: 12 rows per year of data."""
    lacking = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    by_month = df.groupBy(month_start("trade_date").alias(MONTH)).agg(
        F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"), F.count_if(lacking).alias("lacking"),
        F.count(F.lit(1)).alias("rows"))
    rows = by_month.collect()
    if any(r[MONTH] is None or r["lacking"] for r in rows):
        raise ValueError(f"a batch to upsert must not hold rows without {', '.join(keys)}")
    return sorted(rows, key=lambda r: r[MONTH])


def batch_span(df, keys):
    """The months of a batch and its first and last day."""
    rows = batch_months(df, keys)
    return [r[MONTH] for r in rows], min((r["lo"] for r in rows), default=None), max((r["hi"] for r in rows), default=None)


def _write(df, path, mode="overwrite"):
    df.write.mode(mode).options(**PACKED).option("partitionOverwriteMode", "static").partitionBy(MONTH).parquet(path)


def recover(spark, path):
    """Finish an upsert that was interrupted, or drop a stage that was not completed."""
    stage = _stage_path(spark, path)
    done = path_exists(spark, f"{stage}.ready")
    if done:
        _apply(spark, path, stage)
    _clear(spark, stage)
    return done


def _clear(spark, stage):
    """The marker goes first: a stage without one is never moved."""
    delete_path(spark, f"{stage}.ready")
    delete_path(spark, stage)


def _apply(spark, path, stage):
    """Move the staged months into place, each one over the table's. What is still staged is still to be moved."""
    for folder in folders_in(spark, stage):
        replace_path(spark, folder, f"{path.rstrip('/')}/{folder.rsplit('/', 1)[1]}")


def upsert_table(spark, path, source, keys=BAR_KEY, settle=True, counts=None):
    """Upsert ``source`` into the table at ``path``; creates it on first use.

    A batch of keys the table does not hold (the usual new day) is appended, at
    the cost of its own rows. Otherwise the touched months are merged and
    rewritten. An append that dies half way leaves some of its keys behind, so
    its repetition takes the merge and ends in the same table.

    Hand in a batch that is already written somewhere (see
    ``session.write_and_reread``): it is read more than once here. ``settle``
    removes duplicate keys from the batch, newest ``loaded_at`` first. Returns
    the months that were touched. A dict given as ``counts`` gets ``inserted`` and
    ``updated``: the settled rows are counted as they are written, the keys they
    replace by the join that looks for them.

    A batch with copies is settled by the shuffle that lays out its months, unless one key has so
    many copies that they should not meet in one task. Where the batch replaces every row of its months
    (a replay, a whole history sent again), the table's rows are not read for the merge.
    """
    with tidy(spark):
        return _upsert(spark, path, source, keys, settle, counts)


def _upsert(spark, path, source, keys, settle, counts):
    recover(spark, path)
    found = batch_months(source, keys)
    months = [r[MONTH] for r in found]
    if not months:
        return []
    given = source
    target = same_days = None
    if has_data(spark, path):
        target = spark.read.parquet(path).filter(F.col(MONTH).isin(months)).drop(MONTH)
        same_days = target.filter(F.col("trade_date").between(F.lit(found[0]["lo"]), F.lit(found[-1]["hi"])))
    copies, updated = _copies_and_known(given, same_days, keys, settle)
    if counts is not None:
        counts["updated"] = updated
    # Keys of a settled batch come once, so as many known ones as the table has rows are all of its rows.
    if settle and updated and updated == target.count():
        target, whole = target.filter(F.lit(False)), True
    else:
        whole = not updated
    seen = Observation()
    observed = (lambda df: df) if counts is None else (lambda df: df.observe(seen, F.count(F.lit(1)).alias("rows")))
    if copies > 1 and whole and copies <= FEW_COPIES and {"symbol", "trade_date"} <= set(keys):
        slices = math.ceil(max(r["rows"] for r in found) / SLICE_ROWS)
        lay_out = lambda df: _sorted(observed(_settled_months(df, keys, slices)))
    else:
        lay_out, source = _laid_out, observed(dedupe_bars(source, keys) if copies > 1 else source)
    if target is None:
        replace_months(spark, path, lambda stage: _write(lay_out(source), stage))
    elif not updated:
        _write(lay_out(source), path, "append")
    else:
        replace_months(spark, path, lambda stage: _write(lay_out(merge_rows(target, source, keys, given)), stage))
    return _counted(counts, seen, months)


def _copies_and_known(given, same_days, keys, settle):
    """The most copies of a key in the batch, and how many rows of the table it replaces: one job over the keys.

    Rows are sorted to settle copies only where there are any.
    """
    batch = given.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")) if settle else given.select(*keys, F.lit(1).alias("_copies"))
    known = F.lit(0) if same_days is None else F.count("_known")
    if same_days is not None:
        batch = batch.join(same_days.select(*keys, F.lit(1).alias("_known")), list(keys), "left")
    elif not settle:
        return 1, 0
    row = batch.agg(F.max("_copies").alias("copies"), known.alias("known")).first()
    return row["copies"], row["known"]


def _counted(counts, seen, months):
    if counts is not None:
        counts["inserted"] = seen.get["rows"] - counts["updated"]
    return months


def create_table(spark, path, df):
    """The first content of a table, through the same redo log."""
    recover(spark, path)
    with tidy(spark):
        _replace(spark, path, df)


def replace_days(spark, path, fresh, days):
    """Put ``fresh`` in place of all the table's rows of ``days`` (a frame of trade_date), through the same redo log.

    A month in which nothing at all would be left keeps what it held.
    """
    recover(spark, path)
    months = [r[0] for r in days.select(month_start("trade_date")).distinct().collect()]
    if months:
        kept = spark.read.parquet(path).filter(F.col(MONTH).isin(months)).drop(MONTH).join(days, "trade_date", "left_anti")
        with tidy(spark):
            _replace(spark, path, kept.unionByName(fresh))
    return sorted(months)


def _replace(spark, path, df):
    replace_months(spark, path, lambda stage: _write(_laid_out(df), stage))


def replace_months(spark, path, write):
    """Put the months that ``write(folder)`` writes in place of the table's, through the redo log."""
    stage = _stage_path(spark, path)
    write(stage)
    touch_path(spark, f"{stage}.ready")
    _apply(spark, path, stage)
    _clear(spark, stage)


def _sorted(df):
    return df.sortWithinPartitions(*[c for c in (MONTH, "symbol", "trade_date") if c in df.columns])


def _settled_months(df, keys, slices):
    """One row per key, in tasks of whole listings of a month: the shuffle that settles the copies also lays the months out.

    A month is cut into ``slices`` by listing. Rows come sorted as ``_sorted`` wants them.
    """
    cut = F.pmod(F.xxhash64(*sorted(k for k in keys if k != "trade_date")), F.lit(slices))
    dealt = df.withColumns({MONTH: month_start("trade_date"), "_slice": cut}).repartition(MONTH, "_slice")
    first = [MONTH, "symbol", "trade_date"]
    within = [*first, *[k for k in keys if k not in first], "_slice"]
    return dedupe_bars(dealt, within).drop("_slice")


def _laid_out(df):
    """Files of one month each, sized by adaptive execution, sorted by listing."""
    return _sorted(df.withColumn(MONTH, month_start("trade_date")).hint("rebalance", F.col(MONTH)))
