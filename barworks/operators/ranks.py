"""Ranks inside groups that may be too large for one task.

A window function puts a whole group into one task. Here a group is first
reduced to its distinct values with counts, the values are cut into ranges, and
only ranges (not groups) are sorted in a task:

    rank(value) = counts in higher ranges + counts above it in its own range

A range covers values within 1/4096 of each other (near zero, less than 1/4096
apart). So a group has at most some 360,000 ranges over all longs, however many
rows it has, and rows that share a range differ little. Ranks compare the
values themselves; ranges only deal them out.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

# For the ranks in SQL text, whose values are longs: a range spans 2**RANGE_BITS of them.
RANGE_BITS = 17
NO_VALUE = -(2 ** 63)
RANGES_PER_E = 4096


def rank_key(c, data_type="bigint"):
    """The value to rank by: a long, a decimal or a double. Null and NaN sort lowest."""
    c = F.col(c) if isinstance(c, str) else c
    if data_type in ("double", "float"):
        return F.when(F.isnan(c) | c.isNull(), F.lit(float("-inf"))).otherwise(c.cast("double"))
    if data_type.startswith("decimal"):
        precision, scale = map(int, data_type[8:-1].split(","))
        if precision > 18:
            return rank_key(c.cast("double"), "double")
        return F.coalesce((c.cast("decimal(38,18)") * F.lit(10 ** scale)).cast("bigint"), F.lit(NO_VALUE))
    return F.coalesce(c.cast("bigint"), F.lit(NO_VALUE))


def _range_of(key):
    """A whole number that never falls as the key rises."""
    value = F.col(key).cast("double")
    spread = F.signum(value) * F.log1p(F.abs(value)) * F.lit(RANGES_PER_E)
    return F.when(F.abs(value) == F.lit(float("inf")), F.signum(value) * F.lit(1e9)).otherwise(F.floor(spread)).cast("bigint")


def value_ranks(df, group, key):
    """One row per group and value: rank and dense_rank from the top, rank from the bottom."""
    counts = df.groupBy(*group, key).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_range", _range_of(key))

    top_down = Window.partitionBy(*group).orderBy(F.col("_range").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    ranges = counts.groupBy(*group, "_range").agg(
        F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_values"))
    offsets = ranges.select(
        *group, "_range",
        F.coalesce(F.sum("_rows").over(top_down), F.lit(0)).alias("_rows_above"),
        F.coalesce(F.sum("_values").over(top_down), F.lit(0)).alias("_values_above"),
        F.sum("_rows").over(whole).alias("_rows_all"),
    )

    in_range = Window.partitionBy(*group, "_range").orderBy(F.col(key).desc())
    above = in_range.rowsBetween(Window.unboundedPreceding, -1)
    local = counts.select(
        *group, key, "_range", "_n",
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_local_rows"),
        F.row_number().over(in_range).alias("_local_values"),
    )

    rows_above = F.col("_rows_above") + F.col("_local_rows")
    return local.join(offsets, [*group, "_range"]).select(
        *group, key,
        (rows_above + 1).alias("rank_desc"),
        (F.col("_values_above") + F.col("_local_values")).alias("dense_rank_desc"),
        (F.col("_rows_all") - rows_above - F.col("_n") + 1).alias("rank_asc"),
    )


def attach_ranks(df, ranks, group, key, columns, how="left"):
    """Join value ranks, renamed by ``columns``, back to rows.

    There is one row per value on the right, so a hot value only makes the left
    side large, which the adaptive skew join splits. Rows without a group (null
    date) are kept by the left join and have no rank.
    """
    named = ranks.select(*group, key, *[F.col(c).alias(alias) for c, alias in columns.items()])
    return df.join(named, [*group, key], how)


def volume_ranks(df, group=("trade_date",), column="volume", alias="volume_rank"):
    """One row per day and volume with its dense rank, largest first: for :func:`volume_rank`."""
    group = list(group)
    keyed = df.select(*group, rank_key(column, dict(df.dtypes)[column]).alias("_volume_key"))
    return value_ranks(keyed, group, "_volume_key").select(*group, "_volume_key", F.col("dense_rank_desc").alias(alias))


def volume_rank(df, group=("trade_date",), column="volume", alias="volume_rank", ranks=None):
    """Dense rank by volume, largest first, within each day.

    ``ranks`` are those of :func:`volume_ranks`, written. Days have few different volumes beside
    their rows, and where a table's size is known to be small before the plan is made, the rows are not shuffled to meet it.
    """
    group = list(group)
    ranks = volume_ranks(df, group, column, alias) if ranks is None else ranks
    keyed = df.withColumn("_volume_key", rank_key(column, dict(df.dtypes)[column]))
    return keyed.join(ranks, [*group, "_volume_key"], "left").select(*df.columns, alias)
