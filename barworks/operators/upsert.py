"""Upsert and insert-if-absent as joins, for table formats without MERGE."""

from pyspark.sql import functions as F

from barworks.operators.silver import dedupe_bars
from barworks.schemas import BAR_KEY


def merge_rows(target, source, keys, source_keys=None):
    """Source rows replace target rows with the same key; the rest are added.

    ``source`` must hold one row per key. The anti join only ships the keys of
    the source, and adaptive execution broadcasts them when the batch is small,
    in which case the target is not shuffled at all. ``source_keys`` is a
    cheaper frame with the same keys, repeated ones allowed: the batch before it
    was settled.
    """
    found = source if source_keys is None else source_keys
    untouched = target.join(found.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(source, allowMissingColumns=True)


def upsert_bars(target, source, keys=BAR_KEY, latest="loaded_at"):
    """Idempotent upsert of bars; duplicates in the batch are settled first."""
    return merge_rows(target, dedupe_bars(source, keys, latest), keys, source)


def insert_absent(target, source, keys):
    """Add source rows whose key the target lacks; update nothing."""
    fresh = dedupe_bars(source, keys, latest=None).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def upsert_counts(target, source, keys=BAR_KEY):
    """How many rows an upsert would insert and update."""
    known = target.select(*keys).withColumn("_known", F.lit(1))
    flagged = source.select(*keys).distinct().join(known, list(keys), "left")
    return flagged.agg(
        F.count_if(F.col("_known").isNull()).alias("inserted"),
        F.count_if(F.col("_known").isNotNull()).alias("updated"),
        F.count(F.lit(1)).alias("affected"),
    )
