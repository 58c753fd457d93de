"""The stored side of gap watermarks, and of what loads set aside."""

import time

from pyspark.sql import functions as F

from barworks.operators.gaps import as_intervals, missed_days
from barworks.schemas import BAR_KEY, GAP_LOG, LISTING
from barworks.session import PACKED, no_rows, path_exists


class GapTable:
    """Open days of listings, as a log of openings and closings; the last one of a day counts.

    A load appends only what it changes. Recording the same load twice leaves the same days.
    """

    def __init__(self, spark, state_path):
        self.spark, self.path = spark, f"{state_path.rstrip('/')}.gaps"

    def days(self):
        """Open days: symbol, exchange_code, trade_date."""
        if not path_exists(self.spark, self.path):
            return no_rows(self.spark, GAP_LOG).select(*BAR_KEY)
        log = self.spark.read.schema(GAP_LOG).parquet(self.path)
        return log.groupBy(*BAR_KEY).agg(F.max_by("is_open", "turn").alias("is_open")).filter("is_open").select(*BAR_KEY)

    def read(self):
        """Open days as intervals: symbol, exchange_code, gaps."""
        return as_intervals(self.days())

    def _append(self, opened, closed):
        turn = F.lit(time.time_ns()).cast("bigint")
        sides = [days.select(*BAR_KEY, turn.alias("turn"), F.lit(is_open).alias("is_open")) for days, is_open in ((opened, True), (closed, False)) if days is not None]
        events = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
        events.coalesce(8).write.mode("append").parquet(self.path)

    def settle(self, good, bad=None):
        """After a load: days with a good row close, those with only bad rows open."""
        known = self.days()
        none_open = known.isEmpty()
        if bad is None and none_open:
            return
        opened = None if bad is None else missed_days(good, bad).join(known, BAR_KEY, "left_anti")
        closed = None if none_open else known.join(good.select(*BAR_KEY), BAR_KEY, "left_semi")
        self._append(opened, closed)

    def release(self, listings=None, first=None, last=None):
        """Give up on open days: of some listings (a frame with symbol and exchange_code) or all, between two days or all."""
        days = self.days()
        if listings is not None:
            days = days.join(listings.select(*LISTING), LISTING, "left_semi")
        if first is not None:
            days = days.filter(F.col("trade_date") >= F.lit(first).cast("date"))
        if last is not None:
            days = days.filter(F.col("trade_date") <= F.lit(last).cast("date"))
        self._append(None, days)


def set_aside(spark, rows, path, name, digest):
    """Add the rows to those quarantined under ``path`` before, each row's content once.

    A run writes a folder of its own, named by ``name`` and the ``digest`` of its
    rows: a replay finds it finished, and a row that a later run reads again (a gap that
    is still open) is known by its own digest, whatever that run is called.
    """
    own = f"{path.rstrip('/')}/batch_id={name}/rows={digest}"
    if path_exists(spark, f"{own}/_SUCCESS"):
        return
    rows = rows.withColumn("row_digest", F.xxhash64(*sorted(c for c in rows.columns if c != "row_digest")))
    if path_exists(spark, path):
        stored = spark.read.schema("row_digest bigint").option("recursiveFileLookup", "true").parquet(path)
        rows = rows.join(stored, "row_digest", "left_anti")
    rows.write.mode("overwrite").options(**PACKED).parquet(own)
