"""Watermark state as an append-only table.

Every change appends rows; reading folds them with one aggregate. A row carries
an epoch per listing: within an epoch the largest date wins, so advancing twice
or out of order is harmless, and deleting starts a new epoch with no date, so
the listing is loaded in full next time. Nothing is ever overwritten while it
is being read.
"""

import datetime as dt

from pyspark.sql import functions as F

from barworks.operators.incremental import watermark_candidates
from barworks.schemas import LISTING, WATERMARK_LOG
from barworks.session import delete_path, files_in, no_rows, path_exists


class WatermarkTable:
    def __init__(self, spark, path):
        self.spark, self.path = spark, path

    def _log(self):
        if not path_exists(self.spark, self.path):
            return no_rows(self.spark, WATERMARK_LOG)
        return self.spark.read.schema(WATERMARK_LOG).parquet(self.path)

    def _folded(self):
        last = F.max(F.struct("epoch", "watermark")).alias("last")
        return self._log().groupBy(*LISTING).agg(last).select(*LISTING, "last.epoch", "last.watermark")

    def read(self):
        """Current watermarks: symbol, exchange_code, watermark."""
        return self._folded().filter(F.col("watermark").isNotNull()).select(*LISTING, "watermark")

    def get(self, symbol, exchange_code, default=None):
        row = self.read().filter((F.col("symbol") == symbol) & (F.col("exchange_code") == exchange_code)).first()
        return default if row is None else row["watermark"]

    def _append(self, marks):
        marks.select(*[f.name for f in WATERMARK_LOG]).write.mode("append").parquet(self.path)

    def _with_epoch(self, marks):
        epochs = self._folded().select(*LISTING, "epoch")
        return marks.join(epochs, LISTING, "left").withColumn("epoch", F.coalesce("epoch", F.lit(0).cast("bigint")))

    def advance(self, loaded):
        """Record the last date of each listing of a batch that was loaded."""
        self._append(self._with_epoch(watermark_candidates(loaded)))

    def set(self, symbol, exchange_code, day):
        """Set one watermark, also to an earlier day."""
        self.delete(symbol, exchange_code)
        day = day if isinstance(day, dt.date) else dt.date.fromisoformat(str(day))
        one = self.spark.createDataFrame([(symbol, exchange_code, day)], "symbol string, exchange_code string, watermark date")
        self._append(self._with_epoch(one))

    def _forget(self, rows):
        self._append(rows.withColumns({
            "epoch": F.col("epoch") + 1, "watermark": F.lit(None).cast("date")}))

    def delete(self, symbol, exchange_code):
        self._forget(self._folded().filter(
            (F.col("symbol") == symbol) & (F.col("exchange_code") == exchange_code)))

    def reset(self):
        """Forget every listing: the next run is a full load."""
        self._forget(self._folded())

    def compact(self):
        """Replace the log by its folded state, in place, for every reader.

        The folded rows are appended before the older files go, and folding takes
        the largest, so readers see the same state at any moment. Not to be run
        while a load writes.
        """
        if not path_exists(self.spark, self.path):
            return
        older = [f for f in files_in(self.spark, self.path) if "/part-" in f]
        self._folded().coalesce(1).write.mode("append").parquet(self.path)
        for file in older:
            delete_path(self.spark, file)
