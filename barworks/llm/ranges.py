"""Gapless numbers in a global order, without bringing the rows to one task."""

from itertools import accumulate

from pyspark.sql import functions as F

from barworks.llm.common import fresh
from barworks.session import scratch_path, write_and_reread

#: monotonically_increasing_id() counts the rows of a partition in its lower bits.
ROW_BITS = 33


def numbered(rows, order, column):
    """The rows with ``column``: 0, 1, 2, ... in the order of the sort expressions ``order``.

    Ranges of the order go to partitions, each is sorted and counted where it
    lies, and the counts of the partitions before it (one number a partition) are
    added. Equal rows are numbered in any order. The rows are written once.
    """
    spark = rows.sparkSession
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = write_and_reread(sorted_rows.withColumn(column, F.monotonically_increasing_id()), scratch_path(spark, "numbered"))
    piece, own = F.shiftright(column, ROW_BITS), fresh("piece")
    counts = placed.groupBy(piece.alias("piece")).agg(F.count(F.lit(1)).alias("rows")).orderBy("piece").collect()
    before = list(accumulate([r.rows for r in counts], initial=0))
    # One row a partition.
    offsets = spark.createDataFrame([(r.piece, n) for r, n in zip(counts, before)], f"`{own}` bigint, `{own}_before` bigint")
    found = placed.withColumn(own + "_piece", piece).join(F.broadcast(offsets), F.col(own + "_piece") == F.col(own))
    number = F.col(column).bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + F.col(f"{own}_before")
    return found.withColumn(column, number).select(*placed.columns)
