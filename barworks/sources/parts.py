"""Many bar files as one scan, with the outcome of each."""

from urllib.parse import unquote

from pyspark.sql import functions as F

from barworks.schemas import RAW_BARS
from barworks.session import qualified_path, scratch_path, settings, write_and_reread

OUTCOMES = ("loaded", "empty", "corrupt", "missing")


def _plain_path(c):
    """A path without its scheme and escapes, so that spellings of one file compare equal."""
    decoded = F.url_decode(F.regexp_replace(c, r"\+", "%2B"))
    return F.regexp_replace(decoded, r"^[A-Za-z][A-Za-z0-9+.-]*:/+", "/")


def read_parts(spark, root, expected=None, fmt="parquet", schema=RAW_BARS, **options):
    """(bars, outcomes) of the files under ``root``, read as one scan whatever their number.

    A part is a file, or a folder of files, below ``root``; ``expected`` (a frame with column
    ``part``, relative to ``root``) names those that should be there, by default every file is one.
    ``outcomes`` has a row a part: part, status (loaded, empty, corrupt or missing), row_count, files, reason.
    One unreadable file does not fail the others: the scan passes over it. Files that gave no rows
    are looked at once more, and only these: one that does not end like its format is corrupt, one
    without bytes is empty.

    Counting rows by file reads no column of a columnar format. Opening the files is what costs, so the
    counts are written once, to the shared folder, and folders are listed in tasks of many.
    """
    reader = spark.read.format(fmt).schema(schema).options(recursiveFileLookup="true", ignoreCorruptFiles="true", **options)
    with settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism)}):
        bars = reader.load(root)
    base = spark.range(1).select(_plain_path(F.lit(qualified_path(spark, root)))).first()[0].rstrip("/") + "/"
    relative = F.substring(_plain_path(F.col("file")), len(base) + 1, 1 << 30)
    files = spark.createDataFrame([(f,) for f in bars.inputFiles()], "file string").select("file", relative.alias("name"))
    counted = bars.select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    counted = write_and_reread(counted.select(relative.alias("counted"), "rows"), scratch_path(spark, "counted"))
    found = files.join(counted, F.col("name") == F.col("counted"), "left").drop("counted")
    silent = [unquote(r.file) for r in found.filter("rows IS NULL").collect()]
    found = found.join(_unreadable(spark, silent, fmt, relative), F.col("name") == F.col("broken"), "left")
    if expected is None:
        placed, parts = found.withColumn("part", F.col("name")), files.select(F.col("name").alias("part"))
    else:
        # A file belongs to the part of its own name or of any folder above it.
        folders = F.split("name", "/")
        above = F.transform(F.sequence(F.lit(1), F.size(folders)), lambda k: F.array_join(F.slice(folders, 1, k), "/"))
        placed, parts = found.withColumn("part", F.explode(above)), expected.select("part").distinct()
    sums = placed.groupBy("part").agg(F.sum("rows").alias("row_count"), F.count(F.lit(1)).alias("files"), F.min("why").alias("why"))
    joined = parts.join(sums, "part", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("bigint")))
    status = (F.when(F.col("files").isNull(), "missing").when(F.col("why").isNotNull(), "corrupt")
              .when(F.col("row_count") == 0, "empty").otherwise("loaded"))
    reason = F.when(F.col("files").isNull(), "no such file").otherwise(F.coalesce("why", F.lit("")))
    return bars, joined.select("part", status.alias("status"), "row_count", F.coalesce("files", F.lit(0).cast("bigint")).alias("files"), reason.alias("reason"))


def _unreadable(spark, paths, fmt, relative):
    """(broken, why) of the files among ``paths`` that are cut short or of another format."""
    if not paths:
        return spark.createDataFrame([], "broken string, why string")
    ends = F.substring("content", -4, 4).cast("string")
    # The last bytes of the formats that mark their end.
    mark = {"parquet": "PAR1", "orc": "ORC"}.get(fmt, "")
    seen = spark.read.format("binaryFile").load(paths).filter(~F.coalesce(ends.contains(mark), F.lit(False)))
    return seen.select(F.col("path").alias("file")).select(relative.alias("broken"), F.lit(f"not a whole {fmt} file").alias("why"))
