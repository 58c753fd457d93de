"""Line de-duplication over levelled sorted runs of line hashes.

A batch of documents becomes one run: a table of (line key, documents holding it,
keeper), bucketed and sorted by key. Each new batch is merge-joined with the runs
there are; a key found in none of them is new, and the batch's own largest id
becomes its keeper. Runs of one level are merged into one of the next level when
``fanout`` of them are there, so a key is rewritten once a level. Runs of equal
bucketing join without a shuffle.
"""

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barworks.llm.common import fresh, keep_columns, with_fields
from barworks.session import delete_path, scratch_path, settings, write_and_reread

WHITE = b" \t\n\x0b\x0c\r"
#: Stands for a null id: smaller than any other, and equal to itself.
NO_ID = -(1 << 63)
#: Bytes of a row of a run, and of a bucket: a merge task sorts and writes about one bucket.
ROW_BYTES, BUCKET_BYTES = 40, 64 << 20


def line_key(line, min_chars):
    """The 16-byte key of a lower-cased line, or None where it is too short to count."""
    line = line.strip(WHITE)
    if len(line) < min_chars or not line.isascii() and len(line.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(line)


def document_keys(docs, id_col, text_col, min_chars):
    """(id, key): each key of a document once."""
    def keys(batches):
        for batch in batches:
            ids, found = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                own = {line_key(line, min_chars) for line in text.lower().split(b"\n")} if text else set()
                for key in own:
                    if key is not None:
                        ids.append(doc)
                        found.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], names=["id", "key"])

    ids = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID))
    return docs.select(ids.alias("id"), F.col(text_col).alias("text")).mapInArrow(keys, "id bigint, key binary")


class LineRuns:
    """Levels of runs in bucketed tables of the warehouse.

    Executors may be lost at any time: a run is a committed table. Tables of
    merged runs are dropped at once; call ``drop`` in the end.
    """

    def __init__(self, spark, fanout=2, buckets=None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels = [[]]

    def _write(self, df):
        """A run with one file a bucket: what is shuffled by key on the way has as many partitions as there are buckets."""
        name = f"line_run_{uuid.uuid4().hex}"
        sizes = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        with settings(self.spark, dict.fromkeys(sizes, str(self.buckets))):
            df.write.format("parquet").bucketBy(self.buckets, "key").sortBy("key").saveAsTable(name)
        return name

    def runs(self):
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, keys):
        """A batch of (id, key) rows. Batches come in descending order of ids where the largest id is to keep a line."""
        batch = keys.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("keeper"))
        seen = F.lit(False)
        for n, run in enumerate(self.runs()):
            batch = batch.join(run.select("key", F.lit(True).alias(f"seen{n}")), "key", "left")
            seen = seen | F.coalesce(F.col(f"seen{n}"), F.lit(False))
        # The anti-joined part enters with its keeper, the rest only adds to the counts.
        self.levels[0].append(self._write(batch.select("key", "docs", F.when(~seen, F.col("keeper")).alias("keeper"))))
        self._settle()

    def _settle(self):
        for depth in range(len(self.levels)):
            if len(self.levels[depth]) >= self.fanout:
                if depth + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[depth + 1].append(self._merge(self.levels[depth]))
                self.levels[depth] = []

    def _merge(self, names):
        merged = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).select("key", F.col("docs").alias("more"), F.col("keeper").alias("first"))
            merged = merged.join(other, "key", "full").select(
                "key", (F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("docs"),
                F.coalesce("keeper", "first").alias("keeper"))
        name = self._write(merged)
        for old in names:
            self.spark.sql(f"DROP TABLE {old}")
        return name

    def merged(self):
        """All runs as one."""
        names = [name for level in self.levels for name in level]
        if len(names) > 1:
            names = [self._merge(names)]
        self.levels = [names]
        return self.spark.table(names[0])

    def drop(self):
        for level in self.levels:
            for name in level:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels = [[]]


def _batch_number(docs, id_col, n):
    """(number of a row of keys' batch by its ``id``, number of batches): ranges of ids, the largest first, null ids last."""
    ids = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID))
    cuts = docs.agg(F.percentile_approx(ids, [k / n for k in range(n - 1, 0, -1)], 1000)).first()[0] or []
    cuts = list(dict.fromkeys(cuts))
    return sum(((F.col("id") <= cut).cast("int") for cut in cuts), F.lit(0)), len(cuts) + 1


def frequent_lines(keys, batches, min_docs=5):
    """Written table (key, keeper) of the lines to drop everywhere but in their keeper.

    ``keys``: (id, key, batch) in a table partitioned by batch, of which 0 has the largest ids.
    """
    spark = keys.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-keys.count() * ROW_BYTES // BUCKET_BYTES))
    runs = LineRuns(spark, buckets=buckets)
    try:
        for number in range(batches):
            runs.add(keys.filter(F.col("batch") == number).select("id", "key"))
        found = runs.merged().filter(F.col("docs") >= min_docs).select("key", "keeper")
        return write_and_reread(found, scratch_path(spark, "frequent-lines"))
    finally:
        runs.drop()


def _sieve(found, bits):
    """A bitmap over the first ``bits`` bits of the keys: 2^(bits - 6) words at most reach the driver."""
    at = F.shiftright(F.conv(F.substring(F.hex("key"), 1, 8), 16, 10).cast("bigint"), 32 - bits).alias("at")
    words = found.select(at).selectExpr("shiftright(at, 6) AS word", "shiftleft(1L, CAST(at & 63 AS INT)) AS bit").groupBy("word").agg(
        F.bit_or("bit").alias("bits"))
    sieve = np.zeros(1 << (bits - 6), np.int64)
    for row in words.collect():
        sieve[row.word] = row.bits
    return sieve.view(np.uint64)


def _sieved(keys, sieve):
    """The (id, key) rows whose key may be in the sieve: few pass, so few are shuffled."""
    bits = int(len(sieve) * 64).bit_length() - 1

    def passing(batches):
        for batch in batches:
            if batch.num_rows:
                prefix = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u8")[::2] >> np.uint64(64 - bits)
                word = sieve[(prefix >> np.uint64(6)).astype(np.int64)]
                yield batch.filter(pa.array((word >> (prefix & np.uint64(63))) & np.uint64(1) == 1))

    return keys.select("id", "key").mapInArrow(passing, "id bigint, key binary")


def dedup_lines(docs, id_col="doc_id", text_col="text", min_chars=40, min_docs=5, batches=4, sieve_bits=20):
    """The documents without lines that other documents keep.

    A line's key is the line, stripped of ASCII white space and with A-Z in lower
    case. A key of at least ``min_chars`` code points held by at least
    ``min_docs`` documents loses its lines in all documents but those with the
    largest id holding it. Returns all input columns, the text replaced, and
    ``n_lines`` (before), ``n_dropped``.

    A null or empty text is one empty line; it stays null or empty. Every row is
    a document: rows of one id count each, and all of them keep what the id
    keeps. Null ids together count as one smallest id. Columns named ``n_lines``
    or ``n_dropped`` are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_dropped")
    # Texts are read for their keys once, and once more where lines go.
    number, batches = _batch_number(docs, id_col, batches)
    key_path = scratch_path(spark, "line-keys")
    keys = write_and_reread(document_keys(docs, id_col, text_col, min_chars).withColumn("batch", number), key_path, ["batch"])
    found = frequent_lines(keys, batches, min_docs)
    drops = (_sieved(keys, _sieve(found, sieve_bits)).join(found, "key")
             .filter(F.col("id") != F.col("keeper"))
             .groupBy("id").agg(F.collect_set("key").alias("keys")))
    drops = write_and_reread(drops, scratch_path(spark, "line-drops"))
    delete_path(spark, key_path)
    own, other, drop = fresh("own"), fresh("id"), fresh("drop")
    joined = (docs.withColumn(own, F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)))
              .join(drops.select(F.col("id").alias(other), F.col("keys").alias(drop)).hint("merge"), F.col(own) == F.col(other), "left")
              .drop(own, other))

    def rewrite(batches):
        for batch in batches:
            texts = batch.column(text_col).cast(pa.binary()).to_pylist()
            kept, n_lines, n_dropped = [], [], []
            for text, keys in zip(texts, batch.column(drop).to_pylist()):
                lost = 0
                if not text:
                    total = 1
                elif not keys:
                    total = text.count(b"\n") + 1
                else:
                    lines, keys = text.split(b"\n"), set(keys)
                    rest = [line for line in lines if line_key(line.lower(), min_chars) not in keys]
                    total, lost, text = len(lines), len(lines) - len(rest), b"\n".join(rest)
                kept.append(text)
                n_lines.append(total)
                n_dropped.append(lost)
            yield keep_columns(batch.drop_columns([drop]), **{
                text_col: pa.array(kept, pa.binary()).cast(pa.string()),
                "n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64())})

    schema = with_fields(docs.schema, n_lines=T.LongType(), n_dropped=T.LongType())
    return joined.mapInArrow(rewrite, schema)
