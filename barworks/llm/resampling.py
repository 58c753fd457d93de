"""Importance resampling of documents towards a target table, by hashed word runs.

A 256-byte table lower-cases A-Z and blanks every separator in the UTF-8 bytes;
bytes.split gives the words. The CRC-32 of a run of words is chained: the run's
value seeds the blank, the blank's the next word, so each run costs two calls
whatever its length. Counters of buckets are reduced to one table of counts a
task before the shuffle; the gains of the buckets (a bounded table) then weigh each
document in a second map. Ranks come from ranges of the scores, not from one sorted task.
"""

import math
from collections import Counter
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from barworks.llm.common import LOWER, WORD_BYTES, fresh
from barworks.llm.ranges import numbered
from barworks.session import scratch_path, write_and_reread

LONGEST, BUCKETS, LEAST_WORDS, PERCENT, SEED = 2, 10_000, 20, 25, 7
#: The byte table: words in lower case, everything else blank.
BLANKED = bytes(np.where(WORD_BYTES, LOWER, ord(" ")).astype(np.uint8))
#: Bytes of a text that are split at once; longer texts go piece by piece.
PIECE = 1 << 20


def _pieces(text, piece=PIECE):
    """Translated pieces of a text, cut at blanks."""
    text = text.translate(BLANKED)
    low = 0
    while len(text) - low > piece:
        cut = text.find(b" ", low + piece)
        if cut < 0:
            break
        yield text[low:cut]
        low = cut
    yield text[low:]


def run_counts(text, longest=LONGEST, buckets=BUCKETS, piece=PIECE):
    """(words, Counter of buckets) of the runs of 1 to ``longest`` words of a UTF-8 text."""
    counts, total, tail = Counter(), 0, []
    for part in _pieces(text, piece):
        new = part.split()
        words, total = tail + new, total + len(new)
        runs = list(map(crc32, words))
        for n in range(1, longest + 1):
            if n > 1:
                runs = list(map(crc32, words[n - 1:], map(crc32, repeat(b" "), runs)))
            # Runs that end among the words carried over were counted with the piece before.
            ended = runs[max(0, len(tail) - n + 1):]
            counts.update((np.array(ended, np.int64) % buckets).tolist())
        tail = words[max(0, len(words) - longest + 1):]
    return total, counts


def bucket_counts(texts, text_col="text", longest=LONGEST, buckets=BUCKETS):
    """(bucket, features): how often each bucket occurs in all texts. A null text has no words."""
    def compute(batches):
        total = Counter()
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                total.update(run_counts(text or b"", longest, buckets)[1])
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], names=["bucket", "features"])

    return texts.select(F.col(text_col).alias("text")).mapInArrow(compute, "bucket int, features bigint").groupBy("bucket").agg(
        F.sum("features").alias("features"))


def bucket_gains(raw, target, buckets=BUCKETS):
    """floor(1000 * ln of how much commoner a bucket is in the target), add-one smoothed; from {bucket: count}."""
    all_raw, all_target = float(sum(raw.values()) + buckets), float(sum(target.values()) + buckets)
    return [math.floor(1000 * math.log((target.get(b, 0) + 1) * all_raw / ((raw.get(b, 0) + 1) * all_target)))
            for b in range(buckets)]


def weights(docs, gains, id_col="doc_id", text_col="text", longest=LONGEST):
    """(id_col, n_words, n_features, weight): the floored mean gain over a document's runs, 0 where it has none."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    kind = docs.schema[id_col].dataType.simpleString()

    def compute(batches):
        gain = shared.value
        for batch in batches:
            words, features, means = [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                n, counts = run_counts(text or b"", longest, len(gain))
                runs = counts.total()
                words.append(n)
                features.append(runs)
                means.append(sum(gain[b] * k for b, k in counts.items()) // runs if runs else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, pa.int64()) for x in (words, features, means)]],
                                             names=["id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(compute, f"id {kind}, n_words bigint, n_features bigint, weight bigint").withColumnRenamed("id", id_col)


def noise(id_col, seed=SEED):
    """floor(1000 * a Gumbel draw) that the id alone decides; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs, target, id_col="doc_id", text_col="text", longest=LONGEST, buckets=BUCKETS, least_words=LEAST_WORDS,
             percent=PERCENT, seed=SEED):
    """(id_col, n_words, n_features, weight, score, rank) of every document.

    ``score`` is the weight plus noise, so the highest scores are a draw without replacement
    in proportion to the weights. Of the documents with ``least_words`` words,
    floor(``percent`` %) are drawn and have a ``rank`` from 1; ties go to the smaller
    id (null first), equal rows in any order. Null and empty texts have no
    words, weight 0, and are never drawn. Repeated rows each count and give a row. Other
    input columns are not returned, whatever their names.

    The driver holds the counts of ``buckets`` buckets, and broadcasts their gains.
    """
    spark = docs.sparkSession
    found = [{r.bucket: r.features for r in bucket_counts(t, text_col, longest, buckets).collect()} for t in (docs, target)]
    weighed = weights(docs, bucket_gains(*found, buckets), id_col, text_col, longest)
    scored = write_and_reread(weighed.withColumn("score", F.col("weight") + noise(id_col, seed)), scratch_path(spark, "scored"))
    worthy = F.col("n_words") >= least_words
    draws = scored.filter(worthy).count() * percent // 100
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_first(), F.col("n_features"), F.col("weight")]
    ranked = numbered(scored.filter(worthy), order, "rank").withColumn("rank", F.when(F.col("rank") < draws, F.col("rank") + 1))
    rest = scored.filter(~worthy).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest)


def drawn(docs, target, id_col="doc_id", text_col="text", **options):
    """The drawn documents with all their columns. Of a repeated id, rows stay whose id was drawn."""
    own = fresh("drawn")
    ids = resample(docs, target, id_col, text_col, **options).filter("rank IS NOT NULL").select(F.col(id_col).alias(own)).distinct()
    return docs.join(ids.hint("merge"), F.col(id_col).eqNullSafe(F.col(own)), "left_semi")
