"""Shards of near equal size, by sampled splitters.

Rows are ordered by the checksum of their text, so that copies lie side by side,
then by id. A sample of keys, drawn in proportion to size, gives quantile
boundaries; rows go to the range between two of them. The ranges are then
counted exactly, and overfull ones are sampled and cut again until none is left
but single rows. Ranges are many more than shards: consecutive ones, by their exact sizes,
make up a shard, so shards differ by less than two ranges or one document.

A text's copies are cut apart only where they alone are overfull (one text may be a third
of all rows). Every row has a unique key (its place in a written table comes last),
so any range can be cut.
"""

from collections import Counter, defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barworks.llm.common import fresh, with_fields
from barworks.session import scratch_path, write_and_reread

SHARDS = 16
#: Ranges a shard is made of, at least.
RANGES_A_SHARD = 256
#: More ranges where there are more rows than this in each: what a task sorts, and one 24-byte splitter in the driver.
ROWS_A_RANGE = 1 << 21
#: Sampled keys a range.
SAMPLES_A_RANGE = 8
#: A range is overfull from this multiple of its share.
OVERFULL = 2.0
KEY = "S24"
_UNSIGNED = np.uint64(1 << 63)


def _keys(parts):
    """Sortable 24-byte keys of three bigint columns, each ordered as signed."""
    columns = [np.asarray(p, np.int64).view(np.uint64) ^ _UNSIGNED for p in parts]
    return np.ascontiguousarray(np.stack(columns, axis=1).astype(">u8")).view(np.uint8).reshape(-1, 24).view(KEY).ravel()


def _key(*parts):
    return _keys([[p] for p in parts])[0]


LEAST = -(1 << 63)


def splitters(sample, share):
    """Boundaries (first keys of ranges) at the quantiles of a sample of (text, id, row, weight).

    A text in which two or more quantiles fall has a range of its own, cut at
    these; other boundaries are moved to the start of their text.
    """
    if not sample:
        return np.zeros(0, KEY)
    sample = sorted(sample)
    reached = np.cumsum([s[3] for s in sample])
    chosen = [sample[k] for k in np.unique(np.searchsorted(reached, np.arange(share, reached[-1], share)))]
    quantiles, out = Counter(text for text, *_ in chosen), set()
    for text, own, row, _ in chosen:
        out.add(_key(text, LEAST, LEAST))
        if quantiles[text] > 1:
            out |= {_key(text, own, row), _key(text + 1, LEAST, LEAST)}
    return np.array(sorted(out), KEY)


def _ranged(rows, boundaries, names):
    """The rows with ``names["range"]``: the number of boundaries at or below the key."""
    text, own, row, out = (names[k] for k in ("text", "id", "row", "range"))

    def compute(batches):
        for batch in batches:
            keys = _keys([batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in (text, own, row)])
            number = np.searchsorted(boundaries, keys, side="right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number.astype(np.int32))], names=[*batch.schema.names, out])

    return rows.mapInArrow(compute, with_fields(rows.schema, **{out: T.IntegerType()}))


def _sample(keyed, names, share_of_draw, turn):
    """[(text, id, row, weight)]: a row is drawn with probability weight / share_of_draw and stands for at least that; anew each turn."""
    text, own, row, weight = (names[k] for k in ("text", "id", "row", "weight"))
    chance = F.col(weight) / F.lit(float(share_of_draw))
    draw = (F.xxhash64(F.lit(turn), text, own, row).bitwiseAND(F.lit((1 << 40) - 1)) + 0.5) / float(1 << 40)
    drawn = keyed.filter(draw < chance).select(text, own, row, F.greatest(F.col(weight).cast("double"), F.lit(float(share_of_draw))))
    return [tuple(r) for r in drawn.collect()]


def _range_sizes(keyed, boundaries, names):
    """{range: (weight, bytes, rows)}, exact."""
    narrow = keyed.select(*[names[k] for k in ("text", "id", "row", "size", "weight")])
    sums = _ranged(narrow, boundaries, names).groupBy(names["range"]).agg(
        F.sum(names["weight"]).alias("weight"), F.sum(names["size"]).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    return {r[0]: (r.weight, r.bytes, r.rows) for r in sums.collect()}


def _subdivided(keyed, boundaries, names, overfull, share, turn):
    """Boundaries with those added that cut the overfull ranges."""
    edges = [None, *boundaries.tolist(), None]
    narrow = _ranged(keyed.select(*[names[k] for k in ("text", "id", "row", "weight")]), boundaries, names)
    inside = narrow.filter(F.col(names["range"]).isin([int(k) for k in overfull])).drop(names["range"])
    drawn = _sample(inside, names, share / SAMPLES_A_RANGE, turn)
    by_range = defaultdict(list)
    if drawn:
        for s, number in zip(drawn, np.searchsorted(boundaries, _keys(list(zip(*drawn))[:3]), side="right").tolist()):
            by_range[number].append(s)
    added = set(boundaries.tolist())
    for number in overfull:
        sample = by_range[number]
        new = {c for c in splitters(sample, share).tolist() if (edges[number] is None or c > edges[number]) and (edges[number + 1] is None or c < edges[number + 1])}
        # Where the quantiles give no new cut, the keys of the sample themselves do.
        added |= new or {bytes(_key(*s[:3])) for s in sample if edges[number] is None or bytes(_key(*s[:3])) > edges[number]}
    return np.array(sorted(added), KEY)


def _cut(keyed, names, shards):
    """(boundaries, {range: (shard, first slot)})."""
    totals = keyed.agg(F.count(F.lit(1)).alias("rows"), F.sum(names["size"]).alias("bytes"), F.sum(names["weight"]).alias("weight")).first()
    if not totals.rows:
        return np.zeros(0, KEY), {}
    ranges = max(shards * RANGES_A_SHARD, totals.rows // ROWS_A_RANGE)
    share = totals.weight / ranges
    boundaries = splitters(_sample(keyed, names, share / SAMPLES_A_RANGE, 0), share)
    for turn in count(1):
        sizes = _range_sizes(keyed, boundaries, names)
        overfull = [k for k, (weight, _, rows) in sizes.items() if weight > OVERFULL * share and rows > 1]
        if not overfull:
            break
        finer = _subdivided(keyed, boundaries, names, overfull, share, turn)
        if len(finer) == len(boundaries):
            # Only one giant row and small ones beside it are so hard to hit: that range can stay.
            break
        boundaries = finer
    places, before, slots = {}, 0, [0] * shards
    for number in sorted(sizes):
        _, size, rows = sizes[number]
        shard = min(shards - 1, int((before + size // 2) * shards // totals.bytes))
        places[number] = (shard, slots[shard])
        before += size
        slots[shard] += rows
    return boundaries, places


def assign_shards(docs, shards=SHARDS, id_col="doc_id", text_col="text", keep=None):
    """All rows with their columns, and size, text_crc32, shard and slot, which replace columns of these names.

    ``size`` is the UTF-8 bytes of the text plus 1, ``text_crc32`` its unsigned CRC-32
    (null: that of no bytes, 0), ``slot`` the row's place in its shard, from 0 without gaps, in order of
    (text_crc32, a hash of the id). ``keep`` names the input columns to return (all). Null ids,
    null and empty texts, copies and repeated rows are rows like any other; a
    table smaller than the shards leaves some empty.

    The driver holds the splitters and 8 sampled keys for each: 256 a shard, or one for
    2 million rows where that is more.
    """
    spark = docs.sparkSession
    names = {k: fresh(k) for k in ("text", "id", "row", "size", "weight", "range", "number", "first")}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("size", "text_crc32", "shard", "slot")]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(*keep, F.crc32(text.cast("binary")).alias(names["text"]), F.xxhash64(id_col).alias(names["id"]),
                        (F.octet_length(text) + F.lit(1)).cast("bigint").alias(names["size"])).withColumn(
        names["row"], F.monotonically_increasing_id())
    keyed = write_and_reread(keyed, scratch_path(spark, "shard-keys"))
    mean = keyed.agg(F.avg(names["size"])).first()[0] or 0
    # A row weighs its size and a mean size: a range can be overfull by bytes or by rows.
    keyed = keyed.withColumn(names["weight"], F.col(names["size"]) + F.lit(int(mean)))
    boundaries, places = _cut(keyed, names, shards)
    placed = spark.createDataFrame([(k, *v) for k, v in places.items()], f"{names['number']} int, shard int, {names['first']} bigint")
    ranged = _ranged(keyed.drop(names["weight"]), boundaries, names)
    order = Window.partitionBy(names["range"]).orderBy(names["text"], names["id"], names["row"])
    numbered = ranged.withColumn("slot", F.row_number().over(order).cast("bigint") - 1)
    # One row a range.
    joined = numbered.join(F.broadcast(placed), F.col(names["range"]) == F.col(names["number"]))
    return joined.select(*keep, F.col(names["size"]).alias("size"), F.col(names["text"]).alias("text_crc32"), "shard",
                         (F.col("slot") + F.col(names["first"])).alias("slot"))


def write_shards(docs, path, shards=SHARDS, id_col="doc_id", text_col="text"):
    """The documents under ``path``/shard=0 and so on, one folder a shard, with their slots."""
    assign_shards(docs, shards, id_col, text_col).write.partitionBy("shard").parquet(path)
