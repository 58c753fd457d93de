"""Document fingerprints by one-permutation MinHash, in DataFrame operations only.

One hash of each shingle serves all bins: its highest bits name the bin, and the
smallest hash of a bin is kept. Sorted hashes lie bin by bin, so the first of each
bin is its minimum. An empty bin takes the value of the first filled bin along a
fixed sequence of its own (optimal densification). Of each value a few low bits
are stored, packed in hex, and the share of equal values is corrected for equal
bits by chance.
"""

import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from barworks.llm.common import fresh
from barworks.session import scratch_path, write_and_reread

#: Bins, a power of two, and the bits kept of each: one hex digit.
BIN_BITS, KEPT_BITS = 7, 4
BINS = 1 << BIN_BITS
SHINGLE_WORDS = 5
#: Bins that an empty bin tries at random before it goes on in order.
TRIES = 24
#: Ranges of ids at most, and so 100 MB of their table; more than 256 TB of text make larger ranges.
MOST_RANGES = 1 << 22


def _let(value, body):
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _probes():
    """For each bin the sequence of bins it borrows from: the same for every document."""
    source = random.Random(10)
    rows = []
    for own in range(BINS):
        tried = list(dict.fromkeys(source.randrange(BINS) for _ in range(TRIES)))
        rows.append([b for b in tried if b != own])
    return rows


def _literal(rows):
    return F.expr("array(" + ",".join("array(" + ",".join(f"{b}" for b in row) + ")" for row in rows) + ")")


def shingle_hashes(text, words=SHINGLE_WORDS):
    """Hashes of every run of ``words`` words, white space and case aside; of all words where they are fewer."""
    parts = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")
    return _let(F.transform(parts, lambda w: F.xxhash64(w)), lambda h: F.when(
        F.size(h) > 0, F.transform(F.sequence(F.lit(1), F.greatest(F.size(h) - (words - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(h, i, words)))))


def _bin(h):
    """0 to BINS - 1, rising with the signed hash."""
    return (F.shiftright(h, 64 - BIN_BITS) + BINS // 2).cast("int")


def fingerprint(text, words=SHINGLE_WORDS):
    """A string of BINS hex digits; empty for a text without words. Equal texts have equal ones."""
    def first_of_bins(hashes):
        # Neighbours of different bins differ in their highest bits.
        return F.filter(hashes, lambda x, i: F.coalesce(F.shiftright(x.bitwiseXOR(F.get(hashes, i - 1)), 64 - BIN_BITS) != 0, F.lit(True)))

    minima = _let(F.sort_array(shingle_hashes(text, words)), first_of_bins)
    return _let(minima, lambda mins: F.when(F.size(mins) > 0, _packed(mins)).otherwise(F.lit("")))


def _digit(value, b):
    """The bits kept of a bin's value, hashed with the bin: bins that borrow one value differ by chance like others."""
    return F.substr(F.lit("0123456789abcdef"), F.xxhash64(value, b).bitwiseAND((1 << KEPT_BITS) - 1).cast("int") + 1, F.lit(1))


def _packed(mins):
    """Hex digits of the bins, from their sorted minima."""
    none = F.lit(None).cast("bigint")

    def gap(x, i):
        before = F.coalesce(_bin(F.get(mins, i - 1)), F.lit(-1))
        return F.concat(F.array_repeat(none, _bin(x) - before - 1), F.array(x))

    filled = F.concat(F.flatten(F.transform(mins, gap)), F.array_repeat(none, BINS - 1 - _bin(F.get(mins, F.size(mins) - 1))))
    values = F.when(F.size(mins) == BINS, mins).when(
        F.size(mins) == 1, F.array_repeat(F.get(mins, F.lit(0)), BINS)).otherwise(_let(filled, _densified))
    return F.array_join(F.transform(values, _digit), "")


def _densified(values):
    """The values, empty bins (null) filled from their probes."""
    def borrow(row, b):
        some = lambda places: F.get(F.filter(F.transform(places, lambda p: F.get(values, p)), lambda v: v.isNotNull()), F.lit(0))
        onward = F.transform(F.sequence(F.lit(1), F.lit(BINS - 1)), lambda k: F.pmod(b + k, F.lit(BINS)))
        return F.coalesce(some(row), some(onward))

    return F.transform(_literal(_probes()), lambda row, b: F.coalesce(F.get(values, b), borrow(row, b)))


def likeness(a, b):
    """Estimated share of common shingles, 0 to 1, from two fingerprints.

    Without words, two texts are alike and any other is not like them.
    """
    equal = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y), lambda same: same)) / F.lit(BINS)
    chance = 2.0 ** -KEPT_BITS
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(F.greatest(F.lit(0.0), (equal - chance) / (1 - chance)))


def _place(edges, value, most):
    """How many of the sorted edges (an array of at most ``most``) are below a value, by halving."""
    start = F.struct(F.lit(0).alias("low"), F.size(edges).alias("high"))

    def halve(acc, _):
        return _let(((acc.low + acc.high) / 2).cast("int"), lambda m: F.when(acc.low >= acc.high, acc).when(
            F.get(edges, m) < value, F.struct((m + 1).alias("low"), acc.high.alias("high"))).otherwise(
            F.struct(acc.low.alias("low"), m.alias("high"))))

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, most.bit_length()))), start, halve, lambda acc: acc.low)


def _range_index(keys, fan, accuracy):
    """One row for each block of ``keys`` (block, id): (block, edges, heads, targets), written, of at most ``fan`` rows.

    A block is cut at ``edges`` into at most ``fan`` parts. ``heads`` has the largest
    id of each part, and ``targets`` the number of the filled range above it, where range
    block * fan + part is a part of a block. The last range is followed by the first.
    """
    spark = keys.sparkSession
    cuts = F.percentile_approx("id", [k / fan for k in range(1, fan)], accuracy)
    edges = write_and_reread(keys.groupBy("block").agg(F.array_sort(F.array_distinct(cuts)).alias("edges")), scratch_path(spark, "edges"))
    # At most fan * fan longs, see MOST_RANGES.
    parts = keys.join(F.broadcast(edges), "block").groupBy("block", _place(F.col("edges"), F.col("id"), fan).alias("part")).agg(F.max("id").alias("head"))
    filled = parts.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "head"))).alias("filled"))
    # A window over the blocks, of which there are at most fan.
    up = Window.orderBy("block")
    lowest = F.col("block") * fan + F.get("filled", F.lit(0)).part
    above = F.coalesce(F.lead(lowest).over(up), F.first(lowest).over(up))
    every, numbers = F.sequence(F.lit(0), F.lit(fan - 1)), F.transform("filled", lambda x: x.part)
    after = lambda p: F.get(numbers, F.array_position(numbers, p).cast("int"))
    index = filled.withColumn("above", above).join(F.broadcast(edges), "block").select(
        "block", "edges",
        F.transform(every, lambda p: F.get(F.transform("filled", lambda x: x.head), F.array_position(numbers, p).cast("int") - 1)).alias("heads"),
        F.transform(every, lambda p: F.coalesce(F.col("block") * fan + after(p), F.col("above"))).alias("targets"))
    return write_and_reread(index, scratch_path(spark, "ranges"))


def with_next(docs, id_col, columns, bucket_bytes=64 << 20, text_col="text"):
    """The documents with ``next``: the columns of the document of next smaller id, and for the last one those of the first.

    Ids are cut into ranges, by quantiles; each range also gets a copy of the first
    row of the next one, so every pair meets inside a range and texts are shuffled
    once. Quantiles are taken twice, of all ids and in each block between two of these, so the plan
    holds only about as many as the square root of the number of ranges; edges and
    first ids of the ranges are in a written table, which is broadcast: 24 bytes a range, at most ``MOST_RANGES``
    of them. Rows of equal ids follow one another
    in the order of their columns; null ids come last.
    """
    spark = docs.sparkSession
    ids = F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63)))
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    ranges = min(MOST_RANGES, max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // bucket_bytes)))
    fan = max(2, math.isqrt(ranges - 1) + 1)
    accuracy = max(10000, 2 * fan)
    cuts = docs.agg(F.percentile_approx(ids, [k / fan for k in range(1, fan)], accuracy)).first()[0] or []
    block_of = _place(F.lit(sorted(set(cuts))) if cuts else F.array().cast("array<bigint>"), ids, fan).cast("bigint")
    index = _range_index(docs.select(block_of.alias("block"), ids.alias("id")), fan, accuracy)
    own, block, part, at, ghost = fresh("id"), fresh("block"), fresh("part"), fresh("at"), fresh("ghost")
    index = index.select(F.col("block").alias(block), F.struct("edges", "heads", "targets").alias(at))
    placed = (docs.withColumn(own, ids).withColumn(block, block_of).join(F.broadcast(index), block)
              .withColumn(part, _place(F.col(f"{at}.edges"), F.col(own), fan)))
    here = F.struct((F.col(block) * fan + F.col(part)).alias("range"), F.lit(False).alias("ghost"))
    there = F.struct(F.get(f"{at}.targets", F.col(part)).alias("range"), F.lit(True).alias("ghost"))
    copies = F.when(F.col(own) == F.get(f"{at}.heads", F.col(part)), F.array(here, there)).otherwise(F.array(here))
    spread = placed.withColumn(ghost, F.explode(copies)).drop(block, part, at)
    order = Window.partitionBy(F.col(f"{ghost}.range")).orderBy(F.col(f"{ghost}.ghost"), F.col(own).desc(), *columns)
    return (spread.withColumn("next", F.lead(F.struct(*columns)).over(order))
            .filter(~F.col(f"{ghost}.ghost")).drop(own, ghost))


def compare_edited(docs, id_col="doc_id", text_col="text"):
    """(doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) of every document.

    ``edited`` has the last half of the code points (rounded down) replaced by the
    first as many of the next document's, in descending order of ids; the last
    one is followed by the first, a single one by itself. Null texts count as empty;
    an empty text stays empty when edited. Texts without words have an empty fingerprint.
    Repeated rows each give a row. Of the other input columns none is returned.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("fingerprint", fingerprint(F.col("text")))
    paired = with_next(base, "doc_id", ["text", "fingerprint"])
    n = F.length("text")
    half = (n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr(F.col("next.text"), F.lit(1), half))
    made = paired.select("doc_id", n.cast("bigint").alias("n_chars"), "fingerprint", F.col("next.fingerprint").alias("next_fingerprint"), edited.alias("edited"))
    return (made.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
            .withColumns({"near_edited": likeness(F.col("fingerprint"), F.col("edited_fingerprint")),
                          "near_next": likeness(F.col("fingerprint"), F.col("next_fingerprint"))})
            .drop("next_fingerprint"))
