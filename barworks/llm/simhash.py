"""SimHash fingerprints, their near-duplicate links by meeting in the middle, and components.

Two fingerprints within 3 bits meet in a variant that lies within 1 bit of one
and 2 bits of the other. Emitting all 2,081 such variants of every fingerprint is
exact but large, so a sieve comes first: the 64 bits are cut into blocks (three), and one
of the ways to leave a block out leaves at most 2 of the 3 differing bits, so the two
fingerprints meet within 1 bit of each (half the radius) in few variants: 131.
A shuffle on variants counts them; fingerprints without a shared one have no
neighbour. Every other fingerprint, whatever the number it meets, emits its whole ball.
All fingerprints within 2 bits of a variant lie within 3 bits of any that is within
1 bit of it, so each is linked to the smallest such one: links are verified by their
distance to the variant, rows stay in proportion to fingerprints, and no pairs are made.

Exact copies are one fingerprint throughout.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from barworks.llm.common import fresh
from barworks.llm.components import connected_components
from barworks.session import delete_path, scratch_path, write_and_reread

RADIUS = 3
BITS = 64
#: Blocks of the sieve. Chance meetings of unlike fingerprints grow with their number over 2^(64 - 64 / BLOCKS):
#: three blocks serve up to some 10^8 fingerprints, eight (456 variants each) 10^11.
BLOCKS = 3


def shingle_hashes(text, words):
    """XXH64 of each run of ``words`` words of a UTF-8 text, white space and ASCII case aside."""
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(parts) - words + 1)
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[:n].tolist(), ends[min(words, len(parts)) - 1:].tolist())
    return np.fromiter((digest(line[a:b], 42) for a, b in pairs), np.uint64, n)


def fingerprint(hashes):
    """The bits set in over half the hashes; 0 where there are none."""
    if not len(hashes):
        return 0
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.unpackbits(hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += part.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > len(hashes), bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs, id_col="doc_id", text_col="text", words=3):
    """(id, digest, fp) of every document: its id, a hash of the text, the fingerprint as a bigint. Null and wordless texts have 0."""
    def compute(batches):
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            found = [fingerprint(shingle_hashes(t, words)) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.int64())], names=["id", "digest", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"))
    return rows.mapInArrow(compute, f"id {rows.schema['id'].dataType.simpleString()}, digest bigint, fp bigint")


def _mask(bits):
    """A bigint with the given bits set."""
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def _sieve_variants(fps, blocks):
    """(variant, fp): the ball of half the radius around each projection that leaves a block of bits out."""
    def emit(batches):
        flips, keeps = [], []
        edges = [BITS * k // blocks for k in range(blocks + 1)]
        for number in range(blocks):
            inside = range(edges[number], edges[number + 1])
            rest = [b for b in range(BITS) if b not in inside]
            # One bit of the block left out is set, so that its variants differ from other blocks'.
            mark = inside[number % len(inside)]
            flips += [_mask([mark])] + [_mask([mark, b]) for b in rest]
            keeps += [_mask(rest)] * (len(rest) + 1)
        flips, keeps = np.array(flips, np.int64), np.array(keeps, np.int64)
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fp), 4096):
                part = fp[at:at + 4096]
                variant = (part[:, None] & keeps) ^ flips
                yield pa.RecordBatch.from_arrays([pa.array(variant.ravel()), pa.array(np.repeat(part, len(flips)))], names=["variant", "fp"])

    return fps.select("fp").mapInArrow(emit, "variant bigint, fp bigint")


def _ball_variants(fps):
    """(variant, fp): all variants within 2 bits."""
    def emit(batches):
        one = [_mask([b]) for b in range(BITS)]
        two = [_mask([a, b]) for a in range(BITS) for b in range(a)]
        flips = np.array([0, *one, *two], np.int64)
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fp), 256):
                part = fp[at:at + 256]
                yield pa.RecordBatch.from_arrays([pa.array((part[:, None] ^ flips).ravel()), pa.array(np.repeat(part, len(flips)))], names=["variant", "fp"])

    return fps.select("fp").mapInArrow(emit, "variant bigint, fp bigint")


def _meeting(variants, *aggregates):
    """Rows (variant, fp) whose variant several have, with aggregates over it: counted by groupBy, joined back on the variant."""
    dealt = variants.repartition("variant")
    counted = dealt.groupBy(F.col("variant").alias("met")).agg(F.count(F.lit(1)).alias("members"), *aggregates).filter("members > 1")
    return dealt.join(counted.hint("merge"), F.col("variant") == F.col("met"))


def near_links(fps, blocks=BLOCKS):
    """Written table of links (a, b) whose components are those of all pairs within 3 bits.

    ``fps`` has distinct fingerprints in column ``fp``.
    """
    spark = fps.sparkSession
    path = scratch_path(spark, "simhash-meeting")
    meeting = write_and_reread(_meeting(_sieve_variants(fps, blocks)).select("fp").distinct(), path)
    within_1 = F.bit_count(F.col("variant").bitwiseXOR(F.col("fp"))) <= 1
    stars = (_meeting(_ball_variants(meeting), F.min(F.when(within_1, F.col("fp"))).alias("center"))
             .filter("center IS NOT NULL AND center <> fp").select(F.col("center").alias("a"), F.col("fp").alias("b")))
    links = write_and_reread(stars.distinct(), scratch_path(spark, "simhash-links"))
    delete_path(spark, path)
    return links


def _classes(fps, links):
    """Written table (class_fp, first): the smallest ``least`` reachable from each fingerprint."""
    spark = fps.sparkSession
    groups = connected_components(links)
    members = write_and_reread(groups.join(fps, F.col("node") == F.col("fp")).select("fp", "component", "least"),
                               scratch_path(spark, "simhash-members"))
    smallest = members.groupBy("component").agg(F.min("least").alias("first")).withColumnRenamed("component", "named")
    joined = members.join(smallest, F.col("component") == F.col("named")).select(F.col("fp").alias("member"), "first")
    named = fps.join(joined, F.col("fp") == F.col("member"), "left").select(
        F.col("fp").alias("class_fp"), F.when(F.col("member").isNull(), F.col("least")).otherwise(F.col("first")).alias("first"))
    return write_and_reread(named, scratch_path(spark, "simhash-classes"))


def _firsts(found, least):
    """Written table (class_fp, first) from the fingerprints of all documents; ``least`` says which document stands for them."""
    fps = write_and_reread(found.groupBy("fp").agg(F.min(least).alias("least")), scratch_path(found.sparkSession, "simhash-distinct"))
    return _classes(fps, near_links(fps.select("fp")))


def near_components(docs, id_col="doc_id", text_col="text", words=3):
    """(doc_id, fingerprint, component_id) of every document.

    ``fingerprint`` has 16 hex digits. Documents link where their fingerprints
    differ in 3 bits or fewer; ``component_id`` is the smallest id reachable. Null and
    wordless texts have fingerprint zero and link like any other. Rows may
    repeat: each gives a row. Ids may be of any type that has an order. A null id takes no part as
    a smallest id; a component of null ids only has a null ``component_id``. Of the other input columns none is returned.
    """
    found = write_and_reread(fingerprints(docs, id_col, text_col, words), scratch_path(docs.sparkSession, "simhash"))
    named = _firsts(found, F.col("id"))
    return found.join(named, F.col("fp") == F.col("class_fp"), "left").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id"))


def drop_near_duplicates(docs, id_col="doc_id", text_col="text", words=3):
    """One document of each component, the one with the smallest id, all input columns as they are.

    Where several texts of a component have its smallest id, one of them stays, and
    one row where that repeats. Unlike texts under one id are in components
    of their own and both stay. Rows with a null id cannot be told apart or ordered: they
    neither link nor go.
    """
    own, digest = fresh("id"), fresh("digest")
    known = docs.filter(F.col(id_col).isNotNull())
    found = write_and_reread(fingerprints(known, id_col, text_col, words), scratch_path(docs.sparkSession, "simhash"))
    kept = _firsts(found, F.struct("id", "digest")).select(F.col("first.id").alias(own), F.col("first.digest").alias(digest + "_kept")).distinct()
    # The kept ids grow with the documents: the same join at every size. Rows lie by (id, digest) for both steps.
    marked = known.withColumn(digest, F.xxhash64(text_col))
    rest = marked.join(kept.hint("merge"), (F.col(id_col) == F.col(own)) & (F.col(digest) == F.col(digest + "_kept")), "left_semi")
    return rest.dropDuplicates([id_col, digest]).drop(digest).unionByName(docs.filter(F.col(id_col).isNull()))
