import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from barworks.llm import sharding
from barworks.llm.queries import op11_sharding
from barworks.llm.sharding import assign_shards, write_shards


def check(rows, out, shards, largest=None):
    """What holds of every result: all rows, true sizes and checksums, gapless slots, near equal bytes."""
    sizes = {(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows}
    assert Counter(r.doc_id for r in out) == Counter(d for d, _ in rows)
    assert {(r.doc_id, r.size, r.text_crc32) for r in out} == sizes
    slots, load, texts = defaultdict(list), Counter(), defaultdict(set)
    for r in out:
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
        texts[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    total = sum(load.values())
    biggest = max((r.size for r in out), default=0)
    allowed = total / shards * 0.02 + biggest if largest is None else largest
    assert all(abs(load[k] - total / shards) <= allowed for k in range(shards))
    # In the order of the key, shards follow one another: at most one cut a boundary.
    assert sum(len(s) - 1 for s in texts.values()) < shards
    return load, texts


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    out = op11_sharding(spark, folder)
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    out = out.collect()
    assert {(r.law, r.grown_shard) for r in out} == {("bytes", None)}
    check(rows, out, 16)


def test_hot_texts_are_cut(spark, docs):
    """A text with a third of the rows, empty texts, and equal rows by the thousand."""
    rows = [(k, f"text number {k} " * (k % 9)) for k in range(2000)]
    rows += [(5000 + k, "the same text in a third of all rows") for k in range(2000)]
    rows += [(7, "one row again and again")] * 1500 + [(None, None)] * 500
    out = assign_shards(docs(rows).repartition(6)).collect()
    load, texts = check(rows, out, 16)
    assert len(texts[zlib.crc32(b"the same text in a third of all rows")]) > 3
    assert sum(len(s) > 1 for s in texts.values()) < 16


def test_ranges_are_cut_until_none_is_overfull(spark, docs, monkeypatch):
    """With hardly any sample the first boundaries are poor; the exact counts put that right."""
    monkeypatch.setattr(sharding, "SAMPLES_A_RANGE", 0.3)
    rows = [(k, "x" * (k * k % 97)) for k in range(3000)]
    keyed = docs(rows).select(F.crc32(F.col("text").cast("binary")).alias("text"), F.xxhash64("doc_id").alias("id"), F.col("doc_id").alias("row"),
                              (F.length("text") + 1).cast("bigint").alias("size"), (F.length("text") + 40).cast("bigint").alias("weight"))
    names = {k: k for k in ("text", "id", "row", "size", "weight", "range")}
    boundaries, places = sharding._cut(keyed, names, 4)
    sizes = sharding._range_sizes(keyed, boundaries, names)
    assert sum(n for _, _, n in sizes.values()) == 3000 and set(sizes) == set(places)
    assert max(w for w, _, n in sizes.values() if n > 1) < 0.02 * sum(w for w, _, _ in sizes.values())


def test_splitters_keep_copies_together():
    sample = [(k, 0, 0, 1.0) for k in range(100)] + [(200, k, k, 1.0) for k in range(100)] + [(300 + k, 0, 0, 1.0) for k in range(20)]
    cuts = sharding.splitters(sample, 10.0).tolist()
    starts = [c for k in [*range(100), *range(300, 320)] if (c := bytes(sharding._key(k, sharding.LEAST, sharding.LEAST))) in cuts]
    hot = [c for c in cuts if bytes(sharding._key(200, sharding.LEAST, sharding.LEAST)) < c < bytes(sharding._key(201, sharding.LEAST, sharding.LEAST))]
    assert len(starts) >= 9 and len(hot) >= 9
    assert {bytes(sharding._key(200, sharding.LEAST, sharding.LEAST)), bytes(sharding._key(201, sharding.LEAST, sharding.LEAST))} <= set(cuts)
    assert len(sharding.splitters([], 1.0)) == 0


def test_odd_rows(spark, docs, odd_rows, tmp_path):
    frame = docs(odd_rows).withColumn("shard", F.lit("mine")).withColumn("number", F.lit(1)).withColumn("first", F.lit(2))
    out = assign_shards(frame, 4)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "number", "first", "size", "text_crc32", "shard", "slot"]
    check(odd_rows, out.collect(), 4)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(odd_rows, key=str)
    assert assign_shards(docs([]), 4).count() == 0
    assert [tuple(r) for r in assign_shards(docs([(1, "a")]), 4).select("doc_id", "slot").collect()] == [(1, 0)]
    write_shards(docs(odd_rows), str(tmp_path / "shards"), 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=str) == sorted(odd_rows, key=str)
