import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barworks.llm.ranges import numbered
from barworks.llm.resampling import drawn, resample, run_counts

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_runs(text, longest=2, buckets=10_000):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    return len(w), Counter(zlib.crc32(r.encode()) % buckets for r in runs)


def brute(rows, targets, longest=2, buckets=10_000, least=20, percent=25):
    found = [brute_runs(t, longest, buckets) for _, t in rows]
    raw, target = sum((c for _, c in found), Counter()), sum((brute_runs(t, longest, buckets)[1] for t in targets), Counter())
    s, t = raw.total(), target.total()
    gain = [math.floor(1000 * math.log((target[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets)))) for b in range(buckets)]
    out = []
    for (doc, _), (n, counts) in zip(rows, found):
        weight = sum(gain[b] * k for b, k in counts.items()) // counts.total() if counts else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, n, counts.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2], r[3]))
    ranks = [(*r, k + 1 if k < len(order) * percent // 100 else None) for k, r in enumerate(order)]
    return ranks + [(*r, None) for r in out if r[1] < least]


@pytest.mark.parametrize("longest", [1, 2, 3, 5])
@pytest.mark.parametrize("piece", [1, 7, 50, 1 << 20])
def test_runs_of_pieces(longest, piece):
    source = random.Random(4)
    texts = ["", " \n", "One", "éÀ-9_x", "a" * 300, " ".join(source.choices(["A", "bb", "Ünd", "漢字", "x1", "don't", "\x1c", "_"], k=120))]
    for text in texts:
        assert run_counts(text.encode(), longest, 997, piece) == brute_runs(text, longest, 997)


def test_against_brute_force(spark, docs):
    source = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    rows = [(k, " ".join(source.choices(words[:100 + k % 200], k=source.randint(1, 80)))) for k in range(400)]
    rows += [(500 + k, rows[3][1]) for k in range(200)] + [(3, rows[3][1]), (3, rows[4][1]), (None, rows[3][1]), (None, None), (9999, "")]
    targets = [" ".join(source.choices(words[200:], k=60)) for _ in range(20)] + [None, ""]
    target = spark.createDataFrame([(k, t) for k, t in enumerate(targets)], "item_id int, text string")
    frame = docs(rows).repartition(7).withColumn("rank", F.lit("mine")).withColumn("score", F.lit("mine"))
    out = sorted((tuple(r) for r in resample(frame, target).collect()), key=str)
    assert out == sorted(brute(rows, targets), key=str)
    few = sorted((tuple(r) for r in resample(frame, target, longest=3, buckets=50, least_words=5, percent=7).collect()), key=str)
    assert few == sorted(brute(rows, targets, 3, 50, 5, 7), key=str)


def test_drawn_documents(spark, docs, odd_rows):
    target = spark.createDataFrame([(1, "the cat sat")], "item_id int, text string")
    frame = docs(odd_rows).withColumn("rank", F.lit("mine"))
    out = resample(frame, target).collect()
    assert len(out) == len(odd_rows) and all(r.weight == 0 and r.n_features == 0 and r.rank is None for r in out if r.doc_id in (1, 2, 3))
    kept = drawn(frame, target, least_words=1, percent=50)
    assert kept.columns == frame.columns
    ids = {r.doc_id for r in resample(frame, target, least_words=1, percent=50).collect() if r.rank}
    assert {r.doc_id for r in kept.collect()} == ids and ids
    assert resample(docs([]), target).count() == 0 and drawn(docs([]), target).count() == 0
    assert all(r.rank is None or r.rank > 0 for r in resample(frame, target.limit(0)).collect())


def test_numbers_are_gapless(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("k"), "id")
    out = numbered(df, [F.col("k").desc(), F.col("id").desc()], "n").orderBy("n").collect()
    assert [r.n for r in out] == list(range(5000))
    assert [(r.k, r.id) for r in out] == sorted(((r.k, r.id) for r in df.collect()), reverse=True)
    assert numbered(df.limit(0), ["k"], "n").count() == 0
