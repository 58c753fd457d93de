import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from barworks.llm.minhash import BINS, compare_edited, fingerprint, likeness, with_next
from barworks.llm.queries import op10_minhash

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = [x for x in re.split(r"\s+", text.lower()) if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def edits(rows):
    order = sorted(((-(1 << 63) if d is None else d, t or "") for d, t in rows), key=lambda r: (-r[0], r[1]))
    return [(d, t, t[:len(t) - len(t) // 2] + order[(k + 1) % len(order)][1][:len(t) // 2]) for k, (d, t) in enumerate(order)]


def test_edits_and_likeness(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = {r.doc_id: r for r in op10_minhash(spark, SF).collect()}
    errors = []
    for doc, text, edited in edits(rows):
        row = out[doc]
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and row.n_chars == len(text)
        a, b = shingles(text), shingles(edited)
        errors.append(row.near_edited - (len(a & b) / len(a | b) if a | b else 1))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07 and max(map(abs, errors)) < 0.3
    by_text = {}
    for doc, text in rows:
        assert by_text.setdefault(text, out[doc].fingerprint) == out[doc].fingerprint


def test_estimates_over_the_range(spark):
    base = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(base), " ".join(base[:400 - 20 * k] + [f"v{j}" for j in range(20 * k)])) for k in range(20)]
    df = spark.createDataFrame(rows, "k int, a string, b string").withColumn("near", likeness(fingerprint(F.col("a")), fingerprint(F.col("b"))))
    for r in df.collect():
        a, b = shingles(r.a), shingles(r.b)
        assert abs(r.near - len(a & b) / len(a | b)) < 0.16
    short = spark.createDataFrame([("one two", "one two"), ("one two", "one three"), ("", ""), ("", "x"), ("  ", "")], "a string, b string")
    got = [r.near for r in short.select(likeness(fingerprint(F.col("a")), fingerprint(F.col("b"))).alias("near")).collect()]
    assert got[0] == 1.0 and got[1] < 0.15 and got[2:] == [1.0, 0.0, 1.0]
    sizes = {len(r[0]) for r in short.select(fingerprint(F.col("a"))).collect()}
    assert sizes == {0, BINS}


def test_next_across_ranges(spark, docs):
    rows = [(k * 7 % 300, f"text {k * 7 % 300}") for k in range(300)]
    out = with_next(docs(rows), "doc_id", ["text"], bucket_bytes=50).collect()
    assert {r.doc_id: r.next.text for r in out} == {k: f"text {(k - 1) % 300}" for k in range(300)}
    # Most ids lie close together, some far apart, and one holds a third of the rows.
    ids = sorted([k * k * k for k in range(-60, 60)] + [7] * 70 + [10 ** 15 + k for k in range(20)], reverse=True)
    out = with_next(docs([(d, "x") for d in ids]), "doc_id", ["doc_id"], bucket_bytes=1).collect()
    assert sorted((r.doc_id, r.next.doc_id) for r in out) == sorted(zip(ids, [*ids[1:], ids[0]]))


def test_plan_holds_a_square_root_of_the_ranges(docs, plan):
    rows = [(k, "x" * 20) for k in range(3000)]
    text = plan(with_next(docs(rows), "doc_id", ["text"], bucket_bytes=20))
    assert max(len(found.split(",")) for found in re.findall(r"\[([-0-9, ]+)\]", text)) <= 60
    assert text.count("Exchange hashpartitioning") == 1


def test_odd_rows(docs, odd_rows, plan):
    df = docs(odd_rows).withColumn("fingerprint", F.lit(1)).withColumn("next", F.lit(1))
    out = compare_edited(df)
    got = sorted((-(1 << 63) if r.doc_id is None else r.doc_id, r.n_chars, r.edited) for r in out.collect())
    assert got == sorted((d, len(t), e) for d, t, e in edits(odd_rows))
    assert compare_edited(docs([])).count() == 0
    assert [r.edited for r in compare_edited(docs([(1, "abcd")])).collect()] == ["abab"]
    assert not re.search("EvalPython|Pandas|MapInArrow|ArrowEval", plan(out))
