import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barworks.llm.common import WordHash, held_out
from barworks.llm.quality import FEATURES, AdditiveModel, features, reject_low_quality, score, train
from barworks.llm.queries import op2_quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def made(spark):
    scored = op2_quality(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return scored.join(labels, "doc_id", "left").toPandas()


def test_held_out_accuracy(made):
    own = made[made.held_out & made.quality.notna()]
    assert len(own) > 60
    assert (own.predicted == own.quality).mean() > 0.95
    assert own[own.quality == 1].predicted.mean() > 0.98


def test_result_form(made):
    assert len(made) == 1000 and made.score.between(0, 1).all()
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) for d, h in zip(made.doc_id, made.held_out))
    assert ((made.score >= 0.3).astype(int) == made.predicted).all()


def test_features_of_one_text():
    text = "AAA aa aa, | 12.\nb".encode()
    row = dict(zip(FEATURES, features(np.frombuffer(text, np.uint8), np.array([0, len(text)]), WordHash())[0]))
    assert row["log_words"] == pytest.approx(np.log(7)) and row["upper"] == pytest.approx(3 / 8)
    assert row["bare_marks"] == pytest.approx(1 / 6) and row["odd_marks"] == pytest.approx(1 / 6) and row["line_words"] == 3


def test_pairs_are_learnt():
    source = np.random.default_rng(1)
    x = source.random((4000, 3))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    model = AdditiveModel.from_json(AdditiveModel().fit(x, y).to_json())
    assert model.pairs[0][:2] == (1, 0)
    assert ((model.score(x) > 0.5) == y).mean() > 0.9


def test_odd_rows_and_labels(spark, docs, odd_rows):
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (6, 0, 0), (None, 1, 0), (7, None, 0), (77, 0, 0)], "doc_id bigint, quality int, toxic int")
    df = docs(odd_rows).withColumn("label", F.lit(5)).withColumn("score", F.lit("x"))
    model = train(df, labels)
    out = score(df, model).collect()
    assert len(out) == len(odd_rows) and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if not (r.text or "").strip()}) == 1
    again = score(df, train(df, labels)).collect()
    assert sorted(r.score for r in again) == sorted(r.score for r in out)
    empty = train(docs([]), labels.filter("false"))
    assert score(docs([(1, "a")]), empty).first().score == 0.5
    assert reject_low_quality(df, labels).columns == df.columns


def test_labels_of_held_out_rows_are_not_used(spark, docs):
    texts = [(k, "good words here" if k % 2 else "bad!! bad!!") for k in range(400)]
    labels = [(k, k % 2, 0) for k in range(400)]
    kept = {r.doc_id for r in docs(texts).filter(~held_out(F.col("doc_id"))).select("doc_id").collect()}
    turned = [(k, q if k in kept else 1 - q, t) for k, q, t in labels]
    models = [train(docs(texts), spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")).to_json() for rows in (labels, turned)]
    assert models[0] == models[1]
