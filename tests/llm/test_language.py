import numpy as np
import pytest
from pyspark.sql import functions as F

from barworks.llm.common import held_out
from barworks.llm.language import Mixture, infer, predict, train
from barworks.llm.queries import op8_language

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    out = op8_language(spark, SF).join(given, "doc_id").toPandas()
    own = out[out.held_out & out.lang.notna() & (out.lang_pred != "und")]
    assert len(out) == 1000 and (own.lang == own.lang_pred).mean() > 0.97
    assert out.score.between(0, 1).all()
    assert all((p == "und") == (not any(c.isalpha() for c in t or "")) for p, t in zip(out.lang_pred, out.text))


@pytest.fixture(scope="module")
def model(spark, docs):
    source = np.random.default_rng(1)
    words = {"aa": ["the", "thing", "with", "and", "other"], "bb": ["und", "schön", "nicht", "über", "zwölf"], "cc": ["que", "ción", "señor", "años", "está"]}
    rows = [(k, " ".join(source.choice(words[lang], 60)), lang) for k, lang in enumerate(["aa", "bb", "cc"] * 30)]
    return train(docs(rows + [(99, None, "aa"), (98, "text", None)]))


def test_proportions_of_mixtures(docs, model):
    half = "the thing with and other the and thing with other " * 5 + "und schön nicht über zwölf und nicht zwölf über schön " * 5
    rows = [(1, half), (2, "the other thing with and the other thing " * 4), (3, half + "que ción señor años está " * 10)]
    out = {r.doc_id: r for r in predict(docs(rows), model).collect()}
    assert out[1].shares.keys() == {"aa", "bb"} and out[1].shares["aa"] == pytest.approx(0.5, abs=0.05)
    assert out[2].shares == {"aa": 1.0} and out[2].lang_pred == "aa" and out[2].score > 0.99
    assert out[3].shares.keys() == {"aa", "bb", "cc"}


def test_choice_of_sets_is_the_best_in_order():
    """The shortcut for one language against a search over all leading sets."""
    source = np.random.default_rng(2)
    sizes = source.integers(1, 40, 60)
    owner = np.repeat(np.arange(60), sizes)
    logs = source.normal(0, 4, (3, len(owner))).astype(np.float32)
    mixture = Mixture(logs, owner)
    best, score = infer(mixture)
    cost = 0.5 * np.log(sizes + 1.0)
    share, _ = mixture.fit(np.ones((3, 60)))
    rank = np.argsort(np.argsort(-share, axis=0, kind="stable"), axis=0)
    values = [mixture.single().max(axis=0) - cost] + [mixture.fit((rank < k).astype(float))[1] - k * cost for k in (2, 3)]
    chosen = np.where(values[1] <= values[0], 1, np.where(values[2] <= values[1], 2, 3))
    assert (chosen > 1).any() and ((best > 0).sum(axis=0) == chosen).all()
    assert np.allclose(best.sum(axis=0), 1) and ((score > 0) & (score <= 1)).all()


def test_a_document_is_judged_by_itself():
    """Alone or beside others, a document has the same languages and score."""
    source = np.random.default_rng(3)
    sizes = source.integers(1, 60, 400)
    owner, tilt = np.repeat(np.arange(400), sizes), source.normal(0, 3, (5, 400))
    logs = (np.repeat(tilt, sizes, axis=1) * source.integers(0, 2, len(owner)) + source.normal(0, 4, (5, len(owner)))).astype(np.float32)
    best, score = infer(Mixture(logs, owner))
    assert len({*(best > 0).sum(axis=0)}) > 2
    for k in range(400):
        own, alone = infer(Mixture(logs[:, owner == k], np.zeros(sizes[k], int)))
        assert ((own[:, 0] > 0) == (best[:, k] > 0)).all() and own[:, 0] == pytest.approx(best[:, k], abs=1e-6) and alone[0] == pytest.approx(score[k], abs=1e-6)


def test_too_many_languages_fail_before_counting(docs, monkeypatch):
    monkeypatch.setattr("barworks.llm.language.MOST_LANGUAGES", 2)
    with pytest.raises(ValueError, match="more than 2"):
        train(docs([(k, "text", f"l{k}") for k in range(3)]))


def test_odd_rows(docs, odd_rows, model):
    out = predict(docs(odd_rows).withColumn("score", F.lit(1)).withColumn("shares", F.lit(1)), model).collect()
    assert len(out) == len(odd_rows)
    for r in out:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert predict(docs([]), model).count() == 0
    assert {r.lang_pred for r in predict(docs(odd_rows), train(docs([]))).collect()} == {"und"}


def test_held_out_rows_are_not_learnt(spark, docs):
    rows = [(k, "the thing" if k % 2 else "und schön", "aa" if k % 2 else "bb") for k in range(200)]
    kept = {r.doc_id for r in docs(rows).filter(~held_out(F.col("doc_id"))).collect()}
    other = [(k, t, lang if k in kept else "zz") for k, t, lang in rows]
    models = [train(docs(x).filter(~held_out(F.col("doc_id")))) for x in (rows, other)]
    assert models[0][0] == models[1][0] and (models[0][1] == models[1][1]).all()
