import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as e
import check_oracle
import corpus_pipeline
from barworks.llm import queries as llm
from test_decontaminate import WORD
from test_line_dedup import brute as brute_lines
from test_simhash import brute_classes, brute_fingerprint, signed

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = [n for n in e.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(n.split("_")[0] for n in names) == sorted(["pipeline"] + [f"op{k}" for k in range(1, 14)])
    assert set(llm.oracle_sql()) < set(llm.queries())


@pytest.mark.parametrize("name", list(llm.oracle_sql()))
def test_query_matches_sql(spark, name):
    ok, note = check_oracle.compare(spark, check_oracle.connect(SF), name, llm.queries()[name], llm.oracle_sql()[name], SF)
    assert ok, note


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def decontaminated(text, items):
    """The text without its hit passages of ten words or more, or of a whole shorter item; None where most of it is hit."""
    windows = set()
    for _, t in items:
        i = WORD.findall(lowered(t or ""))
        n = min(10, len(i))
        windows |= {tuple(i[k:k + n]) for k in range(len(i) - n + 1)} if n else set()
    sizes, first = sorted({len(w) for w in windows}), True
    while True:
        words = list(WORD.finditer(lowered(text)))
        plain, hits, whole = [w[0] for w in words], np.zeros(len(words) + 1, bool), np.zeros(len(words) + 1, bool)
        for n in sizes:
            for k in range(len(words) - n + 1):
                if tuple(plain[k:k + n]) in windows:
                    hits[k:k + n] = True
                    whole[k] |= n < 10
        if first and hits.sum() > 0.5 * len(words):
            return None
        edges, first = np.flatnonzero(np.diff(np.concatenate([[False], hits]).astype(int))), False
        cuts = [(a, b) for a, b in zip(edges[::2], edges[1::2]) if b - a >= 10 or whole[a:b].any()]
        if not cuts:
            return text
        for a, b in reversed(cuts):
            text = text[:words[a].start()] + text[words[b - 1].end():]


def test_pipeline_against_brute_force(spark, written):
    """The classifier's verdicts are taken from its query's operator; the other stages are worked out anew.

    Items of fewer than ten words, taken from the documents, are added to the benchmark.
    """
    given = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r.doc_id: r.text for r in given.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    long = [WORD.findall(t) for t in docs.values() if len(WORD.findall(t)) > 60]
    items += [(10_000 + k, " ".join(long[k][20:20 + n])) for k, n in enumerate((4, 6, 9, 7))] + [(10_009, None), (10_010, "")]
    folder = written(documents=given, labels=spark.read.parquet(f"{SF}/labels.parquet"), benchmark=spark.createDataFrame(items, "item_id bigint, text string"))
    good = {r.doc_id for r in llm.op2_quality(spark, folder).filter("predicted = 1").collect()}
    rows = [(d, n) for d, _, _, n in brute_lines([(d, t) for d, t in docs.items() if d in good])]
    fps = {t: signed(brute_fingerprint(t)) for _, t in rows}
    classes, least = brute_classes(set(fps.values())), {}
    for d, t in rows:
        least[classes[fps[t]]] = min(d, least.get(classes[fps[t]], d))
    kept = [(d, t) for d, t in rows if d in least.values()]
    want = {d: clean for d, t in kept if (clean := decontaminated(t, items)) is not None}
    assert sum(want.get(d) != t for d, t in kept) > 4
    library = Tokenizer.from_file(llm.vocabulary_path())
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id: r.text for r in out} == want
    for r in out:
        assert r.n_chars == len(r.text) and np.frombuffer(r.ids, "<u4").tolist() == library.encode(r.text, add_special_tokens=False).ids


def test_stages_on_odd_rows(spark, docs, odd_rows, written):
    labels = spark.createDataFrame([(4, 1, 0), (6, 1, 0)], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([(1, "the cat sat on the mat and looked at a dog")], "item_id bigint, text string")
    folder = written(labels=labels, benchmark=bench)
    for rows in (odd_rows, []):
        frame = docs(rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, folder)
            assert out.columns == frame.columns
            frame = spark.read.parquet(written(step=out) + "/step.parquet")
        assert corpus_pipeline.STAGES[-1][1](spark, frame, folder).count() == frame.count()
    assert corpus_pipeline.ORACLE_SQL is None
