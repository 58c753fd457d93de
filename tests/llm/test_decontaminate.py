import random
import re

import pytest
from pyspark.sql import functions as F

from barworks.llm.decontaminate import SuffixAutomaton, _blocks, decontaminate, find_contamination

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        i = words(t)
        n = min(window, len(i))
        for own in {tuple(i[k:k + n]) for k in range(len(i) - n + 1)} if n else ():
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) == own:
                    hit.update(range(k, k + n))
                    found.add(item)
    return len(w), len(hit), found


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


@pytest.fixture(scope="module")
def case():
    source = random.Random(5)
    vocabulary = ["a", "b", "cat", "é", "7x"]
    some = lambda low, high: " ".join(source.choices(vocabulary, k=source.randint(low, high)))
    items = [(k, some(1, 25)) for k in range(12)] + [(100, "B"), (101, ""), (102, None), (103, "..."), (None, "cat cat cat"), (0, "a b cat a")]
    texts = [(k, some(0, 60)) for k in range(150)] + [(900, None), (901, ""), (902, "?!")]
    texts += [(k + 1000, f"{some(3, 9)}. {t.upper()}, {some(3, 9)}") for k, (_, t) in enumerate(items) if t]
    return items, texts


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_against_brute_force(spark, docs, case, block_bytes):
    items, texts = case
    if block_bytes == 40:
        items, texts = items[:6], texts[::4]
    found = find_contamination(docs(texts), items_frame(spark, items), block_bytes=block_bytes).collect()
    assert len(found) == len(texts)
    by = dict(texts)
    for row in found:
        n, hit, own = brute(by[row.doc_id], items)
        assert (row.n_words, row.n_hit, set(row["items"])) == (n, hit, {i for i in own if i is not None}), by[row.doc_id]


def test_automaton_tracks_longest_matches():
    source = random.Random(3)
    for _ in range(60):
        texts = [source.choices(range(3), k=source.randint(1, 12)) for _ in range(3)]
        parts = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        automaton = SuffixAutomaton()
        for t in texts:
            automaton.add(t)
        stream = source.choices(range(4), k=40)
        for end, (_, length) in enumerate(automaton.read(stream), 1):
            assert length == max((n for n in range(end + 1) if not n or tuple(stream[end - n:end]) in parts), default=0)


@pytest.mark.parametrize("block_bytes", [1 << 20, 30])
def test_nothing_is_left_after_removal(spark, docs, block_bytes):
    item = "one two three four five six seven eight nine ten eleven twelve"
    texts = [(1, f"Before it. {item}! After it, and more words so that most of this text is not in the test at all."),
             (2, item), (3, None), (4, ""), (5, "clean words only"),
             (6, "one two three four five " + item + " six seven eight nine ten and a tail of many other words that keep the document in place")]
    bench = items_frame(spark, [(1, item), (2, "short item")])
    out = {r.doc_id: r.text for r in decontaminate(docs(texts), bench, block_bytes=block_bytes).collect()}
    assert out[1] == "Before it. ! After it, and more words so that most of this text is not in the test at all."
    assert 2 not in out and out[3] is None and out[4] == "" and out[5] == "clean words only"
    left = find_contamination(docs(list(out.items())), bench)
    assert left.filter(F.col("n_hit") >= 10).count() == 0


def test_empty_tables_and_odd_rows(spark, docs, odd_rows):
    bench = items_frame(spark, [(1, "the cat sat on the mat and looked at a dog")])
    rows = {(r.doc_id, r.n_words, r.n_hit) for r in find_contamination(docs(odd_rows), bench).collect()}
    assert {(4, 33000, 33000), (5, 33000, 33000), (1, 0, 0), (3, 0, 0)} <= rows and len(odd_rows) == find_contamination(docs(odd_rows), bench).count()
    assert find_contamination(docs([]), bench).count() == 0
    none = find_contamination(docs(odd_rows).withColumn("spans", F.lit(1)), items_frame(spark, []))
    assert none.filter("n_hit > 0 OR size(spans) > 0").count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 20, 20])
def test_whole_short_items_go(spark, docs, block_bytes):
    bench = items_frame(spark, [(1, "the capital of France"), (2, "seven by nine"), (3, "one two three four five six seven eight nine ten eleven twelve")])
    tail = "and many other words that keep this document in its place"
    texts = [(1, f"So: the capital of FRANCE, {tail}"), (2, f"seven seven by nine by nine {tail}"), (3, f"the capital of Spain {tail}"),
             (4, f"two three four five six seven eight nine ten, {tail}")]
    cleaned = decontaminate(docs(texts), bench, block_bytes=block_bytes)
    out = {r.doc_id: r.text for r in cleaned.collect()}
    assert out == {1: f"So: , {tail}", 2: out[2], 3: texts[2][1], 4: texts[3][1]} and out[2].split() == tail.split()
    assert find_contamination(cleaned, bench).filter("n_hit > 0").count() == 0


def test_copies_of_an_item_text_are_one_entry(spark, docs):
    text = "a passage of the test that many items repeat word for word"
    bench = items_frame(spark, [(k, text) for k in range(300)] + [(None, text), (900, "another item of the test, seen once")])
    n, blocks = _blocks(bench, "item_id", "text", 64)
    blocks = [block for block in blocks if block]
    assert n == 2 and sorted(len(ids) for block in blocks for ids, _ in block) == [1, 300]
    row = find_contamination(docs([(1, f"so {text} it says")]), bench, block_bytes=64).first()
    assert row["items"] == list(range(300)) and row.n_hit == 12
