import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from barworks.llm.bpe import Encoder, Vocabulary, decode, encode
from barworks.llm.queries import op1_bpe, vocabulary_path

ODD = list("abcdeTHEthe's'll  \n\t.!?*#123") + list("éÉßñÓÈ́éΣσςİIıǅ①²½Ⅷ٣\x1c\x1f\x85\xa0 ​᠎﻿漢字かなабв😀👍🏽ͅ\x00\x7f") + [
    "<|endoftext|>", "<|startoftext|>", "<|endof", "'RE", "'ve"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def vocabulary():
    with open(vocabulary_path(), encoding="utf-8") as file:
        return Vocabulary(file.read())


def same(library, vocabulary, encoder, texts):
    for text, want, got in zip(texts, library.encode_batch(texts, add_special_tokens=False), encoder.encode(texts)):
        assert want.ids == got.tolist(), text[:200]
        assert " ".join(vocabulary.tokens[i] for i in got.tolist()) == library.decode(want.ids, skip_special_tokens=False)


def test_random_texts(library, vocabulary):
    source, encoder = random.Random(1), Encoder(vocabulary)
    for _ in range(100):
        same(library, vocabulary, encoder, ["".join(source.choices(ODD, k=source.randint(0, 60))) for _ in range(20)])


def test_long_words_and_repeats(library, vocabulary):
    same(library, vocabulary, Encoder(vocabulary), ["", "a" * 5000, "ab" * 3000 + "é" * 100, "!" * 2000, "the" * 40, "x" * 64, "x" * 65, "q"])


def test_side_by_side_equals_one_by_one(vocabulary):
    source = random.Random(2)
    words = [bytes(source.choices(b"aeinrst", k=source.randint(1, 64))) for _ in range(300)]
    flat, counts = vocabulary.merge_words(words)
    for word, ids in zip(words, np.split(flat, np.cumsum(counts)[:-1])):
        assert vocabulary.merge_word(vocabulary.symbols(word)) == ids.tolist()


def test_query_on_odd_rows(spark, docs, odd_rows, written, library):
    folder = written(documents=docs(odd_rows))
    got = sorted(tuple(r) for r in op1_bpe(spark, folder).na.fill({"doc_id": -99}).collect())
    want = []
    for doc, text in odd_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        want.append((-99 if doc is None else doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(shown.encode()).hexdigest()))
    assert got == sorted(want)


def test_empty_and_clashing_columns(spark, docs):
    df = docs([(1, "Hello there")]).withColumnsRenamed({"lang": "ids", "source": "n_tokens", "n_chars": "decoded"})
    out = decode(encode(df, vocabulary_path()), vocabulary_path())
    assert out.columns == ["doc_id", "text", "ids", "n_tokens", "decoded"]
    assert out.first().decoded == "hello</w> there</w>"
    assert encode(docs([]), vocabulary_path()).count() == 0
