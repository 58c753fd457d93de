"""Language identification by mixture inference.

Training counts hashed byte trigrams of words, by language, over all training
documents; tasks count for themselves and a shuffle adds up. A document is then a
mixture: each of its words is drawn from one language with the likelihood of its
trigrams, and expectation-maximisation estimates the languages' proportions. A
set of languages is chosen by likelihood less a penalty for each language.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barworks.llm.common import LOWER, SLICE_BYTES, byte_table, keep_columns, text_slices, with_fields, word_bounds

BUCKETS = 1 << 16
SMOOTHING = 0.2
ROUNDS = 10
#: A model has at most so many languages; it and its counts then stay within some 70 MB.
MOST_LANGUAGES = 256
UNKNOWN = "und"

WORD = byte_table((0x61, 0x7A), (0x80, 0xFF))
LATIN = byte_table((0x41, 0x5A), (0x61, 0x7A))
LETTERS = np.where(WORD[LOWER], LOWER, 0x20).astype(np.uint32)


def trigrams(data, offsets):
    """(buckets of the trigrams around each word byte, word starts among them, documents of words)."""
    letters = LETTERS[data]
    inside = letters != 0x20
    starts, ends, owner = word_bounds(inside, offsets)
    before, after = np.full(len(letters), 0x20, np.uint32), np.full(len(letters), 0x20, np.uint32)
    before[1:], after[:-1] = letters[:-1], letters[1:]
    before[starts], after[ends - 1] = 0x20, 0x20
    code = (before << np.uint32(16)) | (letters << np.uint32(8)) | after
    sizes = ends - starts
    return ((code[inside] * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64), np.cumsum(sizes) - sizes, owner


def count_trigrams(docs, text_col="text", lang_col="lang"):
    """(lang, bucket, n) over all rows with a text and a language."""
    def count(batches):
        sums = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for row, data, offsets in text_slices(batch.column(0)):
                buckets, word_starts, owner = trigrams(data, offsets)
                grams = np.repeat(owner, np.diff(np.append(word_starts, len(buckets))))
                own = langs[row:row + len(offsets) - 1]
                for lang in set(own):
                    sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    sums[lang] += np.bincount(buckets[(own == lang)[grams]], minlength=BUCKETS)
        for lang, n in sums.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(n[some])],
                                             names=["lang", "bucket", "n"])

    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    return rows.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs, text_col="text", lang_col="lang"):
    """(languages in order, log likelihoods by language and bucket).

    A training table of more than MOST_LANGUAGES languages fails before anything is counted, so that what
    reaches the driver is bounded.
    """
    given = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"))
    if given.distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    found = count_trigrams(docs, text_col, lang_col).toArrow().combine_chunks()
    langs = found.column("lang").dictionary_encode().combine_chunks()
    seen = langs.dictionary.to_pylist() if found.num_rows else []
    names = sorted(seen)
    n = np.zeros((len(names), BUCKETS))
    if found.num_rows:
        row = np.array([names.index(x) for x in seen], np.int64)
        n[row[langs.indices.to_numpy()], found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return names, np.log((n + SMOOTHING) / (n.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)).astype(np.float32)


class Mixture:
    """Words of several documents under several languages. ``logs``: a row of word log likelihoods for each language."""

    def __init__(self, logs, owner):
        """owner: the document of each word, in order; every document here has words."""
        self.logs, self.first = logs, np.flatnonzero(np.diff(owner, prepend=-1))
        self.sizes = np.diff(np.append(self.first, len(owner)))
        self.place = np.repeat(np.arange(len(self.first)), self.sizes)

    def _sum(self, values):
        return np.add.reduceat(values, self.first, axis=-1, dtype=np.float64)

    def single(self):
        return np.stack([self._sum(row) for row in self.logs])

    def fit(self, allowed):
        """(proportions, log likelihood) with the languages ``allowed`` in each document."""
        share = allowed / allowed.sum(axis=0)
        top = self.logs.max(axis=0)
        likely = np.exp(self.logs - top)
        for _ in range(ROUNDS):
            part = likely * share.astype(np.float32)[:, self.place]
            part /= np.maximum(part.sum(axis=0), 1e-30)
            share = np.stack([self._sum(row) for row in part]) / self.sizes
        total = (likely * share.astype(np.float32)[:, self.place]).sum(axis=0)
        return share, self._sum(np.log(np.maximum(total, 1e-30)) + top)

    def take(self, documents):
        keep = np.zeros(len(self.first), bool)
        keep[documents] = True
        words = keep[self.place]
        return Mixture(self.logs[:, words], self.place[words])


def infer(mixture):
    """(proportions, score) of each document, after the choice of its languages.

    A language costs half the logarithm of the number of words. Sets are the
    1, 2, ... languages of the largest proportions. Where one language alone is at
    least as good as the whole mixture's likelihood at the cost of two, no other
    set can be better. Each document stops at the first set that is no better than the one before. The score is the first language's proportion times its odds
    against the next one alone.
    """
    alone = mixture.single()
    n_lang = len(alone)
    order = np.sort(alone, axis=0)
    odds = 1 / (1 + np.exp(np.clip(order[-2] - order[-1], -500, 0))) if n_lang > 1 else np.ones(alone.shape[1])
    best = np.zeros(alone.shape)
    best[alone.argmax(axis=0), np.arange(alone.shape[1])] = 1
    if n_lang == 1:
        return best, odds
    cost = 0.5 * np.log(mixture.sizes + 1.0)
    share, full = mixture.fit(np.ones(alone.shape))
    mixed = np.flatnonzero(full - 2 * cost > order[-1] - cost)
    rank = np.argsort(np.argsort(-share, axis=0, kind="stable"), axis=0)
    worth = order[-1] - cost
    for k in range(2, n_lang + 1):
        if not len(mixed):
            break
        own, value = mixture.take(mixed).fit((rank[:, mixed] < k).astype(float))
        value = value - k * cost[mixed]
        # A document whose set does not gain from the next language is done, whatever the others do.
        better = value > worth[mixed]
        mixed, own, value = mixed[better], own[:, better], value[better]
        best[:, mixed], worth[mixed], odds[mixed] = own, value, 1.0
    return best, odds * best.max(axis=0)


def has_letter(text):
    return any(c.isalpha() for c in text)


def predict(docs, model, text_col="text"):
    """The documents with ``lang_pred``, ``score`` and ``shares`` (language: proportion, of the chosen set).

    A text without a letter, null and empty ones too, is ``und`` with score 0, and so
    is every text under a model without languages. Ties go to the first language in
    order. Rows pass one by one in a map, repeated ones alike. Input columns of
    the three names are replaced.
    """
    names, logs = model
    shared = docs.sparkSession.sparkContext.broadcast(logs)

    def run(batches):
        logs = shared.value
        for batch in batches:
            preds, scores, shares = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), [[]] * batch.num_rows
            column = batch.column(text_col)
            for row, data, offsets in text_slices(column, max(1, 4 * SLICE_BYTES // max(4, len(names)))) if names else ():
                buckets, word_starts, owner = trigrams(data, offsets)
                if not len(owner):
                    continue
                latin = np.bincount(owner, np.add.reduceat(LATIN[data][LETTERS[data] != 0x20].astype(float), word_starts), len(offsets) - 1)
                mixture = Mixture(np.stack([np.add.reduceat(table[buckets], word_starts) for table in logs]), owner)
                best, score = infer(mixture)
                for k, document in enumerate(owner[mixture.first].tolist()):
                    if latin[document] or has_letter(column[row + document].as_py()):
                        preds[row + document] = names[int(best[:, k].argmax())]
                        scores[row + document] = min(1.0, max(0.0, float(score[k])))
                        shares[row + document] = [(names[j], float(best[j, k])) for j in np.flatnonzero(best[:, k] > 0)]
            yield keep_columns(batch, lang_pred=pa.array(preds, pa.string()), score=pa.array(scores),
                               shares=pa.array(shares, pa.map_(pa.string(), pa.float64())))

    docs = docs.drop("lang_pred", "score", "shares")
    schema = with_fields(docs.schema, lang_pred=T.StringType(), score=T.DoubleType(), shares=T.MapType(T.StringType(), T.DoubleType()))
    return docs.mapInArrow(run, schema)
