"""Quality scores from a generalised additive model with pairwise interactions.

Features of a text are counts over its bytes and words, found side by side for
many texts. The model is trained on a bounded sample of labelled rows: rounds of
boosting visit the features in turn, and each visit fits a shallow tree to the
residuals of one feature's bins; then the same for the pairs of features that
explain most of what is left. Summed up, the trees are lookup tables, so a score
is a sum of table entries.
"""

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barworks.llm.common import (
    fresh, LEADING, LOWER, SPACE_BYTES, WordHash, byte_table, held_out, keep_columns, per_text, text_slices, with_fields, word_bounds,
)

#: Labelled rows that a model is trained on, at most: those of smallest hash.
SAMPLE_ROWS = 40_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, LEAVES, LEAST_LEAF = 120, 60, 0.1, 4, 20.0
THRESHOLD = 0.3

UPPER_BYTES = byte_table((0x41, 0x5A))
LETTER_BYTES = byte_table((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
DIGIT_BYTES = byte_table((0x30, 0x39))
PUNCT_BYTES = byte_table((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
STOP_BYTES = byte_table((0x2C, 0x2C), (0x2E, 0x2E))
LINE_BYTES = byte_table((0x0A, 0x0A))

FEATURES = ("log_words", "word_chars", "long_words", "upper", "letters", "digits", "punctuation", "stops", "odd_marks",
            "bare_marks", "repeats", "distinct", "line_words", "top_word")


def _word_counts(owner, hashes, n):
    """Of each text: distinct words, and the count of the most frequent one."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(first)
    runs = np.diff(np.append(at, len(owner)))
    top = np.zeros(n)
    np.maximum.at(top, owner[at], runs)
    return np.bincount(owner[at], minlength=n).astype(float), top


def features(data, offsets, hasher):
    """A row of FEATURES for each text in a byte array."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    of = lambda inside: np.bincount(owner[inside[data]], minlength=n).astype(float)
    chars = np.maximum(of(LEADING), 1)
    starts, ends, word_owner = word_bounds(~SPACE_BYTES[data], offsets)
    words = np.bincount(word_owner, minlength=n).astype(float)
    some = np.maximum(words, 1)
    hashes = hasher(LOWER[data], starts, ends)
    same = np.zeros(len(hashes))
    if len(hashes) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (word_owner[1:] == word_owner[:-1])
    distinct, top = _word_counts(word_owner, hashes, n)
    marks = PUNCT_BYTES & ~STOP_BYTES
    first, last = data[starts], data[ends - 1]
    columns = {
        "log_words": np.log1p(words),
        "word_chars": chars / some,
        "long_words": per_text(ends - starts > 12, word_owner, n) / some,
        "upper": of(UPPER_BYTES) / np.maximum(of(LETTER_BYTES), 1),
        "letters": of(LETTER_BYTES) / np.maximum(np.diff(offsets), 1),
        "digits": of(DIGIT_BYTES) / chars,
        "punctuation": of(PUNCT_BYTES) / some,
        "stops": of(STOP_BYTES) / some,
        "odd_marks": per_text(marks[last], word_owner, n) / some,
        "bare_marks": per_text(marks[first] & (ends - starts == 1), word_owner, n) / some,
        "repeats": per_text(same, word_owner, n) / some,
        "distinct": distinct / some,
        "line_words": words / (of(LINE_BYTES) + 1),
        "top_word": top / some,
    }
    return np.stack([columns[name] for name in FEATURES], axis=1)


def _best_cut(residual, weight, low, high):
    """(gain, cut) of the best two-way cut of bins low..high."""
    r, w = np.cumsum(residual[low:high]), np.cumsum(weight[low:high])
    if len(r) < 2:
        return 0.0, None
    left_w, right_w = w[:-1], w[-1] - w[:-1]
    gain = r[:-1] ** 2 / np.maximum(left_w, 1e-9) + (r[-1] - r[:-1]) ** 2 / np.maximum(right_w, 1e-9) - r[-1] ** 2 / max(w[-1], 1e-9)
    gain = np.where((left_w >= LEAST_LEAF) & (right_w >= LEAST_LEAF), gain, 0)
    k = int(np.argmax(gain))
    return float(gain[k]), low + k + 1


def _shallow_tree(residual, curvature, weight):
    """Values by bin of a tree of at most LEAVES leaves, grown by the best cut."""
    leaves = [(0, len(residual))]
    while len(leaves) < LEAVES:
        gain, cut, leaf = max(((*_best_cut(residual, weight, *leaf), leaf) for leaf in leaves), key=lambda x: x[0])
        if gain <= 1e-9:
            break
        leaves.remove(leaf)
        leaves += [(leaf[0], cut), (cut, leaf[1])]
    out = np.zeros(len(residual))
    for low, high in leaves:
        out[low:high] = residual[low:high].sum() / (curvature[low:high].sum() + 1.0)
    return out


def _pair_tree(residual, curvature, weight):
    """The same over a grid: a cut of one feature, then one of the other on either side."""
    best = (0.0, None)
    for axis in (0, 1):
        r, w = (residual, weight) if axis == 0 else (residual.T, weight.T)
        _, cut = _best_cut(r.sum(axis=1), w.sum(axis=1), 0, r.shape[0])
        for cut in {cut, *range(1, r.shape[0])} - {None}:
            parts, gain = [], 0.0
            for low, high in ((0, cut), (cut, r.shape[0])):
                g, k = _best_cut(r[low:high].sum(axis=0), w[low:high].sum(axis=0), 0, r.shape[1])
                total, mass = r[low:high].sum(), w[low:high].sum()
                gain += g + total ** 2 / max(mass, 1e-9)
                parts.append((low, high, k if g > 0 else None))
            if gain > best[0]:
                best = (gain, (axis, parts))
    out = np.zeros(residual.shape)
    if best[1] is not None:
        axis, parts = best[1]
        r, c, view = (residual, curvature, out) if axis == 0 else (residual.T, curvature.T, out.T)
        for low, high, k in parts:
            for a, b in ((0, r.shape[1]),) if k is None else ((0, k), (k, r.shape[1])):
                view[low:high, a:b] = r[low:high, a:b].sum() / (c[low:high, a:b].sum() + 1.0)
    return out


class AdditiveModel:
    """Bin edges and lookup tables: an intercept, one table a feature, one grid a pair."""

    def fit(self, x, y):
        n, width = x.shape
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if n else np.zeros(0) for f in range(width)]
        self.pair_edges = [e[np.unique(np.linspace(0, len(e) - 1, PAIR_BINS - 1).astype(int))] if len(e) else e for e in self.edges]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs = []
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if n else 0.5
        self.intercept = float(np.log(share / (1 - share)))
        if not n:
            return self
        bins, score = self._bins(x, self.edges), np.full(n, self.intercept)
        counts = [np.bincount(b, minlength=len(t)).astype(float) for b, t in zip(bins, self.tables)]
        for _ in range(ROUNDS):
            for f, table in enumerate(self.tables):
                p = 1 / (1 + np.exp(-score))
                step = RATE * _shallow_tree(np.bincount(bins[f], y - p, len(table)), np.bincount(bins[f], p * (1 - p), len(table)), counts[f])
                table += step
                score += step[bins[f]]
        coarse = self._bins(x, self.pair_edges)
        grids = [(f, g) for f in range(width) for g in range(f)]
        p = 1 / (1 + np.exp(-score))
        explained = [(self._explained(coarse, pair, y - p), pair) for pair in grids]
        chosen = [pair for gain, pair in sorted(explained, reverse=True)[:PAIRS] if gain > 0]
        self.pairs = [(f, g, np.zeros((len(self.pair_edges[f]) + 1, len(self.pair_edges[g]) + 1))) for f, g in chosen]
        for _ in range(PAIR_ROUNDS):
            for f, g, grid in self.pairs:
                p = 1 / (1 + np.exp(-score))
                cell = coarse[f] * grid.shape[1] + coarse[g]
                sums = [np.bincount(cell, w, grid.size).reshape(grid.shape) for w in (y - p, p * (1 - p), np.ones(n))]
                step = RATE * _pair_tree(*sums)
                grid += step
                score += step.ravel()[cell]
        return self

    def _explained(self, coarse, pair, residual):
        f, g = pair
        width = len(self.pair_edges[g]) + 1
        cell = coarse[f] * width + coarse[g]
        size = (len(self.pair_edges[f]) + 1) * width
        total, mass = np.bincount(cell, residual, size), np.bincount(cell, minlength=size)
        return float((total ** 2 / np.maximum(mass, LEAST_LEAF)).sum())

    @staticmethod
    def _bins(x, edges):
        return [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]

    def score(self, x):
        bins, coarse = self._bins(x, self.edges), self._bins(x, self.pair_edges)
        total = np.full(len(x), self.intercept)
        for table, b in zip(self.tables, bins):
            total += table[b]
        for f, g, grid in self.pairs:
            total += grid[coarse[f], coarse[g]]
        return 1 / (1 + np.exp(-total))

    def to_json(self):
        return json.dumps({
            "features": FEATURES, "intercept": self.intercept, "edges": [e.tolist() for e in self.edges],
            "pair_edges": [e.tolist() for e in self.pair_edges], "tables": [t.tolist() for t in self.tables],
            "pairs": [(f, g, grid.tolist()) for f, g, grid in self.pairs]})

    @classmethod
    def from_json(cls, text):
        d, out = json.loads(text), cls()
        out.intercept = d["intercept"]
        out.edges, out.pair_edges, out.tables = ([np.array(x) for x in d[k]] for k in ("edges", "pair_edges", "tables"))
        out.pairs = [(f, g, np.array(grid)) for f, g, grid in d["pairs"]]
        return out


def train(docs, labels, id_col="doc_id", text_col="text", label_col="quality", sample_rows=SAMPLE_ROWS):
    """A model from at most ``sample_rows`` labelled documents that are not held out.

    Only the ids of the sample are broadcast, and only its features reach the driver:
    both are bounded by ``sample_rows``. A document's label is the mean of its rows in
    ``labels``; null labels and ids are left out. Without labelled rows the model
    says 0.5 everywhere.
    """
    own = labels.select(F.col(id_col).alias("labelled"), F.col(label_col).cast("double").alias("label")).filter(
        F.col("labelled").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("labelled")))
    sample = (own.groupBy("labelled").agg(F.avg("label").alias("label"))
              .orderBy(F.xxhash64("labelled"), "labelled").limit(sample_rows))
    rows = docs.select(F.col(id_col).alias("labelled"), F.col(text_col).alias("text")).join(F.broadcast(sample), "labelled")

    def extract(batches):
        hasher = WordHash()
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(0)):
                x = features(data, offsets, hasher)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(row, len(x)), *(pa.array(x[:, f]) for f in range(x.shape[1]))], names=["label", *FEATURES])

    schema = T.StructType([T.StructField(name, T.DoubleType()) for name in ("label", *FEATURES)])
    seen = rows.select("text", "label").mapInArrow(extract, schema).toArrow()
    x = np.stack([seen.column(name).to_numpy() for name in FEATURES], axis=1)
    y = seen.column("label").to_numpy()
    order = np.lexsort((*x.T, y))
    return AdditiveModel().fit(x[order], y[order])


def score(docs, model, text_col="text", score_col="score"):
    """The documents with ``score_col``: how likely label 1 is, 0 to 1.

    Null and empty texts have a score like any other: that of no words. Rows pass one by
    one in a map; equal texts have equal scores. An input column of that name is replaced.
    """
    text = model.to_json()

    def run(batches):
        model, hasher = AdditiveModel.from_json(text), WordHash()
        for batch in batches:
            found = [model.score(features(data, offsets, hasher)) for _, data, offsets in text_slices(batch.column(text_col))]
            yield keep_columns(batch, **{score_col: pa.array(np.concatenate([np.zeros(0), *found]))})

    docs = docs.drop(score_col)
    return docs.mapInArrow(run, with_fields(docs.schema, **{score_col: T.DoubleType()}))


def reject_low_quality(docs, labels, threshold=THRESHOLD, **options):
    """The documents scored ``threshold`` or more, with all their columns."""
    names, own = docs.columns, fresh("quality")
    return score(docs, train(docs, labels, **options), options.get("text_col", "text"), own).filter(
        F.col(own) >= threshold).select(*names)
