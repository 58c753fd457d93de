"""Byte-pair encoding and decoding with a public vocabulary file.

A word's adjacent pairs are the leaves of a segment tree of (rank, place): its
root is the leftmost pair of lowest rank. A merge rewrites three leaves and
their ancestors, until the root holds no pair. Trees of one size are arrays, and
all distinct new words of a slice of texts are merged side by side.

The vocabulary (of fixed size) is read once by the driver and broadcast; texts
pass in a map without a shuffle.
"""

import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import types as T

from barworks.llm.common import SLICE_BYTES, keep_columns, with_fields

NO_PAIR = np.iinfo(np.int32).max
#: Words of more symbols than this are merged one by one, not side by side.
WIDE = 64
CACHED_WORDS = 200_000
#: Code points with the property White_Space.
SPACE = regex.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: Spaces for str.split() that have no such property.
ODD_SPACE = regex.compile("[\x1c-\x1f]")


def byte_characters():
    """The printable stand-in of each byte: itself where it is printable Latin-1, else the next from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens and ranked merges of a word-level BPE file in the tokenizers library's JSON form."""

    def __init__(self, text):
        file = json.loads(text)
        model, self.suffix = file["model"], file["model"]["end_of_word_suffix"] or ""
        self.ids = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        everything = {**self.ids, **self.special}
        self.tokens = [""] * (max(everything.values()) + 1)
        for token, i in everything.items():
            self.tokens[i] = token
        self.size = len(self.tokens)
        code = np.array([self.ids[a] * self.size + self.ids[b] for a, b in merges], np.int64)
        order = np.argsort(code)
        self.codes, self.ranks = code[order], order.astype(np.int32)
        self.merged = np.array([self.ids[a + b] for a, b in merges], np.int32)[order]
        self.pairs = {int(c): (int(r), int(m)) for c, r, m in zip(self.codes, self.ranks, self.merged)}
        self.plain = np.array([self.ids[c] for c in byte_characters()], np.int32)
        self.last = np.array([self.ids[c + self.suffix] for c in byte_characters()], np.int32)
        split = next(p for p in file["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def words(self, chunks):
        """The pieces of each stretch of text without white space: ids of special tokens, or words."""
        marked = {k for k, c in enumerate(chunks) if self.marks is not None and self.marks.search(c)} if self._may_mark(chunks) else ()
        # A line break changes nothing around it: normal forms and matches end there anyway.
        plain = self._normal("\n".join("" if k in marked else c for k, c in enumerate(chunks))).split("\n")
        out = [[c] if c.isalpha() else self.pattern.findall(c) for c in plain]
        for k in marked:
            at, own = 0, []
            for mark in self.marks.finditer(chunks[k]):
                own += [*self.pattern.findall(self._normal(chunks[k][at:mark.start()])), self.special[mark[0]]]
                at = mark.end()
            out[k] = own + self.pattern.findall(self._normal(chunks[k][at:]))
        return out

    def _may_mark(self, chunks):
        text = "\n".join(chunks)
        return any(mark in text for mark in self.special)

    @staticmethod
    def _normal(text):
        # Lower case letter by letter: a capital sigma is the same at the end of a word as elsewhere.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def symbols(self, word):
        data = np.frombuffer(word, np.uint8)
        out = self.plain[data]
        out[-1] = self.last[data[-1]]
        return out

    def look_up(self, left, right):
        """(rank, merged id) of pairs, NO_PAIR where there is none."""
        code = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        known = (self.codes[at] == code) & (left >= 0) & (right >= 0)
        return np.where(known, self.ranks[at], NO_PAIR), self.merged[at]

    def merge_word(self, symbols):
        """One word of any length: the same tree in plain lists."""
        ids = symbols.tolist()
        n = len(ids)
        width = 1 << max(0, n - 1).bit_length()
        none = (NO_PAIR, 0)
        tree = [none] * (2 * width)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def leaf(i):
            if i < 0 or after[i] >= n:
                return none
            pair = self.pairs.get(ids[i] * self.size + ids[after[i]])
            return (pair[0], i) if pair else none

        def update(i, value):
            at = width + i
            tree[at] = value
            while at > 1:
                at >>= 1
                tree[at] = min(tree[2 * at], tree[2 * at + 1])

        for i in range(n):
            tree[width + i] = leaf(i)
        for at in range(width - 1, 0, -1):
            tree[at] = min(tree[2 * at], tree[2 * at + 1])
        alive = [True] * n
        while tree[1][0] != NO_PAIR:
            i = tree[1][1]
            j = after[i]
            ids[i] = self.pairs[ids[i] * self.size + ids[j]][1]
            alive[j], after[i] = False, after[j]
            if after[i] < n:
                before[after[i]] = i
            update(j, none)
            update(i, leaf(i))
            if before[i] >= 0:
                update(before[i], leaf(before[i]))
        return [x for x, on in zip(ids, alive) if on]

    def merge_words(self, words):
        """(ids of all words (UTF-8 bytes), number of ids of each); words of similar length share the arrays."""
        counts, parts, by_width = np.zeros(len(words), np.int64), [], {}
        for k, word in enumerate(words):
            by_width.setdefault(max(2, 1 << (len(word) - 1).bit_length()), []).append(k)
        for width, own in by_width.items():
            for at in range(0, len(own), 1 << 15):
                part = np.array(own[at:at + (1 << 15)])
                if width > WIDE:
                    merged = [self.merge_word(self.symbols(words[k])) for k in part]
                    ids, counts[part] = np.array([i for m in merged for i in m], np.uint32), [len(m) for m in merged]
                else:
                    ids, counts[part] = self._merge_side_by_side([words[k] for k in part], width)
                parts.append((part, ids))
        starts = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.uint32)
        for part, ids in parts:
            out[stretches(starts[part], counts[part])] = ids
        return out, counts

    def _merge_side_by_side(self, words, width):
        n = len(words)
        lengths = np.array([len(w) for w in words])
        ids = np.full((n, width + 1), -1, np.int32)
        inside = np.arange(width) < lengths[:, None]
        ids[:, :width][inside] = self.plain[np.frombuffer(b"".join(words), np.uint8)]
        rows = np.arange(n)
        ids[rows, lengths - 1] = self.last[[w[-1] for w in words]]
        after = np.minimum(np.arange(1, width + 1), lengths[:, None])
        after = np.where(after < lengths[:, None], after, width)
        before = np.tile(np.arange(-1, width - 1), (n, 1))
        tree = np.full((n, 2 * width), NO_PAIR, np.int32)
        result = np.zeros((n, 2 * width), np.int32)

        def leaf(r, i):
            rank, merged = self.look_up(ids[r, i], ids[r, after[r, i]])
            result[r, width + i] = merged
            return np.where(rank == NO_PAIR, NO_PAIR, rank * width + i)

        def update(r, i, value):
            at = width + i
            tree[r, at] = value
            while at[0] > 1:
                at = at >> 1
                tree[r, at] = np.minimum(tree[r, 2 * at], tree[r, 2 * at + 1])

        r, i = np.nonzero(inside)
        tree[r, width + i] = leaf(r, i)
        level = width
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level = half
        while len(rows := rows[tree[rows, 1] != NO_PAIR]):
            i = tree[rows, 1] % width
            j = after[rows, i]
            ids[rows, i] = result[rows, width + i]
            ids[rows, j] = -1
            k = after[rows, j]
            after[rows, i] = k
            on = k < width
            before[rows[on], k[on]] = i[on]
            update(rows, j, np.full(len(rows), NO_PAIR))
            update(rows, i, leaf(rows, i))
            b = before[rows, i]
            on = b >= 0
            if on.any():
                update(rows[on], b[on], leaf(rows[on], b[on]))
        kept = ids[:, :width] >= 0
        return ids[:, :width][kept].astype(np.uint32), kept.sum(axis=1)


def stretches(starts, sizes):
    """The places of stretches, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Lists:
    """Lists of ids by key, in one array."""

    def __init__(self):
        self.places, self.flat, self.sizes, self.starts = {}, np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys, flat, sizes):
        self.places.update(zip(keys, range(len(self.places), len(self.places) + len(keys))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.flat, self.sizes = np.concatenate([self.flat, flat]), np.concatenate([self.sizes, sizes])

    def get(self, keys):
        """(ids of all keys, number of ids of each)."""
        at = np.fromiter(map(self.places.__getitem__, keys), np.int64)
        sizes = self.sizes[at]
        return self.flat[stretches(self.starts[at], sizes)], sizes


class Encoder:
    """Texts to ids; remembers words, and stretches between white space, up to CACHED_WORDS of each and those of one slice."""

    def __init__(self, vocabulary):
        self.vocabulary = vocabulary
        self.words, self.chunks = Lists(), Lists()

    def _learn(self, chunks):
        pieces = self.vocabulary.words(chunks)
        new = list({w for own in pieces for w in own} - self.words.places.keys())
        special = [w for w in new if isinstance(w, int)]
        if special:
            self.words.add(special, np.array(special, np.uint32), np.ones(len(special), np.int64))
            new = [w for w in new if not isinstance(w, int)]
        self.words.add(new, *self.vocabulary.merge_words([w.encode() for w in new]))
        ids, sizes = self.words.get(w for own in pieces for w in own)
        counts = np.fromiter(map(len, pieces), np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)]
        self.chunks.add(chunks, ids, np.diff(ends, prepend=0))

    def encode(self, texts):
        """Arrays of ids, one for each text."""
        if len(self.words.places) > CACHED_WORDS:
            self.words = Lists()
        if len(self.chunks.places) > CACHED_WORDS:
            self.chunks = Lists()
        split = [[c for c in SPACE.split(t) if c] if ODD_SPACE.search(t) else t.split() for t in texts]
        new = list(set().union(*split).difference(self.chunks.places))
        if new:
            self._learn(new)
        ids, sizes = self.chunks.get(c for own in split for c in own)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([len(own) for own in split])] if split else []
        return np.split(ids, ends[:-1])


def load(spark, path):
    """The vocabulary file's text, broadcast."""
    return spark.sparkContext.broadcast(spark.sparkContext.wholeTextFiles(path).values().first() if "://" in path else open(path, encoding="utf-8").read())


def _slices(sizes):
    start = total = 0
    for k, size in enumerate(sizes):
        if total and total + size > SLICE_BYTES:
            yield start, k
            start, total = k, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def encode(docs, path, text_col="text"):
    """The documents with ``ids`` (32-bit little-endian ids, packed in a binary) and ``n_tokens``.

    Special tokens written out in a text become their ids; none is added. Null and
    empty texts have no tokens. Texts of any length are encoded whole. Rows pass
    one by one, so repeated ones are encoded alike. Input columns named ``ids`` or
    ``n_tokens`` are replaced.
    """
    shared = load(docs.sparkSession, path)

    def run(batches):
        encoder = Encoder(Vocabulary(shared.value))
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            if not texts:
                yield keep_columns(batch, ids=pa.array([], pa.binary()), n_tokens=pa.array([], pa.int64()))
            for a, b in _slices([len(t) for t in texts]):
                ids = encoder.encode(texts[a:b])
                yield keep_columns(batch.slice(a, b - a), ids=pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                                   n_tokens=pa.array([len(x) for x in ids], pa.int64()))

    docs = docs.drop("ids", "n_tokens")
    return docs.mapInArrow(run, with_fields(docs.schema, ids=T.BinaryType(), n_tokens=T.LongType()))


def decode(rows, path, ids_col="ids", out_col="decoded"):
    """The rows with ``out_col``: the tokens of the packed ids, special ones too, joined by spaces.

    (The files served have no decoder of their own, which leaves exactly that.) Null
    ids give an empty text; ids outside the vocabulary give nothing.
    """
    shared = load(rows.sparkSession, path)

    def run(batches):
        tokens = dict(enumerate(Vocabulary(shared.value).tokens))
        for batch in batches:
            packed = [x or b"" for x in batch.column(ids_col).to_pylist()]
            if not packed:
                yield keep_columns(batch, **{out_col: pa.array([], pa.string())})
            for a, b in _slices([len(x) for x in packed]):
                texts = []
                for x in packed[a:b]:
                    ids = np.frombuffer(x, "<u4").tolist()
                    try:
                        texts.append(" ".join([tokens[i] for i in ids]))
                    except KeyError:
                        texts.append(" ".join([tokens[i] for i in ids if i in tokens]))
                yield keep_columns(batch.slice(a, b - a), **{out_col: pa.array(texts, pa.string())})

    rows = rows.drop(out_col)
    return rows.mapInArrow(run, with_fields(rows.schema, **{out_col: T.StringType()}))
