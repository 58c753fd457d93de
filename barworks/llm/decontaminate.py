"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton of all test items reads a document's words and tracks the longest
suffix of what it has read that occurs in an item. A word is hit when it lies in
a whole window of an item. Documents pass in a map without a shuffle. Only runs of
words whose neighbours stand side by side in some item reach the automaton; every
match of two words or more lies in such a run, so nothing is missed.
"""

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barworks.llm.common import LOWER, WORD_BYTES, WordHash, fresh, keep_columns, text_slices, with_fields, word_bounds
from barworks.session import scratch_path, write_and_reread

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 10
#: Bytes of item texts in one automaton, and so the bound of what is broadcast.
BLOCK_BYTES = 1 << 20


def words_of(text):
    """The lower-cased words of a UTF-8 text."""
    return WORD.findall(text.lower())


class SuffixAutomaton:
    """States with their longest length, suffix link and moves, over all items.

    ``add`` starts at the root for each item, so no match runs across two of them.
    """

    def __init__(self):
        self.moves, self.link, self.length = [{}], [-1], [0]

    def _state(self, length, moves, link):
        self.moves.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.moves) - 1

    def _split(self, parent, symbol, child):
        """A copy of ``child`` for the suffixes that end as long as parent + 1."""
        twin = self._state(self.length[parent] + 1, dict(self.moves[child]), self.link[child])
        self.link[child] = twin
        while parent >= 0 and self.moves[parent].get(symbol) == child:
            self.moves[parent][symbol] = twin
            parent = self.link[parent]
        return twin

    def add(self, symbols):
        last = 0
        for symbol in symbols:
            child = self.moves[last].get(symbol)
            if child is not None:
                last = child if self.length[child] == self.length[last] + 1 else self._split(last, symbol, child)
                continue
            new, parent = self._state(self.length[last] + 1, {}, 0), last
            while parent >= 0 and symbol not in self.moves[parent]:
                self.moves[parent][symbol] = new
                parent = self.link[parent]
            if parent >= 0:
                child = self.moves[parent][symbol]
                fits = self.length[child] == self.length[parent] + 1
                self.link[new] = child if fits else self._split(parent, symbol, child)
            last = new

    def read(self, symbols):
        """(state, match length) after each symbol."""
        state = length = 0
        for symbol in symbols:
            while state and symbol not in self.moves[state]:
                state = self.link[state]
                length = self.length[state]
            if symbol in self.moves[state]:
                state, length = self.moves[state][symbol], length + 1
            yield state, length

    def cut(self, state, length):
        """The state of the last ``length`` symbols of a match."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state


class Benchmark:
    """Windows of items, found in documents. ``items``: (position in the list, bytes of the text)."""

    def __init__(self, items, window=WINDOW):
        self.vocabulary, texts = {}, []
        for number, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if ids:
                texts.append((number, ids))
        self.automaton = SuffixAutomaton()
        for _, ids in texts:
            self.automaton.add(ids)
        self.windows = {}
        for number, ids in texts:
            size = min(window, len(ids))
            for end, (state, length) in enumerate(self.automaton.read(ids), 1):
                if end >= size:
                    own = self.windows.setdefault((self.automaton.cut(state, size), size), set())
                    own.add(number)
        self.window, self.sizes = window, sorted({size for _, size in self.windows})
        pairs = {(a << 32) | b for _, ids in texts for a, b in zip(ids, ids[1:])}
        self.pairs = np.sort(np.fromiter(pairs, np.int64, len(pairs)))
        words = list(self.vocabulary)
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        self.hasher = WordHash()
        hashes = self.hasher(data, ends - [len(w) for w in words], ends) if words else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.hash_ids = hashes[order], order
        self.listed = np.zeros(1 << 16, bool)
        self.listed[(hashes & np.uint64(0xFFFF)).astype(np.int64)] = True

    def _ids(self, hashes):
        out = np.full(len(hashes), -1, np.int64)
        if len(self.hashes):
            maybe = np.flatnonzero(self.listed[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
            sure = self.hashes[at] == hashes[maybe]
            out[maybe[sure]] = self.hash_ids[at[sure]]
        return out

    def _known(self, left, right):
        out = (left >= 0) & (right >= 0)
        both = np.flatnonzero(out)
        if len(both) and len(self.pairs):
            code = (left[both] << 32) | right[both]
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            out[both] = self.pairs[at] == code
        else:
            out[both] = False
        return out

    def scan(self, data, offsets):
        """Of texts in one byte array: words of each, then {text: (hit spans in bytes and whether they hold a whole short item, hit words, items)}."""
        data = LOWER[data]
        starts, ends, owner = word_bounds(WORD_BYTES[data], offsets)
        n_words = np.bincount(owner, minlength=len(offsets) - 1)
        found = {}
        if not self.sizes or not len(starts):
            return n_words, found
        ids = self._ids(self.hasher(data, starts, ends))
        joined = np.zeros(len(ids) + 1, bool)
        joined[1:-1] = self._known(ids[:-1], ids[1:]) & (owner[1:] == owner[:-1])
        first = np.flatnonzero((ids >= 0) & ~joined[:-1])
        last = np.flatnonzero((ids >= 0) & ~joined[1:])
        long = last - first + 1 >= self.sizes[0]
        for a, b in zip(first[long].tolist(), last[long].tolist()):
            run = [self.vocabulary.get(data[s:e].tobytes(), -1) for s, e in zip(starts[a:b + 1], ends[a:b + 1])]
            hit, items = self._run(run)
            if items:
                spans, count, own = found.setdefault(int(owner[a]), ([], [0], set()))
                count[0] += sum(y - x for x, y, _ in hit)
                spans += [(int(starts[a + x] - offsets[owner[a]]), int(ends[a + y - 1] - offsets[owner[a]]), whole) for x, y, whole in hit]
                own |= items
        return n_words, {k: (spans, count[0], own) for k, (spans, count, own) in found.items()}

    def _run(self, run):
        spans, items = [], set()
        for end, (state, length) in enumerate(self.automaton.read(run), 1):
            for size in self.sizes:
                if size > length:
                    break
                own = self.windows.get((self.automaton.cut(state, size), size))
                if own:
                    items |= own
                    start, whole = end - size, size < self.window
                    while spans and spans[-1][1] >= start:
                        before, _, had = spans.pop()
                        start, whole = min(start, before), whole or had
                    spans.append((start, end, whole))
        return spans, items


FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()),
                                                     T.StructField("whole", T.BooleanType())]))),
    T.StructField("items", T.ArrayType(T.LongType()))])


def _blocks(benchmark, item_col, text_col, block_bytes):
    """(number of blocks, the blocks one by one): lists of (ids, text) of about ``block_bytes`` of text each.

    Copies of an item text are one entry with the ids of all of them, so they don't add up in one block.
    """
    rows = benchmark.select(F.col(item_col).cast("bigint").alias("item"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    rows = rows.groupBy("text").agg(F.collect_set("item").alias("ids"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("text"), F.lit(n))
    return n, ([(r.ids, r.text.encode()) for r in rows.filter(part == k).toLocalIterator()] for k in range(n))


def _union(spans):
    out = []
    for start, stop, whole in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1:] = max(out[-1][1], stop), out[-1][2] or whole
        else:
            out.append([start, stop, whole])
    return out


def find_contamination(docs, benchmark, text_col="text", item_col="item_id", item_text_col="text",
                       window=WINDOW, block_bytes=BLOCK_BYTES):
    """The documents with ``n_words``, ``n_hit``, ``spans`` (hit words, in UTF-8 bytes, end exclusive; ``whole``
    where one holds all of an item shorter than a window) and ``items``.

    A window is ``window`` consecutive words of an item, or all words of a
    shorter one. A benchmark of more than ``block_bytes`` is searched for in
    blocks, one pass over the documents each, written between passes; spans and
    items of earlier passes ride along in the row.

    Null and wordless texts have no words and no hits; items without words or with
    a null text have no windows; an empty benchmark hits nothing. Items with a
    null id hit words but have no id to list. Rows may repeat. Columns with the names added
    are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop(*FOUND.names)
    names = docs.columns
    schema = with_fields(docs.schema, **{f.name: f.dataType for f in FOUND.fields})
    _, blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    out = docs
    for number, block in enumerate(blocks):
        if number:
            out = write_and_reread(out, scratch_path(spark, "contamination"))
        out = out.mapInArrow(_pass(spark.sparkContext.broadcast(block), window, text_col, number), schema)
    return out.select(*names, *FOUND.names)


def _pass(shared, window, text_col, number):
    def scan(batches):
        block = shared.value
        bench = Benchmark(list(enumerate(text for _, text in block)), window)
        for batch in batches:
            words, found = np.zeros(batch.num_rows, np.int64), {}
            for row, data, offsets in text_slices(batch.column(text_col)):
                n, hits = bench.scan(data, offsets)
                words[row:row + len(n)] = n
                found.update({row + k: v for k, v in hits.items()})
            spans = [[list(x) for x in found[k][0]] if k in found else [] for k in range(batch.num_rows)]
            items = [[own for i in found[k][2] for own in block[i][0]] if k in found else [] for k in range(batch.num_rows)]
            hits = [found[k][1] if k in found else 0 for k in range(batch.num_rows)]
            if number:
                texts = batch.column(text_col).cast(pa.binary())
                for k, (old, old_items) in enumerate(zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())):
                    if old and k in found:
                        spans[k] = _union([(s["start"], s["stop"], s["whole"]) for s in old] + spans[k])
                        text = texts[k].as_py()
                        hits[k] = sum(len(words_of(text[a:b])) for a, b, _ in spans[k])
                    elif old:
                        spans[k] = [(s["start"], s["stop"], s["whole"]) for s in old]
                        hits[k] = batch.column("n_hit")[k].as_py()
                    items[k] = items[k] + old_items
            pair = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("whole", pa.bool_())]))
            yield keep_columns(
                batch, n_words=pa.array(words), n_hit=pa.array(hits, pa.int64()),
                spans=pa.array([[{"start": a, "stop": b, "whole": whole} for a, b, whole in own] for own in spans], pair),
                items=pa.array([sorted(set(own)) for own in items], pa.list_(pa.int64())))
    return scan


def decontaminate(docs, benchmark, text_col="text", max_coverage=0.5, max_length=WINDOW, **options):
    """The documents without test passages, with all their input columns.

    Spans of ``max_length`` words or more are cut out of a text, and so are those that
    hold the whole of an item shorter than a window. A document of
    whose words more than ``max_coverage`` are hit goes as a whole. What a cut
    joins is searched again until nothing is to be cut, so no such passage is left.

    A span of several short windows counts with all its words. Texts without hits,
    null and empty ones stay as they are.
    """
    names, spark = docs.columns, docs.sparkSession
    n, blocks = _blocks(benchmark, options.get("item_col", "item_id"), options.get("item_text_col", "text"),
                        options.get("block_bytes", BLOCK_BYTES))
    if n > 1:
        return _decontaminate_blocks(docs, benchmark, text_col, max_coverage, max_length, options)
    shared = spark.sparkContext.broadcast(next(blocks))

    def clean(batches):
        bench = Benchmark(list(enumerate(text for _, text in shared.value)), options.get("window", WINDOW))
        for batch in batches:
            changed, gone = {}, set()
            for row, data, offsets in text_slices(batch.column(text_col)):
                n_words, found = bench.scan(data, offsets)
                for k, (spans, n_hit, _) in found.items():
                    if n_hit > max_coverage * n_words[k]:
                        gone.add(row + k)
                        continue
                    text = data[offsets[k]:offsets[k + 1]].tobytes()
                    while cut := _long(text, spans, max_length):
                        text = _without(text, cut)
                        again = bench.scan(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[1]
                        spans = again[0][0] if again else []
                    changed[row + k] = text.decode()
            if changed:
                texts = batch.column(text_col).to_pylist()
                for k, text in changed.items():
                    texts[k] = text
                batch = keep_columns(batch, **{text_col: pa.array(texts, pa.string())})
            if gone:
                batch = batch.filter(pa.array([k not in gone for k in range(batch.num_rows)]))
            yield batch.select(names)

    return docs.mapInArrow(clean, docs.schema)


def _long(text, spans, max_length):
    return [(a, b) for a, b, whole in _union(spans) if whole or len(words_of(text[a:b])) >= max_length]


def _without(text, spans):
    kept, at = [], 0
    for start, stop in spans:
        kept.append(text[at:start])
        at = stop
    return b"".join([*kept, text[at:]])


def _decontaminate_blocks(docs, benchmark, text_col, max_coverage, max_length, options):
    """For a benchmark of several automata: passes of search and cut, each over the documents the last one changed."""
    names, first, changed, settled = docs.columns, True, fresh("changed"), []
    while True:
        found = find_contamination(docs, benchmark, text_col, **options)
        if first:
            found = found.filter(~(F.col("n_hit") > max_coverage * F.col("n_words")))

        def cut(batches):
            for batch in batches:
                texts, flags = batch.column(text_col).to_pylist(), []
                for k, spans in enumerate(batch.column("spans").to_pylist()):
                    text = (texts[k] or "").encode()
                    long = _long(text, [(s["start"], s["stop"], s["whole"]) for s in spans], max_length)
                    if long:
                        texts[k] = _without(text, long).decode()
                    flags.append(bool(long))
                yield keep_columns(batch.select(names), **{text_col: pa.array(texts, pa.string()), changed: pa.array(flags)})

        schema = with_fields(docs.select(*names).schema, **{changed: T.BooleanType()})
        done = write_and_reread(found.mapInArrow(cut, schema), scratch_path(docs.sparkSession, "decontaminate"))
        settled.append(done.filter(~F.col(changed)).drop(changed))
        docs, first = done.filter(changed).drop(changed), False
        if docs.isEmpty():
            return reduce(DataFrame.union, settled)
