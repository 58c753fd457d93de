"""Shared helpers: documents as Arrow batches, and words found on byte arrays."""

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 2_000_000


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name):
    """A column name that no input column can have."""
    return f"__{name}_{uuid.uuid4().hex[:12]}"


def held_out(doc_id):
    """True for the documents no model may learn from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def text_slices(column, limit=SLICE_BYTES):
    """(first row, bytes, offsets) of consecutive rows of a string column.

    The bytes are those of the Arrow buffer, nulls count as empty, and a slice
    holds about ``limit`` bytes, or one text if that is longer.
    """
    column = column.fill_null("") if column.null_count else column
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    if len(column) == 0:
        return
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + limit, side="right")) - 1)
        stop = min(stop, len(column))
        yield row, raw[ends[row]:ends[stop]], ends[row:stop + 1] - ends[row]
        row = stop


def byte_table(*ranges):
    """A table over the 256 bytes: True inside the ranges."""
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low:high + 1] = True
    return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: A text byte that starts a code point.
LEADING = ~byte_table((0x80, 0xBF))
SPACE_BYTES = byte_table((0x09, 0x0D), (0x20, 0x20))
#: Bytes of words of letters and digits; every byte of a non-ASCII character counts.
WORD_BYTES = byte_table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def word_bounds(inside, offsets):
    """Starts, ends and documents of the runs of True bytes; no run crosses a text's end."""
    edge = np.zeros(len(inside) + 1, np.int8)
    edge[:-1] = inside
    edge[1:] -= inside
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(inside))])
    cuts = cuts[inside[cuts] & inside[cuts - 1]]
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


class WordHash:
    """64-bit polynomial hashes of byte ranges, through prefix sums modulo 2^64."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def _grow(self, n):
        if n > len(self.up):
            self.up = np.cumprod(np.full(n, self.BASE, np.uint64))
            self.down = np.cumprod(np.full(n, pow(self.BASE, -1, 1 << 64), np.uint64))

    def __call__(self, data, starts, ends):
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * self.down[starts]
        return h ^ (h >> np.uint64(29))


def per_text(values, documents, n):
    """Sums of values by document."""
    return np.bincount(documents, weights=values, minlength=n)


def keep_columns(batch, **new):
    """The batch with columns replaced or appended."""
    columns = dict(zip(batch.schema.names, batch.columns))
    columns.update(new)
    return pa.RecordBatch.from_arrays([pa.array(v) if not isinstance(v, pa.Array) else v for v in columns.values()],
                                      names=list(columns))


def with_fields(schema, **types):
    """The schema with fields appended, or replaced where the name is there."""
    kept = [f for f in schema.fields if f.name not in types]
    return T.StructType(kept + [T.StructField(name, kind) for name, kind in types.items()])
