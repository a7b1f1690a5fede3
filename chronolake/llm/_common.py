"""Helpers shared by the training-data operators: samples, Arrow text buffers, word hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A batch of texts is worked on in slices of about this many bytes, so a task's memory follows the slice, not the batch.
SLICE_BYTES = 1 << 20

#: Groups whose counts are broadcast, at most.
FEW = 10_000

def whole_rows(df: DataFrame) -> DataFrame:
    """Each row as one column ``row``, so that no name of it can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % n


def smallest_hashes(df: DataFrame, key: Column, n: int, by: str | None = None) -> DataFrame:
    """At most ``n`` rows of each ``by`` (of all, without it): those with the smallest hash of ``key``.

    Rows are counted first and only hashes in a range that holds about 4 n rows are ranked, so what is sorted
    does not grow with the table. Few rows are all kept.
    """
    rows = df.withColumn("_hash", F.xxhash64(key))
    share = F.pmod("_hash", F.lit(1 << 32)) / F.lit(float(1 << 32))
    if by is None:
        near, own = rows.where(share * df.count() < 4 * n + 100), Window.partitionBy(F.lit(0))
    else:
        counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_rows"))
        if counts.limit(FEW + 1).count() <= FEW:  # else both sides are shuffled
            counts = F.broadcast(counts)
        near, own = rows.join(counts, by).where(share * F.col("_rows") < 4 * n + 100), Window.partitionBy(by)
    ranked = near.withColumn("_k", F.row_number().over(own.orderBy(share, "_hash", key)))
    return ranked.where(F.col("_k") <= n).select(*df.columns)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (length rows + 1) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose text takes about ``limit`` bytes; one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes.astype(np.int64)), 0
        while at < batch.num_rows:
            base = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for lo, hi in ranges:
        out[lo : hi + 1] = True
    return out


#: Bytes of words of digits, lower-case letters and everything beyond ASCII.
ALNUM = _table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: Bytes of words that white space separates.
NONSPACE = ~_table((0x09, 0x0D), (0x20, 0x20))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def runs_of(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end (exclusive) of each run of places that are ``inside``, and the row it is in. Runs never cross rows."""
    n = len(inside)
    if n == 0:
        return (np.zeros(0, np.int64),) * 3
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    before[cuts], after[cuts - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def words_of(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end (exclusive) byte of each word, and the row it is in. Words never cross rows."""
    return runs_of(table[data], offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each word; equal words have equal hashes, users verify the rest."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    power = np.cumprod(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
    value = (data[place + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)) * power[place]
    return mix(np.add.reduceat(value, first))


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def hash_windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, by its first word; rows are not looked at."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n]
    return mix(out)
