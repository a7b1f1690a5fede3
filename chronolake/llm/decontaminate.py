"""Benchmark decontamination by a broadcast hash set of normalised word windows.

Words are runs of digits, a-z and characters beyond ASCII, after A-Z are lower-cased. A window is
``size`` consecutive words of a benchmark item; an item of fewer words, but not none, is one window.
The windows' hashes are broadcast, every task hashes the windows of its documents, looks them up and
verifies each hit on the words themselves.

The benchmark is not trusted to be small: its windows are computed once, weighed, and dealt into blocks of
about ``block_bytes`` by hash of window and item, so a window of very many items is dealt as well. One block is the usual case: documents are judged, dropped or cut
in the scan itself, and nothing is shuffled. With more, each block is broadcast in a scan of its own, whose
hits are written before the next one takes its place; then the hits of a document are merged by one shuffle of
hit ranges and items. No window is ever dropped.

Defined cases: a null or empty text has no words and is clean; a null item id counts as the empty id;
repeated documents are judged one by one, repeated items count once; an empty benchmark leaves every
document clean; very long texts are scanned whole; an empty table gives an empty result; other columns are
ignored, and kept where documents are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._spark import checkpoint, ship, written
from ._common import ALNUM, LOWER, hash_windows, hash_words, sliced, text_buffer, whole_rows, words_of

SIZE = 13
#: Bytes of window texts and item ids in one broadcast.
BLOCK_BYTES = 64 << 20
#: A document is contaminated if 1 in so many words is hit.
SHARE = 20


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """(window, item): each distinct window, its words joined by spaces, with each item that has it."""
    ship(benchmark.sparkSession)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            items, out = [], []
            ids = batch.column(0).to_pylist()
            data, offsets = text_buffer(batch.column(1))
            low = LOWER[data].tobytes()
            starts, ends, row = words_of(np.frombuffer(low, np.uint8), offsets, ALNUM)
            words = [low[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            first = np.searchsorted(row, np.arange(len(ids) + 1))
            for i, item in enumerate(ids):
                own = words[first[i] : first[i + 1]]
                for k in range(max(1, len(own) - size + 1) if own else 0):
                    items.append(item or "")
                    out.append(b" ".join(own[k : k + size]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(items, pa.string())], ["window", "item"])

    rows = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(windows, "window string, item string").distinct()


class WindowSet:
    """Windows by length, their hashes sorted, behind a sieve; and the items of each window's text."""

    def __init__(self, windows: list[tuple[str, list[str]]]) -> None:
        self.items = {w.encode(): items for w, items in windows}
        by_size: dict[int, list[bytes]] = {}
        for w in self.items:
            by_size.setdefault(w.count(b" ") + 1, []).append(w)
        self.hashes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size, group in by_size.items():
            data = np.frombuffer(b" ".join(group), np.uint8)
            starts, ends, _ = words_of(data, np.array([0, len(data)]), ALNUM)
            hashes = np.unique(hash_windows(hash_words(data, starts, ends), size)[::size])
            sieve = np.zeros(1 << 20, bool)
            sieve[hashes >> np.uint64(44)] = True
            self.hashes[size] = (hashes, sieve)

    def hits(self, low: bytes, starts: np.ndarray, ends: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, words, items) of every verified window."""
        words = hash_words(np.frombuffer(low, np.uint8), starts, ends)
        for size, (hashes, sieve) in self.hashes.items():
            seen = hash_windows(words, size)
            at = np.flatnonzero(sieve[seen >> np.uint64(44)])
            at = at[hashes[np.minimum(np.searchsorted(hashes, seen[at]), len(hashes) - 1)] == seen[at]]
            for i in at[row[at] == row[at + size - 1]].tolist():
                text = b" ".join([low[a:b] for a, b in zip(starts[i : i + size].tolist(), ends[i : i + size].tolist(), strict=True)])
                if (items := self.items.get(text)) is not None:
                    yield i, size, items


def _judge(index: WindowSet, column: pa.Array) -> tuple[np.ndarray, list[list[dict]], list[list[str]]]:
    """Words, hit ranges and items of each text of a slice."""
    data, offsets = text_buffer(column)
    low = LOWER[data].tobytes()
    starts, ends, row = words_of(np.frombuffer(low, np.uint8), offsets, ALNUM)
    n = len(column)
    edge = np.zeros(len(starts) + 1, np.int64)
    items: dict[int, set[str]] = {}
    for i, size, found in index.hits(low, starts, ends, row):
        edge[i] += 1
        edge[i + size] -= 1
        items.setdefault(int(row[i]), set()).update(found)
    hit = np.cumsum(edge[:-1]) > 0
    first = np.searchsorted(row, np.arange(n + 1))
    ranges: list[list[dict]] = [[] for _ in range(n)]
    for r in items:
        own = np.flatnonzero(np.diff(np.concatenate([[False], hit[first[r] : first[r + 1]], [False]]).astype(np.int8)))
        text = data[offsets[r] : offsets[r + 1]]
        points = np.cumsum((text & 0xC0) != 0x80)  # code points up to and with a byte
        for a, b in own.reshape(-1, 2).tolist():
            s, e = int(starts[first[r] + a] - offsets[r]), int(ends[first[r] + b - 1] - offsets[r])
            ranges[r].append({"first": a, "last": b, "start": int(points[s]) - 1, "end": int(points[e - 1])})
    return np.bincount(row, minlength=n)[:n], ranges, [sorted(items.get(r, ())) for r in range(n)]


def _scan(windows, id_type: str, only_hits: bool = False):
    """A mapInArrow function over (id, text_hash, text): word count, hit ranges and items."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = WindowSet(windows.value)
        for batch in sliced(batches, "text"):
            n_words, ranges, items = _judge(index, batch.column(2))
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(ranges, _RANGES), pa.array(items, pa.list_(pa.string()))], ["id", "text_hash", "n_words", "ranges", "items"])
            yield out.filter(pa.array([bool(r) for r in ranges], pa.bool_())) if only_hits else out

    return scan, f"id {id_type}, text_hash long, n_words long, ranges array<struct<first:long,last:long,start:long,end:long>>, items array<string>"


_RANGES = pa.list_(pa.struct([(k, pa.int64()) for k in ("first", "last", "start", "end")]))


def _merged(ranges) -> list[dict]:
    """Union of ranges of one document from several blocks, in order; they may overlap or touch."""
    out: list[dict] = []
    for r in sorted(ranges, key=lambda r: r["first"]):
        if out and r["first"] <= out[-1]["last"]:
            if r["last"] > out[-1]["last"]:
                out[-1] |= {"last": r["last"], "end": r["end"]}
        else:
            out.append({k: r[k] for k in ("first", "last", "start", "end")})
    return out


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str, size: int, block_bytes: int) -> list[DataFrame]:
    """The benchmark's windows in blocks of about ``block_bytes``."""
    windows = checkpoint(benchmark_windows(benchmark, item_col, item_text_col, size))
    weight = windows.agg(F.sum(F.octet_length("window") + F.octet_length("item") + 8)).first()[0] or 0
    n = max(1, -(-int(weight) // block_bytes))
    return [windows] if n == 1 else [windows.where(F.pmod(F.xxhash64("window", "item"), F.lit(n)) == b) for b in range(n)]


def _held(block: DataFrame):
    """A block's windows and their items, broadcast: about ``block_bytes`` of them."""
    items: dict[str, list[str]] = {}
    for window, item in block.toLocalIterator():
        items.setdefault(window, []).append(item)
    return block.sparkSession.sparkContext.broadcast([(w, sorted(own)) for w, own in items.items()])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = SIZE, block_bytes: int = BLOCK_BYTES, share: int = SHARE) -> DataFrame:
    """(id, text_hash, n_words, n_hit, items, ranges, contaminated) for each row of ``docs``.

    ``ranges`` holds the hit runs as word positions [first, last) and code points [start, end).
    """
    return _contamination(docs, _blocks(benchmark, item_col, item_text_col, size, block_bytes), id_col, text_col, share)


def _contamination(docs: DataFrame, blocks: list[DataFrame], id_col: str, text_col: str, share: int) -> DataFrame:
    ship(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    if len(blocks) == 1:
        found = rows.mapInArrow(*_scan(_held(blocks[0]), id_type))
    else:
        every = None
        for k, block in enumerate(blocks):
            held = _held(block)
            one = written(rows.mapInArrow(*_scan(held, id_type, only_hits=k > 0)).withColumn("own", F.lit(k == 0).cast("int")))
            held.destroy()
            every = one if every is None else every.unionAll(one)

        @F.pandas_udf("array<struct<first:long,last:long,start:long,end:long>>")
        def merge(ranges: pd.Series) -> pd.Series:
            return ranges.map(_merged)

        # equal rows of an id have equal hits, and come back as often as they went in
        found = every.groupBy("id", "text_hash").agg(
            F.max("n_words").alias("n_words"),
            merge(F.flatten(F.collect_set("ranges"))).alias("ranges"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
            F.sum("own").alias("copies"),
        )
        found = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    n_hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda a, r: a + r["last"] - r["first"])
    return found.select(F.col("id").alias(id_col), "text_hash", "n_words", n_hit.alias("n_hit"), "items", "ranges").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))
    )


def _without(text: str, ranges: list[dict]) -> str:
    parts, at = [], 0
    for r in ranges:
        parts.append(text[at : r["start"]])
        at = r["end"]
    return "".join([*parts, text[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, how: str = "documents", id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = SIZE, block_bytes: int = BLOCK_BYTES, share: int = SHARE) -> DataFrame:
    """``docs`` without its contaminated rows (``how='documents'``) or without the hit runs of those (``'spans'``).

    Rows that are not contaminated stay as they are, columns and all.
    """
    if how not in ("documents", "spans"):
        raise ValueError("how is 'documents' or 'spans'")
    blocks = _blocks(benchmark, item_col, item_text_col, size, block_bytes)
    if len(blocks) == 1:
        return _in_scan(docs, _held(blocks[0]), how, text_col, share)
    bad = _contamination(docs, blocks, id_col, text_col, share).where("contaminated").groupBy(F.col(id_col).alias("id"), "text_hash").agg(F.first("ranges").alias("ranges"))
    bad = bad.select(F.struct("id", "text_hash", "ranges").alias("bad"))
    rows = whole_rows(docs)
    same = F.col(f"row.{id_col}").eqNullSafe(F.col("bad.id")) & (F.xxhash64(F.col(f"row.{text_col}").cast("string")) == F.col("bad.text_hash"))
    if how == "documents":
        return rows.join(bad, same, "left_anti").select("row.*")

    @F.pandas_udf("string")
    def cut(text: pd.Series, ranges: pd.Series) -> pd.Series:
        return pd.Series([t if rs is None or t is None else _without(t, rs) for t, rs in zip(text, ranges, strict=True)], dtype=object)

    joined = rows.join(bad, same, "left").withColumn("cut", cut(F.col("row")[text_col], "bad.ranges"))
    return joined.select(*[F.col("cut").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def _in_scan(docs: DataFrame, windows, how: str, text_col: str, share: int) -> DataFrame:
    """Rows judged where they are read; ``docs`` has its text as strings."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = WindowSet(windows.value)
        for batch in sliced(batches, text_col):
            n_words, ranges, _ = _judge(index, batch.column(at))
            bad = [sum(r["last"] - r["first"] for r in own) * share >= n if own else False for own, n in zip(ranges, n_words.tolist(), strict=True)]
            if how == "documents":
                yield batch.filter(pa.array([not x for x in bad], pa.bool_()))
                continue
            if any(bad):
                texts = [_without(t, own) if x else t for t, own, x in zip(batch.column(at).to_pylist(), ranges, bad, strict=True)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield batch

    return docs.mapInArrow(run, docs.schema)
