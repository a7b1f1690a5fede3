"""Line de-duplication: range-partitioned hashes, sorted by document, streamed for first occurrences.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased. Keys of at
least ``least_chars`` code points that stand in at least ``least_docs`` documents lose all their lines
but those of the document with the largest id.

Every document sends one row for each of its keys: a 128-bit hash, its id and the lines' positions. The
rows are range-partitioned by (hash, id descending), so a key that is everywhere is dealt over several
partitions, and sorted within them. One stream over a partition then meets the staying document of a key
first. Until ``least_docs`` documents are counted a key's rows wait, up to ``HELD`` of them; beyond, as when
one id has very many rows, they go out as open ones, and meet their key's verdict in a join afterwards. Only
the first and the last key of a partition can go on in another one; their document counts, two rows a
partition at most, are summed beforehand. The result is a compressed keep bitmap for each document that loses
a line.

Defined cases: null and empty texts are one empty line; rows without id count as one document that is
smaller than any other; repeated rows of an id count as one document and, where their text is the same,
lose the same lines; equal lines of a document fall and stay together; very long texts and lines are read
whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._spark import checkpoint, ship
from ._common import sliced, whole_rows

LEAST_CHARS, LEAST_DOCS = 40, 5
#: Rows of a key that wait in a task until its documents are counted.
HELD = 20_000
_SPACE = " \t\n\x0b\x0c\r"


def line_key(line: str) -> bytes:
    return line.strip(_SPACE).encode("utf-8", "surrogatepass").lower()


def _line_rows(docs: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    """(h1, h2, id, text_hash, lines): the positions of each long enough key of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            row, digests, lines = [], [], []
            for i, text in enumerate(batch.column(2)):
                text, own = text.as_py() or "", {}
                for k, line in enumerate(text.split("\n")):
                    if len(line) >= least_chars and len(line.strip(_SPACE)) >= least_chars:
                        own.setdefault(xxhash.xxh3_128_digest(line_key(line)), []).append(k)
                row += [i] * len(own)
                digests += own.keys()
                lines += own.values()
            h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), batch.column(0).take(at), batch.column(1).take(at), pa.array(lines, pa.list_(pa.int32()))], ["h1", "h2", "id", "text_hash", "lines"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"h1 long, h2 long, id {docs.schema[id_col].dataType.simpleString()}, text_hash long, lines array<int>")


_NONE = object()


class _Runs:
    """Sorted rows as runs of one key, each row with its document's number in the run.

    ``before`` is the key that rows seen earlier ended with, their documents and the last one's id.
    """

    def __init__(self, rows: pa.RecordBatch | pa.Table, before: tuple | None) -> None:
        h = np.stack([rows.column(k).to_numpy() for k in (0, 1)], 1)
        ids = rows.column(2)
        ids = (ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids).dictionary_encode()
        code = pc.fill_null(ids.indices, -1).to_numpy(zero_copy_only=False)
        n = len(h)
        starts = np.ones(n, bool)
        starts[1:] = (h[1:] != h[:-1]).any(1)
        fresh = starts.copy()
        fresh[1:] |= code[1:] != code[:-1]
        carried = 0
        if before is not None and before[0] == (int(h[0, 0]), int(h[0, 1])):
            carried = before[1]
            fresh[0] = ids[0].as_py() != before[2]
        count = np.cumsum(fresh)
        self.starts = np.flatnonzero(starts)
        self.sizes = np.diff(np.concatenate([self.starts, [n]]))
        base = (count - fresh)[self.starts]
        base[0] -= carried
        self.number = count - np.repeat(base, self.sizes)  # 1 for the rows of a key's first document
        self.docs = self.number[self.starts + self.sizes - 1]
        self.keys = h[self.starts]
        self.last = ((int(h[-1, 0]), int(h[-1, 1])), int(self.docs[-1]), ids[n - 1].as_py())


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of the first and of the last key of a partition."""
    first, before, part = None, None, -1
    for batch in batches:
        if not batch.num_rows:
            continue
        runs, part = _Runs(batch, before), batch.column(3)[0].as_py()
        if first is None:  # the first key's count is final once another one follows
            head = (tuple(map(int, runs.keys[0])), int(runs.docs[0])) if before is None or before[0] == tuple(runs.keys[0].tolist()) else (before[0], before[1])
            if len(runs.docs) > 1 or head[0] != runs.last[0]:
                first = head
        before = runs.last
    if before is not None:
        rows = [(*first[0], first[1])] if first else []
        rows.append((*before[0], before[1]))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)] + [pa.array([part] * len(rows), pa.int32())], ["h1", "h2", "n", "part"])


#: What a row of the stream says: lines that fall; lines that fall if their key does; a key that falls.
FALLEN, OPEN, VERDICT = range(3)


def _fallen(shared: dict[tuple[int, int], tuple[int, int]], least_docs: int, most: int):
    """A mapInArrow function over sorted rows: (kind, h1, h2, id, text_hash, lines).

    ``shared`` has the documents of each key of several partitions, and the first of those partitions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, waiting, opened = None, None, False  # the last key so far, its rows that wait, whether some are out

        def out(rows, kind: int):
            return pa.RecordBatch.from_arrays([pa.array(np.full(rows.num_rows, kind, np.int32)), *(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in rows.columns[:5])], ["kind", "h1", "h2", "id", "text_hash", "lines"])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(5)[0].as_py()
            rows = batch if waiting is None else pa.Table.from_batches([*waiting, batch]).combine_chunks().to_batches()[0]
            runs = _Runs(rows, before)
            goes_on = before is not None and before[0] == tuple(runs.keys[0].tolist())
            falls = runs.docs >= least_docs
            settled = np.ones(len(falls), bool)
            settled[-1] = falls[-1]  # the last key may go on
            settled[-1] |= rows.column(2)[rows.num_rows - 1].as_py() is None  # rows without id are a key's last document
            stays = np.ones(len(falls), bool)
            for k in {0, len(falls) - 1}:  # others have no row outside
                total, home = shared.get(tuple(runs.keys[k].tolist()), (None, part))
                if total is not None:
                    falls[k], settled[k], stays[k] = total >= least_docs, True, home == part
            per_row = np.repeat(falls & settled, runs.sizes) & ~((runs.number == 1) & np.repeat(stays, runs.sizes))
            if per_row.any():
                yield out(rows.filter(pa.array(per_row)), FALLEN)
            if opened and (not goes_on or settled[0]):
                if goes_on and falls[0]:
                    yield pa.RecordBatch.from_arrays([pa.array([VERDICT], pa.int32()), *(pa.array([x], pa.int64()) for x in before[0]), pa.nulls(1, batch.column(2).type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int32()))], ["kind", "h1", "h2", "id", "text_hash", "lines"])
                opened = False
            waiting, kept = None, None
            if not settled[-1]:
                tail = rows.slice(int(runs.starts[-1]))
                own = runs.number[runs.starts[-1] :] > 1  # the first document stays whatever comes
                if len(own) > most:
                    if own.any():
                        yield out(tail.filter(pa.array(own)), OPEN)
                        opened = True
                else:
                    waiting, kept = [tail], before if len(falls) == 1 else None
            before = kept if waiting else runs.last

    return run


def pack(dropped: np.ndarray | list[int]) -> bytes:
    """The compressed bitmap with a 0 for each dropped line; lines beyond its end are kept."""
    keep = np.ones(8 * (max(dropped) // 8 + 1), bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes())


def unpack(bitmap: bytes, n: int) -> np.ndarray:
    keep = np.ones(n, bool)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n]
    keep[: len(bits)] = bits
    return keep


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, held: int = HELD) -> DataFrame:
    """(id, text_hash, bitmap) of the rows that lose lines."""
    ship(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    order = ("h1", "h2", F.col("id").desc_nulls_last())
    lines = checkpoint(_line_rows(docs, id_col, text_col, least_chars))
    rows = checkpoint(lines.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))
    ends = rows.select("h1", "h2", "id", "part").mapInArrow(_edges, "h1 long, h2 long, n long, part int").collect()  # two rows a partition at most
    seen: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for h1, h2, n, part in ends:
        seen.setdefault((h1, h2), []).append((part, n))
    shared = {k: (sum(n for _, n in v), min(p for p, _ in v)) for k, v in seen.items() if len(v) > 1}
    said = checkpoint(rows.mapInArrow(_fallen(shared, least_docs, held), f"kind int, h1 long, h2 long, id {id_type}, text_hash long, lines array<int>"))
    verdicts = said.where(F.col("kind") == VERDICT).select("h1", "h2")
    fallen = said.where(F.col("kind") == FALLEN).unionByName(said.where(F.col("kind") == OPEN).join(verdicts, ["h1", "h2"], "left_semi"))

    @F.pandas_udf("binary")
    def bitmap(lines: pd.Series) -> pd.Series:
        return lines.map(pack)

    # a document's lines: equal rows of an id say the same, so each list counts once
    return fallen.groupBy("id", "text_hash").agg(bitmap(F.flatten(F.collect_set("lines"))).alias("bitmap")).select(F.col("id").alias(id_col), "text_hash", "bitmap")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = True) -> DataFrame:
    """``docs`` with its text cut by the bitmaps; a null text stays null.

    With ``counts`` there are (n_lines, n_dropped) as further columns, in place of any of these names; without,
    the columns are those of ``docs``.
    """
    ship(docs.sparkSession)
    bits = bitmaps.select(F.struct(F.col(id_col).alias("id"), "text_hash", "bitmap").alias("bits"))
    rows = whole_rows(docs)
    joined = rows.join(bits, F.col(f"row.{id_col}").eqNullSafe(F.col("bits.id")) & (F.xxhash64(F.col(f"row.{text_col}").cast("string")) == F.col("bits.text_hash")), "left")

    @F.pandas_udf("kept string, n_lines long, n_dropped long")
    def cut(text: pd.Series, bitmap: pd.Series) -> pd.DataFrame:
        kept, n_lines, n_dropped = [], [], []
        for t, b in zip(text, bitmap, strict=True):
            lines = (t or "").split("\n") if b is not None else ()
            n_lines.append(len(lines) if b is not None else (t or "").count("\n") + 1)
            if b is None:
                n_dropped.append(0)
                kept.append(t)
                continue
            keep = unpack(b, len(lines))
            n_dropped.append(len(lines) - int(keep.sum()))
            kept.append("\n".join([x for x, k in zip(lines, keep.tolist(), strict=True) if k]))
        return pd.DataFrame({"kept": pd.Series(kept, dtype=object), "n_lines": n_lines, "n_dropped": n_dropped})

    out = joined.withColumn("cut", cut(F.col(f"row.{text_col}").cast("string"), "bits.bitmap"))
    more = ("n_lines", "n_dropped") if counts else ()
    own = [F.col("cut.kept").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns if c not in more]
    return out.select(*own, *[F.col("cut")[c].alias(c) for c in more])


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, counts: bool = True) -> DataFrame:
    return apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, least_chars, least_docs), id_col, text_col, counts)
