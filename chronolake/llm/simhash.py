"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two 64-bit fingerprints within ``BITS`` = 3 bits differ in at most 3 of their 8 bytes, so they share at
least ``SHARED`` = 5 positional bytes: that is the guaranteed minimum. A posting list of a single (position,
byte) would hold 1/256 of all fingerprints, so the index posts three positions at a time: the triples within
the first and within the second half. Of 5 shared positions 3 lie in one half, hence every pair that reaches
the minimum meets in one of these 8 lists at least. In each list the shared positional bytes of every pair are
tallied, pairs below the minimum are dropped, and what is left is verified by its differing bits.

Every list is tallied whole, and none is long: a list beyond ``LIST`` members is dealt to four narrower ones
that fix one more of four disjoint parts of the free bits each, one more byte as long as a byte is left to be
shared. 3 differing bits can't touch all four parts, so every near pair meets again in one of the four. At
most six rounds later the free bits leave a list no more members than that. Sizes are counted by Spark with
partial sums, so no task ever meets a long list.

Copies are folded first (one entry for each distinct fingerprint), and a list returns the components of
its links, never the pairs. Components over all lists come from alternating large-star and small-star steps
on distributed edges.

Defined cases: a null or empty text, or one of white space, has fingerprint 0 and is linked like any
other; a null id takes part but never names a component (a component of null ids only has a null one);
repeated rows are all returned; very long texts are read whole, slice by slice; ties need no rule, as the
smallest id names a component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._spark import checkpoint, new_path, remove, ship, written
from ._common import FEW, sliced, whole_rows

BYTES, BITS, SHARED = 8, 3, 5
#: Positions that the lists fix to begin with.
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]
#: Members of a list beyond which it is dealt to narrower ones.
LIST = 1024
#: Pairs that are tallied at a time, unless one list has more.
PAIRS = 1 << 20
_ALL = (1 << 64) - 1


def _of_bytes(positions) -> int:
    return sum(0xFF << (8 * p) for p in positions)


def narrower(mask: int) -> list[int]:
    """Four masks that fix one more part of the free bits each; the parts are disjoint."""
    free = [p for p in range(BYTES) if not mask >> (8 * p) & 0xFF]
    if len(free) >= 4:
        parts = [0xFF << (8 * p) for p in free[:4]]
    else:
        bits = [b for b in range(64) if not mask >> b & 1]
        parts = [sum(1 << b for b in own.tolist()) for own in np.array_split(bits, 4)]
    return [mask | part for part in parts]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def simhash(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of a text, as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest, ones, n = xxhash.xxh64_digest, np.zeros(64, np.int64), max(1, len(words) - shingle + 1)
    for at in range(0, n, 1 << 15):
        own = words[at : at + (1 << 15) + shingle - 1]
        grams = zip(*(own[k:] for k in range(shingle)), strict=False) if len(words) >= shingle else [words]
        hashed = b"".join([digest(b" ".join(g), 42) for g in grams])
        ones += np.unpackbits(np.frombuffer(hashed, np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) for each row; fp is the bit pattern as a long."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([simhash(x.as_py(), shingle) for x in batch.column(1)], pa.int64())], ["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, fp long")


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index of each component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (a, b, label[a], label[b]):
            np.minimum.at(new, side, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _list_links(of: np.ndarray, fps: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole lists, one after the other in ``fps``: positions of both ends. ``of`` is each member's list."""
    left, right = [], []
    last = np.cumsum(sizes)[of]  # end of each member's list
    at = np.arange(len(fps))
    for step in range(1, int(sizes.max(initial=0))):
        at = at[at + step < last[at]]
        x = fps[at] ^ fps[at + step]
        shared = np.count_nonzero(x.view(np.uint8).reshape(-1, BYTES) == 0, axis=1)  # the tally
        enough = np.flatnonzero(shared >= SHARED)
        near = at[enough[np.bitwise_count(x[enough]) <= BITS]]
        left.append(near)
        right.append(near + step)
    return np.concatenate(left or [at[:0]]), np.concatenate(right or [at[:0]])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) from each linked member of a list to the first one of its component. Rows come sorted by list."""
    keys, fps = np.zeros((0, 2), np.int64), np.zeros(0, np.uint64)

    def edges(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1])
        sizes = np.diff(np.concatenate([starts, [len(fps)]]))
        pairs = np.cumsum(sizes * (sizes - 1) // 2)
        at = 0
        while at < len(sizes):  # runs of lists of about so many pairs
            to = max(at + 1, int(np.searchsorted(pairs, (pairs[at - 1] if at else 0) + PAIRS, "right")))
            own = fps[starts[at] : starts[to - 1] + sizes[to - 1]]
            a, b = _list_links(np.repeat(np.arange(to - at), sizes[at:to]), own, sizes[at:to])
            label = _labels(len(own), a, b)
            linked = np.flatnonzero(label != np.arange(len(own)))
            if len(linked):
                yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)) for v in (own[linked], own[label[linked]])], ["a", "b"])
            at = to

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.concatenate([keys, np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], 1)])
        fps = np.concatenate([fps, batch.column(2).to_numpy().view(np.uint64)])
        cut = int(np.argmax((keys == keys[-1]).all(1)))  # the last list may go on in the next batch
        if cut:
            yield from edges(keys[:cut], fps[:cut])
            keys, fps = keys[cut:], fps[cut:]
    if len(fps):
        yield from edges(keys, fps)


def _posted(rows: DataFrame, step: dict[int, list[int]] | None) -> DataFrame:
    """(mask, key, fp): ``rows`` in each list to begin with, or in those that narrow the list they ``was`` in."""
    if step is None:
        posted = rows.select(F.explode(F.array(*[F.lit(_signed(_of_bytes(t))) for t in TRIPLES])).alias("mask"), "fp")
    else:
        masks = rows.sparkSession.createDataFrame([(_signed(was), _signed(m)) for was, own in step.items() for m in own], "was long, mask long")
        posted = rows.join(F.broadcast(masks), "was")  # at most 8 x 4^6 masks
    return posted.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def links(distinct: DataFrame, longest: int = LIST) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints that links within 3 bits connect. ``distinct`` has a column fp without repeats."""
    ship(distinct.sparkSession)
    step, own, rows, found = None, [_of_bytes(t) for t in TRIPLES], distinct, None
    while True:
        posted = _posted(rows, step)
        # lists that are too long, found by partial counts: no task sees their members together
        long = checkpoint(posted.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > longest).select("mask", "key"))
        n_long = long.limit(FEW + 1).count()
        if n_long:
            side = F.broadcast(long) if n_long <= FEW else long
            short, again = posted.join(side, ["mask", "key"], "left_anti"), posted.join(side, ["mask", "key"], "left_semi")
        else:
            short = posted
        edges = short.repartition("mask", "key").sortWithinPartitions("mask", "key").mapInArrow(_links, "a long, b long")
        found = edges if found is None else found.unionAll(edges)
        if not n_long:
            return found
        step = {m: narrower(m) for m in own if m != _ALL}
        own = sorted({m for masks in step.values() for m in masks})
        rows = checkpoint(again.select(F.col("mask").alias("was"), "fp"))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each linked node can reach; alternating star contraction.

    Rows are edges (a, b) of longs. Every step keeps the components; rounds grow with the logarithm of
    the nodes, and the loop ends when a round changes nothing. Each round's edges are written, and those of
    the round before removed.
    """
    spark = edges.sparkSession

    def print_of(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()

    def kept(e: DataFrame) -> tuple[DataFrame, str]:
        path = new_path(spark, ".parquet")
        return written(e.distinct(), path), path

    edges, path = kept(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))  # kept as a > b
    was = print_of(edges)
    for _ in range(most_rounds):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        # large star: larger neighbours hang on the smallest one
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        # small star: smaller neighbours, and the node itself, hang on the smallest one
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(low.select("a", F.col("low").alias("b")))
        (edges, path), before = kept(small), path
        remove(spark, before)
        now = print_of(edges)
        if now == was:
            break
        was = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _roots(prints: DataFrame) -> DataFrame:
    """(fp, root) of each distinct fingerprint; the root is one of its component's."""
    reps = checkpoint(prints.select("fp").distinct())
    return reps.join(components(links(reps)).withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp, component_id) for each row; the component is named by its smallest id."""
    prints = checkpoint(fingerprints(docs, id_col, text_col, shingle))
    least = prints.groupBy("fp").agg(F.min("id").alias("least")).join(_roots(prints), "fp")
    named = least.join(least.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return prints.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def fingerprint_hex(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, nulls last, then the smallest hash of the text and of the row.

    Rows that share an id but not their component all stay; rows without id are folded like any other.
    """
    ship(docs.sparkSession)
    text = F.col(f"`{text_col}`").cast("string")
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("\0"))  # no null, so that it is a plain key
    own = F.struct(name.alias("name"), F.xxhash64(text).alias("text"))
    prints = checkpoint(fingerprints(docs.select(F.struct(F.col(f"`{id_col}`").alias("id"), own.alias("own")).alias("id"), text.alias("text")), "id", "text", shingle))
    order = F.struct(F.col("id.id").isNull(), F.col("id.id"), F.col("id.own.text"))
    first = prints.groupBy("fp").agg(F.min_by("id", order).alias("id"))  # of exact copies, before anything is joined
    kept = first.join(_roots(prints), "fp").groupBy("root").agg(F.min_by("id", order).alias("id")).select(F.col("id.own.name").alias("_name"), F.col("id.own.text").alias("_text")).distinct()
    rows = whole_rows(docs).select("row", F.coalesce(F.col("row")[id_col].cast("string"), F.lit("\0")).alias("_name"), F.xxhash64(F.col("row")[text_col].cast("string")).alias("_text"))
    others = [F.col("row")[c].alias(c) for c in docs.columns if c != text_col]
    found = rows.join(kept, ["_name", "_text"], "left_semi").groupBy("_name", "_text").agg(F.min_by("row", F.to_json(F.struct(*others))).alias("row"))
    return found.select("row.*")
