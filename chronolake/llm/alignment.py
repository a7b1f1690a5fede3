"""Cross-tokenizer alignment: which tokens of two tokenizers stand for the same bytes of a text.

Both tokenizers encode the space and the text that follows; A is a byte-level BPE, B a piece model that puts the space
there itself. Places where a token of both ends cut the bytes into groups, found by divide and conquer: in an interval
of A's tokens, the end nearest to the middle that is an end of B as well is looked for outwards in doubling rings, each
end by bisection of B's; it cuts the interval in two, which are worked on alike, and an interval without a cut is a
group. All intervals of a depth, over all texts of a slice, are probed together. As the cut nearest to the middle is
taken, a wide run without cuts is left alone after two of them, so the work is about n log n probes.

Tokens of a group are linked, each of A with each of B. The documents that hold an id pair linked are counted over the
corpus. The pairs of most documents, ``HELD`` at most, are broadcast and looked up where the links are; all others stand
in few documents, so these links are joined with their counts by a shuffle, without hot keys.

Pieces of A and words of B (spaces and what follows them up to the next) that were met are remembered. No piece of B may
go on from something else into a space; a model where one does is refused. What the model's own normaliser changes does
not come back from the tokens, so such texts have none.

Defined cases: null, empty, or texts that do not come back from either tokenizer's tokens have no tokens and no groups;
repeated rows are aligned one by one, and each counts as a document; null ids are passed through; other columns are
ignored; very long texts are aligned whole, links of wide groups in runs of ``LINKS``; ties for an id's most frequent
pair are all the most frequent; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .._spark import ship, written
from ._common import sliced
from .byte_bpe import ByteBPE

#: Id pairs whose counts are broadcast at most (24 bytes each), links that are spread out at a time, words remembered.
HELD, LINKS, REMEMBERED, SHORT = 1 << 20, 1 << 20, 400_000, 256
_SPACE, _WORD = "▁", re.compile(r" +[^ ]*")
#: A pair of ids as one number: A's times this, plus B's.
PAIR = 1 << 32


class Pieces:
    """A piece model's file, encoded word by word."""

    def __init__(self, model: bytes) -> None:
        self.model = model
        self.sizes: np.ndarray | None = None
        self._ready: tuple | None = None

    @classmethod
    def from_file(cls, path: str) -> Pieces:
        with open(path, "rb") as f:
            return cls(f.read())

    def __getstate__(self) -> dict:
        return {"model": self.model, "_ready": None, "sizes": None}

    def ready(self) -> tuple:
        """The processor, the bytes of each id, and the packed ids of the words met; None where they stand for something else."""
        if self._ready is None:
            from sentencepiece import SentencePieceProcessor

            processor = SentencePieceProcessor(model_proto=self.model)
            names = processor.id_to_piece(list(range(processor.get_piece_size())))
            if any(_SPACE in name.lstrip(_SPACE) for name in names):
                raise ValueError("pieces that go on into a space are not supported")
            tokens = [bytes([int(name[3:5], 16)]) if processor.is_byte(i) else name.replace(_SPACE, " ").encode() for i, name in enumerate(names)]
            self.sizes = np.array(list(map(len, tokens)), np.int64)
            self._ready = processor, tokens, {" ": array("I", [processor.piece_to_id(_SPACE)]).tobytes()}
        return self._ready

    def encode_many(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of texts with their leading space; None where they do not stand for the text. New words are encoded together."""
        processor, tokens, known = self.ready()
        runs = [_WORD.findall(t) for t in texts]
        words = {w for run in runs for w in run}
        if new := [w for w in words if w not in known]:
            if len(known) + len(new) > REMEMBERED:
                space = known[" "]
                known.clear()
                known[" "] = space
                new = [w for w in words if w != " "]
            found = processor.encode([w[1:] for w in new], num_threads=1)  # the model puts a space in front
            known.update(zip(new, self._packed(new, found), strict=True))
        out: list[np.ndarray | None] = []
        for run in runs:
            try:
                out.append(np.frombuffer(b"".join(map(known.__getitem__, run)), np.uint32).astype(np.int64))
            except TypeError:  # None among them
                out.append(None)
        for w in new:
            if len(w) > SHORT:
                known.pop(w, None)
        return out


    def _packed(self, words: list[str], found: list[list[int]]) -> list[bytes | None]:
        """Packed ids of each word; None where their bytes are not the word's."""
        tokens = self.ready()[1]
        data, ids = [w.encode() for w in words], np.fromiter(chain.from_iterable(found), np.int64)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64))
        packed, at = ids.astype(np.uint32).tobytes(), [0, *(4 * ends).tolist()]
        out: list[bytes | None] = [packed[a:b] for a, b in zip(at, at[1:], strict=False)]
        told = np.append(0, np.cumsum(self.sizes[ids]))[ends]  # bytes up to each word's end, by its tokens
        if b"".join(map(tokens.__getitem__, ids.tolist())) != b"".join(data) or (told != np.cumsum(np.fromiter(map(len, data), np.int64))).any():
            out = [p if b"".join(map(tokens.__getitem__, i)) == d else None for p, i, d in zip(out, found, data, strict=True)]
        return out


def shared_cuts(a: np.ndarray, b: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Positions in ``a`` of the ends that are in ``b`` too, sorted; by bisection from the middle of each interval.

    ``a`` and ``b`` ascend. ``edges`` are positions in ``a`` behind each text's last token, whose ends are shared.
    """
    lo = np.concatenate([[0], edges[:-1]]).astype(np.int64)
    hi = edges.astype(np.int64)  # intervals of tokens [lo, hi), whose own end is known to be shared
    lo, hi = lo[hi > lo], hi[hi > lo]
    cuts = [hi - 1]
    while len(lo):
        lo, hi = lo[hi - lo > 1], hi[hi - lo > 1]
        cut = _nearest(a, b, lo, hi)
        found = cut >= 0
        cuts.append(cut[found])
        lo, hi, cut = lo[found], hi[found], cut[found]
        lo, hi = np.concatenate([lo, cut + 1]), np.concatenate([cut + 1, hi])
    return np.sort(np.concatenate(cuts))


def _nearest(a: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For each interval, the position before its last one, nearest to the middle, whose end is in ``b``; -1 without one."""
    out = np.full(len(lo), -1, np.int64)
    middle = (lo + hi - 2) // 2
    open_, near, far = np.arange(len(lo)), 0, 1  # distances [near, far) from the middle are probed next
    while len(open_):
        m, left, right = middle[open_], lo[open_], hi[open_] - 2
        most = np.maximum(m - left, right - m)
        reach = np.minimum(far, most + 1) - near  # distances of this ring
        sides = 2 if near else 1  # the middle itself is one place
        which = np.repeat(np.arange(len(open_)), sides * reach)
        place = np.arange(len(which)) - np.repeat(sides * (np.cumsum(reach) - reach), sides * reach)
        distance = near + place // sides
        at = m[which] + np.where(place % 2 == 0, distance, -distance)
        inside = (at >= left[which]) & (at <= right[which])
        which, at = which[inside], at[inside]
        end = a[at]
        place_b = np.searchsorted(b, end)  # bisection
        hit = (place_b < len(b)) & (b[np.minimum(place_b, len(b) - 1)] == end)
        first, once = np.unique(which[hit], return_index=True)  # probes are in order of their distance
        out[open_[first]] = at[hit][once]
        rest = (out[open_] < 0) & (most >= far)
        open_, near, far = open_[rest], far, far * 2
    return out


def token_links(first: np.ndarray, second: np.ndarray, a: np.ndarray, b: np.ndarray, row_a: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, pair, times) of links between the ids ``a`` and ``b``, in runs of groups with about ``LINKS`` links.

    Group g has A's tokens from first[g] to first[g + 1] and B's likewise in ``second``. Repeated ids of a wide group
    are counted before they are paired.
    """
    wide = np.flatnonzero(np.diff(first) * np.diff(second) > LINKS)
    narrow = np.ones(len(first) - 1, bool)
    narrow[wide] = False
    sizes = np.where(narrow, np.diff(first) * np.diff(second), 0)
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + LINKS, "right")))
        own = np.arange(at, to)[narrow[at:to]]
        n_a, n_b = (first[own + 1] - first[own]), (second[own + 1] - second[own])
        total = n_a * n_b
        which = np.repeat(np.arange(len(own)), total)
        place = np.arange(int(total.sum())) - np.repeat(np.cumsum(total) - total, total)
        i, j = first[own][which] + place // np.maximum(n_b[which], 1), second[own][which] + place % np.maximum(n_b[which], 1)
        yield _counted(row_a[i], a[i] * PAIR + b[j])
        at = to
    for g in wide.tolist():
        row = row_a[first[g]]
        ids_b, times_b = np.unique(b[second[g] : second[g + 1]], return_counts=True)
        ids_a, times_a = np.unique(a[first[g] : first[g + 1]], return_counts=True)
        step = max(1, LINKS // len(ids_b))
        for k in range(0, len(ids_a), step):
            some, often = ids_a[k : k + step], times_a[k : k + step]
            pairs = (some[:, None] * PAIR + ids_b[None, :]).ravel()
            yield np.full(len(pairs), row), pairs, (often[:, None] * times_b[None, :]).ravel()


def _counted(row: np.ndarray, pair: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, pair) in order, and how often each stands."""
    bits = int(pair.max(initial=0)).bit_length()
    if times is None and int(row.max(initial=0)) < 1 << (62 - bits):  # both in one number
        key, n = np.unique(row << bits | pair, return_counts=True)
        return key >> bits, key & ((1 << bits) - 1), n
    order = np.lexsort((pair, row))
    row, pair = row[order], pair[order]
    times = np.ones(len(row), np.int64) if times is None else times[order]
    starts = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (pair[1:] != pair[:-1]))) if len(row) else np.zeros(0, np.int64)
    return row[starts], pair[starts], np.add.reduceat(times, starts) if len(starts) else times


class _Aligned:
    """Tokens, groups and links of some texts; each array over all of them."""

    def __init__(self, texts: list[str | None], tokenizer: ByteBPE, pieces: Pieces, size_a: np.ndarray, size_b: np.ndarray) -> None:
        self.n = len(texts)
        none = np.zeros(0, np.int64)
        ids_a, ids_b = [none] * self.n, [none] * self.n
        own = [i for i, text in enumerate(texts) if text]
        found = dict(zip(own, pieces.encode_many([" " + texts[i] for i in own]), strict=True))
        own = [i for i in own if found[i] is not None]
        for i, packed in zip(own, tokenizer.encode_many([" " + texts[i] for i in own]), strict=True):  # A's pieces cover every text
            ids_a[i], ids_b[i] = np.frombuffer(packed, np.uint32).astype(np.int64), found[i]
        self.a, self.b = np.concatenate([none, *ids_a]), np.concatenate([none, *ids_b])
        self.n_a, self.n_b = np.array([len(x) for x in ids_a], np.int64), np.array([len(x) for x in ids_b], np.int64)
        self.row_a = np.repeat(np.arange(self.n), self.n_a)
        end_a, end_b = np.cumsum(size_a[self.a]), np.cumsum(size_b[self.b])  # over all texts: each brings as many bytes to both
        self.cuts = shared_cuts(end_a, end_b, np.cumsum(self.n_a)) if len(end_a) else none
        self.first = np.concatenate([[0], self.cuts + 1])
        self.second = np.concatenate([[0], np.searchsorted(end_b, end_a[self.cuts]) + 1])
        self.row_group = self.row_a[self.cuts]

    def groups(self, told: list[str], size_a: int) -> list[str]:
        """a1,a2|b1;a3|b2 of each text; ``told`` has each id of A and then of B with what may follow it."""
        n_a, n_b = np.diff(self.first), np.diff(self.second)
        codes = np.zeros(len(self.a) + len(self.b), np.int64)
        at_a = np.arange(len(self.a)) + np.repeat(self.second[:-1], n_a)
        at_b = np.arange(len(self.b)) + np.repeat(self.first[1:], n_b)
        codes[at_a], codes[at_b] = 2 * self.a, 2 * (size_a + self.b)
        codes[at_a[self.first[1:] - 1]] += 1
        codes[at_b[self.second[1:] - 1]] += 1
        parts = list(map(told.__getitem__, codes.tolist()))
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(parts[a:b])[:-1] for a, b in zip([0, *ends], ends, strict=False)]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, pair, times) of distinct pairs, by row."""
        runs = list(token_links(self.first, self.second, self.a, self.b, self.row_a))
        if len(runs) < 2:
            return runs[0] if runs else (np.zeros(0, np.int64),) * 3
        return _counted(*(np.concatenate([r[k] for r in runs]) for k in range(3)))


def align(docs: DataFrame, tokenizer: ByteBPE, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups, links) for each row of ``docs``.

    ``groups`` reads a1,a2|b1;a3|b2,b3 with the ids of A and B in order; ``links`` has (pair, times) of each distinct
    pair of linked ids, a pair being A's id times ``PAIR`` plus B's.
    """
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast((tokenizer, pieces))  # two vocabulary files
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, pieces = held.value
        size_a = np.zeros(max(tokenizer.tokens.values()) + 1, np.int64)
        size_a[list(tokenizer.tokens.values())] = list(map(len, tokenizer.tokens))
        size_b = pieces.ready() and pieces.sizes
        told = [f"{i}{end}" for size, last in ((len(size_a), "|"), (len(size_b), ";")) for i in range(size) for end in (",", last)]
        for batch in sliced(batches, "text"):
            found = _Aligned(batch.column(1).to_pylist(), tokenizer, pieces, size_a, size_b)
            row, pair, times = found.links()
            offsets = pa.array(np.searchsorted(row, np.arange(found.n + 1)), pa.int32())
            links = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(pair, pa.int64()), pa.array(times, pa.int64())], ["pair", "times"]))
            n_links = np.bincount(row, times, minlength=found.n)[: found.n].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.n_a), pa.array(found.n_b), pa.array(np.bincount(found.row_group, minlength=found.n)[: found.n]), pa.array(n_links), pa.array(found.groups(told, len(size_a)), pa.string()), links],
                ["id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, f"id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups string, links array<struct<pair:long,times:long>>")
    return out.withColumnRenamed("id", id_col)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold a pair linked, and whether no pair of A's id is in more of them."""
    pairs = aligned.select(F.explode("links.pair").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    pairs = pairs.withColumn("a", F.floor(F.col("pair") / PAIR).cast("int"))
    most = pairs.groupBy("a").agg(F.max("n").alias("most"))
    return pairs.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _most_frequent(counts: DataFrame, held: int) -> int:
    """The count from which pairs are ``held`` at most."""
    steps = counts.groupBy("n").agg(F.count(F.lit(1)).alias("pairs"))  # one row a distinct count
    run = F.sum("pairs").over(Window.orderBy(F.col("n").desc()))
    return steps.select("n", run.alias("up_to")).where(F.col("up_to") <= held).agg(F.min("n")).first()[0] or 1 << 62


def linked_counts(aligned: DataFrame, key: str, held: int = HELD) -> DataFrame:
    """(key, n_best, count_sum): links of each row whose pair is the most frequent of A's id, and the sum of all links' counts.

    ``aligned`` is read twice or more, so it is a written table.
    """
    counts = written(pair_counts(aligned))
    total = counts.count()
    links = aligned.select(key, F.explode("links").alias("link")).select(key, "link.*")
    if total <= held:
        near, far = links.join(F.broadcast(counts), "pair"), None
    else:
        least = _most_frequent(counts, held)
        looked_up = links.join(F.broadcast(counts.where(F.col("n") >= least)), "pair", "left")
        near = looked_up.where("n IS NOT NULL")
        far = looked_up.where("n IS NULL").drop("n", "best").join(counts.where(F.col("n") < least), "pair")
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    out = near.groupBy(key).agg(*sums)
    if far is not None:
        out = out.unionByName(far.groupBy(key).agg(*sums)).groupBy(key).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return out


def alignment_counts(docs: DataFrame, tokenizer: ByteBPE, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text", held: int = HELD) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row of ``docs``; no groups have the digest ''."""
    found = align(docs, tokenizer, pieces, id_col, text_col)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    # numbered as written: the rows are then the same whenever they are read
    aligned = written(found.select(F.monotonically_increasing_id().alias("_row"), id_col, "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"), "links"))
    sums = linked_counts(aligned, "_row", held)
    out = aligned.drop("links").join(sums, "_row", "left")
    return out.select(id_col, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0).cast("long")).alias("n_best"), F.coalesce("count_sum", F.lit(0).cast("long")).alias("count_sum"), "groups_sha256")
