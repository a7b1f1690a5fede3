"""Byte-level BPE encoding and decoding by overlapping chunks of a text.

A text is cut into chunks of ``CHUNK`` characters, each with ``OVERLAP`` characters of the next one. Every chunk is
split into pieces from its own start, whatever stands before it. Where two neighbours have a boundary in common, they
go on alike, since what a splitting expression matches at a place depends on what follows alone; so the pieces of the
one are taken up to there and those of the other from there on. The last ``MARGIN`` characters of a chunk are not
trusted, as an expression looks so far ahead. Where no boundary is shared (a piece longer than the overlap), the
expression goes on from the last one, step by step on the whole text, until it meets one. Then every piece is merged
by rank, lowest first, then leftmost. Decoding concatenates the tokens' bytes.

Texts of up to ``DEAL`` characters are worked on where they are read. Longer ones are dealt over all tasks in parts of
that size, split and encoded as if a piece began at each part, and joined up where the boundaries of neighbouring
parts meet, so one long text does not hold up a task. A text whose parts do not meet is encoded in one go.

What the expression may hold: the classes \\p{L}, \\p{N}, \\s and \\S, no look-behind, and no look-ahead beyond
``MARGIN``; its matches have to cover every text.

Defined cases: null counts as the empty text, which has no tokens and decodes to no bytes; repeated rows are encoded
one by one; null ids are passed through; other columns are ignored; very long texts are encoded whole, with memory
that follows the text and its longest piece; there are no ties: of equal ranks the leftmost pair merges; an empty
table gives an empty result.
"""

from __future__ import annotations

import base64
import json
import re
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._spark import ship, written
from ._common import sliced
from .bpe import Merges, byte_symbols, plane
from .bpe import _expression as spelt

# Fixed value: the splitting expression of the given rank files and byte-level tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of a chunk, of what it sees of the next one, and of its end that are not trusted.
CHUNK, OVERLAP, MARGIN = 4096, 256, 3
#: Characters of a text from which its parts are dealt over the tasks.
DEAL = 1 << 16
#: Pieces that a worker remembers at most, and their bytes.
REMEMBERED, SHORT = 400_000, 256
_LAST = 1 << 62


class ByteBPE:
    """Tokens' bytes, ranks of merges, and the splitting expression; as plain values that can be broadcast."""

    def __init__(self, tokens: dict[bytes, int], pattern: str = PATTERN, merges: Merges | None = None) -> None:
        if "(?<" in pattern:
            raise ValueError("expressions that look behind are not supported")
        if any(bytes([b]) not in tokens for b in range(256)):
            raise ValueError("every byte needs a token")
        self.tokens, self.pattern, self.merges = tokens, pattern.replace(r"\S", r"[^\s]"), merges
        self._known: dict[str, bytes] | None = None
        self._pairs: Pairs | None = None

    @classmethod
    def from_ranks(cls, path: str, pattern: str = PATTERN) -> ByteBPE:
        """A file of lines with a token in base 64 and its rank, which is its id."""
        with open(path, "rb") as f:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f) if token}, pattern)

    @classmethod
    def from_json(cls, path: str, pattern: str = PATTERN) -> ByteBPE:
        """A byte-level tokenizer's JSON with a list of merges; added tokens are ordinary text."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"] or spec["normalizer"]:
            raise ValueError("only plain byte-level models are supported")
        symbol = {s: b for b, s in enumerate(byte_symbols())}
        added = {t["content"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in model["vocab"].items() if t not in added}
        merges = Merges(vocab, [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]], "")
        return cls({bytes(symbol[c] for c in t): i for t, i in vocab.items()}, pattern, merges)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_known": None, "_pairs": None}

    @property
    def known(self) -> dict[str, bytes]:
        """Pieces that were met and their packed ids."""
        if self._known is None:
            self._known = {}
        return self._known

    @property
    def pairs(self) -> Pairs:
        if self._pairs is None:
            if self.merges is not None:
                found = [(a, b, r, whole) for (a, b), (r, whole) in self.merges.rank.items()]
            else:  # any two tokens that make a token
                found = [(a, b, i, i) for token, i in self.tokens.items() for k in range(1, len(token)) if (a := self.tokens.get(token[:k])) is not None and (b := self.tokens.get(token[k:])) is not None]
            self._pairs = Pairs(found, [self.tokens[bytes([b])] for b in range(256)])
        return self._pairs

    def expression(self, text: str) -> re.Pattern:
        return spelt(self.pattern, plane(text))

    def pieces(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[list[str]]:
        """The pieces of a text, in runs: each chunk's own from where it is in step with the ones before."""
        expression = self.expression(text)
        if len(text) <= chunk + overlap:
            yield _covering(expression.findall(text), len(text))
            return
        before: list[str] = []  # pieces of the chunk before from the place ``at`` on, and their ends
        ends: list[int] = []
        at = 0
        for start in range(0, len(text), chunk):
            stop = min(len(text), start + chunk + overlap)
            found = _covering(expression.findall(text[start:stop]), stop - start)
            reach = list(accumulate(map(len, found), initial=start))
            trusted = len(reach) if stop == len(text) else bisect_left(reach, stop - MARGIN + 1)
            marks = {place: i for i, place in enumerate(reach[:trusted])}
            if start:
                k = next((i for i in range(bisect_left(ends, start), len(ends)) if ends[i] in marks), None)
                yield before[: len(ends) if k is None else k + 1]
                at = ends[-1] if k is None and ends else at if k is None else ends[k]
                if k is None:  # on from the last boundary that is known, until this chunk has it
                    single = []
                    while at < reach[trusted - 1] and at not in marks:
                        m = expression.match(text, at)
                        single.append(m[0])
                        at = m.end()
                    yield single
            first = marks.get(at)
            if first is None:  # a piece reaches beyond the chunk
                before, ends = [], []
                continue
            before, ends = found[first : trusted - 1], reach[first + 1 : trusted]
            if stop == len(text):
                break
        yield before
        at = ends[-1] if ends else at
        while at < len(text):
            m = expression.match(text, at)
            yield [m[0]]
            at = m.end()

    def encode(self, text: str) -> bytes:
        """Ids of a text, 32 bits each in the machine's order."""
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text; the pieces that are new to the worker are merged together."""
        runs = [[piece for run in self.pieces(text) for piece in run] for text in texts]
        look = self.learned({piece for run in runs for piece in run})
        return [b"".join(map(look, run)) for run in runs]

    def learned(self, pieces: set[str]) -> Callable[[str], bytes]:
        """What gives the packed ids of these pieces."""
        known = self.known
        if not (new := [p for p in pieces if p not in known]):
            return known.__getitem__
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(pieces)
        data = [p.encode() for p in new]
        short = [k for k, d in enumerate(data) if len(d) <= SHORT]
        packed = self.pairs.merged([data[k] for k in short])
        if self.merges is None:  # a piece that is a token is one, whatever the merges make of it
            whole = self.tokens.get
            packed = [p if (i := whole(data[k])) is None else array("I", [i]).tobytes() for k, p in zip(short, packed, strict=True)]
        known.update(zip([new[k] for k in short], packed, strict=True))
        if len(short) == len(new):
            return known.__getitem__
        long = {new[k]: array("I", self.merged(d)).tobytes() for k, d in enumerate(data) if len(d) > SHORT}  # not remembered
        return lambda piece: long[piece] if piece in long else known[piece]

    def merged(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        if self.merges is not None:
            tokens = self.tokens
            return self.merges.apply([tokens[data[i : i + 1]] for i in range(len(data))])
        return [whole] if (whole := self.tokens.get(data)) is not None else self._merged_long(data)

    def _merged_long(self, data: bytes) -> list[int]:
        get, n = self.tokens.get, len(data)
        parts: list[bytes] = [data[i : i + 1] for i in range(n)]  # an empty one has been taken in by its left neighbour
        left, right = list(range(-1, n - 1)), [*range(1, n), n]
        queue = [(r, i) for i in range(n - 1) if (r := get(data[i : i + 2])) is not None]
        heapify(queue)
        while queue:
            r, i = heappop(queue)
            j = right[i] if parts[i] else n
            if j == n or get(parts[i] + parts[j]) != r:
                continue
            parts[i], parts[j], right[i] = parts[i] + parts[j], b"", right[j]
            if right[i] < n:
                left[right[i]] = i
                if (r := get(parts[i] + parts[right[i]])) is not None:
                    heappush(queue, (r, i))
            if left[i] >= 0 and (r := get(parts[left[i]] + parts[i])) is not None:
                heappush(queue, (r, left[i]))
        return [self.tokens[p] for p in parts if p]


class Pairs:
    """Merges as arrays, for many short pieces at once: every round merges each piece's lowest pair, the leftmost of them."""

    def __init__(self, pairs: list[tuple[int, int, int, int]], bytes_: list[int]) -> None:
        table = np.array(pairs, np.int64).reshape(-1, 4)
        keys = table[:, 0] << 32 | table[:, 1]
        order = np.argsort(keys)
        self.keys = np.append(keys[order], _LAST)  # never looked for
        self.order = np.append(table[order, 2] << 32 | table[order, 3], _LAST)  # rank, and the token it makes
        self.bytes = np.array(bytes_, np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.order[at], _LAST)

    def merged(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece."""
        sizes = np.array(list(map(len, pieces)), np.int64)
        piece = np.repeat(np.arange(len(pieces)), sizes)
        ids = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        order = np.full(len(ids), _LAST, np.int64)  # of a symbol and the next one of its piece
        inside = np.flatnonzero(piece[1:] == piece[:-1])
        order[inside] = self.find(ids[inside], ids[inside + 1])
        done_ids, done_pieces = [], []
        while len(ids):
            starts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            best = np.minimum.reduceat(order, starts)
            spans = np.diff(np.append(starts, len(ids)))
            if (best == _LAST).any():  # nothing left to merge in these
                over = np.repeat(best == _LAST, spans)
                done_ids.append(ids[over])
                done_pieces.append(piece[over])
                ids, piece, order = ids[~over], piece[~over], order[~over]
                best, spans = best[best != _LAST], spans[best != _LAST]
                if not len(ids):
                    break
            at = np.flatnonzero(order == np.repeat(best, spans))
            at = at[np.append(True, piece[at[1:]] != piece[at[:-1]])]  # the leftmost
            ids[at] = order[at] & 0xFFFFFFFF
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, piece, order = ids[keep], piece[keep], order[keep]
            at = at - np.arange(len(at))
            order[at] = _LAST
            right = at[at + 1 < len(ids)]
            right = right[piece[right] == piece[right + 1]]
            left = at[at > 0] - 1
            left = left[piece[left] == piece[left + 1]]
            both = np.concatenate([right, left])
            order[both] = self.find(ids[both], ids[both + 1])
        if not done_ids:
            return [b""] * len(pieces)
        every, whose = np.concatenate(done_ids), np.concatenate(done_pieces)
        rank = np.argsort(whose, kind="stable")
        packed = every[rank].astype(np.uint32).tobytes()
        ends = (4 * np.cumsum(np.bincount(whose, minlength=len(pieces)))).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _covering(pieces: list[str], length: int) -> list[str]:
    if sum(map(len, pieces)) != length:
        raise ValueError("the expression does not cover the text")
    return pieces


def _lists(packed: list[bytes | None]) -> pa.Array:
    """Runs of packed ids as a column of lists; None is null."""
    ends = np.cumsum([0, *(len(p or b"") // 4 for p in packed)])
    offsets = pa.array(ends, pa.int32(), mask=np.array([*(p is None for p in packed), False]))
    return pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(p or b"" for p in packed), np.uint32).astype(np.int32), pa.int32()))


def encode(docs: DataFrame, bpe: ByteBPE, id_col: str = "doc_id", text_col: str = "text", deal: int = DEAL) -> DataFrame:
    """(id, ids) for each row of ``docs``; ids as an array of int."""
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(bpe)  # a vocabulary file, whatever the documents are
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    is_long = F.char_length("text") > deal

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(held.value.encode_many(batch.column(1).to_pylist()))], ["id", "ids"])

    schema = f"id {id_type}, ids array<int>"
    short = rows.where(~is_long).mapInArrow(whole, schema)
    texts = rows.where(is_long).withColumn("text_hash", F.xxhash64("text"))
    joined = written(_dealt(texts.withColumn("row", F.monotonically_increasing_id()), held, id_type, deal))
    out = short.unionAll(joined.where("ids IS NOT NULL").select("id", "ids"))
    apart = joined.where("ids IS NULL").select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    if not apart.isEmpty():  # that a text's parts do not meet is decided by the text, so all its rows are here
        same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
        out = out.unionAll(texts.join(apart, same, "left_semi").select("id", "text").mapInArrow(whole, schema))
    return out.withColumnRenamed("id", id_col)


def _dealt(texts: DataFrame, held, id_type: str, deal: int) -> DataFrame:
    """(id, text_hash, row, ids) of long texts, part by part; ids are null where parts do not meet."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            for r, text in zip(batch.select(["id", "text_hash", "row"]).to_pylist(), batch.column(1).to_pylist(), strict=True):
                starts = range(0, len(text), deal)
                out = [r | {"k": k, "n": len(starts), "text": text[a : a + deal + OVERLAP]} for k, a in enumerate(starts)]
                yield pa.RecordBatch.from_pylist(out, pa.schema([*map(batch.schema.field, ("id", "text_hash", "row")), ("k", pa.int32()), ("n", pa.int32()), ("text", pa.string())]))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            ids, heads, tails = [], [], []
            for k, n, text in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                one, head, tail = part_tokens(held.value, text, deal, k == 0, k == n - 1)
                ids.append(one)
                heads.append(head)
                tails.append(tail)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], _lists(ids), pa.array(heads, _MARKS), pa.array(tails, _MARKS)], [*batch.schema.names[:5], "ids", "head", "tail"])

    def stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a document at a time
                own = batch.slice(i, 1)
                found = sorted(own.column(3).to_pylist()[0], key=lambda p: p["k"])
                if [p["k"] for p in found] != list(range(found[0]["n"])):
                    raise RuntimeError("parts of a text are missing: its rows were read in another order when a task ran again")
                yield pa.RecordBatch.from_arrays([*own.columns[:3], _lists([joined_up(found)])], [*own.schema.names[:3], "ids"])

    key = f"id {id_type}, text_hash long, row long"
    marks = "array<struct<place:int,token:int>>"
    dealt = texts.select("id", "text", "text_hash", "row").mapInArrow(parts, f"{key}, k int, n int, text string").repartition("row", "k")
    found = dealt.mapInArrow(encoded, f"{key}, k int, n int, ids array<int>, head {marks}, tail {marks}")
    return found.groupBy("id", "text_hash", "row").agg(F.collect_list(F.struct("k", "n", "ids", "head", "tail")).alias("parts")).mapInArrow(stitched, f"{key}, ids array<int>")


_MARKS = pa.list_(pa.struct([("place", pa.int32()), ("token", pa.int32())]))


def part_tokens(bpe: ByteBPE, text: str, deal: int, first: bool, last: bool) -> tuple[bytes, list[dict], list[dict]]:
    """Packed ids of a part, and the boundaries in its first and beyond its last characters with the ids before them."""
    runs = list(bpe.pieces(text))
    look, place, token, out, head, tail = bpe.learned({piece for run in runs for piece in run}), 0, 0, [], [], []
    trusted = len(text) if last or len(text) < deal + OVERLAP else len(text) - MARGIN
    if not first:
        head.append({"place": 0, "token": 0})
    for run in runs:
        for piece in run:
            ids = look(piece)
            out.append(ids)
            place += len(piece)
            token += len(ids) // 4
            if place <= OVERLAP and not first and place <= trusted:
                head.append({"place": place, "token": token})
            if not last and deal <= place <= trusted:
                tail.append({"place": place - deal, "token": token})
    return b"".join(out), head, tail


def joined_up(parts: list[dict]) -> bytes | None:
    """Packed ids of a text from its parts in order; None where two of them have no boundary in common."""
    out, start = [], 0
    for part, following in zip(parts, [*parts[1:], None], strict=True):
        stop, onward = len(part["ids"]), 0
        if following:
            marks = {m["place"]: m["token"] for m in following["head"]}
            meet = next((m for m in part["tail"] if m["place"] in marks and m["token"] >= start), None)
            if meet is None:
                return None
            stop, onward = meet["token"], marks[meet["place"]]
        out.append(array("I", part["ids"][start:stop]).tobytes())
        start = onward
    return b"".join(out)


class TokenBytes:
    """The bytes of every token, one after the other."""

    def __init__(self, tokens: dict[bytes, int]) -> None:
        known = {i: t for t, i in tokens.items()}
        every = [known.get(i, b"") for i in range(max(known, default=-1) + 1)]
        self.sizes = np.array(list(map(len, every)), np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(every), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of runs of ids, and where each run's begin."""
        sizes = self.sizes[ids]
        ends = np.append(0, np.cumsum(sizes))
        place = np.arange(int(ends[-1])) + np.repeat(self.starts[ids] - ends[:-1], sizes)
        return self.data[place], ends[offsets]


def decode(encoded: DataFrame, bpe: ByteBPE, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that its ids stand for, one after the other; null has none."""
    ship(encoded.sparkSession)
    held = encoded.sparkSession.sparkContext.broadcast(TokenBytes(bpe.tokens))
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                own = batch.slice(a, 256)
                lists = own.column(at)
                sizes = np.append(0, pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
                data, starts = held.value.decode(lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes))
                decoded = pa.Array.from_buffers(pa.large_binary(), own.num_rows, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([*own.columns, decoded.cast(pa.binary())], [*own.schema.names, into])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{types}, `{into}` binary")
