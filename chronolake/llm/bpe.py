"""BPE encoding and decoding of whole texts from a tokenizer's JSON file.

The merge list decides how far a symbol can feel what follows it. A token ending somewhere is settled by
the merges that can take a part of it away first, each of a lower rank than the merge it prevents; such
a chain has falling ranks, so its longest reach can be summed rank by rank. That reach is the merge
list's sufficient lookahead, and every token has a reach of its own, which is mostly shorter. A transducer takes
``STEP`` symbols at a time (as many as wait already, if these are more), merges what waits, emits the tokens
whose reach lies within it, and goes on behind them; no more than the lookahead and the longest token can wait for
long. Every word goes through it, and the end of a word empties the window; what came out for words of up to
``SHORT`` bytes is remembered, at most ``REMEMBERED`` of them.

A text streams as well: it is cut before runs of white space into pieces of ``PIECE`` characters or more,
each is normalised and matched word by word, and ids leave in runs of ``RUN``. So beside the text itself and
its results, memory is constant however long a text or a word is (a piece without white space is normalised
whole).

Decoding is a state machine that takes ids as they are emitted and holds the bytes of an unfinished character
at most: for a byte-level decoder it turns bytes into text, replacing ill-formed ones; for a file without a
decoder it joins the tokens by single spaces.

What the file may hold: a normalizer of NFC, white-space replacement and lower-casing, a splitting
expression whose matches are kept and never go on from other characters into white space, byte-level symbols,
an end-of-word suffix, and added tokens that are found in the raw text. Anything else is refused.

Defined cases: null counts as the empty text, which has no tokens and decodes to the empty text;
repeated rows are encoded one by one; null ids are passed through; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._spark import ship
from ._common import sliced

#: Words that a worker remembers at most, and their bytes.
REMEMBERED, SHORT = 400_000, 256
#: Characters of a piece of text, and ids that are emitted at a time.
PIECE, RUN = 1 << 16, 4096
#: Symbols that a transducer takes in at a time.
STEP = 12


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + rest.index(b)) for b in range(256)]


# Letters and numbers (first and last code point) and lower-case forms (first, last, step) that the
# tokenizers library's Unicode tables have beyond those of Python 3.13.
LATER_LETTERS = (
    (0x1C8A, 0x1C8A), (0xA7CD, 0xA7CD), (0xA7DB, 0xA7DB), (0x105C0, 0x105F3), (0x10D4A, 0x10D4F), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
LATER_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
LATER_LOWER = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1),
    (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
)
_LOWER = {c: c + step for a, b, step in LATER_LOWER for c in range(a, b + 1)} | {0x3A3: 0x3C3}
_TO_LOWER = re.compile("[" + "".join(map(chr, _LOWER)) + "]")


#: Texts within the first planes are split with classes cut to those: a class of many ranges is slow to leave.
PLANES = (0x7F, 0xFFFF, sys.maxunicode)


def plane(text: str) -> int:
    return 0x7F if text.isascii() else 0xFFFF if len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text) else sys.maxunicode


@cache
def _class(kind: str, top: int) -> str:
    """Ranges of a regular expression's class for code points of general category L or N up to ``top``."""
    later = LATER_LETTERS if kind == "L" else LATER_NUMBERS
    inside = [unicodedata.category(chr(c))[0] == kind for c in range(top + 1)]
    for a, b in later:
        if a <= top:
            inside[a : b + 1] = [True] * (min(b, top) - a + 1)
    out, start = [], None
    for c, x in enumerate([*inside, False]):
        if x and start is None:
            start = c
        elif not x and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(out)


#: White space as Unicode defines it; \s of Python's own expressions has four control characters more.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


#: Where a text may be cut: before white space that follows something else (at the character before).
_SPACES = re.compile(r"[^\s][\t-\r ]")
_INTO_SPACE = re.compile(r"\S\s")
_PROBE = "".join(f"{x}{gap}" for gap in ("", " ", "  ", "\n", "\t\n ") for x in ("ab", "1", "23", "!", "?!", "it's", "'s", "\u00e9", "\u0636", "\u2014", "a'"))


@cache
def _expression(pattern: str, top: int = sys.maxunicode) -> re.Pattern:
    """A splitting expression with its Unicode classes spelt out, for texts of code points up to ``top``."""
    ranges, inside = {"\\p{L}": _class("L", top), "\\p{N}": _class("N", top), "\\s": _SPACE}, False

    def spell(m: re.Match) -> str:
        nonlocal inside
        if m[0] in ranges:
            return ranges[m[0]] if inside else f"[{ranges[m[0]]}]"
        inside = m[0] == "[" or m[0] != "]" and inside
        return m[0]

    return re.compile(re.sub(r"\\p\{[LN]\}|\\.|[\[\]]", spell, pattern))


_LAST = 1 << 63


class Merges:
    """The merge list over token ids: ranks, results, and the sufficient lookahead in symbols."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(merges):
            self.rank.setdefault((vocab[a], vocab[b]), (r, vocab[a + b]))
        self.order = {p: r << 32 | whole for p, (r, whole) in self.rank.items()}
        self.length = {i: len(t.removesuffix(suffix) if suffix else t) for t, i in vocab.items()}
        self.longest = max(self.length.values(), default=1)
        self.reach: dict[int, int] = {}  # symbols behind a token that it can feel; none for the others
        self.lookahead = self._reach()

    def _reach(self) -> int | None:
        """None if the ranks do not ascend from parts to wholes: then a word's end may matter anywhere."""
        made: dict[int, int] = {}
        for r, whole in self.rank.values():
            if whole in made:
                return None
            made[whole] = r
        inner: dict[int, int] = {}  # reach of what can break a token's right edge before the token is whole
        outer: dict[int, int] = {}  # reach of the merges so far that have the token on their left
        for (a, b), (r, whole) in sorted(self.rank.items(), key=lambda x: x[1]):
            if max(made.get(a, -1), made.get(b, -1)) >= r:
                return None
            behind = max(inner.get(b, 0), outer.get(b, 0))
            inner[whole] = behind
            outer[a] = max(outer.get(a, 0), self.length[b] + behind)
        self.reach = {token: max(inner.get(token, 0), outer.get(token, 0)) for token in {*inner, *outer}}
        return max([0, *self.reach.values()])

    def apply(self, ids: list[int]) -> list[int]:
        """All merges of a run of symbols: lowest rank first, then leftmost."""
        if len(ids) > 48:
            return self._apply_long(ids)
        get, ids = self.order.get, list(ids)
        ranks = [get(p, _LAST) for p in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) != _LAST:
            i = ranks.index(best)
            whole = best & 0xFFFFFFFF
            ids[i : i + 2] = [whole]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], whole), _LAST)
            if i < len(ranks):
                ranks[i] = get((whole, ids[i + 1]), _LAST)
        return ids

    def _apply_long(self, ids: list[int]) -> list[int]:
        rank, ids = self.rank, list(ids)
        left, right = list(range(-1, len(ids) - 1)), [*range(1, len(ids)), -1]
        queue = [(x[0], i, x[1]) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if (x := rank.get(p))]
        heapify(queue)
        while queue:
            r, i, whole = heappop(queue)
            j = right[i]
            if ids[i] < 0 or j < 0 or rank.get((ids[i], ids[j])) != (r, whole):
                continue
            ids[i], ids[j], right[i] = whole, -1, right[j]
            if right[i] >= 0:
                left[right[i]] = i
                if x := rank.get((whole, ids[right[i]])):
                    heappush(queue, (x[0], i, x[1]))
            if left[i] >= 0 and (x := rank.get((ids[left[i]], whole))):
                heappush(queue, (x[0], left[i], x[1]))
        return [x for x in ids if x >= 0]

    def stream(self, symbols: Iterable[int]) -> Iterator[int]:
        """Tokens of a run of symbols, each emitted once it is stable; memory follows the lookahead, not the run."""
        if self.lookahead is None:
            yield from self.apply(list(symbols))
            return
        symbols, window, length, reach = iter(symbols), [], self.length, self.reach.get
        while True:
            step = max(STEP, len(window))
            more = list(islice(symbols, step))
            window += more
            if len(more) < step:
                yield from self.apply(window)
                return
            at, size = 0, len(window)
            for token in self.apply(window):
                if at + length[token] + reach(token, 0) > size:
                    break
                at += length[token]
                yield token
            del window[:at]


class Decoder:
    """Ids to text, piece by piece; ``finish`` gives what is left."""

    def __init__(self, tokens: dict[int, str], byte_level: bool, special: frozenset[int] = frozenset()) -> None:
        self.tokens, self.byte_level, self.special = tokens, byte_level, special
        self.bytes = {s: b for b, s in enumerate(byte_symbols())}
        self.started, self.pending = False, b""

    def feed(self, ids: Iterable[int]) -> str:
        if not self.byte_level:
            text = " ".join(map(self.tokens.__getitem__, ids))
            lead = " " if self.started and text else ""
            self.started |= bool(text)
            return lead + text
        out = []
        for i in ids:
            if i in self.special:
                out += [self.finish(), self.tokens[i]]
            else:
                out.append(self._bytes(bytes(map(self.bytes.__getitem__, self.tokens[i])), False))
        return "".join(out)

    def _bytes(self, more: bytes, last: bool) -> str:
        data = self.pending + more
        self.pending = b""
        if not last:  # an unfinished character of up to 3 bytes may stand at the end
            for k in range(1, min(3, len(data)) + 1):
                lead = data[-k]
                if lead >= 0xC0:
                    if k < (2 if lead < 0xE0 else 3 if lead < 0xF0 else 4):
                        data, self.pending = data[:-k], data[-k:]
                    break
                if lead < 0x80:
                    break
        return data.decode("utf-8", "replace")

    def finish(self) -> str:
        return self._bytes(b"", True)


class _Known(dict):
    """Words and the bytes of the ids that the transducer emits for them."""

    def __init__(self, merges: Merges, inner: list[int], final: list[int]) -> None:
        self.merges, self.inner, self.final = merges, inner, final

    def symbols(self, data: bytes) -> Iterator[int]:
        return chain(map(self.inner.__getitem__, memoryview(data)[:-1]), (self.final[data[-1]],))

    def __missing__(self, word: str) -> bytes:
        data = word.encode("utf-8", "surrogatepass")
        ids = array("I", self.merges.stream(self.symbols(data))).tobytes()
        if len(data) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids


class Tokenizer:
    """What a tokenizer's JSON says, as plain values that can be broadcast."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("only plain BPE models are supported")
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.merges = Merges(self.vocab, [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]], self.suffix)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens have to be found as they are")
        self.steps = [_normal_step(x) for x in _parts(spec["normalizer"], "normalizers")]
        self.expression = None
        for x in _parts(spec["pre_tokenizer"], "pretokenizers"):
            if x["type"] == "Split" and x["behavior"] == "Removed" and x["invert"] and "Regex" in x["pattern"]:
                self.expression = x["pattern"]["Regex"]
            elif x["type"] != "ByteLevel" or x["add_prefix_space"] or x["use_regex"]:
                raise ValueError(f"{x['type']} pre-tokenizer is not supported as it stands")
        if self.expression is None:
            raise ValueError("a splitting expression is needed")
        if any(_INTO_SPACE.search(m[0]) for m in _expression(self.expression).finditer(_PROBE)):
            raise ValueError("words that go on into white space are not supported")
        if spec["decoder"] is not None and spec["decoder"]["type"] != "ByteLevel":
            raise ValueError("only byte-level decoders, or none, are supported")
        self.byte_level = spec["decoder"] is not None
        self._prepared: tuple | None = None

    @classmethod
    def from_file(cls, path: str) -> Tokenizer:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_prepared": None}

    def prepare(self) -> tuple:
        if self._prepared is None:
            symbols = byte_symbols()
            inner = [self.vocab[s] for s in symbols]
            final = [self.vocab[s + self.suffix] for s in symbols]
            added = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
            tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.added.items()}
            self._prepared = added, tokens, _Known(self.merges, inner, final)
        return self._prepared

    def normalize(self, text: str) -> str:
        for kind, *args in self.steps:
            if kind == "NFC":
                text = unicodedata.normalize("NFC", text)
            elif kind == "Lowercase":
                if not text.isascii() and _TO_LOWER.search(text):  # letter by letter: no final sigma
                    text = text.translate(_LOWER)
                text = text.lower()
            elif tuple(args) == (r"\s+", " ") and not any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space of Python's but not of Unicode
                text = f"{' ' if text[:1].isspace() else ''}{' '.join(text.split())}{' ' if text[-1:].isspace() and not text.isspace() else ''}"
            else:
                text = _expression(args[0]).sub(args[1].replace("\\", r"\\"), text)
        return text

    def words(self, text: str) -> Iterator[list[str]]:
        """Runs of words of a text without added tokens, piece by piece."""
        at = 0
        while at < len(text):
            cut = _SPACES.search(text, at + PIECE) if len(text) - at > PIECE else None
            piece = self.normalize(text[at : cut.start() + 1] if cut else text[at:])
            at = cut.start() + 1 if cut else len(text)
            expression = _expression(self.expression, plane(piece))
            if len(piece) <= 2 * PIECE and not expression.groups:
                yield expression.findall(piece)
                continue
            found = expression.finditer(piece)
            while run := [m[0] for m in islice(found, RUN)]:
                yield run

    def stream(self, text: str) -> Iterator[array]:
        """Ids as unsigned 32-bit integers, in runs."""
        added, _, known = self.prepare()
        at = 0
        for found in chain(added.finditer(text) if added else (), (None,)):
            for run in self.words(text[at : found.start()] if found else text[at:] if at else text):
                yield array("I", b"".join(map(known.__getitem__, run)))
            if found:
                yield array("I", (self.added[found[0]],))
                at = found.end()

    def encode(self, text: str) -> array:
        out = array("I")
        for run in self.stream(text):
            out += run
        return out

    def decoder(self) -> Decoder:
        return Decoder(self.prepare()[1], self.byte_level, frozenset(self.added.values()))

    def encode_decode(self, text: str) -> tuple[array, str]:
        """The ids, and the text that a decoder makes of them as they come."""
        ids, machine, out = array("I"), self.decoder(), []
        for run in self.stream(text):
            ids += run
            out.append(machine.feed(run))
        return ids, "".join([*out, machine.finish()])

    def decode(self, ids: Iterable[int]) -> str:
        machine, ids, out = self.decoder(), array("I", ids), []
        for at in range(0, len(ids), RUN):
            out.append(machine.feed(ids[at : at + RUN]))
        return "".join([*out, machine.finish()])


def _parts(x: dict | None, name: str) -> list[dict]:
    return [] if x is None else x[name] if x["type"] == "Sequence" else [x]


def _normal_step(x: dict) -> tuple:
    if x["type"] in ("NFC", "Lowercase"):
        return (x["type"],)
    if x["type"] == "Replace" and "Regex" in x["pattern"]:
        return ("Replace", x["pattern"]["Regex"], x["content"])
    raise ValueError(f"{x['type']} normalizer is not supported")


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids_le, decoded) for each row: the token ids as little-endian unsigned 32-bit integers, and the decoded text.

    The driver reads the file at ``path`` and broadcasts what it says, a few MB for any input.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(Tokenizer.from_file(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = held.value
        for batch in sliced(batches, "text"):
            both = [tokenizer.encode_decode(x.as_py() or "") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_little(x[0]) for x in both], pa.binary()), pa.array([x[1] for x in both], pa.string())], ["id", "ids_le", "decoded"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, ids_le binary, decoded string")
    return out.select(F.col("id").alias(id_col), "ids_le", "decoded")


def _little(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids_le") -> DataFrame:
    """(id, decoded) from the ids that ``encode_decode`` returns; null decodes to the empty text."""
    ship(tokens.sparkSession)
    held = tokens.sparkSession.sparkContext.broadcast(Tokenizer.from_file(path))

    def one(data: bytes | None) -> str:
        ids = array("I", data or b"")
        if sys.byteorder == "big":
            ids.byteswap()
        return held.value.decode(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([one(x.as_py()) for x in batch.column(1)], pa.string())], ["id", "decoded"])

    rows = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    out = rows.mapInArrow(run, f"id {tokens.schema[id_col].dataType.simpleString()}, decoded string")
    return out.select(F.col("id").alias(id_col), "decoded")
