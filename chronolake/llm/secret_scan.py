"""Secret scan by a trigram inverted index.

Each rule is a regular expression. From its parsed form a Boolean trigram query is derived: an AND of
groups, a group being an OR of literals, a literal an AND of its trigrams. An expression with more than
literals, classes, groups, alternatives and repeats has no query and reads every row. Documents are indexed in
shards, the slices of a task: a posting bitmap over the shard's rows for every trigram that some query
names. A rule's postings are intersected and only the candidates are verified with the expression;
a rule without a mandatory trigram (plain hexadecimal runs) reads every row. An index sharded like
this needs no shuffle, so the scan is one pass at any size.

Defined cases: a null or empty text has no spans; a null id is passed through; repeated rows are scanned
one by one; any column besides the id and the text is ignored; an empty table gives an empty result; texts
of any length are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .._spark import ship
from ._common import LOWER, sliced, text_buffer

SPANS = "array<struct<kind:string,start:long,end:long>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``at_least`` characters; ``base`` ones are in every report."""

    kind: str
    pattern: str
    group: int = 0
    at_least: int = 0
    base: bool = False


RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    # A run of 16 or more is what is left of [0-9a-f]+ once shorter matches are dropped.
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, True),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("code_host", r"gh[opusr]_[A-Za-z0-9]{36,}"),
    Rule("chat_bot", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

#: Alternatives kept while literals are multiplied out; beyond, the literal is closed.
MOST_ALTERNATIVES = 64


def _fold(char: str) -> str:
    return char.lower() if "A" <= char <= "Z" else char


class _Unknown(Exception):
    """Syntax that the parser below does not read."""


class _Parser:
    """A small reader of expressions: nodes are ("chars", set or None), ("any of", ways) and ("repeat", least, most, nodes).

    Chars of None stand for more characters than are worth multiplying out.
    """

    def __init__(self, pattern: str) -> None:
        self.text, self.at = pattern, 0

    def next(self, expected: str = "") -> str:
        if self.at >= len(self.text) or expected and self.text[self.at] != expected:
            raise _Unknown
        self.at += 1
        return self.text[self.at - 1]

    def sees(self, text: str) -> bool:
        if self.text.startswith(text, self.at):
            self.at += len(text)
            return True
        return False

    def ways(self) -> list[list]:
        out: list[list] = [[]]
        while self.at < len(self.text) and self.text[self.at] != ")":
            if self.sees("|"):
                out.append([])
            else:
                out[-1].append(self.repeated(self.one()))
        return out

    def one(self) -> tuple:
        char = self.next()
        if char == "(":
            if self.text.startswith("?", self.at) and not (self.sees("?:") or self.sees("?i:")):
                raise _Unknown
            ways = self.ways()
            self.next(")")
            return "any of", ways
        if char == "[":
            return "chars", self.char_class()
        if char == ".":
            return "chars", None
        if char in "^$*+?{":
            raise _Unknown
        return "chars", {_fold(self.escaped() if char == "\\" else char)}

    def escaped(self) -> str:
        char = self.next()
        if char == "x":
            return chr(int(self.next() + self.next(), 16))
        if char.isalnum():
            raise _Unknown
        return char

    def char_class(self) -> set[str] | None:
        out, wide = set(), self.sees("^")
        while not self.sees("]"):
            char = self.next()
            first = last = self.escaped() if char == "\\" else char
            if self.text[self.at : self.at + 1] == "-" and self.text[self.at + 1 : self.at + 2] not in ("]", ""):
                self.next()
                char = self.next()
                last = self.escaped() if char == "\\" else char
            if ord(last) - ord(first) >= 8:
                wide = True
            else:
                out |= {_fold(chr(c)) for c in range(ord(first), ord(last) + 1)}
        return None if wide else out

    def repeated(self, node: tuple) -> tuple:
        if self.sees("*"):
            node = ("repeat", 0, None, [node])
        elif self.sees("+"):
            node = ("repeat", 1, None, [node])
        elif self.sees("?"):
            node = ("repeat", 0, 1, [node])
        elif m := re.compile(r"\{(\d+)(,?)(\d*)\}").match(self.text, self.at):
            self.at = m.end()
            node = ("repeat", int(m[1]), int(m[3]) if m[3] else None if m[2] else int(m[1]), [node])
        else:
            return node
        if self.text[self.at : self.at + 1] in ("?", "+"):  # lazy or possessive: the same literals
            self.at += 1
        return node


def _parsed(pattern: str) -> list | None:
    """Nodes of an expression, or None for what is not understood."""
    parser = _Parser(pattern)
    try:
        ways = parser.ways()
    except _Unknown:
        return None
    return None if parser.at < len(pattern) else [("any of", ways)]


class _Query:
    """Literals multiplied out from left to right, closed to a group where they can't go on."""

    def __init__(self) -> None:
        self.current: set[str] = {""}
        self.groups: list[frozenset[str]] = []

    def close(self) -> None:
        if min(map(len, (x.encode() for x in self.current))) >= 3:
            self.groups.append(frozenset(self.current))
        self.current = {""}

    def times(self, strings: set[str]) -> None:
        if len(self.current) * len(strings) > MOST_ALTERNATIVES:
            self.close()
        if len(strings) > MOST_ALTERNATIVES:
            return
        self.current = {a + b for a in self.current for b in strings}

    def walk(self, nodes: list) -> None:
        for kind, *args in nodes:
            if kind == "chars" and args[0]:
                self.times(args[0])
            elif kind == "any of":
                self.branch(args[0])
            elif kind == "repeat":
                self.repeat(*args)
            else:
                self.close()

    def branch(self, ways: list[list]) -> None:
        if len(ways) == 1:
            self.walk(ways[0])
            return
        parts = [_literals(x) for x in ways]
        if all(x is not None for x in parts):
            self.times(set().union(*parts))
            return
        # some way is not a plain set of literals: its best group, or nothing if one way has none
        self.close()
        best = [max(g, key=lambda x: min(map(len, x))) if (g := trigram_groups(x)) else None for x in ways]
        if all(best):
            self.groups.append(frozenset().union(*best))

    def repeat(self, least: int, most: int | None, body: list) -> None:
        strings = _literals(body)
        if least == 0 and most == 1 and strings is not None:
            self.times(strings | {""})
            return
        for _ in range(min(least, 4)):
            self.walk(body)
        if not (least == most and least <= 4 and strings is not None):
            self.close()


def _literals(nodes: list) -> set[str] | None:
    """All strings of an expression, or None if they are not few."""
    q = _Query()
    q.walk(nodes)
    return None if q.groups or q.current == {""} and nodes else q.current


def trigram_groups(pattern: str | list) -> list[frozenset[str]]:
    """The mandatory literals of an expression: each match holds a string of every group. ASCII letters are folded."""
    nodes = _parsed(pattern) if isinstance(pattern, str) else pattern
    if nodes is None:
        return []
    q = _Query()
    q.walk(nodes)
    q.close()
    return q.groups


def _trigrams(text: str) -> list[int]:
    b = text.encode()
    return [b[i] << 16 | b[i + 1] << 8 | b[i + 2] for i in range(len(b) - 2)]


class TrigramIndex:
    """Posting bitmaps of a shard for the trigrams that the rules' queries name."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        self.queries = [[[_trigrams(x) for x in sorted(group)] for group in trigram_groups(r.pattern)] for r in rules]
        self.expressions = [re.compile(r.pattern, re.ASCII) for r in rules]
        self.terms = np.unique(np.array([t for q in self.queries for g in q for x in g for t in x] or [0], np.uint32))
        self.row = {int(t): i for i, t in enumerate(self.terms)}
        self.sieve = np.zeros(1 << 16, bool)
        self.sieve[self._slot(self.terms)] = True

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint32(0x9E3779B1)) >> np.uint32(16)

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A bitmap of rows for each term."""
        out = np.zeros((len(self.terms), len(offsets) - 1), bool)
        if len(data) < 3:
            return out
        low = LOWER[data].astype(np.uint32)
        codes = low[:-2] << np.uint32(16) | low[1:-1] << np.uint32(8) | low[2:]
        at = np.flatnonzero(self.sieve[self._slot(codes)])
        term = np.minimum(np.searchsorted(self.terms, codes[at]), len(self.terms) - 1)
        row = np.searchsorted(offsets, at, "right") - 1
        real = (self.terms[term] == codes[at]) & (at + 3 <= offsets[row + 1])
        out[term[real], row[real]] = True
        return out

    def candidates(self, postings: np.ndarray) -> list[np.ndarray]:
        """Rows that each rule has to be verified on."""
        rows = postings.shape[1]
        out = []
        for query in self.queries:
            hit = np.ones(rows, bool)
            for group in query:
                any_of = np.zeros(rows, bool)
                for literal in group:
                    any_of |= np.logical_and.reduce(postings[[self.row[t] for t in literal]])
                hit &= any_of
            out.append(np.flatnonzero(hit))
        return out

    def scan(self, column: pa.Array) -> list[list[tuple[int, int, int]]]:
        """Spans (start, rule, end) of each row in code points, by start and then rule."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(column))]
        texts: dict[int, str] = {}
        for k, (rule, rows) in enumerate(zip(self.rules, self.candidates(self.postings(*text_buffer(column))), strict=True)):
            for i in map(int, rows):
                if i not in texts:
                    texts[i] = column[i].as_py() or ""
                for m in self.expressions[k].finditer(texts[i]):
                    if len(m[rule.group]) >= rule.at_least:
                        found[i].append((m.start(), k, m.end()))
        return [sorted(x) for x in found]


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, spans): all secrets of each row, as code-point spans by start and then by the order of the rules."""
    ship(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    kinds = [r.kind for r in rules]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TrigramIndex(rules)
        for batch in sliced(batches, "text"):
            spans = [[{"kind": kinds[k], "start": a, "end": b} for a, k, b in row] for row in index.scan(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS)], ["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(scan, f"id {id_type.simpleString()}, spans {SPANS}")
    return out.select(F.col("id").alias(id_col), "spans")


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """(id, text): the texts with every span, overlapping ones as one, replaced by ``mark``; null stays null."""
    ship(docs.sparkSession)
    id_type = docs.schema[id_col].dataType

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TrigramIndex(rules)
        for batch in sliced(batches, "text"):
            texts = []
            for i, row in enumerate(index.scan(batch.column(1))):
                text = batch.column(1)[i].as_py()
                parts, at, cut = [], 0, -1
                for a, _, b in row:
                    if a >= cut:
                        parts += [text[at:a], mark]
                    cut = at = max(b, at)
                texts.append("".join([*parts, text[at:]]) if row else text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(scan, f"id {id_type.simpleString()}, text string").select(F.col("id").alias(id_col), F.col("text").alias(text_col))
