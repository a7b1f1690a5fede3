"""License scan: an exact set-similarity join of text blocks with license templates.

A block is a run of consecutive words between blank lines, as long as the template and as many words more as may be
missing from it (or the whole stretch between blank lines, where that is shorter): words that lie scattered over a page
make no notice. It matches where at least ``threshold`` of the template's distinct words stand in it (containment).

The words of all templates are ordered by their frequency in the whole corpus, rarest first. With a need of n of a
template's m words, a matching block holds one of the first m - n + 1, so only these are looked for (prefix filter);
the stretch around one, as far as a block can reach, needs n words at least (length filter); and if the first of the
template's words that it holds is the i-th, from 0, at most m - i can be shared (positional filter). What is left is
counted exactly, by a window that slides over the template's words in the stretch. One more exact check follows: the
words that name the license, which tell kindred notices apart, must be in the block. Stretches that overlap are joined
first, so the work is linear in the length of a text.

Templates are a parameter, a tuple or a frame, and are broadcast, in blocks of about ``TEMPLATE_BYTES``. For each block
the corpus is read twice, for the frequencies (one count for each template word reaches the driver) and for the join;
neither moves texts. From the second block on a scan gives the rows that match, which are joined to the first one's.

Defined cases: a null or empty text has no words and no labels; a null id is passed through; repeated rows
are scanned one by one; very long texts are scanned whole; other columns are ignored; ties in frequency are
ordered by the word; templates without a word match nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._spark import ship, written
from ._common import ALNUM, LOWER, hash_windows, hash_words, sliced, text_buffer, words_of
from .lexical_search import Vocabulary, term_list

THRESHOLD = 0.8
#: Phrases whose places are counted, and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
# Label, text and naming words of notices that are in wide use. All naming words have to be met, one of those that | joins.
TEMPLATES = (
    ("mit", "Released under the MIT License.", "mit"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so", ""),
    ("apache-2", "Licensed under the Apache License, Version 2.0.", "apache 2"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at", "apache"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0.", "cc nc"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "noncommercial"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial", "noncommercial"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3.", "gnu 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "gnu"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ""),
)
#: Bytes of templates in one broadcast.
TEMPLATE_BYTES = 32 << 20
Template = tuple[str, str, str]


def naming_words(names: str | None) -> list[set[bytes]]:
    return [{w.encode() for w in part.split("|")} for part in (names or "").split()]


def template_blocks(templates: tuple[Template, ...] | DataFrame, block_bytes: int = TEMPLATE_BYTES) -> Iterator[tuple[Template, ...]]:
    """Templates with a word, in blocks of about ``block_bytes``; a frame has label, text and names."""
    if isinstance(templates, DataFrame):
        rows = templates.where("label IS NOT NULL AND text IS NOT NULL").select("label", "text", F.coalesce("names", F.lit("")).alias("names")).distinct().orderBy("label", "text", "names")
        found: Iterator[Template] = (tuple(r) for r in rows.toLocalIterator())
    else:
        found = iter(templates)
    block, size = [], 0
    for t in found:
        if term_list(t[1]):
            if block and size + len(t[1].encode()) > block_bytes:
                yield tuple(block)
                block, size = [], 0
            block.append(t)
            size += len(t[1].encode())
    yield tuple(block)


def block_words(templates: tuple[Template, ...]) -> list[bytes]:
    """The words of some templates and of their names."""
    return sorted({w for _, text, names in templates for w in (*term_list(text), *(x for any_of in naming_words(names) for x in any_of))})


def corpus_counts(docs: DataFrame, words: list[bytes], text_col: str = "text") -> np.ndarray:
    """How often each word of the templates stands in the corpus, over all rows."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(words)  # of TEMPLATE_BYTES of templates

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, total = Vocabulary(held.value), np.zeros(len(held.value), np.int64)
        for batch in sliced(batches, "text"):
            data, offsets = text_buffer(batch.column(0))
            low = LOWER[data]
            starts, ends, _ = words_of(low, offsets, ALNUM)
            total += np.bincount(vocabulary.find(low, starts, ends)[1], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["at", "n"])

    out = np.zeros(len(words), np.int64)
    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "at long, n long")
    for at, n in rows.groupBy("at").agg(F.sum("n")).collect():
        out[at] = n
    return out


class TemplateIndex:
    """Templates in corpus order with their prefixes indexed; words are numbers."""

    def __init__(self, templates: tuple[Template, ...], words: list[bytes], counts: np.ndarray, threshold: float) -> None:
        number = {w: i for i, w in enumerate(words)}
        self.vocabulary, self.size = Vocabulary(words), len(words)
        self.labels = [t[0] for t in templates]
        self.words: list[list[int]] = []  # each template's words, rarest first
        self.names: list[list[set[int]]] = []
        self.need: list[int] = []
        self.reach: list[int] = []  # words of a block
        self.prefix: dict[int, list[int]] = {}
        for k, (_, text, names) in enumerate(templates):
            tokens = [number[w] for w in term_list(text)]
            own = sorted(set(tokens), key=lambda w: (counts[w], w))
            need = ceil(threshold * len(own) - 1e-9)
            self.words.append(own)
            self.names.append([{number[w] for w in any_of} for any_of in naming_words(names)])
            self.need.append(need)
            self.reach.append(len(tokens) + len(own) - need)
            for w in own[: len(own) - need + 1]:
                self.prefix.setdefault(w, []).append(k)

    def matches(self, at: np.ndarray, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, float, int, int]]:
        """(template, containment, first word, end word) of joined blocks that match.

        ``at`` and ``word`` are places and numbers of the templates' words among all words, ``low`` and ``high`` the
        stretches between blank lines that they lie in.
        """
        present = np.unique(word).tolist()
        for k in sorted({k for w in present for k in self.prefix.get(w, ())}):
            order, need, reach = self.words[k], self.need[k], self.reach[k]
            rank = np.full(self.size, -1, np.int64)
            rank[order] = np.arange(len(order))
            extra = sorted({w for any_of in self.names[k] for w in any_of} - set(order))
            rank[extra] = len(order) + np.arange(len(extra))
            names = [{int(rank[w]) for w in any_of} for any_of in self.names[k]]
            own = rank[word]
            hints = np.flatnonzero((own >= 0) & (own <= len(order) - need))
            start, stop = np.maximum(at[hints] - reach + 1, low[hints]), np.minimum(at[hints] + reach, high[hints])
            new = np.ones(len(hints), bool)
            new[1:] = start[1:] >= np.maximum.accumulate(stop)[:-1]
            first = np.flatnonzero(new)
            for a, b in zip(start[first].tolist(), np.maximum.reduceat(stop, first).tolist(), strict=True):
                if b - a < need:
                    continue
                i, j = np.searchsorted(at, [a, b])
                some = own[i:j]
                held = np.unique(some[(some >= 0) & (some < len(order))])
                if len(order) - held[0] < need or len(held) < need:
                    continue
                mine = np.flatnonzero(some >= 0)
                yield from ((k, *m) for m in _slid(at[i:j][mine].tolist(), some[mine].tolist(), len(order), len(extra), need, reach, names))


def _slid(places: list[int], ranks: list[int], m: int, extra: int, need: int, reach: int, names: list[set[int]]) -> list[tuple[float, int, int]]:
    """Joined blocks in which ``need`` of ``m`` words and one of each of the names stand, by a sliding window."""
    counts, shared, left = [0] * (m + extra), 0, 0
    out: list[tuple[float, int, int]] = []
    for right, (place, r) in enumerate(zip(places, ranks, strict=True)):
        counts[r] += 1
        shared += r < m and counts[r] == 1
        while place - places[left] >= reach:
            gone = ranks[left]
            counts[gone] -= 1
            shared -= gone < m and counts[gone] == 0
            left += 1
        if shared >= need and all(any(counts[x] for x in any_of) for any_of in names):
            if out and places[left] < out[-1][2]:
                out[-1] = max(out[-1][0], shared / m), out[-1][1], place + 1
            else:
                out.append((shared / m, places[left], place + 1))
    return out


def license_labels(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] | DataFrame = TEMPLATES, phrases: tuple[tuple[str, str], ...] = PHRASES, threshold: float = THRESHOLD, block_bytes: int = TEMPLATE_BYTES) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, matches, score) for each row.

    ``matches`` lists (label, containment, first word, end word) of the joined blocks that meet a template.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    out = more = None
    for block in template_blocks(templates, block_bytes):
        words = block_words(block)
        index = TemplateIndex(block, words, corpus_counts(docs, words, text_col) if words else np.zeros(0, np.int64), threshold)
        held = docs.sparkSession.sparkContext.broadcast(index)  # TEMPLATE_BYTES of templates
        if out is None:
            out = rows.mapInArrow(*_scan(held, phrases, id_type))
        else:
            found = written(rows.mapInArrow(*_scan(held, (), id_type)).where(F.size("matches") > 0).select("id", "text_hash", "matches").distinct())
            held.destroy()
            more = found if more is None else more.unionAll(found)
    if more is not None:  # equal rows of an id have equal matches
        more = more.groupBy(F.col("id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.flatten(F.collect_list("matches")).alias("more"))
        out = out.join(more, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
        out = out.withColumn("matches", F.sort_array(F.concat("matches", F.coalesce("more", F.array().cast(dict(out.dtypes)["matches"])))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(F.array_max("matches.containment"), F.lit(0.0)))
    labels = F.array_sort(F.array_union("base_labels", "matches.label"))
    return out.select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", labels.alias("labels"), "matches", score.alias("score"))


def _scan(held, phrases: tuple[tuple[str, str], ...], id_type: str):
    """A mapInArrow function over (id, text_hash, text): words, places of phrases, and matches of one block of templates."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            data, offsets = text_buffer(batch.column(2))
            found, base, n_words = judged(held.value, phrases, data, offsets, batch.num_rows)
            out = []
            for i in range(batch.num_rows):
                places = base.get(i, [])
                out.append((n_words[i], len(places), min((p for p, _ in places), default=None), max((p for p, _ in places), default=None), sorted({label for _, label in places}), found.get(i, [])))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), _MATCHES)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([x[k] for x in out], t) for k, t in enumerate(types))], ["id", "text_hash", "n_words", "n_base", "first_word", "last_word", "base_labels", "matches"])

    return scan, f"id {id_type}, text_hash long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, matches array<struct<label:string,containment:double,first:long,last:long>>"


_MATCHES = pa.list_(pa.struct([("label", pa.string()), ("containment", pa.float64()), ("first", pa.int64()), ("last", pa.int64())]))


def judged(index: TemplateIndex, phrases: tuple[tuple[str, str], ...], data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[dict[int, list[dict]], dict[int, list[tuple[int, str]]], list[int]]:
    """Matches and places of phrases, by row, and the words of each of ``n`` texts."""
    low = LOWER[data]
    starts, ends, row = words_of(low, offsets, ALNUM)
    first = np.searchsorted(row, np.arange(n + 1))
    base = _phrases(phrases, hash_words(low, starts, ends), low.tobytes(), starts, ends, row) if phrases else {}
    out: dict[int, list[dict]] = {}
    at, word = index.vocabulary.find(low, starts, ends)
    if len(at):
        blank = np.flatnonzero((low[:-1] == 0x0A) & (low[1:] == 0x0A))
        passed = np.searchsorted(blank, starts)  # blank lines before each word
        new = np.flatnonzero((row[1:] != row[:-1]) | (passed[1:] != passed[:-1])) + 1
        edges = np.concatenate([[0], new, [len(starts)]])
        own = np.searchsorted(edges, at, "right") - 1
        for k, share, a, b in index.matches(at, word, edges[own], edges[own + 1]):
            r = int(row[a])
            out.setdefault(r, []).append({"label": index.labels[k], "containment": share, "first": a - int(first[r]), "last": b - int(first[r])})
    for found in out.values():
        found.sort(key=lambda m: (m["label"], m["containment"], m["first"], m["last"]))
    return out, base, np.diff(first).tolist()


def _phrases(phrases, hashes, low: bytes, starts, ends, row) -> dict[int, list[tuple[int, str]]]:
    """(first word, label) of each place of a phrase, by row."""
    out: dict[int, list[tuple[int, str]]] = {}
    for phrase, label in phrases:
        words = phrase.encode().split()
        data = np.frombuffer(phrase.encode(), np.uint8)
        own = hash_words(data, *words_of(data, np.array([0, len(data)]), ALNUM)[:2])
        for i in np.flatnonzero(hash_windows(hashes, len(words)) == hash_windows(own, len(words))[0]).tolist():
            j = i + len(words) - 1
            if row[i] == row[j] and [low[a:b] for a, b in zip(starts[i : j + 1].tolist(), ends[i : j + 1].tolist(), strict=True)] == words:
                r = int(row[i])
                out.setdefault(r, []).append((i - int(np.searchsorted(row, r)), label))
    return out
