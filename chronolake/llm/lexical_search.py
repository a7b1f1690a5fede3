"""Ranked lexical search: the documents of highest score for each query, by MaxScore with bounds of term pairs.

The corpus is cut by documents: every task turns a block of its texts into postings of the queries' terms, with the
impact of a term in a document and the largest impact of each term. For pairs of terms that stand in a query together
the block has intersection lists: the documents of both, with the largest joint impact. A pair's bound is the largest of
the joint one and the two single ones, which is less than the sum of the two where no document has both at their best.
A query's terms are taken in pairs, in falling order of their weight, and read by falling impact; what is left to read
is bounded by the pairs that are left whole and the single terms beside them. Once that cannot lift a document to the
score to beat (the k-th best so far, of this block and those before it in the task), no new document is looked at, and
those at hand are completed by bisection of the remaining lists, and dropped as soon as they cannot get there.

Two passes over the texts, no text is moved: one counts documents, terms and document frequencies, the other searches.
A task returns k rows a query at most, which are ranked in two steps. Queries are not trusted to be few: they are dealt
into blocks of about ``QUERY_BYTES``, each with two passes of its own.

All numbers but the logarithm of a weight are whole. Terms are runs of digits, a-z and characters beyond ASCII, after
A-Z are lower-cased.

Defined cases: a null or empty text has no terms and is never found; a query without terms finds nothing; equal scores
go by ascending id, null ids last, and equal rows get ranks of their own; repeated queries (same id and text) are one,
queries that share an id but not a text are ranked apart; very long texts are indexed whole; other columns are ignored;
empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from heapq import nsmallest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .._spark import ship
from ._common import ALNUM, LOWER, hash_words, sliced, text_buffer, words_of

#: Documents for each query.
TOP = 20
#: Bytes of query texts in one broadcast, and of texts in one block of an index.
QUERY_BYTES, BLOCK_BYTES = 4 << 20, 4 << 20
#: Runs of a query's rows that are ranked before all of them are.
FIRST_RANKS = 64
# Fixed values of the score: a weight's and an impact's scale, and how the length of a document counts.
SCALE, IMPACT, DAMPING, LENGTH = 1000, 1_000_000_000, 12, 25


def term_list(text: str | None) -> list[bytes]:
    data = LOWER[np.frombuffer((text or " ").encode(), np.uint8)]
    starts, ends, _ = words_of(data, np.array([0, len(data)]), ALNUM)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def weight(n_docs: int, df: int) -> int:
    return math.floor(SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Vocabulary:
    """Given words, found among many at once by their hashes; each hit is verified on the bytes."""

    def __init__(self, words: Sequence[bytes]) -> None:
        data = np.frombuffer(b" ".join(words) or b" ", np.uint8)
        starts, ends, _ = words_of(data, np.array([0, len(data)]), ALNUM)
        hashes = hash_words(data, starts, ends)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two words have one hash")
        self.ids, self.data, self.starts, self.sizes = order, data, starts, ends - starts
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.hashes >> np.uint64(44)] = True

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of words that are in the vocabulary, and which they are."""
        if not len(self.hashes) or not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = hash_words(data, starts, ends)
        at = np.flatnonzero(self.sieve[hashes >> np.uint64(44)])
        near = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        same = self.hashes[near] == hashes[at]
        at, word = at[same], self.ids[near[same]]
        fits = ends[at] - starts[at] == self.sizes[word]
        at, word = at[fits], word[fits]
        sizes = self.sizes[word]
        first = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
        equal = data[place + np.repeat(starts[at], sizes)] == self.data[place + np.repeat(self.starts[word], sizes)]
        good = np.logical_and.reduceat(equal, first) if len(first) else np.zeros(0, bool)
        return at[good], word[good]


class Queries:
    """Queries of one block: their ids, their words and how often each stands in each."""

    def __init__(self, rows: list[tuple[object, str | None]]) -> None:
        counts = [Counter(term_list(text)) for _, text in rows]
        self.items = [item for item, _ in rows]
        self.words = sorted({w for c in counts for w in c})
        number = {w: i for i, w in enumerate(self.words)}
        self.terms = [[(number[w], n) for w, n in sorted(c.items())] for c in counts]
        self.vocabulary = Vocabulary(self.words)


class Plan:
    """Queries with their terms' weights: for each query its units, which are pairs of terms, or one term."""

    def __init__(self, queries: Queries, n_docs: int, n_terms: int, df: np.ndarray, pairs: bool = True) -> None:
        self.queries, self.n_docs, self.n_terms = queries, n_docs, n_terms
        self.weights = np.array([weight(n_docs, int(n)) for n in df], np.int64)
        self.units: list[list[tuple[tuple[int, int], ...]]] = []
        for terms in queries.terms:
            own = sorted((t for t in terms if df[t[0]] and self.weights[t[0]]), key=lambda t: (-self.weights[t[0]] * t[1], t[0]))
            step = 2 if pairs else 1
            self.units.append([tuple(sorted(own[i : i + step])) for i in range(0, len(own), step)])
        self.pairs = sorted({u for units in self.units for u in units if len(u) == 2})


class BlockIndex:
    """Postings of a block of texts: documents and impacts by term, the largest impacts, and the pairs' lists."""

    def __init__(self, plan: Plan, column: pa.Array) -> None:
        data, offsets = text_buffer(column)
        low = LOWER[data]
        starts, ends, row = words_of(low, offsets, ALNUM)
        self.n = len(column)
        at, word = plan.queries.vocabulary.find(low, starts, ends)
        key, tf = np.unique(word * self.n + row[at], return_counts=True)
        term, self.docs = key // self.n, key % self.n
        length = 100 - LENGTH + (LENGTH * np.bincount(row, minlength=self.n).astype(np.int64) * plan.n_docs) // max(plan.n_terms, 1)
        tf = tf.astype(np.int64)
        self.impacts = plan.weights[term] * ((IMPACT * tf) // (SCALE * tf + DAMPING * length[self.docs]))
        self.bounds = np.searchsorted(term, np.arange(len(plan.queries.words) + 1))
        self.largest = np.zeros(len(plan.queries.words), np.int64)
        np.maximum.at(self.largest, term, self.impacts)
        self.joint: dict[tuple, tuple[np.ndarray, np.ndarray, int]] = {}
        place = np.full(self.n, -1, np.int64)
        for (s, often_s), (t, often_t) in plan.pairs:
            (docs, own), (others, theirs) = self.postings(s), self.postings(t)
            if len(docs) and len(others):
                place[docs] = np.arange(len(docs))
                both = place[others] >= 0
                impacts = often_s * own[place[others[both]]] + often_t * theirs[both]
                place[docs] = -1
                self.joint[(s, often_s), (t, often_t)] = others[both], impacts, int(impacts.max(initial=0))

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.bounds[term], self.bounds[term + 1]
        return self.docs[a:b], self.impacts[a:b]

    def bound(self, unit: tuple[tuple[int, int], ...]) -> int:
        """The most that a unit can add to a document's score."""
        single = [int(self.largest[t]) * often for t, often in unit]
        return max(*single, self.joint[unit][2]) if unit in self.joint else max(single)

    def search(self, units: list[tuple[tuple[int, int], ...]], k: int, beat: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents that may be among the k best, and their whole scores; and postings that were read.

        ``beat`` is a score that k documents elsewhere have reached; one that is equal may still win by its id.
        """
        partner = {a[0]: b[0] for u in units if u in self.joint for a, b in (u, u[::-1])}
        pair = {t: self.joint[u][2] for u in units if u in self.joint for t, _ in u}
        most = {t: int(self.largest[t]) * often for u in units for t, often in u}
        ordered = sorted(((most[t], t, often) for u in units for t, often in u if most[t] > 0), key=lambda x: (-x[0], x[1]))
        left, beat, read = sum(self.bound(u) for u in units), max(beat, 1), 0
        lefts = []  # what the terms from each one on can add; a pair's bound holds while both are left
        open_ = {t for _, t, _ in ordered}
        for _, t, _ in ordered:
            lefts.append(left)
            open_.discard(t)
            other = partner.get(t)
            left -= max(pair[t], most[t], most[other]) - most[other] if other in open_ else most[t]
        scores, done = np.zeros(self.n, np.int64), 0
        for rest, (_, term, often) in zip(lefts, ordered, strict=True):
            if rest < beat:
                break
            docs, impacts = self.postings(term)
            scores[docs] += often * impacts
            read, done = read + len(docs), done + 1
            if self.n >= k:
                beat = max(beat, int(np.partition(scores, self.n - k)[self.n - k]))
        lefts.append(0)
        found = np.flatnonzero((scores > 0) & (scores + lefts[done] >= beat))
        own = scores[found]
        for rest, (_, term, often) in zip(lefts[done + 1 :], ordered[done:], strict=True):
            if not len(found):
                break
            docs, impacts = self.postings(term)
            at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
            own = own + np.where(docs[at] == found, often * impacts[at], 0)
            read += min(len(found), len(docs))
            if len(found) >= k:
                beat = max(beat, int(np.partition(own, len(own) - k)[len(own) - k]))
            keep = own + rest >= beat
            found, own = found[keep], own[keep]
        keep = own >= beat
        return found[keep], own[keep], read


def _merged(best: list[tuple], scores: np.ndarray, ids: list, k: int) -> list[tuple]:
    """The k best of (-score, id is null, id)."""
    return nsmallest(k, [*best, *((-s, i is None, i) for s, i in zip(scores.tolist(), ids, strict=True))], key=lambda x: x[: 2 if x[1] else 3])


def collection_counts(docs: DataFrame, queries: Queries, text_col: str = "text") -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms with repeats, and the documents of each of the queries' words."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(queries)  # QUERY_BYTES at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        total = np.zeros(len(own.words) + 2, np.int64)
        for batch in sliced(batches, "text"):
            data, offsets = text_buffer(batch.column(0))
            low = LOWER[data]
            starts, ends, row = words_of(low, offsets, ALNUM)
            at, word = own.vocabulary.find(low, starts, ends)
            seen = np.unique(word * batch.num_rows + row[at]) // batch.num_rows
            total[: len(own.words)] += np.bincount(seen, minlength=len(own.words))[: len(own.words)]
            total[-2:] += len(np.unique(row)), len(starts)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["at", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "at long, n long")
    out = np.zeros(len(queries.words) + 2, np.int64)
    for at, n in rows.groupBy("at").agg(F.sum("n")).collect():  # a row for each word of the queries
        out[at] = n
    return int(out[-2]), int(out[-1]), out[:-2]


def query_blocks(queries: DataFrame, item_col: str, item_text_col: str, query_bytes: int) -> list[DataFrame]:
    """Distinct (item, text), dealt into blocks of about ``query_bytes``."""
    rows = queries.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text")).distinct()
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    n = max(1, -(-int(size) // query_bytes))
    return [rows] if n == 1 else [rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b) for b in range(n)]


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", query_bytes: int = QUERY_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item, rank, id, score) of the k documents of highest score above 0 for each query, rank from 1."""
    out = None
    for block in query_blocks(queries, item_col, item_text_col, query_bytes):
        found = _search_block(docs, block, k, id_col, text_col, block_bytes)
        out = found if out is None else out.unionAll(found)
    return out.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _search_block(docs: DataFrame, block: DataFrame, k: int, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    own = Queries(sorted(((r[0], r[1]) for r in block.toLocalIterator()), key=repr))  # query_bytes of them
    held = spark.sparkContext.broadcast(Plan(own, *collection_counts(docs, own, text_col)))
    types = [block.schema["item"].dataType, docs.schema[id_col].dataType]
    item_type, id_type = map(to_arrow_type, types)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = held.value
        best: list[list[tuple]] = [[] for _ in plan.units]
        for batch in sliced(batches, "text", block_bytes):
            index = BlockIndex(plan, batch.column(1))
            ids = batch.column(0)
            for q, units in enumerate(plan.units):
                if units:
                    found, scores, _ = index.search(units, k, -best[q][-1][0] if len(best[q]) == k else 0)
                    if len(found):
                        best[q] = _merged(best[q], scores, ids.take(pa.array(found)).to_pylist(), k)
        out = [(q, plan.queries.items[q], i, -s) for q, rows in enumerate(best) for s, _, i in rows]
        columns = [pa.array([x[c] for x in out], t) for c, t in enumerate((pa.int64(), item_type, id_type, pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["query", "item", "id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = rows.mapInArrow(search, f"query long, item {types[0].simpleString()}, id {types[1].simpleString()}, score long")
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    some = F.row_number().over(Window.partitionBy("query", "part").orderBy(*order))
    near = found.withColumn("part", F.spark_partition_id() % FIRST_RANKS).withColumn("rank", some).where(F.col("rank") <= k)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("item", "rank", "id", "score")
