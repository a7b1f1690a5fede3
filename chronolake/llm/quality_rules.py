"""Quality rules: counts of a text, and the divergence of its distributions from those of its language.

Two histograms describe a text: shares of character classes, and shares of the most common words of a
language with everything else as one more bin. References are the same histograms summed over all
documents of a language. A text fails where its Jensen-Shannon distance to even the nearest reference is
beyond a threshold; a histogram of too short a text proves nothing and is not compared (guards).

References: tasks count classes and words of their slices, Spark sums them by (language, key), and the
common words are the top of each language, ranked within salted parts first, so no task sorts a whole
language. Every language with ``REFERENCE_CHARS`` characters has a reference of classes, and every one with
``REFERENCE_WORDS`` words one of words, however small its share. They are packed in blocks of ``BLOCK``
languages, about a kilobyte each, and unpacked block by block. Judging is one pass without a shuffle.

Defined cases: a null or empty text has no words and fails the base rules; rows without language teach
nothing but are judged by all references; a text whose own language has no reference is not compared;
without any reference only the base rules decide; repeated rows count as often as they stand there; null ids
are passed through; ties among the common words go to the smaller word; very long texts are read whole; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .._spark import checkpoint, ship
from ._common import sliced

#: Bytes of each character class; a character beyond ASCII counts by its first byte, its other bytes not at all.
CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t\n\x0b\x0c\r",
    "stop": b".,;:?'\"()-",
    "beyond": bytes(range(0xC0, 0x100)),
}
_CLASS_OF = np.full(256, len(CLASSES), np.int64)  # the last class: symbols and controls
for _k, _bytes in enumerate(CLASSES.values()):
    _CLASS_OF[list(_bytes)] = _k
_CONTINUED = slice(0x80, 0xC0)
N_CLASSES = len(CLASSES) + 1
SYMBOLS = b"#*$%&|<>"
EDGES = b".,;:!?\"'()"
WINDOW = 5
COMMON = 50
#: Characters and words of a language from which its counts are a reference.
REFERENCE_CHARS, REFERENCE_WORDS = 5000, 1000
#: Languages whose references a task unpacks at a time.
BLOCK = 1000
#: Jensen-Shannon distances beyond which a text fails, and the characters and words it needs to be compared.
MOST_CLASS_DISTANCE, LEAST_CHARS = 0.25, 250
MOST_WORD_DISTANCE, LEAST_WORDS = 0.3, 50


def n_repeated(words: list[bytes]) -> int:
    """Words that stand in a window of five words found twice or more in the text."""
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    n = len(ids)
    if n <= WINDOW or len(known) == n:
        return 0
    # ranks of pairs, of pairs of pairs, of those and one word: exact, no hashing
    two, pair = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)
    if len(two) == n - 1:
        return 0
    four, quad = np.unique(pair[:-2] * len(two) + pair[2:], return_inverse=True)
    _, five, count = np.unique(quad[:-1] * len(known) + ids[4:], return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[five] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edge)[:n]))


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    points = len(text or "") - sum(map(data.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = Counter(x for x in data.split(b"\n") if x.strip())
    return len(words), points, symbols, sum(lines.values()) - len(lines), n_repeated(words)


def class_counts(data: bytes) -> np.ndarray:
    n = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n[_CONTINUED] = 0
    return np.bincount(_CLASS_OF, weights=n, minlength=N_CLASSES)


def folded(data: bytes) -> list[bytes]:
    return [w.strip(EDGES) for w in data.lower().split()]


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Square root of the Jensen-Shannon divergence in bits: 0 for equal distributions, 1 for disjoint ones.

    ``p`` are counts of a sample; what n draws from ``q`` itself diverge by on average, (bins - 1) / (8 n ln 2),
    is taken off. Distributions lie along the last axis.
    """
    chance = (np.count_nonzero(q, axis=-1) - 1) / (8 * np.log(2) * p.sum(-1))
    p, q = p / p.sum(-1, keepdims=True), q / q.sum(-1, keepdims=True)
    m = (p + q) / 2
    m[m == 0] = 1

    def towards_m(x: np.ndarray) -> np.ndarray:
        return np.sum(x * np.log2(np.where(x > 0, x, m) / m), -1)

    return np.sqrt(np.clip((towards_m(p) + towards_m(q)) / 2 - chance, 0, 1))


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", common: int = COMMON) -> Iterator[tuple[str, np.ndarray, dict[bytes, int]]]:
    """For each language its class counts and the counts of its common words, the rest under the empty word.

    Where the language has too few characters or words, these are zeros or nothing.
    """
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 32 << 20):
            classes: dict[str, np.ndarray] = {}
            words: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                lang, data = lang.as_py(), (text.as_py() or "").encode("utf-8", "surrogatepass")
                classes[lang] = classes.get(lang, 0) + class_counts(data)
                words.setdefault(lang, Counter()).update(folded(data))
            out = [(lang, "class", b"%d" % k, int(n)) for lang, c in classes.items() for k, n in enumerate(c)]
            out += [(lang, "word", w, n) for lang, c in words.items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.string(), pa.binary(), pa.int64()))], ["lang", "kind", "key", "n"])

    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = checkpoint(rows.mapInArrow(count, "lang string, kind string, key binary, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")))
    sums = [F.coalesce(F.sum(F.when((F.col("kind") == "class") & (F.col("key") == F.lit(b"%d" % k)), F.col("n"))), F.lit(0)) for k in range(N_CLASSES)]
    totals = counts.groupBy("lang").agg(F.array(*sums).alias("classes"), F.coalesce(F.sum(F.when(F.col("kind") == "word", F.col("n"))), F.lit(0)).alias("n_words"))
    words = counts.where((F.col("kind") == "word") & (F.length("key") > 0)).withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(64)))
    order = (F.col("n").desc(), F.col("key"))
    top = words.withColumn("k", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("k") <= common)
    top = top.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("k") <= common)
    bins = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "key", "n"))).alias("top"))
    n_chars = F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x)
    found = totals.where((F.col("n_words") >= REFERENCE_WORDS) | (n_chars >= REFERENCE_CHARS)).join(bins, "lang", "left")
    for lang, classes, n_words, own in found.select("lang", "classes", "n_words", "top").toLocalIterator():
        most = {bytes(x["key"]): x["n"] for x in own or []} if n_words >= REFERENCE_WORDS else {}
        enough = sum(classes) >= REFERENCE_CHARS
        yield lang, np.array(classes if enough else [0] * N_CLASSES, float), most and most | {b"": n_words - sum(most.values())}


class Divergence:
    """Distances of a text to the nearest of some references, infinite without one, and the languages that have them."""

    def __init__(self, refs: list[tuple[str, np.ndarray, dict[bytes, int]]]) -> None:
        by_class, by_word = [r for r in refs if r[1].sum()], [r for r in refs if r[2]]
        self.class_langs, self.word_langs = {r[0] for r in by_class}, {r[0] for r in by_word}
        self.classes = np.array([r[1] for r in by_class])
        self.every: dict[bytes, int] = {}
        width = max((len(r[2]) for r in by_word), default=1)
        places = [[self.every.setdefault(w, len(self.every)) for w in r[2] if w] for r in by_word]
        self.places = np.full((len(by_word), width - 1), len(self.every), np.int64)  # the last place is of no word
        self.words = np.zeros((len(by_word), width))
        for i, (own, r) in enumerate(zip(places, by_word, strict=True)):
            self.places[i, : len(own)] = own
            self.words[i, : len(own)] = list(r[2].values())[:-1]
            self.words[i, -1] = r[2][b""]

    def by_class(self, own: np.ndarray) -> float:
        return float(js_distance(own[None], self.classes).min()) if len(self.classes) else np.inf

    def by_word(self, words: list[bytes]) -> float:
        if not len(self.words):
            return np.inf
        seen = np.bincount([i for w in words if (i := self.every.get(w)) is not None], minlength=len(self.every) + 1)
        own = seen[self.places]
        return float(js_distance(np.concatenate([own, len(words) - own.sum(1, keepdims=True)], 1).astype(float), self.words).min())


class References:
    """Blocks of references, packed."""

    def __init__(self, refs: Iterator[tuple[str, np.ndarray, dict[bytes, int]]], size: int = BLOCK) -> None:
        self.blocks: list[bytes] = []
        held = []
        for ref in refs:
            held.append(ref)
            if len(held) == size:
                self.blocks.append(zlib.compress(pickle.dumps(held), 1))
                held = []
        self.blocks.append(zlib.compress(pickle.dumps(held), 1))

    def models(self) -> Iterator[Divergence]:
        return (Divergence(pickle.loads(zlib.decompress(block))) for block in self.blocks)


def distances(texts: list[str | None], langs: list[str | None], models: Iterator[Divergence]) -> list[list[float | None]]:
    """Distances of each text to its nearest references by class and by word; None where a guard applies."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    classes = [class_counts(d) if len(t or "") >= LEAST_CHARS else None for t, d in zip(texts, data, strict=True)]
    words = [w if len(w := folded(d)) >= LEAST_WORDS else None for d in data]
    out = [[np.inf, np.inf] for _ in texts]
    known = [[lang is None, lang is None] for lang in langs]
    for model in models:
        for i, lang in enumerate(langs):
            known[i][0] |= lang in model.class_langs
            known[i][1] |= lang in model.word_langs
            if classes[i] is not None:
                out[i][0] = min(out[i][0], model.by_class(classes[i]))
            if words[i] is not None:
                out[i][1] = min(out[i][1], model.by_word(words[i]))
    return [[x if own and np.isfinite(x) else None for x, own in zip(*pair, strict=True)] for pair in zip(out, known, strict=True)]


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, counts, base_failed, kept, class_distance, word_distance) for each row."""
    held = docs.sparkSession.sparkContext.broadcast(References(references(docs, text_col, lang_col)))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = held.value
        one = list(refs.models()) if len(refs.blocks) == 1 else None
        for batch in sliced(batches, "text"):
            texts = batch.column(1).to_pylist()
            counts = [base_counts(t) for t in texts]
            far = distances(texts, batch.column(2).to_pylist(), one or refs.models())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(5)), *(pa.array([d[k] for d in far], pa.float64()) for k in range(2))],
                ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    out = rows.mapInArrow(judge, f"id {docs.schema[id_col].dataType.simpleString()}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, word_distance double")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    near = (F.coalesce("class_distance", F.lit(0.0)) <= MOST_CLASS_DISTANCE) & (F.coalesce("word_distance", F.lit(0.0)) <= MOST_WORD_DISTANCE)
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & near).alias("kept"), "class_distance", "word_distance")
