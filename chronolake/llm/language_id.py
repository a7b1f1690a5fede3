"""Language identification by language-bitmask n-gram filters.

Every language has a Bloom filter of the character n-grams of its words. The filters lie bit-sliced: a
slot holds a mask with one bit for each language, so the AND of a gram's slots names all languages that
hold it, in one lookup. A text's grams give each language a popcount; the count expected by chance from
the filter's measured false-positive rate is taken off, and the largest corrected share decides.

The fit reads a bounded sample: at most ``per_language`` labelled documents of each language, those with
the smallest hash of their id. Of several rows of an id and language it reads one, the text with the
smallest hash; without an id each different text is a document. A language's profile is what stands in the
most of its documents: up to ``grams`` n-grams, those of one document only left out unless there are no
others, as with a single document. The profile's size is a parameter of the model, like the sizes of the
n-grams, and bounds the filters: ``slots`` masks. Prediction is one pass over whole texts without a shuffle.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every text when
nothing could be learned (``keep_known`` then keeps texts with letters); null ids neither take places of
the sample nor are left out of it, they are told apart by their texts; ties go to the first language in
alphabetical order; repeated rows are judged one by one; very long texts are read whole, in chunks; an
empty table gives an empty result and teaches nothing; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .._spark import checkpoint, ship
from ._common import mix, sliced, smallest_hashes

UNKNOWN = "und"
SIZES = (2, 3, 4)
#: Labelled documents of a language that the fit reads at most.
PER_LANGUAGE = 2000
#: Size of a language's profile: its grams in most documents.
GRAMS = 6000
SLOTS = 1 << 18
HASHES = 3
#: A text of a known language has this share of grams of it at least.
LEAST_SCORE = 0.3
#: Rows of the sample (language, id and hash) that are broadcast, at most.
SENT_ROWS = 1 << 20
#: Code points worked on at a time.
CHUNK = 1 << 18


def gram_hashes(text: str, sizes: tuple[int, ...] = SIZES) -> Iterator[np.ndarray]:
    """Hashes of the n-grams within words of letters, a space standing at both ends of a word; chunk by chunk.

    A chunk begins with the last characters of the one before, and yields the grams that end behind those: what
    it is cut into changes nothing.
    """
    low, before = text.lower(), np.full(1, 32, np.uint64)
    for at in range(0, len(low), CHUNK):
        points = np.frombuffer(low[at : at + CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.where(_letters(points), points, 32).astype(np.uint64)
        points = np.concatenate([before, points] + ([np.full(1, 32, np.uint64)] if at + CHUNK >= len(low) else []))
        space = points == 32
        for n in sizes:
            first = max(0, len(before) - n + 1)
            own, gap, m = points[first:], space[first:], len(points) - first - n + 1
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            for k in range(n):
                h = h * np.uint64(0x100000001B3) + own[k : k + m]
            ok = ~(gap[:m] & gap[n - 1 : n - 1 + m]) if n <= 3 else np.ones(m, bool)  # with a letter at least
            for k in range(1, n - 1):  # a space only at the ends
                ok &= ~gap[k : k + m]
            yield mix(h[ok])
        before = points[1 - max(sizes) :]


_LETTER = np.zeros(0, bool)


def _letters(points: np.ndarray) -> np.ndarray:
    """Which code points are letters; a table for the basic plane, one look each beyond it."""
    global _LETTER
    if not len(_LETTER):
        _LETTER = np.array([chr(c).isalpha() for c in range(0x10000)])
    out = _LETTER[np.minimum(points, 0xFFFF)]
    for i in np.flatnonzero(points > 0xFFFF):
        out[i] = chr(points[i]).isalpha()
    return out


def _slots_of(hashes: np.ndarray, slots: int, k: int) -> np.ndarray:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([((hashes + np.uint64(i) * step) % np.uint64(slots)).astype(np.int64) for i in range(k)])


class LanguageFilters:
    """Bit-sliced Bloom filters of up to any number of languages, 64 to a mask word."""

    def __init__(self, languages: list[str], masks: np.ndarray, hashes: int) -> None:
        self.languages, self.masks, self.hashes = languages, masks, hashes
        bits = (masks[:, [i // 64 for i in range(len(languages))]] >> np.array([i % 64 for i in range(len(languages))], np.uint64)) & np.uint64(1)
        self.chance = bits.mean(axis=0) ** hashes if languages else np.zeros(0)  # false positives of each filter

    def lookup(self, grams: np.ndarray) -> np.ndarray:
        """The language mask of each gram."""
        slots = _slots_of(grams, len(self.masks), self.hashes)
        out = self.masks[slots[0]]
        for row in slots[1:]:
            out = out & self.masks[row]
        return out

    def shares(self, text: str) -> np.ndarray:
        """For each language the share of the text's grams that it holds, false positives taken off."""
        counts, n = np.zeros(len(self.languages)), 0
        for grams in gram_hashes(text):
            found = self.lookup(grams)
            n += len(grams)
            for i in range(len(self.languages)):
                counts[i] += np.count_nonzero(found[:, i // 64] & np.uint64(1 << (i % 64)))
        return np.clip((counts / max(n, 1) - self.chance) / np.maximum(1 - self.chance, 1e-9), 0, 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        shares = self.shares(text)
        best = int(np.argmax(shares))
        return self.languages[best], float(shares[best])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, grams: int = GRAMS, slots: int = SLOTS, hashes: int = HASHES) -> LanguageFilters:
    """Filters from labelled rows; rows without text or label teach nothing."""
    ship(docs.sparkSession)
    texts = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    texts = texts.withColumn("hash", F.xxhash64("text")).select(F.coalesce("id", F.concat(F.lit("\0"), F.hex("hash"))).alias("id"), "lang", "hash", "text")
    distinct = checkpoint(texts.groupBy("lang", "id").agg(F.min("hash").alias("hash")))
    sample = checkpoint(smallest_hashes(distinct, F.col("id"), per_language, "lang"))  # at most per_language ids a language
    few = sample.count() <= SENT_ROWS  # else both sides are shuffled
    chosen = texts.join(F.broadcast(sample) if few else sample, ["lang", "id", "hash"], "left_semi").groupBy("lang", "id").agg(F.min("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            seen: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = [np.unique(x) for x in gram_hashes(text or "")]
                if own:
                    seen.setdefault(lang, []).append(np.unique(np.concatenate(own)))
            for lang, arrays in seen.items():
                gram, n = np.unique(np.concatenate(arrays), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n, pa.int64())], ["lang", "gram", "n"])

    counts = checkpoint(chosen.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    most = counts.groupBy("lang").agg(F.max("n").alias("most"))
    counts = counts.join(most, "lang").where("n > 1 or most = 1").drop("most")
    salted = counts.withColumn("salt", F.pmod("gram", F.lit(64)))
    order = (F.col("n").desc(), F.col("gram"))
    top = salted.withColumn("k", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("k") <= grams)
    top = top.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("k") <= grams)
    held = checkpoint(top.groupBy("lang").agg(F.collect_list("gram").alias("grams")))  # at most `grams` of them in a row
    languages = sorted(r[0] for r in held.select("lang").collect())
    at = {lang: i for i, lang in enumerate(languages)}
    masks = np.zeros((slots, max(1, -(-len(languages) // 64))), np.uint64)
    for lang, own in held.toLocalIterator():  # by partition, whatever the number of languages
        i = at[lang]
        found = _slots_of(np.array(own, np.int64).view(np.uint64), slots, hashes)
        np.bitwise_or.at(masks[:, i // 64], found.ravel(), np.uint64(1 << (i % 64)))
    return LanguageFilters(languages, masks, hashes)


def predict(docs: DataFrame, filters: LanguageFilters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for each row."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(filters)  # slots x languages / 8 bytes, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in sliced(batches, "text"):
            found = [model.predict(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double")
    return out.select(F.col("id").alias(id_col), "lang_pred", "score")


def keep_known(docs: DataFrame, filters: LanguageFilters, text_col: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of at least ``least``, as they are.

    Without any language learned, the rows whose text has letters.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(filters)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in sliced(batches, text_col):
            texts = batch.column(at).to_pylist()
            if not model.languages:
                yield batch.filter(pa.array([any(map(str.isalpha, x or "")) for x in texts], pa.bool_()))
                continue
            found = [model.predict(x) for x in texts]
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
