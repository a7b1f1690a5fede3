"""Quality classifier: supervised subword embeddings.

Words and the character n-grams within words are hashed to buckets, each with a learned vector; a text is the
mean of its features' vectors, and a softmax layer turns it into the chance of each label. Vectors and
layer are trained together by stochastic gradient descent in numpy.

Training reads a bounded sample: the ``sample`` labelled documents with the smallest hash of their id.
Tasks turn their texts into bucket counts, at most ``buckets`` numbers each, and only these reach the
driver. Scoring is one pass over whole texts without a shuffle: the mean of vectors times a layer is the
mean of one number per bucket, so that a table of ``buckets`` floats is all that a task needs.

Defined cases: a null or empty text has no features and gets the layer's bias alone; labels that are null
are not read, of several labels of an id the smallest counts; of several rows of an id training reads
one, the text with the smallest hash, a null only where there is no text, so repeated documents weigh no
more than others; null ids have no label and teach nothing; labels of one kind only give every text the
same score near it, without labels every score is 0.5; repeated documents are scored one by one; an empty
table gives an empty result; very long texts are read whole; ties among the hashes of ids go to the smaller id, as text;
other columns are ignored. The driver holds ``sample`` times ``buckets`` pairs of numbers at the very most (2 GB with
both as they stand, had every text a feature in every bucket).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._spark import ship
from ._common import NONSPACE, hash_words, mix, runs_of, sliced, smallest_hashes, text_buffer

BUCKETS = 1 << 16
DIMENSIONS = 8
GRAMS = (2, 3, 4)
#: Labelled documents that training reads at most.
SAMPLE = 4000
EPOCHS = 12
BATCH = 32
RATE = 4.0
SEED = 7
CUT = 0.3


def characters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points and row offsets (length rows + 1) of a string column; nulls are empty."""
    data, offsets = text_buffer(column)
    if not len(data) or data.max() < 0x80:
        return data.astype(np.uint32), offsets
    ends = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters before each byte
    return np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32), ends[offsets]


def features(column: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every feature of a slice: each word, and each n-gram of characters without white space."""
    points, offsets = characters(column)
    inside = NONSPACE[np.minimum(points, 0xFF)]
    starts, ends, row = runs_of(inside, offsets)
    found = [hash_words(points, starts, ends)]
    rows = [row]
    wide = points.astype(np.uint64)
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)) if len(points) else np.zeros(0, np.int64)
    for n in GRAMS:
        m = len(points) - n + 1
        if m <= 0:
            continue
        h, ok = np.full(m, n, np.uint64), row_of[:m] == row_of[n - 1 :]
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + wide[k : k + m]
            ok &= inside[k : k + m]
        found.append(mix(h[ok]))
        rows.append(row_of[:m][ok])
    return (np.concatenate(found) % np.uint64(buckets)).astype(np.int64), np.concatenate(rows)


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], buckets: int = BUCKETS) -> tuple[np.ndarray, float]:
    """From (label, buckets, counts) of each example: the log odds of label 1 that each bucket adds, and the bias."""
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (buckets, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    if len({e[0] for e in examples}) < 2:
        only = 0.0 if not examples else 4.0 if examples[0][0] else -4.0
        return np.zeros(buckets, np.float32), only
    steps = EPOCHS * -(-len(examples) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(examples))
        for at in range(0, len(order), BATCH):
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            batch = [examples[i] for i in order[at : at + BATCH]]
            index = np.concatenate([e[1] for e in batch])
            weight = np.concatenate([e[2] / max(e[2].sum(), 1) for e in batch]).astype(np.float32)
            sizes = np.array([len(e[1]) for e in batch])
            which = np.repeat(np.arange(len(batch)), sizes)
            parts = vectors[index] * weight[:, None]
            hidden = np.stack([np.bincount(which, parts[:, d], len(batch)) for d in range(DIMENSIONS)], 1).astype(np.float32)
            logits = hidden @ layer + bias
            chance = np.exp(logits - logits.max(1, keepdims=True))
            chance /= chance.sum(1, keepdims=True)
            error = chance
            error[np.arange(len(batch)), [e[0] for e in batch]] -= 1
            error /= len(batch)
            back = error @ layer.T
            layer -= rate * (hidden.T @ error)
            bias -= rate * error.sum(0)
            for d in range(DIMENSIONS):
                vectors[:, d] -= rate * np.bincount(index, weight * back[which, d] * len(batch), buckets).astype(np.float32)
    return vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, buckets: int = BUCKETS) -> tuple[np.ndarray, float]:
    """Train on the documents whose id ``labels`` has."""
    ship(docs.sparkSession)
    one = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    chosen = smallest_hashes(one, F.col("id").cast("string"), sample)  # ids and labels only
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "id")
    texts = texts.groupBy("id", "label").agg(F.min_by("text", F.struct(F.col("text").isNull(), F.xxhash64("text"), "text")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            bucket, row = features(batch.column(1), buckets)
            order = np.argsort(row, kind="stable")
            bucket, cut = bucket[order], np.searchsorted(row[order], np.arange(batch.num_rows + 1))
            own = [np.unique(bucket[cut[i] : cut[i + 1]], return_counts=True) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0].astype("<i4").tobytes() for x in own], pa.binary()), pa.array([x[1].astype("<i4").tobytes() for x in own], pa.binary())], ["label", "bucket", "n"])

    rows = texts.select("label", "text").mapInArrow(count, "label int, bucket binary, n binary")
    examples = [(int(r[0] > 0), np.frombuffer(r[1], "<i4"), np.frombuffer(r[2], "<i4")) for r in rows.toLocalIterator()]
    examples.sort(key=lambda e: (e[0], len(e[1]), e[1].tobytes(), e[2].tobytes()))  # the same order however tasks end
    return train(examples, buckets)


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): the chance of label 1 for each row."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), model[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds, bias = held.value
        for batch in sliced(batches, "text", 1 << 20):
            bucket, row = features(batch.column(1), len(odds))
            total = np.bincount(row, odds[bucket], batch.num_rows)
            n = np.bincount(row, minlength=batch.num_rows)
            logit = np.clip(total / np.maximum(n, 1) + bias, -50, 50)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-logit)), pa.float64())], ["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)
