"""From raw documents to tokens: language, repeated lines, near copies, benchmark passages, token ids.

``STAGES`` are applied in order; each stage's result is written as Parquet and read again as the next
one's documents, and removed once that one's own is written. All but the last return the columns of
``documents``.

Defined cases: a null or empty text, or one without letters, has no known language and goes in the first
stage, so later ones meet none but what the lines' stage empties (an empty text stays, near-duplicate of any
other empty one, never contaminated, with no tokens); a null id is a document like any other, and names a
kept row last; rows that share an id but not their text are judged one by one, and repeated rows are near
copies, of which one stays; very long texts are read whole; ties go to the smallest id and then to the
smallest hash; an empty table gives an empty result, and an empty benchmark drops nothing; other columns,
whatever their names, come through unchanged, but for ``n_chars``, which follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake._spark import new_path, remove, written
from chronolake.llm import bpe, decontaminate, language_id, line_dedup, simhash
from chronolake.llm.queries import tokenizer_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents without a known language go. The filters are learned from the rows' own labels."""
    return language_id.keep_known(docs, language_id.fit(docs))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: long lines of many documents stay in one; n_chars follows the text, and stays where that is null."""
    out = line_dedup.line_dedup(docs, counts=False)
    return out.select(*[F.coalesce(F.char_length("text").cast(docs.schema[c].dataType), c).alias(c) if c == "n_chars" else c for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one document of each group stays, the one with the smallest id.

    Its parameters are the operator's own, three words and three bits: a copy that differs by more bits stays.
    """
    return simhash.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: contaminated documents go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: token ids of each document, and digests of the ids and of the text they decode to."""
    out = bpe.encode_decode(docs, tokenizer_path())
    return out.select(
        "doc_id", F.floor(F.octet_length("ids_le") / 4).cast("long").alias("n_tokens"), "ids_le",
        F.sha2("ids_le", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_copies),
    ("decontaminate", without_benchmark),
    ("bpe", tokens),
]

#: Fingerprints and merges are beyond SQL; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        path = new_path(spark, ".parquet")
        docs = written(stage(spark, docs, sf_dir), path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
