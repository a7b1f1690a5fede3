"""Index of raw bodies: which ones differ from the body their series had before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import path_safe, redact


def raw_index(raw: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Index rows of ``(source, series_id, run_id, fetched_at, url, body)``; ``stored`` is false for a repeated body.

    ``before`` is the index so far; only its latest row of each series is looked at.
    """
    sha = F.sha2(F.col("body").cast("binary"), 256)
    new = raw.select("source", "series_id", "run_id", "fetched_at", redact(F.col("url")).alias("url"), sha.alias("sha256"), F.octet_length("body").cast("long").alias("bytes"), F.concat_ws("/", F.lit("raw"), "source", path_safe(F.col("series_id")), F.concat(sha, F.lit(".gz"))).alias("path"))
    if before is not None:
        last = before.groupBy("series_id").agg(F.max_by("sha256", "fetched_at").alias("last"))
        new = new.join(last, "series_id", "left")
    else:
        new = new.withColumn("last", F.lit(None).cast("string"))
    prev = F.coalesce(F.lag("sha256").over(Window.partitionBy("series_id").orderBy("fetched_at", "run_id")), F.col("last"))
    return new.withColumn("stored", ~F.col("sha256").eqNullSafe(prev)).select("source", "series_id", "run_id", "fetched_at", "url", "sha256", "bytes", "path", "stored")
