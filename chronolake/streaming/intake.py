"""Continuous intake: a folder of raw bodies as a stream, parsed and applied to the stored observations batch by batch.

Each day of a batch is one run. Bodies that publish their own vintages are upserted, the others are snapshots of
their day. A series whose body can't be read, is empty, or is refused by a guard keeps its rows as they are, and
the run's tables say why: ``run_series`` has a row for every series, ``raw_index`` one for every body, ``runs`` one
for the run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .._spark import checkpoint
from ..functions.calendar import run_date
from ..functions.values import redact
from ..operators import scd
from ..sources import archive, store, tables

#: A line of a body file: which series, which parser, when it was fetched, and the body.
RAW = "source string, series_id string, freq string, vintaged boolean, fetched_at timestamp, body string"


def read_raw(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(RAW).option("maxFilesPerTrigger", files_per_batch).json(folder)


def diff_parsed(cur: DataFrame, parsed: DataFrame, series: DataFrame, day: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What one day's parsed bodies change: classified periods of snapshots, published vintages that differ, and
    (series_id, rows_fetched, rows_new, rows_revised, rows_closed, error) of each series.

    ``cur`` are stored rows with ``year``; ``series`` has series_id and ``vintaged``; a frame that is read whole is a
    vintage one by this flag. Blocks of a series and year that are equal on both sides are told by their digests and
    not diffed; guards and counts come from the digests and the changes.
    """
    rows = parsed.join(series.select("series_id", F.coalesce("vintaged", F.lit(False)).alias("vintaged")), "series_id").withColumnRenamed("ordinal", "arrival")
    good = rows.where("error IS NULL")
    snapshots, published = checkpoint(scd.normalize_snapshot(good.where("NOT vintaged"))), good.where("vintaged")
    vintages, refused = scd.normalize_vintages(published)
    # a body is taken whole or not at all
    unread = rows.where("error IS NOT NULL").groupBy("series_id").agg(F.min("error").alias("error"))
    empty = series.select("series_id").join(rows.select("series_id").distinct(), "series_id", "left_anti").withColumn("error", F.lit("empty response; no changes applied"))
    bad = refused.groupBy("series_id").agg(F.min("error").alias("error"))
    missing = vintages.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_values")).where((F.col("n") >= scd.LEAST_ALL_MISSING) & (F.col("n_values") == 0))
    bad = bad.unionByName(missing.select("series_id", F.lit("every value is missing").alias("error"))).groupBy("series_id").agg(F.min("error").alias("error"))
    vintages = vintages.join(bad, "series_id", "left_anti").withColumn("year", store.year())
    vintages = checkpoint(scd.vintage_changes(cur, vintages, ["year"]))

    blocks = checkpoint(scd.compare_blocks(cur, snapshots))
    changes = checkpoint(scd.block_changes(cur, snapshots, blocks))
    guarded = checkpoint(scd.block_guards(blocks, changes, day))
    let = lambda df: df.join(guarded, "series_id", "left_anti")
    errors = unread.unionByName(empty).unionByName(bad).unionByName(guarded)
    counts = scd.block_counts(let(blocks), let(changes)).unionByName(scd.counted_vintages(vintages))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    said = series.select("series_id").join(counts, "series_id", "left").join(errors.groupBy("series_id").agg(F.min("error").alias("error")), "series_id", "left")
    moved = vintages.where("new OR revised OR moves").drop("new", "revised", "closes", "moves")
    return let(changes), moved, said.select("series_id", *map(zero, ("rows_fetched", "rows_new", "rows_revised", "rows_closed")), "error")


def _append_once(df: DataFrame, root: str, name: str, run_id: str) -> None:
    """Append a run's rows unless an earlier attempt at the run did."""
    spark = df.sparkSession
    if not tables.read_table(spark, root, name).where(F.col("run_id") == run_id).limit(1).count():
        tables.append_table(df, root, name)


def _apply_day(one: DataFrame, root: str, name: str, day: str, run_id: str, parse: Callable[[DataFrame], DataFrame], buckets: int) -> None:
    spark, now = one.sparkSession, F.lit(day).cast("timestamp")
    newest = checkpoint(one.groupBy("series_id").agg(F.max_by(F.struct(*[c for c in one.columns if c != "series_id"]), "fetched_at").alias("r")).select("series_id", "r.*"))
    parsed = checkpoint(parse(newest))
    sources = [r[0] for r in newest.select(F.substring_index("series_id", ":", 1)).distinct().collect()]  # partitions of the table
    store.recover(spark, root, name, run_id, buckets)
    cur = store.read_blocks(spark, name, sources)
    changes, vintages, said = diff_parsed(cur, parsed, newest, day)
    said = checkpoint(said)

    raw = newest.select("source", "series_id", F.lit(run_id).alias("run_id"), "fetched_at", F.lit("").alias("url"), "body")
    index = archive.raw_index(raw, tables.read_table(spark, root, "raw_index").where(F.col("run_id") != run_id))
    sha = newest.select("series_id", "source", F.sha2(F.col("body").cast("binary"), 256).alias("raw_sha256"))
    _append_once(index, root, "raw_index", run_id)
    _append_once(said.join(sha, "series_id").select(F.lit(run_id).alias("run_id"), *said.columns[:-1], "source", "raw_sha256", redact(F.col("error")).alias("error"), F.lit(0).cast("long").alias("duration_ms")), root, "run_series", run_id)

    keys = changes.select("series_id", "period").unionByName(vintages.select("series_id", "period"))
    touched = [tuple(r) for r in store.placed(keys, buckets).select("source", "bucket").distinct().collect()]  # of the buckets of the sources above
    if touched:
        cur = store.read_blocks(spark, name, sources, touched)
        after = scd.apply_changes(cur, changes, day, run_id, now, ["year"])
        after = scd.upsert_vintages(after, vintages, run_id, now, ["year"])
        store.replace_blocks(after, root, name, touched, run_id, buckets)

    # what a first attempt counted holds, so the summary is of the stored rows
    counted = tables.read_table(spark, root, "run_series").where(F.col("run_id") == run_id)
    summary = scd.run_summary(counted, counted.where("error IS NOT NULL").select("series_id", "error"))
    runs = summary.select(F.lit(run_id).alias("run_id"), now.alias("started_at"), now.alias("finished_at"), "status", F.lit("stream").alias("trigger"), F.col("n_series").cast("int").alias("n_series"), F.col("n_errors").cast("int").alias("n_errors"))
    _append_once(runs, root, "runs", run_id)


def apply_batch(root: str, parse: Callable[[DataFrame], DataFrame], zone: str = "UTC", buckets: int = store.BUCKETS) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch``: the batch's bodies, day by day, become intervals of the table at ``root``.

    A batch that is run again leaves the same rows: snapshots of a day replace what that day opened, and the run's own
    rows are appended once. Only buckets with changes are read again and written, beside the table first and then in
    place; an attempt that was lost in between is finished first.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = store.open_store(spark, root, buckets)
        dated = batch.withColumn("day", run_date(F.col("fetched_at"), zone)).persist()
        try:
            for (day,) in sorted(dated.select("day").distinct().collect()):  # few days in a batch
                with store.co_located(spark):
                    _apply_day(dated.where(F.col("day") == F.lit(day)), root, name, str(day), f"batch-{batch_id}-{day}", parse, buckets)
        finally:
            dated.unpersist()

    return run


def start(spark: SparkSession, folder: str, root: str, checkpoint: str, parse: Callable[[DataFrame], DataFrame], once: bool = True) -> StreamingQuery:
    writer = read_raw(spark, folder).writeStream.foreachBatch(apply_batch(root, parse)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
