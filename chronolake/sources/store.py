"""The stored observations as a bucketed table, of which a batch writes the touched buckets only.

Rows are bucketed by (series, year of the period) with Spark's own bucketing, so what is joined on series and year
moves and the stored side doesn't, and a series that holds a third of all rows is spread by its years. Each bucket is
also a partition folder below its source, so a dynamic overwrite replaces single buckets and leaves other files alone.
A catalog that forgets tables is told again by ``open_store``: the folder is the whole state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .._spark import exists, remove
from . import tables

BUCKETS = 64
#: Columns that rows are bucketed by; ``year`` is stored beside the table's own columns.
BLOCK = ("series_id", "year")
_PLACE = ("source", "bucket")


@contextmanager
def co_located(spark: SparkSession) -> Iterator[None]:
    """Joins computed inside may use the stored bucketing although they have the period as a key besides."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def year() -> Column:
    return F.year("period").alias("year")


def placed(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows with the year, source and bucket they are stored under; the bucket is the one Spark's bucketing gives."""
    df = df.withColumn("year", year())
    return df.withColumns({"source": F.substring_index("series_id", ":", 1), "bucket": F.pmod(F.hash(*BLOCK), F.lit(buckets)).cast("int")})


def open_store(spark: SparkSession, root: str, buckets: int = BUCKETS) -> str:
    """The name of the table over ``root``/observations, which is registered with the folders that are there.

    A folder that was written with another number of buckets is refused.
    """
    path = f"{root}/observations"
    name = f"observations_{hashlib.sha256(path.encode()).hexdigest()[:16]}_{buckets}"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tables.schema("observations"))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, year int, source string, bucket int) USING parquet OPTIONS (compression 'zstd') PARTITIONED BY (source, bucket) CLUSTERED BY (series_id, year) SORTED BY (series_id, year) INTO {buckets} BUCKETS LOCATION '{path}'")
    if exists(spark, path):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(name)
        wrong = placed(spark.table(name).select("series_id", "period", F.col("bucket").alias("_bucket")).limit(1), buckets).where("bucket <> _bucket")
        if wrong.count():
            raise ValueError(f"{path} was not written with {buckets} buckets")
    return name


def read_blocks(spark: SparkSession, name: str, sources: Sequence[str], only: Sequence[tuple[str, int]] | None = None) -> DataFrame:
    """Stored rows with their year, of some sources or of some (source, bucket); folders of others aren't listed as input."""
    df = spark.table(name)
    df = df.where(F.col("source").isin(list(sources)))
    if only is not None:
        df = df.where(F.concat_ws("/", F.col("source"), F.col("bucket").cast("string")).isin([f"{s}/{b}" for s, b in only]))
    return df.drop(*_PLACE)


def _replace(rows: DataFrame, name: str, touched: Sequence[tuple[str, int]], buckets: int) -> None:
    spark = rows.sparkSession
    kept = {tuple(r) for r in rows.select(*_PLACE).distinct().collect()}  # of the touched buckets
    if kept:
        before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            rows.select(*spark.table(name).columns).repartition(buckets, *BLOCK).write.insertInto(name, overwrite=True)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    for source, bucket in touched:
        if (source, bucket) not in kept:  # a bucket whose last row went
            none = rows.where("false").select(*[c for c in spark.table(name).columns if c not in _PLACE])
            spark.sql(f"INSERT OVERWRITE {name} PARTITION (source = :source, bucket = {bucket}) SELECT * FROM {{none}}", args={"source": source}, none=none)


def replace_blocks(after: DataFrame, root: str, name: str, touched: Sequence[tuple[str, int]], run_id: str, buckets: int = BUCKETS) -> None:
    """Put ``after``, all rows of the ``touched`` buckets, in place of what these hold.

    The rows are written beside the table first: an attempt that is lost while folders are swapped is finished by
    ``recover`` from there.
    """
    spark, staged = after.sparkSession, f"{root}/_staged/{run_id}"
    spark.createDataFrame(list(touched), "source string, bucket int").coalesce(1).write.mode("overwrite").parquet(f"{staged}/touched")
    own = tables.conform(after.drop("year", *_PLACE), "observations")
    placed(own, buckets).write.mode("overwrite").parquet(f"{staged}/rows")
    recover(spark, root, name, run_id, buckets)


def recover(spark: SparkSession, root: str, name: str, run_id: str, buckets: int = BUCKETS) -> None:
    """Finish the replacement that a run has written beside the table in full, if there is one; else forget it."""
    staged = f"{root}/_staged/{run_id}"
    if exists(spark, f"{staged}/rows/_SUCCESS"):
        touched = [tuple(r) for r in spark.read.parquet(f"{staged}/touched").collect()]
        _replace(spark.read.parquet(f"{staged}/rows"), name, touched, buckets)
    if exists(spark, staged):
        remove(spark, staged)
