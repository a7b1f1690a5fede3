"""Fixed-schema tables as Parquet, and the SQL surface on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .._spark import exists

# Columns of the tables. A trailing ! marks a column without nulls.
TABLES = {
    "observations": "series_id string!, period date!, value double, realtime_start date!, realtime_end date, observed_at timestamp!, run_id string!",
    "series": "series_id string!, entity_id string!, concept_id string, source string!, native_id string!, title string!, unit string, scale double, freq string!, seasonal_adj boolean, calendar string, source_url string, license string, redistributable boolean, aliases array<string>, method_version string, expected_lag_days int, table string!, domain string!, first_period date, last_period date, last_updated timestamp",
    "entities": "entity_id string!, entity_type string!, name string!, attributes string",
    "runs": "run_id string!, started_at timestamp!, finished_at timestamp, status string!, trigger string!, package_version string, git_sha string, catalog_hash string, n_series int!, n_errors int!",
    "run_series": "run_id string!, series_id string!, source string!, rows_fetched long!, rows_new long!, rows_revised long!, rows_closed long!, raw_sha256 string, error string, duration_ms long!",
    "raw_index": "source string!, series_id string!, run_id string!, fetched_at timestamp!, url string, sha256 string!, bytes long!, path string!, stored boolean!",
    "model_runs": "model_run_id string!, model_id string!, model_version string!, entity_id string, asof date!, seed long!, vintage_kind string!, spec_id string, spec_hash string, params string, git_sha string, package_version string, catalog_hash string, created_at timestamp!",
    "model_outputs": "model_run_id string!, table_name string!, row_ix int!, column_name string!, value_num double, value_txt string",
}
PARTITIONED = {"observations": "source"}


def schema(name: str) -> T.StructType:
    fields = []
    for part in TABLES[name].split(", "):
        column, kind = part.rstrip("!").split(" ")
        fields.append(T.StructField(column, T._parse_datatype_string(kind), not part.endswith("!")))
    return T.StructType(fields)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Exactly the table's columns in order and type; missing nullable ones are null, anything else is an error.

    Columns are checked here. A value that does not fit its column, or a null where none may be, stops the job
    that meets it, so a write leaves the table as it was; ``rejected`` lists such rows.
    """
    want = schema(name)
    extra = set(df.columns) - set(want.names)
    lacking = [f.name for f in want if f.name not in df.columns and not f.nullable]
    if extra or lacking:
        raise ValueError(f"{name}: columns {sorted(extra)} are not known, {lacking} are missing")

    def checked(f: T.StructField) -> Column:
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType)
        given = F.col(f.name)
        refuse = lambda why: F.raise_error(F.lit(f"{name}.{f.name}: {why}")).cast(f.dataType)
        out = given
        if df.schema[f.name].dataType != f.dataType:
            cast = given.try_cast(f.dataType)
            out = F.when(cast.isNull() & given.isNotNull(), refuse(f"not {f.dataType.simpleString()}")).otherwise(cast)
        return out if f.nullable else F.when(given.isNull(), refuse("null")).otherwise(out)

    return df.select(*[checked(f).alias(f.name) for f in want])


def rejected(df: DataFrame, name: str) -> DataFrame:
    """Rows that ``conform`` can't take: (row, reason), for a failed cast or a null in a column without nulls."""
    reasons = []
    for f in schema(name):
        if f.name in df.columns:
            cast = F.col(f.name).try_cast(f.dataType)
            reasons.append(F.when(cast.isNull() & F.col(f.name).isNotNull(), F.lit(f"{f.name}: not {f.dataType.simpleString()}")))
            if not f.nullable:
                reasons.append(F.when(F.col(f.name).isNull(), F.lit(f"{f.name}: null")))
    return df.select(F.to_json(F.struct("*")).alias("row"), F.concat_ws("; ", *reasons).alias("reason")).where("reason <> ''")


def read_table(spark: SparkSession, root: str, name: str, source: str | None = None) -> DataFrame:
    """A table with its fixed schema; one that has not been written yet has no rows."""
    want = schema(name)
    by = PARTITIONED.get(name)
    path = f"{root}/{name}"
    if not exists(spark, path):
        return spark.createDataFrame([], want)
    df = spark.read.schema(T.StructType([*want, T.StructField(by, T.StringType())]) if by else want).parquet(path)
    if source is not None and by:
        df = df.where(F.col(by) == source)
    return df.select(*want.names)


def _writer(df: DataFrame, mode: str, name: str):
    out = df.write.mode(mode).option("compression", "zstd")
    by = PARTITIONED.get(name)
    return out.partitionBy(by).option("partitionOverwriteMode", "dynamic") if by else out


def _with_partition(df: DataFrame, name: str) -> DataFrame:
    out = conform(df, name)
    return out.withColumn(PARTITIONED[name], F.substring_index("series_id", ":", 1)) if name in PARTITIONED else out


def replace_table(df: DataFrame, root: str, name: str) -> None:
    """Replace a table, or, where it is partitioned, the partitions that the rows are in."""
    _writer(_with_partition(df, name), "overwrite", name).parquet(f"{root}/{name}")


def append_table(df: DataFrame, root: str, name: str) -> None:
    _writer(_with_partition(df, name), "append", name).parquet(f"{root}/{name}")


def install_views(observations: DataFrame, others: dict[str, DataFrame] | None = None) -> None:
    """Views of all tables, ``obs_latest``, ``obs_first_release`` and the table function ``obs_asof(day)``."""
    spark = observations.sparkSession
    for name, df in {"observations": observations, **(others or {})}.items():
        df.createOrReplaceTempView(name)
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW obs_latest AS SELECT * FROM observations WHERE realtime_end IS NULL")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY VIEW obs_first_release AS
        SELECT first.* FROM (SELECT min_by(struct(*), realtime_start) AS first FROM observations GROUP BY series_id, period)
    """)
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION obs_asof(day DATE)
        RETURNS TABLE (series_id STRING, period DATE, value DOUBLE, realtime_start DATE, realtime_end DATE)
        RETURN SELECT series_id, period, value, realtime_start, realtime_end FROM observations
        WHERE realtime_start <= day AND (realtime_end IS NULL OR realtime_end > day)
    """)


def query(spark: SparkSession, sql: str, **args) -> DataFrame:
    """SQL on the views, with named parameters."""
    return spark.sql(sql, args=args)
