"""The given tables as time series, in DataFrames and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as daily readings (series_id, period, realtime_start, value, arrival) of dates up to nine days before."""
    day = F.to_date("ts")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("ev:"), "event_type").alias("series_id"), F.date_sub(day, (F.col("event_id") % 10).cast("int")).alias("period"), day.alias("realtime_start"), "value", F.struct("ts", "event_id").alias("arrival")
    )


def bitemporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings' last value of a day as validity intervals; equal readings open intervals too."""
    daily = readings(spark, sf_dir).groupBy("series_id", "period", "realtime_start").agg(F.max_by(F.struct("value"), "arrival").alias("v"))
    w = Window.partitionBy("series_id", "period").orderBy("realtime_start")
    return daily.select("series_id", "period", "v.value", "realtime_start", F.lead("realtime_start").over(w).alias("realtime_end"))


OBS = """
ev AS (
  SELECT 'ev:' || event_type AS series_id, CAST(ts AS DATE) - CAST(event_id % 10 AS INTEGER) AS period, CAST(ts AS DATE) AS realtime_start, value,
    row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) - CAST(event_id % 10 AS INTEGER), CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS k
  FROM events
),
obs AS (
  SELECT series_id, period, value, realtime_start, lead(realtime_start) OVER (PARTITION BY series_id, period ORDER BY realtime_start) AS realtime_end
  FROM ev WHERE k = 1
)"""


def _monthly(spark: SparkSession, sf_dir: str, by: str, prefix: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").select("c_custkey", by)
    rows = orders.select("o_custkey", "o_orderdate", "o_totalprice").join(customer, orders["o_custkey"] == customer["c_custkey"])
    value = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return rows.groupBy(F.concat(F.lit(prefix), F.col(by).cast("string")).alias("series_id"), F.trunc("o_orderdate", "month").alias("period")).agg(value.alias("value"))


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals by month and market segment."""
    return _monthly(spark, sf_dir, "c_mktsegment", "ord:")


def monthly_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(spark, sf_dir, "c_nationkey", "nat:")


def _monthly_sql(name: str, by: str, prefix: str) -> str:
    return f"""
{name} AS (
  SELECT '{prefix}' || CAST({by} AS VARCHAR) AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS period, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
)"""


MON = _monthly_sql("mon", "c_mktsegment", "ord:")
NAT = _monthly_sql("nat", "c_nationkey", "nat:")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line totals by ship date and return flag."""
    value = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
    return table(spark, sf_dir, "lineitem").groupBy(F.concat(F.lit("li:"), "l_returnflag").alias("series_id"), F.to_date("l_shipdate").alias("period")).agg(value.alias("value"))


DAY = """
day AS (
  SELECT 'li:' || l_returnflag AS series_id, CAST(l_shipdate AS DATE) AS period, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM lineitem GROUP BY 1, 2
)"""

#: Column expressions that Spark and DuckDB read alike.
DIMENSION = {
    "entity_id": "CASE WHEN length(series_id) % 2 = 0 THEN 'north' ELSE 'south' END",
    "concept_id": "'c' || CAST(length(series_id) % 3 AS STRING)",
    "source": "split_part(series_id, ':', 1)",
    "native_id": "split_part(series_id, ':', 2)",
    "title": "'Series of ' || upper(split_part(series_id, ':', 2))",
    "unit": "CASE WHEN series_id LIKE 'ev:%' THEN 'points' ELSE 'currency' END",
    "freq": "CASE WHEN series_id LIKE 'ev:%' OR series_id LIKE 'li:%' THEN 'D' ELSE 'M' END",
    "expected_lag_days": "CASE WHEN length(series_id) % 5 = 4 THEN NULL ELSE CAST(length(series_id) % 7 AS INT) END",
    "redistributable": "length(series_id) % 3 <> 1",
}


def dimension(rows: DataFrame) -> DataFrame:
    """A row for each series, with metadata that follows from its id; its alias is the id with a dash."""
    out = rows.select("series_id").distinct().selectExpr("series_id", *[f"{e} AS {c}" for c, e in DIMENSION.items()])
    return out.withColumn("aliases", F.array(F.concat("source", F.lit("-"), "native_id")))


def dimension_sql(of: str, name: str = "dim") -> str:
    return f"\n{name} AS (SELECT series_id, {', '.join(f'{e} AS {c}' for c, e in DIMENSION.items())}, split_part(series_id, ':', 1) || '-' || split_part(series_id, ':', 2) AS alias FROM (SELECT DISTINCT series_id FROM {of}))"


def concepts(spark: SparkSession) -> DataFrame:
    return spark.range(3).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("concept_id"), F.element_at(F.array(F.lit("sum"), F.lit("mean"), F.lit("last")), (F.col("id") + 1).cast("int")).alias("default_agg"))


CONCEPTS = "\nconcept AS (SELECT * FROM (VALUES ('c0', 'sum'), ('c1', 'mean'), ('c2', 'last')) t(concept_id, default_agg))"


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, period, price, output, rate) by quarter and nation, from order values, order counts and discounts."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    rows = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    n = F.count(F.lit(1)).cast("double")
    return rows.groupBy(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("entity"), F.trunc("o_orderdate", "quarter").alias("period")).agg(
        (total / n).alias("price"), total.alias("output"), (F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).cast("double") / n * 10).alias("rate")
    )


MACRO = """
macro AS (
  SELECT 'n' || CAST(c_nationkey AS VARCHAR) AS entity, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS period,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS price, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS output,
    CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 10 AS rate
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
)"""
