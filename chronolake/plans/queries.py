"""Queries on the given tables, one for each operator, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .._spark import checkpoint, new_path
from ..functions import calendar, values
from ..operators import audits, backtest, catalog, macro, panels, ranges, regression, results, scd, sweeps, transforms, var, vintages
from ..sources import archive, payloads, store, tables
from . import adapters as A
from . import oracles as O

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
DAY = "2024-01-15"
RUN = "2024-01-20"


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _r(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns or ("value",)})


# reads ------------------------------------------------------------------------------------------------------------

KNOWN = f"realtime_start <= DATE '{DAY}' AND (realtime_end IS NULL OR realtime_end > DATE '{DAY}')"


@query(_with(A.OBS) + "SELECT * FROM obs WHERE realtime_end IS NULL")
def obs_latest(spark, d):
    return vintages.latest(A.bitemporal(spark, d))


@query(_with(A.OBS) + f"SELECT * FROM obs WHERE {KNOWN}")
def obs_asof(spark, d):
    return vintages.as_of(A.bitemporal(spark, d), DAY)


def _days(spark, d) -> DataFrame:
    return A.table(spark, d, "events").select(F.to_date("ts").alias("asof")).distinct()


@query(_with(A.OBS) + """SELECT obs.*, "asof" FROM obs JOIN (SELECT DISTINCT CAST(ts AS DATE) AS "asof" FROM events) ON realtime_start <= "asof" AND (realtime_end IS NULL OR realtime_end > "asof")""")
def obs_asof_grid(spark, d):
    return vintages.as_of_grid(A.bitemporal(spark, d), _days(spark, d))


@query(_with(A.OBS) + "SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY series_id, period ORDER BY realtime_start) = 1")
def obs_first_release(spark, d):
    return vintages.first_release(A.bitemporal(spark, d))


@query(_with(A.OBS) + "SELECT * FROM obs WHERE series_id IN ('ev:click', 'ev:view', 'ev:purchase')")
def obs_history(spark, d):
    return vintages.vintages(A.bitemporal(spark, d), ["ev:click", "ev:view", "ev:purchase"])


@query(_with(A.OBS) + f"SELECT * FROM obs WHERE series_id IN ('ev:click', 'ev:view') AND {KNOWN}")
def obs_of_series(spark, d):
    return vintages.observations(A.bitemporal(spark, d), ["ev:click", "ev:view"], DAY)


@query(_with(A.OBS) + """
SELECT series_id, CAST(sum(n - n_open) AS BIGINT) AS n_revisions, round(avg(abs(now - first)), 6) AS mean_abs_revision
FROM (SELECT series_id, period, count(*) AS n, count(*) FILTER (realtime_end IS NULL) AS n_open, arg_min(value, realtime_start) AS first, max(value) FILTER (realtime_end IS NULL) AS now FROM obs GROUP BY ALL)
GROUP BY series_id""")
def revisions(spark, d):
    return _r(vintages.revisions(A.bitemporal(spark, d)), 6, "mean_abs_revision")


@query(_with(A.OBS) + f"SELECT series_id, count(*) AS n, max(period) AS last_period FROM obs WHERE {KNOWN} GROUP BY series_id")
def sql_obs_asof(spark, d):
    tables.install_views(A.bitemporal(spark, d))
    return tables.query(spark, "SELECT series_id, count(*) AS n, max(period) AS last_period FROM obs_asof(CAST(:day AS DATE)) GROUP BY series_id", day=DAY)


@query("SELECT CAST(0 AS BIGINT) AS n_leaks")
def leakage_zero(spark, d):
    grid = vintages.as_of_grid(A.bitemporal(spark, d), _days(spark, d))
    return vintages.leakage(grid, F.col("asof")).agg(F.count(F.lit(1)).alias("n_leaks"))


_FREQS = "(VALUES ('D'), ('B'), ('W'), ('M'), ('Q'), ('A')) f(freq)"


def _every_freq(spark, d) -> DataFrame:
    days = A.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.withColumn("freq", F.explode(F.array(*map(F.lit, calendar.RANK)))).withColumn("period", calendar.period_start(F.col("day"), "freq"))


_STARTS = f"""p AS (SELECT day, freq, CASE freq WHEN 'D' THEN day WHEN 'B' THEN day - CAST(greatest(isodow(day) - 5, 0) AS INTEGER) WHEN 'W' THEN CAST(date_trunc('week', day) AS DATE)
  WHEN 'M' THEN CAST(date_trunc('month', day) AS DATE) WHEN 'Q' THEN CAST(date_trunc('quarter', day) AS DATE) ELSE CAST(date_trunc('year', day) AS DATE) END AS period
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders), {_FREQS})"""


@query(f"WITH {_STARTS} SELECT day, freq, period, CAST(CASE freq WHEN 'D' THEN period WHEN 'B' THEN period WHEN 'W' THEN period + 6 WHEN 'M' THEN last_day(period) WHEN 'Q' THEN last_day(period + INTERVAL 2 MONTH) ELSE make_date(year(period), 12, 31) END AS DATE) AS ends FROM p")
def period_end_all(spark, d):
    return _every_freq(spark, d).withColumn("ends", calendar.period_end(F.col("period"), "freq"))


@query(f"WITH {_STARTS} SELECT day, freq, period, CAST(CASE freq WHEN 'D' THEN period + 1 WHEN 'B' THEN period + CASE isodow(period) WHEN 5 THEN 3 ELSE 1 END WHEN 'W' THEN period + 7 WHEN 'M' THEN period + INTERVAL 1 MONTH WHEN 'Q' THEN period + INTERVAL 3 MONTH ELSE period + INTERVAL 1 YEAR END AS DATE) AS next FROM p")
def next_period_all(spark, d):
    return _every_freq(spark, d).withColumn("next", calendar.next_period(F.col("period"), "freq"))


_AVAILABLE = "av AS (SELECT series_id, count(DISTINCT realtime_start) > 1 AS has_vintages, min(realtime_start) AS known_since FROM obs GROUP BY 1)"


@query(_with(A.OBS, _AVAILABLE) + "SELECT * FROM av")
def availability(spark, d):
    obs = A.bitemporal(spark, d)
    return vintages.availability(obs, A.dimension(obs))


@query(_with(A.OBS, A.dimension_sql("obs")) + f"SELECT obs.* FROM obs JOIN dim USING (series_id) WHERE realtime_end IS NULL AND period + expected_lag_days <= DATE '{DAY}'")
def pseudo_asof(spark, d):
    obs = A.bitemporal(spark, d)
    return vintages.pseudo_as_of(obs, A.dimension(obs), DAY)[0]


@query(_with(A.OBS, A.dimension_sql("obs")) + "SELECT series_id, 'expected_lag_days is not known' AS error FROM dim WHERE expected_lag_days IS NULL")
def pseudo_asof_errors(spark, d):
    obs = A.bitemporal(spark, d)
    return vintages.pseudo_as_of(obs, A.dimension(obs), DAY)[1]


def _mixed(spark, d) -> tuple[DataFrame, DataFrame]:
    obs = A.bitemporal(spark, d)
    series = A.dimension(obs).withColumn("has_vintages", F.length("series_id") % 2 == 0)
    return obs, series


_MIXED = f"""mix AS (SELECT obs.*, CASE WHEN length(series_id) % 2 = 0 THEN 'true' ELSE 'pseudo' END AS vintage_kind FROM obs JOIN dim USING (series_id)
WHERE CASE WHEN length(series_id) % 2 = 0 THEN {KNOWN} ELSE realtime_end IS NULL AND coalesce(period + expected_lag_days <= DATE '{DAY}', false) END)"""


@query(_with(A.OBS, A.dimension_sql("obs"), _MIXED) + "SELECT * FROM mix")
def mixed_asof(spark, d):
    return vintages.read_as_of(*_mixed(spark, d), DAY, "mixed")


@query(_with(A.OBS, A.dimension_sql("obs"), _MIXED, "n AS (SELECT vintage_kind, count(DISTINCT series_id) AS n FROM mix GROUP BY 1)") + "SELECT string_agg(vintage_kind || ':' || n, ', ' ORDER BY vintage_kind) AS split FROM n")
def vintage_split(spark, d):
    return vintages.describe_split(vintages.read_as_of(*_mixed(spark, d), DAY, "mixed"))


@query(_with(A.OBS) + "SELECT series_id, min(realtime_start) AS known_since FROM obs WHERE length(series_id) % 2 = 1 GROUP BY 1 HAVING min(realtime_start) > DATE '2023-12-31'")
def asof_artefacts(spark, d):
    return vintages.as_of_artefacts(*_mixed(spark, d), "2023-12-31")


# transforms -------------------------------------------------------------------------------------------------------

def _resample_sql(to: str, agg: str, of: str = "day", tail: str = "", digits: int = 4) -> str:
    return f"SELECT series_id, CAST(date_trunc('{to}', period) AS DATE) AS period, round({agg}, {digits}) AS value FROM {of} GROUP BY 1, 2 {tail}"


@query(_with(A.DAY) + _resample_sql("month", "arg_max(value, period)"))
def resample_last(spark, d):
    return _r(transforms.resample(A.daily(spark, d), "D", "M", "last"), 4)


@query(_with(A.DAY) + _resample_sql("week", "avg(value)"))
def resample_mean(spark, d):
    return _r(transforms.resample(A.daily(spark, d), "D", "W", "mean"), 4)


@query(_with(A.DAY) + _resample_sql("quarter", "sum(value)", digits=2))
def resample_sum(spark, d):
    return _r(transforms.resample(A.daily(spark, d), "D", "Q", "sum"), 2)


_COMPLETE = "HAVING last_day(CAST(date_trunc('{0}', period) AS DATE) + INTERVAL {1} MONTH) <= (SELECT last_day(max(period)) FROM mon m WHERE m.series_id = mon.series_id)"


@query(_with(A.MON) + """SELECT series_id, period, value FROM (
SELECT series_id, CAST(date_trunc('year', period) AS DATE) AS period, round((product(1 + (value / 1e8) / 100) - 1) * 100, 6) AS value, max(max(period)) OVER (PARTITION BY series_id) AS last
FROM mon GROUP BY 1, 2) WHERE make_date(year(period), 12, 31) <= last_day(last)""")
def resample_compound(spark, d):
    rows = A.monthly(spark, d).withColumn("value", F.col("value") / 1e8)
    return _r(transforms.resample(rows, "M", "A", "compound"))


@query(_with(A.MON) + """SELECT series_id, period, value FROM (
SELECT series_id, CAST(date_trunc('quarter', period) AS DATE) AS period, round(sum(value), 2) AS value, max(max(period)) OVER (PARTITION BY series_id) AS last
FROM mon GROUP BY 1, 2) WHERE last_day(period + INTERVAL 2 MONTH) <= last_day(last)""")
def resample_drop_tail(spark, d):
    return _r(transforms.resample(A.monthly(spark, d), "M", "Q", "sum"), 2)


@query(_with(A.MON, A.dimension_sql("mon"), A.CONCEPTS) + """SELECT series_id, period, value FROM (
SELECT series_id, CAST(date_trunc('quarter', period) AS DATE) AS period, max(max(period)) OVER (PARTITION BY series_id) AS last,
  round(CASE any_value(default_agg) WHEN 'sum' THEN sum(value) WHEN 'mean' THEN avg(value) ELSE arg_max(value, period) END, 2) AS value
FROM mon JOIN dim USING (series_id) JOIN concept USING (concept_id) GROUP BY 1, 2) WHERE last_day(period + INTERVAL 2 MONTH) <= last_day(last)""")
def resample_default_agg(spark, d):
    rows = A.monthly(spark, d)
    return _r(transforms.resample_by_concept(rows, A.dimension(rows), A.concepts(spark), "Q"), 2)


def _window_sql(expr: str, of: str = "mon") -> str:
    return _with(A.MON) + f"SELECT series_id, period, round({expr}, 6) AS value FROM {of} WINDOW w AS (PARTITION BY series_id ORDER BY period)"


@query(_window_sql("(value / lag(value) OVER w - 1) * 100"))
def mom(spark, d):
    return _r(transforms.transform(A.monthly(spark, d), "mom", "M"))


@query(_window_sql("(value / lag(value, 12) OVER w - 1) * 100"))
def yoy(spark, d):
    return _r(transforms.transform(A.monthly(spark, d), "yoy", "M"))


@query(_with(A.MON) + """, r AS (SELECT series_id, period, (pow(value / lag(value) OVER (PARTITION BY series_id ORDER BY period), 12.0) - 1) * 100 AS v FROM mon),
e AS (SELECT *, CASE WHEN v <> 0 THEN CAST(floor(log10(abs(v))) AS BIGINT) END AS exponent FROM r) SELECT series_id, period, round(v / pow(10.0, exponent), 6) AS mantissa, exponent FROM e""")
def mom_ann(spark, d):
    """Annualised monthly rates span many orders of magnitude: six digits behind the first one, and the power of ten."""
    rows = transforms.transform(A.monthly(spark, d), "mom_ann", "M")
    exponent = F.when(F.col("value") != 0, F.floor(F.log10(F.abs("value"))).cast("long"))
    return rows.withColumn("exponent", exponent).select("series_id", "period", F.round(F.col("value") / F.pow(F.lit(10.0), F.col("exponent")), 6).alias("mantissa"), "exponent")


@query(_window_sql("(ln(value) - ln(lag(value) OVER w)) * 100"))
def log_diff(spark, d):
    return _r(transforms.transform(A.monthly(spark, d), "log_diff", "M"))


@query(_window_sql("(ln(value) - ln(lag(value) OVER w)) * 100 * 12.0"))
def log_diff_ann(spark, d):
    return _r(transforms.transform(A.monthly(spark, d), "log_diff_ann", "M"))


@query(_window_sql("value - lag(value) OVER w"))
def diff(spark, d):
    return _r(transforms.transform(A.monthly(spark, d), "diff", "M"))


@query(_window_sql("lag(value, 3) OVER w"))
def lag(spark, d):
    return _r(transforms.lag(A.monthly(spark, d), 3))


@query(_with(A.MON) + "SELECT series_id, period, round(value / base * 100, 6) AS value FROM mon JOIN (SELECT series_id, value AS base FROM mon WHERE period = DATE '1996-01-01' AND value <> 0) USING (series_id)")
def rebase(spark, d):
    return _r(transforms.rebase(A.monthly(spark, d), "1996-01-01")[0])


@query(_with(A.MON, A.NAT) + "SELECT nat.series_id, period, round(nat.value / (p.value / b.value * 100) * 100, 4) AS value FROM nat JOIN (SELECT * FROM mon WHERE series_id = 'ord:BUILDING' AND value <> 0) p USING (period), (SELECT value FROM mon WHERE series_id = 'ord:BUILDING' AND period = DATE '1996-01-01') b")
def deflate(spark, d):
    prices = A.monthly(spark, d).where("series_id = 'ord:BUILDING'")
    return _r(transforms.deflate(A.monthly_nations(spark, d), prices, "1996-01-01"), 4)


@query(_with(A.MON) + "SELECT series_id, period, CASE WHEN count(value) OVER w = 12 THEN round((product(1 + value / 1e8 / 100) OVER w - 1) * 100, 6) END AS value FROM mon WINDOW w AS (PARTITION BY series_id ORDER BY period ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)")
def rolling_compound(spark, d):
    return _r(transforms.rolling_compound(A.monthly(spark, d).withColumn("value", F.col("value") / 1e8), 12))


@query(SQL["rolling_compound"])
def rolling_compound_in_ranges(spark, d):
    rates = A.monthly(spark, d).withColumn("value", F.col("value") / 1e8)
    return _r(ranges.in_ranges(rates, lambda rows, group: transforms.rolling_compound(rows, 12, group), 11, ranges=64))


@query(SQL["yoy"])
def yoy_in_ranges(spark, d):
    return _r(ranges.in_ranges(A.monthly(spark, d), lambda rows, group: transforms.transform(rows, "yoy", "M", group), 12, ranges=16))


@query(_with(A.MON) + "SELECT series_id, period, round((pow(1 + value / 1e8 / 100, 4.0) - 1) * 100, 6) AS value FROM mon")
def annualised_quarterly(spark, d):
    return _r(A.monthly(spark, d).withColumn("value", values.annualize_quarterly(F.col("value") / 1e8)))


# catalog and panels -----------------------------------------------------------------------------------------------

def _keys(spark, d) -> tuple[DataFrame, DataFrame]:
    rows = A.monthly(spark, d)
    series = A.dimension(rows).withColumn("concept_id", F.concat("concept_id", F.lit("_"), F.lower("native_id")))
    keys = series.select("entity_id", F.col("concept_id").alias("key")).unionAll(series.select("entity_id", "series_id")).unionAll(series.select(F.lit("east"), "series_id")).unionAll(series.select(F.lit("east"), F.lit("none")).distinct())
    return keys, series


_KEYS = "d AS (SELECT series_id, entity_id, concept_id || '_' || lower(native_id) AS concept FROM dim)"


@query(_with(A.MON, A.dimension_sql("mon"), _KEYS) + "SELECT entity_id, concept AS key, series_id FROM d UNION ALL SELECT entity_id, series_id, series_id FROM d")
def resolve(spark, d):
    return catalog.resolve(*_keys(spark, d))[0]


@query(_with(A.MON, A.dimension_sql("mon"), _KEYS) + "SELECT 'east' AS entity_id, series_id AS key, 'series belongs to ' || entity_id AS error FROM d UNION ALL SELECT 'east', 'none', 'unknown key'")
def resolve_errors(spark, d):
    return catalog.resolve(*_keys(spark, d))[1]


@query(_with(A.MON, A.dimension_sql("mon")) + "SELECT alias AS series_id, series_id AS canonical FROM dim UNION ALL SELECT series_id, series_id FROM dim UNION ALL SELECT 'nobody', 'nobody'")
def alias(spark, d):
    series = A.dimension(A.monthly(spark, d))
    ids = series.select(F.explode("aliases").alias("series_id")).unionAll(series.select("series_id")).unionAll(series.select(F.lit("nobody")).distinct())
    return catalog.resolve_alias(ids, series)


@query(_with(A.OBS, A.MON, "every AS (SELECT series_id FROM obs UNION SELECT series_id FROM mon)", A.dimension_sql("every")) + "SELECT series_id, title FROM dim WHERE lower(series_id) LIKE '%ma%' OR lower(title) LIKE '%ma%' OR lower(concept_id) LIKE '%ma%' OR lower(unit) LIKE '%ma%'")
def search(spark, d):
    every = A.bitemporal(spark, d).select("series_id").unionAll(A.monthly(spark, d).select("series_id"))
    return catalog.search(A.dimension(every), "Ma").select("series_id", "title")


@query(_with(A.OBS, A.MON, "every AS (SELECT series_id FROM obs UNION SELECT series_id FROM mon)", A.dimension_sql("every")) + "SELECT series_id, source, freq FROM dim WHERE source = 'ord'")
def list_series(spark, d):
    every = A.bitemporal(spark, d).select("series_id").unionAll(A.monthly(spark, d).select("series_id"))
    return catalog.list_series(A.dimension(every), "ord").select("series_id", "source", "freq")


@query(_with(A.MON, A.dimension_sql("mon")) + "SELECT DISTINCT concept_id FROM dim WHERE entity_id = 'north'")
def concepts_of_entity(spark, d):
    return catalog.concepts(A.dimension(A.monthly(spark, d)), "north")


@query(_with(A.OBS, A.dimension_sql("obs")) + "SELECT series_id, title, min(period) AS first_open, max(period) AS last_open, count(value) AS n_values FROM dim LEFT JOIN (SELECT * FROM obs WHERE realtime_end IS NULL) USING (series_id) GROUP BY 1, 2")
def describe(spark, d):
    obs = A.bitemporal(spark, d)
    return catalog.describe(A.dimension(obs), obs).select("series_id", "title", "first_open", "last_open", "n_values")


_ALIASES = "CASE WHEN series_id = 'nat:2' THEN 'nat:3' WHEN series_id IN ('nat:4', 'nat:5') THEN 'shared' ELSE split_part(series_id, ':', 1) || '-' || split_part(series_id, ':', 2) END"


@query(_with(A.NAT, A.dimension_sql("nat")) + f""", cat AS (SELECT series_id, entity_id, concept_id, {_ALIASES} AS al FROM dim UNION ALL SELECT series_id, entity_id, concept_id, {_ALIASES} FROM dim WHERE series_id = 'nat:6' UNION ALL SELECT 'Bad id', entity_id, concept_id, 'nat-1' FROM dim WHERE series_id = 'nat:1')
SELECT 'repeated id' AS violation, series_id AS subject FROM cat GROUP BY series_id HAVING count(*) > 1
UNION ALL SELECT 'malformed id', series_id FROM cat WHERE NOT regexp_matches(series_id, '^[a-z][a-z0-9_]*:')
UNION ALL SELECT 'alias is an id', al FROM cat WHERE al IN (SELECT series_id FROM cat)
UNION ALL SELECT 'alias of several series', al FROM cat GROUP BY al HAVING count(DISTINCT series_id) > 1
UNION ALL SELECT 'undefined concept', series_id FROM cat WHERE concept_id NOT IN ('c0', 'c1')
UNION ALL SELECT 'undefined entity', series_id FROM cat WHERE entity_id <> 'north'
UNION ALL SELECT 'concept mapped twice', concept_id || '@' || entity_id FROM cat GROUP BY concept_id, entity_id HAVING count(*) > 1""")
def catalog_violations(spark, d):
    """Every kind: an id twice, a malformed one, an alias that is an id, one of two series, and what the ids make up themselves."""
    series = A.dimension(A.monthly_nations(spark, d)).withColumn("aliases", F.array(F.expr(_ALIASES)))
    series = series.unionAll(series.where("series_id = 'nat:6'")).unionAll(series.where("series_id = 'nat:1'").withColumn("series_id", F.lit("Bad id")))
    entities = series.where("entity_id = 'north'").select("entity_id").distinct()
    return catalog.catalog_violations(series, A.concepts(spark).where("concept_id <> 'c2'"), entities)


@query(_with(A.MON, A.NAT) + "SELECT DISTINCT series_id FROM nat")
def missing_ids(spark, d):
    rows = A.monthly(spark, d)
    baseline = rows.select("series_id").unionAll(A.monthly_nations(spark, d).select("series_id")).unionAll(A.dimension(rows).select(F.explode("aliases")))
    return catalog.missing_ids(baseline, A.dimension(rows))


@query("""WITH t AS (SELECT sha256('{"r_comment":"' || r_name || '","r_name":"' || r_name || '","r_regionkey":' || r_regionkey || '}') AS d FROM (SELECT o_orderpriority AS r_name, o_orderkey AS r_regionkey FROM orders)),
h AS (SELECT CAST('0x' || substring(d, 1, 15) AS BIGINT) AS a, CAST('0x' || substring(d, 16, 15) AS BIGINT) AS b FROM t)
SELECT count(*) AS n_rows, CAST(sum(CAST(a AS HUGEINT)) AS VARCHAR) AS sum_a, CAST(sum(CAST(b AS HUGEINT)) AS VARCHAR) AS sum_b FROM h""")
def fingerprint(spark, d):
    """Of texts and whole numbers, which JSON writes alike everywhere."""
    rows = A.table(spark, d, "orders").select(F.col("o_orderkey").alias("r_regionkey"), F.col("o_orderpriority").alias("r_name"), F.col("o_orderpriority").alias("r_comment"))
    return catalog.fingerprint(rows).withColumns({c: F.col(c).cast("string") for c in ("sum_a", "sum_b")})


@query("SELECT url, replace(replace(url, ':', '__'), '/', '__') AS safe FROM pages")
def path_safe(spark, d):
    return A.table(spark, d, "pages").select("url", values.path_safe(F.col("url")).alias("safe"))


@query("SELECT event_type, count(*) AS n FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1")
def entity_attr(spark, d):
    return A.table(spark, d, "events").where(values.attribute(F.col("props"), "k").isNotNull()).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(_with(A.MON) + "SELECT * FROM (SELECT series_id, period, round((value / lag(value, 12) OVER (PARTITION BY series_id ORDER BY period) - 1) * 100, 6) AS value FROM mon) WHERE period BETWEEN DATE '1997-01-01' AND DATE '1998-06-01'")
def get_yoy_trim_last(spark, d):
    rows = A.monthly(spark, d).withColumn("realtime_start", F.lit("2024-01-01").cast("date")).withColumn("realtime_end", F.lit(None).cast("date"))
    series = A.dimension(rows)
    return _r(panels.get(rows, series, A.concepts(spark), series.select("series_id"), "1997-01-01", "1998-06-01", transform="yoy"))


def _current(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"realtime_start": F.lit("2024-01-01").cast("date"), "realtime_end": F.lit(None).cast("date")})


@query(_with(A.MON) + """SELECT series_id, period, value FROM (
SELECT series_id, CAST(date_trunc('quarter', period) AS DATE) AS period, round(avg(value), 2) AS value, max(max(period)) OVER (PARTITION BY series_id) AS last
FROM mon GROUP BY 1, 2) WHERE last_day(period + INTERVAL 2 MONTH) <= last_day(last)""")
def get_mean_of_quarters(spark, d):
    rows = _current(A.monthly(spark, d))
    series = A.dimension(rows)
    return _r(panels.get(rows, series, A.concepts(spark), series.select("series_id"), freq="Q", agg="mean"), 2)


@query(_with(A.MON) + "SELECT series_id, period, round(value, 2) AS value, CASE series_id WHEN 'ord:BUILDING' THEN 'c0_building@north' ELSE 'ord:FURNITURE' END AS label FROM mon WHERE series_id IN ('ord:BUILDING', 'ord:FURNITURE')")
def panel_labels(spark, d):
    """A (concept, entity) pair and a series id, found in the catalog."""
    keys = panels.panel_keys([("c0_building", "north"), "ord:FURNITURE"])
    return _r(panels.label_rows(A.monthly(spark, d), keys, _keys(spark, d)[1]), 2)


_LABELS = ["AUTOMOBILE", "BUILDING", "FURNITURE"]


def _labelled(spark, d) -> DataFrame:
    return A.monthly(spark, d).withColumn("label", F.substring_index("series_id", ":", -1))


_PANEL = "SELECT period, {} FROM mon WHERE series_id IN ({}) GROUP BY period".format(", ".join(f"round(max(value) FILTER (series_id = 'ord:{x}'), 2) AS \"{x}\"" for x in _LABELS), ", ".join(f"'ord:{x}'" for x in _LABELS))


@query(_with(A.MON) + _PANEL)
def panel_outer(spark, d):
    return _r(panels.panel(_labelled(spark, d), _LABELS), 2, *_LABELS)


@query(_with(A.MON) + _PANEL + " HAVING count(*) = 3")
def panel_inner(spark, d):
    return _r(panels.panel(_labelled(spark, d), _LABELS, "inner"), 2, *_LABELS)


@query(_with(A.OBS) + """SELECT "asof", period, round(max(value) FILTER (series_id = 'ev:click'), 6) AS click, round(max(value) FILTER (series_id = 'ev:view'), 6) AS view
FROM obs JOIN (SELECT DISTINCT CAST(ts AS DATE) AS "asof" FROM events) ON realtime_start <= "asof" AND (realtime_end IS NULL OR realtime_end > "asof") WHERE series_id IN ('ev:click', 'ev:view') GROUP BY 1, 2""")
def panel_grid(spark, d):
    obs = A.bitemporal(spark, d)
    labelled = obs.select("series_id").distinct().withColumn("label", F.substring_index("series_id", ":", -1))
    return _r(panels.panel_grid(obs, _days(spark, d), labelled, ["click", "view"]), 6, "click", "view")


@query(_with(A.OBS) + """SELECT DISTINCT "asof", 'none' AS label FROM obs JOIN (SELECT DISTINCT CAST(ts AS DATE) AS "asof" FROM events) ON realtime_start <= "asof" AND (realtime_end IS NULL OR realtime_end > "asof")""")
def missing_inputs(spark, d):
    obs = A.bitemporal(spark, d)
    rows = vintages.as_of_grid(obs, _days(spark, d)).withColumn("label", F.substring_index("series_id", ":", -1))
    requests = spark.range(2).select(F.when(F.col("id") == 0, "none").otherwise("maybe").alias("label"), (F.col("id") == 0).alias("required"))
    return panels.missing_inputs(rows, requests, ["asof"])


@query(_with(A.NAT) + """, s AS (SELECT series_id, unnest(generate_series(min(period)::TIMESTAMP, max(period)::TIMESTAMP, INTERVAL 1 MONTH)) AS p FROM nat WHERE month(period) <> 7 GROUP BY 1)
SELECT series_id, CAST(p AS DATE) AS period, 'hole' AS violation FROM s WHERE NOT EXISTS (SELECT 1 FROM nat WHERE nat.series_id = s.series_id AND nat.period = CAST(p AS DATE) AND month(nat.period) <> 7)""")
def grid_violations(spark, d):
    return panels.grid_violations(A.monthly_nations(spark, d).where(F.month("period") != 7), "M")


# writes -----------------------------------------------------------------------------------------------------------

def _stored(spark, d) -> DataFrame:
    """What was known before the run date, as it stood then."""
    obs = A.bitemporal(spark, d).where(F.col("realtime_start") < F.lit(DAY).cast("date"))
    return obs.withColumn("realtime_end", F.when(F.col("realtime_end") < F.lit(DAY).cast("date"), F.col("realtime_end")))


def _snapshot(spark, d) -> DataFrame:
    """What was current on the run date, without a thirteenth of the periods."""
    rows = vintages.as_of(A.bitemporal(spark, d), RUN).where(F.dayofyear("period") % 13 != 5)
    return rows.select("series_id", "period", "value")


_STORED = f"""stored AS (SELECT series_id, period, value, realtime_start, CASE WHEN realtime_end < DATE '{DAY}' THEN realtime_end END AS realtime_end FROM obs WHERE realtime_start < DATE '{DAY}'),
snap AS (SELECT series_id, period, value FROM obs WHERE realtime_start <= DATE '{RUN}' AND (realtime_end IS NULL OR realtime_end > DATE '{RUN}') AND dayofyear(period) % 13 <> 5),
cl AS (SELECT coalesce(o.series_id, n.series_id) AS series_id, coalesce(o.period, n.period) AS period, o.value AS old, n.value AS new,
  CASE WHEN n.series_id IS NULL THEN 'vanished' WHEN o.series_id IS NULL THEN 'new' WHEN o.value IS NOT DISTINCT FROM n.value OR coalesce(abs(o.value - n.value) <= 1e-12, false) THEN 'keep' ELSE 'changed' END AS class
  FROM (SELECT * FROM stored WHERE realtime_end IS NULL AND series_id IN (SELECT series_id FROM snap)) o FULL JOIN snap n ON o.series_id = n.series_id AND o.period = n.period)"""
_APPLIED = f"""SELECT s.series_id, s.period, s.value, s.realtime_start, CASE WHEN s.realtime_end IS NULL AND c.class IN ('changed', 'vanished') THEN DATE '{RUN}' ELSE s.realtime_end END AS realtime_end
FROM stored s LEFT JOIN cl c ON s.series_id = c.series_id AND s.period = c.period AND c.class IN ('changed', 'vanished')
UNION ALL SELECT series_id, period, new, DATE '{RUN}', NULL FROM cl WHERE class IN ('changed', 'new')"""


@query(_with(A.OBS, _STORED) + _APPLIED)
def snapshot_diff(spark, d):
    return scd.apply_snapshot(_stored(spark, d), _snapshot(spark, d), RUN, guarded=False)[0]


@query(_with(A.OBS, _STORED).replace("FROM (SELECT * FROM stored WHERE realtime_end IS NULL AND", "FROM (SELECT * FROM stored WHERE period >= DATE '2024-01-08' AND realtime_end IS NULL AND").replace("FULL JOIN snap n", "FULL JOIN (SELECT * FROM snap WHERE period >= DATE '2024-01-08') n") + _APPLIED)
def snapshot_window(spark, d):
    cur = _stored(spark, d)
    covers = cur.select("series_id").distinct().withColumn("covers_from", F.lit("2024-01-08").cast("date"))
    return scd.apply_snapshot(cur, _snapshot(spark, d), RUN, covers=covers, guarded=False)[0]


@query(_with(A.OBS, _STORED) + f"SELECT * FROM ({_APPLIED}) WHERE NOT (realtime_start = DATE '{RUN}' AND realtime_end IS NULL) UNION ALL SELECT series_id, period, value + 1, DATE '{RUN}', NULL FROM snap WHERE (series_id, period) IN (SELECT (series_id, period) FROM cl WHERE class IN ('changed', 'new')) UNION ALL SELECT series_id, period, value + 1, DATE '{RUN}', NULL FROM snap WHERE false")
def snapshot_same_day(spark, d):
    """A second run of the day replaces what the first one opened: only those periods change again."""
    once = scd.apply_snapshot(_stored(spark, d), _snapshot(spark, d), RUN, guarded=False)[0]
    again = once.where("realtime_end IS NULL").select("series_id", "period", F.when(F.col("realtime_start") == F.lit(RUN).cast("date"), F.col("value") + 1).otherwise(F.col("value")).alias("value"))
    return scd.apply_snapshot(once, again, RUN, guarded=False)[0]


@query(_with(A.OBS, _STORED.replace("dayofyear(period) % 13 <> 5", "(length(series_id) % 2 = 0 OR dayofyear(period) % 2 = 0)")) + """SELECT series_id, 'too many periods vanished' AS error FROM cl GROUP BY 1
HAVING count(*) FILTER (class = 'vanished') > 0 AND (count(*) FILTER (class = 'vanished') = count(*) FILTER (class <> 'new') OR count(*) FILTER (class = 'vanished') > greatest(10, 0.5 * count(*) FILTER (class <> 'new')))""")
def snapshot_guards(spark, d):
    inc = vintages.as_of(A.bitemporal(spark, d), RUN).where((F.length("series_id") % 2 == 0) | (F.dayofyear("period") % 2 == 0)).select("series_id", "period", "value")
    return scd.snapshot_guards(_stored(spark, d), inc, RUN)


@query(_with(A.OBS) + f"SELECT series_id, 'every value is missing' AS error FROM obs WHERE realtime_start <= DATE '{RUN}' AND (realtime_end IS NULL OR realtime_end > DATE '{RUN}') AND length(series_id) % 2 = 1 GROUP BY 1 HAVING count(*) >= 12")
def snapshot_guard_missing(spark, d):
    inc = vintages.as_of(A.bitemporal(spark, d), RUN).select("series_id", "period", F.when(F.length("series_id") % 2 == 0, F.col("value")).alias("value"))
    return scd.snapshot_guards(_stored(spark, d), inc, RUN)


@query(_with(A.OBS) + f"SELECT series_id, 'run date before a stored vintage' AS error FROM obs GROUP BY 1 HAVING greatest(max(realtime_start), max(realtime_end)) > DATE '{DAY}'")
def snapshot_guard_late(spark, d):
    obs = A.bitemporal(spark, d)
    return scd.snapshot_guards(obs, vintages.latest(obs).select("series_id", "period", "value"), DAY)


@query("SELECT 'ev:' || event_type AS series_id, CAST(ts AS DATE) - CAST(event_id % 10 AS INTEGER) AS period, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) - CAST(event_id % 10 AS INTEGER) ORDER BY ts DESC, event_id DESC) = 1")
def normalize_snapshot(spark, d):
    return scd.normalize_snapshot(A.readings(spark, d))


def _published(spark, d) -> DataFrame:
    """Vintages as published: open ends are the last day of the calendar, and some intervals are empty."""
    end = F.when(F.dayofyear("period") % 7 == 3, F.col("realtime_start")).otherwise(F.coalesce("realtime_end", F.lit("9999-12-31").cast("date")))
    return A.bitemporal(spark, d).withColumns({"realtime_end": end, "arrival": F.lit(1)})


@query(_with(A.OBS) + "SELECT * FROM obs WHERE dayofyear(period) % 7 <> 3")
def normalize_vintages(spark, d):
    return scd.normalize_vintages(_published(spark, d))[0]


@query(_with(A.OBS) + "SELECT series_id, period, realtime_start, 'empty validity interval' AS error FROM obs WHERE dayofyear(period) % 7 = 3")
def refused_vintages(spark, d):
    return scd.normalize_vintages(_published(spark, d))[1].select("series_id", "period", "realtime_start", "error")


@query(_with(A.OBS, _STORED) + "SELECT series_id, count(*) FILTER (class <> 'vanished') AS rows_fetched, count(*) FILTER (class = 'new') AS rows_new, count(*) FILTER (class = 'changed') AS rows_revised, count(*) FILTER (class IN ('changed', 'vanished')) AS rows_closed FROM cl GROUP BY 1")
def diff_counts(spark, d):
    return scd.diff_counts(scd.classify(_stored(spark, d), _snapshot(spark, d)))


@query(_with(A.OBS, _STORED) + "SELECT coalesce(s.series_id, o.series_id) AS series_id, coalesce(s.period, o.period) AS period, CASE WHEN o.series_id IS NOT NULL THEN o.value ELSE s.value END AS value, coalesce(s.realtime_start, o.realtime_start) AS realtime_start, CASE WHEN o.series_id IS NOT NULL THEN o.realtime_end ELSE s.realtime_end END AS realtime_end FROM stored s FULL JOIN (SELECT * FROM obs WHERE realtime_start >= DATE '2024-01-05') o ON s.series_id = o.series_id AND s.period = o.period AND s.realtime_start = o.realtime_start")
def vintage_upsert(spark, d):
    inc = A.bitemporal(spark, d).where("realtime_start >= DATE '2024-01-05'")
    return scd.upsert_vintages(_stored(spark, d), inc)


@query(_with(A.OBS, _STORED) + "SELECT o.series_id, count(*) AS rows_fetched, count(*) FILTER (s.series_id IS NULL) AS rows_new, CAST(0 AS BIGINT) AS rows_revised, count(*) FILTER (s.series_id IS NOT NULL AND s.realtime_end IS NULL AND o.realtime_end IS NOT NULL) AS rows_closed FROM obs o LEFT JOIN stored s ON s.series_id = o.series_id AND s.period = o.period AND s.realtime_start = o.realtime_start GROUP BY 1")
def vintage_counts(spark, d):
    return scd.vintage_counts(_stored(spark, d), A.bitemporal(spark, d))


def _monthly_store(spark, d) -> DataFrame:
    start = F.lit("2024-01-01").cast("date")
    return A.monthly(spark, d).select("series_id", "period", "value", start.alias("realtime_start"), F.lit(None).cast("date").alias("realtime_end"), start.cast("timestamp").alias("observed_at"), F.lit("first").alias("run_id"))


def _revised_months(spark, d) -> DataFrame:
    """All months, of which some of 1998 are revised and one of 1997 is gone."""
    rows = A.monthly(spark, d).where("NOT (year(period) = 1997 AND month(period) = 6)")
    return rows.select("series_id", "period", F.when(F.expr("year(period) = 1998 AND month(period) % 3 = 1"), F.col("value") + 1).otherwise(F.col("value")).alias("value"))


_REVISED = "revised AS (SELECT series_id, period, CASE WHEN year(period) = 1998 AND month(period) % 3 = 1 THEN value + 1 ELSE value END AS value FROM mon WHERE NOT (year(period) = 1997 AND month(period) = 6))"


@query(_with(A.MON, _REVISED) + """SELECT coalesce(s.series_id, n.series_id) AS series_id, CAST(year(coalesce(s.period, n.period)) AS INTEGER) AS year, count(s.period) AS n_stored, count(n.period) AS n_fetched, bool_or(s.period IS NULL OR n.period IS NULL OR s.value IS DISTINCT FROM n.value) AS differs
FROM mon s FULL JOIN revised n ON s.series_id = n.series_id AND s.period = n.period GROUP BY 1, 2""")
def compare_blocks(spark, d):
    return scd.compare_blocks(_monthly_store(spark, d), _revised_months(spark, d)).select("series_id", "year", "n_stored", "n_fetched", "differs")


@query(_with(A.MON, _REVISED) + """SELECT s.series_id, s.period, round(s.value, 2) AS value, DATE '2024-01-01' AS realtime_start, CASE WHEN n.period IS NULL OR n.value <> s.value THEN DATE '2024-02-01' END AS realtime_end FROM mon s LEFT JOIN revised n ON s.series_id = n.series_id AND s.period = n.period
UNION ALL SELECT n.series_id, n.period, round(n.value, 2), DATE '2024-02-01', NULL FROM mon s JOIN revised n ON s.series_id = n.series_id AND s.period = n.period AND s.value <> n.value""")
def snapshot_stored(spark, d):
    """A snapshot applied to a bucketed store: only blocks that differ are diffed, only their buckets written."""
    root, inc, day = new_path(spark), _revised_months(spark, d), "2024-02-01"
    name = store.open_store(spark, root, 8)
    places = lambda df: [tuple(r) for r in store.placed(df, 8).select("source", "bucket").distinct().collect()]
    first = _monthly_store(spark, d)
    sources = sorted({s for s, _ in places(first)})
    store.replace_blocks(first, root, name, places(first), "first", 8)
    with store.co_located(spark):
        cur = store.read_blocks(spark, name, sources)
        changes = checkpoint(scd.block_changes(cur, inc, checkpoint(scd.compare_blocks(cur, inc))))
        touched = places(changes)
        after = scd.apply_changes(store.read_blocks(spark, name, sources, touched), changes, day, "second", F.lit(day).cast("timestamp"), ["year"])
        store.replace_blocks(after, root, name, touched, "second", 8)
    return _r(tables.read_table(spark, root, "observations").drop("observed_at", "run_id"), 2)


@query(_with(A.OBS) + """, m AS (SELECT * FROM (SELECT series_id, period, value, realtime_start, lag(value) OVER w AS prev, row_number() OVER w AS k FROM obs WINDOW w AS (PARTITION BY series_id, period ORDER BY realtime_start))
  WHERE k = 1 OR NOT (value IS NOT DISTINCT FROM prev OR coalesce(abs(value - prev) <= 1e-12, false)))
SELECT series_id, period, value, realtime_start, lead(realtime_start) OVER (PARTITION BY series_id, period ORDER BY realtime_start) AS realtime_end FROM m""")
def intervals_from_log(spark, d):
    return scd.intervals_from_log(A.readings(spark, d))


@query("SELECT CAST(0 AS BIGINT) AS n_violations")
def invariants_zero(spark, d):
    after, _ = scd.apply_snapshot(_stored(spark, d), _snapshot(spark, d), RUN)
    return scd.invariant_violations(after).agg(F.count(F.lit(1)).alias("n_violations"))


@query(_with(A.OBS) + """SELECT series_id, period, 'overlap' AS violation FROM (SELECT series_id, period, realtime_end + 1 AS e, lead(realtime_start) OVER (PARTITION BY series_id, period ORDER BY realtime_start) AS n FROM obs) WHERE e > n GROUP BY ALL""")
def invariant_violations(spark, d):
    return scd.invariant_violations(A.bitemporal(spark, d).withColumn("realtime_end", F.date_add("realtime_end", 1)))


@query(_with(A.OBS) + "SELECT series_id, min(period) FILTER (realtime_end IS NULL) AS first_period, max(period) FILTER (realtime_end IS NULL) AS last_period, CASE WHEN series_id = 'ev:click' THEN DATE '2024-02-01' END AS last_updated FROM obs GROUP BY 1")
def series_coverage(spark, d):
    obs = A.bitemporal(spark, d)
    before = obs.select("series_id").distinct().withColumn("last_updated", F.lit(None).cast("date"))
    return scd.series_coverage(obs, before, before.where("series_id = 'ev:click'"), F.lit("2024-02-01").cast("date"))


@query(_with(A.OBS, _STORED) + """SELECT count(DISTINCT series_id) AS n_series, count(DISTINCT series_id) FILTER (length(series_id) % 2 = 1) AS n_errors, count(*) FILTER (class <> 'vanished' AND length(series_id) % 2 = 0) AS rows_fetched, count(*) FILTER (class = 'new' AND length(series_id) % 2 = 0) AS rows_new,
count(*) FILTER (class = 'changed' AND length(series_id) % 2 = 0) AS rows_revised, count(*) FILTER (class IN ('changed', 'vanished') AND length(series_id) % 2 = 0) AS rows_closed, CASE count(DISTINCT series_id) FILTER (length(series_id) % 2 = 1) WHEN 0 THEN 'ok' WHEN count(DISTINCT series_id) THEN 'failed' ELSE 'partial' END AS status FROM cl""")
def run_summary(spark, d):
    """A run in which some series failed."""
    counts = scd.diff_counts(scd.classify(_stored(spark, d), _snapshot(spark, d)))
    odd = F.length("series_id") % 2 == 1
    return scd.run_summary(counts.where(~odd), counts.where(odd).select("series_id", F.lit("unread").alias("error")))


@query(_with(A.OBS, A.MON, "every AS (SELECT series_id FROM obs UNION SELECT series_id FROM mon)", A.dimension_sql("every")) + "SELECT series_id, source FROM dim WHERE (alias IN ('ord-BUILDING', 'ev-click') OR series_id = 'ev:view') AND source = 'ev'")
def select_series(spark, d):
    every = A.bitemporal(spark, d).select("series_id").unionAll(A.monthly(spark, d).select("series_id"))
    return scd.select_series(A.dimension(every), ["ord-BUILDING", "ev-click", "ev:view"], ["ev"]).select("series_id", "source")


@query("SELECT event_id, CAST(ts - INTERVAL 3 HOUR AS DATE) AS run_date FROM events")
def run_date(spark, d):
    return A.table(spark, d, "events").select("event_id", calendar.run_date(F.col("ts").cast("timestamp"), "America/Sao_Paulo").alias("run_date"))


# audits -----------------------------------------------------------------------------------------------------------

TODAY = "2001-10-20"


@query(_with(A.MON, A.dimension_sql("mon")) + f"""SELECT series_id, last_period, expected_by, CASE WHEN expected_lag_days IS NULL THEN 'unknown_lag' WHEN DATE '{TODAY}' > expected_by THEN 'stale' ELSE 'ok' END AS status, CAST(greatest(coalesce(DATE '{TODAY}' - expected_by, 0), 0) AS INTEGER) AS days_stale
FROM (SELECT series_id, last_period, expected_lag_days, last_day(last_period + INTERVAL 1 MONTH) + expected_lag_days AS expected_by FROM dim JOIN (SELECT series_id, max(period) AS last_period FROM mon GROUP BY 1) USING (series_id))""")
def freshness(spark, d):
    rows = A.monthly(spark, d)
    return audits.freshness(rows, A.dimension(rows), TODAY)


@query(_with(A.NAT) + """SELECT series_id, 'gap' AS finding, CASE WHEN missing / grid > 0.05 THEN 'high' ELSE 'medium' END AS severity, CAST(missing AS VARCHAR) AS detail FROM
(SELECT series_id, datediff('month', min(period), max(period)) + 1 AS grid, datediff('month', min(period), max(period)) + 1 - count(DISTINCT period) AS missing FROM nat WHERE hash_no(period, series_id) GROUP BY 1) WHERE missing > 0""".replace("hash_no(period, series_id)", "(year(period) * 12 + month(period)) % (length(series_id) * 3) <> 1"))
def audit_gap(spark, d):
    rows = A.monthly_nations(spark, d).where((F.year("period") * 12 + F.month("period")) % (F.length("series_id") * 3) != 1)
    return audits.gaps(rows, A.dimension(rows))


_SPIKED = "v AS (SELECT series_id, period, value * CASE WHEN year(period) = 1997 AND month(period) = 5 AND length(series_id) % 2 = 0 THEN 60 ELSE 1 END AS value FROM mon)"


@query(_with(A.MON, _SPIKED) + """, m AS (SELECT *, value - lag(value) OVER w AS d FROM v WINDOW w AS (PARTITION BY series_id ORDER BY period)),
b AS (SELECT *, lead(d) OVER (PARTITION BY series_id ORDER BY period) AS back FROM m),
z AS (SELECT series_id, period, CASE WHEN sign(d) * sign(back) < 0 THEN least(abs(d), abs(back)) ELSE 0 END AS size FROM b WHERE d IS NOT NULL AND back IS NOT NULL),
s AS (SELECT series_id, median(abs(d)) FILTER (k > 2) AS scale FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY abs(d) DESC) AS k FROM m WHERE d IS NOT NULL) GROUP BY 1)
SELECT series_id, arg_max(period, size) AS period, round(max(size), 2) AS size, round(scale, 2) AS scale FROM z JOIN s USING (series_id) GROUP BY series_id, scale HAVING max(size) > 12 * scale""")
def audit_spike(spark, d):
    factor = F.when((F.year("period") == 1997) & (F.month("period") == 5) & (F.length("series_id") % 2 == 0), 60).otherwise(1)
    return _r(audits.spikes(A.monthly(spark, d).withColumn("value", F.col("value") * factor)), 2, "size", "scale")


@query(SQL["audit_spike"])
def audit_spike_in_ranges(spark, d):
    """Moves by ranges with a halo, the median by rounds of counts: no task has a series, none is sorted by size."""
    factor = F.when((F.year("period") == 1997) & (F.month("period") == 5) & (F.length("series_id") % 2 == 0), 60).otherwise(1)
    return _r(audits.spikes(A.monthly(spark, d).withColumn("value", F.col("value") * factor), 16, 8), 2, "size", "scale")


_FLAT = "CASE WHEN period >= DATE '2000-01-01' THEN 1.0 WHEN period < DATE '1995-10-01' AND length(series_id) % 2 = 0 THEN 2.0 ELSE value END"


@query(_with(A.MON) + "SELECT series_id, count(*) FILTER (period >= DATE '2000-01-01') AS run, CASE WHEN length(series_id) % 2 = 0 THEN count(*) FILTER (period < DATE '1995-10-01') ELSE 1 END AS before FROM mon GROUP BY 1, length(series_id) HAVING count(*) FILTER (period >= DATE '2000-01-01') >= 12")
def audit_flat(spark, d):
    return audits.flat_runs(A.monthly(spark, d).withColumn("value", F.expr(_FLAT)))


@query(SQL["audit_flat"])
def audit_flat_in_ranges(spark, d):
    return audits.flat_runs(A.monthly(spark, d).withColumn("value", F.expr(_FLAT)), 16)


@query(_with(A.MON) + "SELECT series_id, 'all_null' AS finding, 'high' AS severity, count(*) || ' rows without a value' AS detail FROM mon WHERE length(series_id) % 2 = 1 GROUP BY 1")
def audit_null(spark, d):
    return audits.all_null(A.monthly(spark, d).withColumn("value", F.when(F.length("series_id") % 2 == 0, F.col("value"))))


@query(_with(A.NAT) + "SELECT DISTINCT series_id, 'no_data' AS finding, 'high' AS severity, 'no rows' AS detail FROM nat WHERE length(series_id) % 2 = 1")
def audit_no_data(spark, d):
    rows = A.monthly_nations(spark, d)
    return audits.no_data(rows.where(F.length("series_id") % 2 == 0), A.dimension(rows))


def _audited(spark, d) -> tuple[DataFrame, DataFrame]:
    rows = A.monthly_nations(spark, d)
    return rows, A.dimension(rows)


_LATE = f"late AS (SELECT series_id FROM nat JOIN dim USING (series_id) WHERE expected_lag_days IS NOT NULL GROUP BY series_id, expected_lag_days HAVING DATE '{TODAY}' > last_day(max(period) + INTERVAL 1 MONTH) + expected_lag_days)"

# a series without rows, one without values, one with a spike, one that ends flat, and gaps in all
_FAULTY = "series_id <> 'nat:3' AND (year(period) * 12 + month(period)) % (length(series_id) * 3) <> 1"
_FAULTS = "CASE WHEN series_id = 'nat:7' THEN NULL WHEN series_id = 'nat:8' AND period >= DATE'2000-01-01' THEN 1.0 WHEN series_id = 'nat:9' AND period = DATE'1997-05-01' THEN value * 60 ELSE value END"
_FINDINGS = f"""v AS (SELECT series_id, period, {_FAULTS} AS value FROM nat WHERE {_FAULTY}),
rest AS (SELECT * FROM v WHERE series_id <> 'nat:7'),
m AS (SELECT *, value - lag(value) OVER (PARTITION BY series_id ORDER BY period) AS d FROM rest),
bk AS (SELECT *, lead(d) OVER (PARTITION BY series_id ORDER BY period) AS back FROM m),
z AS (SELECT series_id, period, CASE WHEN sign(d) * sign(back) < 0 THEN least(abs(d), abs(back)) ELSE 0 END AS size FROM bk WHERE d IS NOT NULL AND back IS NOT NULL),
sc AS (SELECT series_id, median(abs(d)) FILTER (k > 2) AS scale FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY abs(d) DESC) AS k FROM m WHERE d IS NOT NULL) GROUP BY 1 HAVING count(*) >= 23),
found AS (
SELECT DISTINCT series_id, 'no_data' AS finding, 'high' AS severity, 'no rows' AS detail FROM nat WHERE series_id NOT IN (SELECT series_id FROM v)
UNION ALL SELECT series_id, 'all_null', 'high', count(*) || ' rows without a value' FROM v WHERE series_id = 'nat:7' GROUP BY 1
UNION ALL SELECT series_id, 'stale', 'high', (DATE '{TODAY}' - due) || ' days late' FROM (SELECT series_id, last_day(max(period) + INTERVAL 1 MONTH) + any_value(expected_lag_days) AS due FROM rest JOIN dim USING (series_id) GROUP BY 1) WHERE DATE '{TODAY}' > due
UNION ALL SELECT series_id, 'gap', CASE WHEN missing / grid > 0.05 THEN 'high' ELSE 'medium' END, CAST(missing AS VARCHAR) FROM (SELECT series_id, datediff('month', min(period), max(period)) + 1 AS grid, datediff('month', min(period), max(period)) + 1 - count(DISTINCT period) AS missing FROM rest GROUP BY 1) WHERE missing > 0
UNION ALL SELECT series_id, 'isolated_spike', 'low', CAST(arg_max(period, size) AS VARCHAR) FROM z JOIN sc USING (series_id) GROUP BY series_id, scale HAVING max(size) > 12 * scale
UNION ALL SELECT series_id, 'flat', 'medium', CAST(count(*) AS VARCHAR) FROM v WHERE series_id = 'nat:8' AND period >= DATE '2000-01-01' GROUP BY 1 HAVING count(*) >= 12)"""


def _all_findings(spark, d) -> DataFrame:
    rows, series = _audited(spark, d)
    return audits.audit(rows.where(_FAULTY).withColumn("value", F.expr(_FAULTS)), series, TODAY)


@query(_with(A.NAT, A.dimension_sql("nat"), _FINDINGS) + "SELECT * FROM found")
def audit(spark, d):
    """Findings of every kind."""
    return _all_findings(spark, d)


@query(_with(A.NAT, A.dimension_sql("nat"), _FINDINGS) + "SELECT series_id, CASE min(CASE severity WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END) WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS severity, count(*) AS n_findings FROM found GROUP BY 1")
def worst_of_findings(spark, d):
    return audits.worst_severity(audits.rank_findings(_all_findings(spark, d)))


@query(_with(A.NAT, A.dimension_sql("nat"), _LATE) + "SELECT series_id, 'high' AS severity, count(*) AS n_findings FROM late GROUP BY 1")
def worst_severity(spark, d):
    return audits.worst_severity(audits.rank_findings(audits.stale(*_audited(spark, d), TODAY)))


@query(_with(A.OBS) + """SELECT series_id, count(*) FILTER (realtime_end IS NULL) AS n_obs, count(*) FILTER (realtime_end IS NOT NULL) AS n_revisions, min(period) FILTER (realtime_end IS NULL) AS first_period, max(period) FILTER (realtime_end IS NULL) AS last_period,
min(value) FILTER (realtime_end IS NULL) AS min_value, max(value) FILTER (realtime_end IS NULL) AS max_value, arg_max(value, period) FILTER (realtime_end IS NULL AND value IS NOT NULL) AS last_value FROM obs GROUP BY 1""")
def profile(spark, d):
    obs = A.bitemporal(spark, d)
    return audits.profile(obs, A.dimension(obs))


@query(_with(A.DAY) + """, m AS (SELECT series_id, CAST(date_trunc('month', period) AS DATE) AS period, arg_max(value, period) AS value FROM day GROUP BY 1, 2),
n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY period) - 1 AS k, count(*) OVER (PARTITION BY series_id) AS n FROM m) SELECT series_id, period, round(value, 6) AS value FROM n WHERE k % CAST(ceil(n / 20.0) AS BIGINT) = 0""")
def thin(spark, d):
    return audits.thin(A.daily(spark, d), "D", 20)


@query(_with(A.OBS, A.NAT, A.dimension_sql("nat"), _FINDINGS) + """SELECT count(*) AS n_observations, count(*) FILTER (realtime_end IS NULL) AS n_open, min(period) AS earliest, max(period) AS latest, count(DISTINCT series_id) AS n_series, CAST(1 AS BIGINT) AS n_sources,
(SELECT count(*) FROM found) AS n_findings, (SELECT count(*) FROM found WHERE severity = 'high') AS n_high, (SELECT count(*) FROM found WHERE finding = 'stale') AS n_stale FROM obs""")
def totals(spark, d):
    obs = A.bitemporal(spark, d)
    return audits.totals(obs, A.dimension(obs), _all_findings(spark, d))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS run_id, CAST(o_orderdate AS TIMESTAMP) AS started_at FROM orders ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) LIMIT 10")
def recent_runs(spark, d):
    return audits.recent_runs(A.table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderdate").alias("started_at")))


@query(_with(A.NAT) + "SELECT series_id, period, CASE WHEN length(series_id) % 3 <> 1 THEN round(value, 2) END AS value FROM nat")
def mask_restricted(spark, d):
    rows = A.monthly_nations(spark, d)
    return _r(audits.mask_restricted(rows, A.dimension(rows)), 2)


# sources ----------------------------------------------------------------------------------------------------------

def _bodies(rows: DataFrame, item) -> DataFrame:
    """One JSON body for each series, its items in order of period."""
    return rows.groupBy("series_id").agg(F.array_sort(F.collect_list(F.struct("period", item.alias("item")))).alias("x")).select("series_id", F.transform("x", lambda r: r["item"]).alias("items"))


def _parsed(df: DataFrame, *more: str) -> DataFrame:
    return _r(df.where("error IS NULL").select("series_id", "period", "value", *more), 2)


_PARSED = "SELECT series_id, period, round(value, 2) AS value FROM mon"


def _text():
    return F.col("value").cast("decimal(18,2)").cast("string")


@query(_with(A.OBS) + "SELECT series_id, period, round(value, 2) AS value, realtime_start, realtime_end FROM obs")
def parse_fred(spark, d):
    obs = A.bitemporal(spark, d)
    end = F.coalesce(F.date_sub("realtime_end", 1), F.lit("9999-12-31").cast("date"))
    item = F.struct(F.col("realtime_start").cast("string").alias("realtime_start"), end.cast("string").alias("realtime_end"), F.col("period").cast("string").alias("date"), F.coalesce(F.col("value").cast("string"), F.lit(".")).alias("value"))
    raw = _bodies(obs, item).select("series_id", F.to_json(F.struct(F.col("items").alias("observations"))).alias("body"), F.lit(True).alias("vintaged"))
    return _parsed(payloads.parse_fred(raw), "realtime_start", "realtime_end")


@query(_with(A.MON) + _PARSED)
def parse_sgs(spark, d):
    item = F.struct(F.date_format("period", "dd/MM/yyyy").alias("data"), F.replace(_text(), F.lit("."), F.lit(",")).alias("valor"))
    return _parsed(payloads.parse_sgs(_bodies(A.monthly(spark, d), item).select("series_id", F.to_json("items").alias("body"))))


@query(_with(A.MON) + _PARSED)
def parse_focus(spark, d):
    item = F.struct(F.col("period").cast("string").alias("Data"), _text().alias("Mediana"), F.lit("1").alias("Media"))
    return _parsed(payloads.parse_focus(_bodies(A.monthly(spark, d), item).select("series_id", F.to_json(F.struct(F.col("items").alias("value"))).alias("body"))))


@query(_with(A.MON) + _PARSED)
def parse_sidra(spark, d):
    item = F.struct(F.lit("1").alias("D1C"), F.date_format("period", "yyyyMM").alias("D3C"), _text().alias("V"))
    head = F.struct(F.lit("Brasil (Código)").alias("D1C"), F.lit("Mês (Código)").alias("D3C"), F.lit("Valor").alias("V"))
    raw = _bodies(A.monthly(spark, d), item).select("series_id", F.to_json(F.concat(F.array(head), "items")).alias("body"), F.lit("M").alias("freq"))
    return _parsed(payloads.parse_sidra(raw))


@query(_with(A.MON) + _PARSED)
def parse_ipea(spark, d):
    item = F.struct(F.concat(F.col("period").cast("string"), F.lit("T00:00:00-03:00")).alias("VALDATA"), F.col("value").cast("decimal(18,2)").alias("VALVALOR"))
    return _parsed(payloads.parse_ipea(_bodies(A.monthly(spark, d), item).select("series_id", F.to_json(F.struct(F.col("items").alias("value"))).alias("body"))))


@query(_with(A.MON) + _PARSED)
def parse_dbnomics(spark, d):
    item = F.struct(F.date_format("period", "yyyy-MM").alias("p"), F.col("value").cast("decimal(18,2)").alias("v"))
    doc = F.struct(F.lit("monthly").alias("@frequency"), F.transform("items", lambda x: x["p"]).alias("period"), F.transform("items", lambda x: x["v"]).alias("value"))
    body = F.to_json(F.struct(F.struct(F.array(doc).alias("docs")).alias("series")))
    return _parsed(payloads.parse_dbnomics(_bodies(A.monthly(spark, d), item).select("series_id", body.alias("body"), F.lit("M").alias("freq"))))


@query(_with(A.MON) + _PARSED)
def parse_csv(spark, d):
    item = F.concat_ws(",", F.lit("x"), F.date_format(F.last_day("period"), "MM/dd/yyyy"), _text())
    body = F.concat(F.lit("banner\n\nname,date,value\n"), F.array_join("items", "\n"))
    return _parsed(payloads.parse_csv(_bodies(A.monthly(spark, d), item).select("series_id", body.alias("body")), "date", "value", 1, "MM/dd/yyyy", True))


@query(_with(A.MON) + "SELECT series_id, period, CASE WHEN month(period) = 2 THEN NULL ELSE round(value, 2) END AS value FROM mon")
def parse_csv_quoted(spark, d):
    """Grouped numbers in quotes, a quoted name with separators and a line break, and footnotes for numbers."""
    text = F.when(F.month("period") == 2, "(a)").otherwise(F.format_number(F.col("value").cast("decimal(18,2)"), 2))
    item = F.concat(F.lit('"x, ""y""\n;",'), F.col("period").cast("string"), F.lit(',"'), text, F.lit('"'))
    body = F.concat(F.lit('name,date,"value, total"\r\n'), F.array_join("items", "\r\n"), F.lit("\r\n"))
    return _parsed(payloads.parse_csv(_bodies(A.monthly(spark, d), item).select("series_id", body.alias("body")), "date", "value, total"))


@query(_with(A.MON) + "SELECT DISTINCT series_id, CASE length(series_id) % 3 WHEN 0 THEN 'bad number: oops' ELSE 'bad period' END AS error FROM mon WHERE length(series_id) % 3 <> 1")
def parse_refused(spark, d):
    """A bad number or a bad date refuses its whole body, and no other."""
    k, bad = F.length("series_id") % 3, F.month("period") == 6
    date = F.when(bad & (k == 2), "32/06/1999").otherwise(F.date_format("period", "dd/MM/yyyy"))
    item = F.struct(date.alias("data"), F.when(bad & (k == 0), "oops").otherwise(_text()).alias("valor"))
    parsed = payloads.parse_sgs(_bodies(A.monthly(spark, d), item).select("series_id", F.to_json("items").alias("body")))
    lost = parsed.groupBy("series_id").agg(F.max("error").alias("error"), F.count(F.lit(1)).alias("n")).where("error IS NOT NULL AND n = 1")
    return lost.select("series_id", "error")


@query("SELECT o_orderkey, round(o_totalprice, 2) AS value FROM orders")
def to_number(spark, d):
    """Order totals written in four notations, read back."""
    text = F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2)
    swapped = F.translate(text, ",.", ".,")
    k = F.col("o_orderkey") % 4
    written = F.when(k == 0, text).when(k == 1, swapped).when(k == 2, F.concat(F.lit(" "), F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit(" %"))).otherwise(F.concat(F.lit("("), text, F.lit(")")))
    number = values.to_number(written)
    return A.table(spark, d, "orders").select("o_orderkey", F.round(F.when(k == 3, -number).otherwise(number), 2).alias("value"))


@query("SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(ts AS DATE) + 1 END AS realtime_end FROM events")
def exclusive_end(spark, d):
    end = F.when(F.col("event_id") % 7 == 0, F.lit("9999-12-31").cast("date")).otherwise(F.to_date("ts"))
    return A.table(spark, d, "events").select("event_id", values.exclusive_end(end).alias("realtime_end"))


@query("SELECT series_id, run_id, sha256, bytes, NOT (sha256 IS NOT DISTINCT FROM lag(sha256) OVER (PARTITION BY series_id ORDER BY doc_id)) AS stored FROM (SELECT doc_id, coalesce(source, '') AS series_id, CAST(doc_id AS VARCHAR) AS run_id, sha256(coalesce(text, '')) AS sha256, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes FROM documents)")
def raw_index(spark, d):
    docs = A.table(spark, d, "documents")
    raw = docs.select(F.lit("src").alias("source"), F.coalesce("source", F.lit("")).alias("series_id"), F.col("doc_id").cast("string").alias("run_id"), F.timestamp_seconds("doc_id").alias("fetched_at"), F.lit("https://h/?api_key=1").alias("url"), F.coalesce("text", F.lit("")).alias("body"))
    return archive.raw_index(raw).select("series_id", "run_id", "sha256", "bytes", "stored")


@query("SELECT page_id, url || '?api_key=REDACTED&page=' || page_id || '&Token=REDACTED' AS url FROM pages")
def redact(spark, d):
    url = F.concat("url", F.lit("?api_key=abc-"), "page_id", F.lit("&page="), "page_id", F.lit("&Token=x.y"))
    return A.table(spark, d, "pages").select("page_id", values.redact(url).alias("url"))


@query(_with(A.OBS) + "SELECT series_id, period, value, realtime_start, realtime_end FROM obs")
def conform(spark, d):
    obs = A.bitemporal(spark, d).withColumns({"observed_at": F.lit("2024-02-01").cast("timestamp"), "run_id": F.lit("r")})
    return tables.conform(obs.withColumn("value", F.col("value").cast("string")), "observations").drop("observed_at", "run_id")


def _stored_twice(spark, d) -> str:
    """A store with two sources, one of which was written again."""
    root = new_path(spark)
    own = lambda df: df.select("series_id", "period", "value", "realtime_start", "realtime_end").withColumns({"observed_at": F.lit("2024-02-01").cast("timestamp"), "run_id": F.lit("r")})
    months = own(_current(A.monthly(spark, d)))
    tables.replace_table(own(A.bitemporal(spark, d)).unionByName(months), root, "observations")
    tables.replace_table(months.withColumn("value", F.col("value") + 1), root, "observations")
    return root


_TWO_SOURCES = "SELECT series_id, period, round(value, 2) AS value, realtime_start, realtime_end FROM obs UNION ALL SELECT series_id, period, round(value + 1, 2), DATE '2024-01-01', NULL FROM mon"


@query(_with(A.OBS, A.MON) + _TWO_SOURCES)
def replace_partition(spark, d):
    return _r(tables.read_table(spark, _stored_twice(spark, d), "observations").drop("observed_at", "run_id"), 2)


@query(_with(A.MON) + "SELECT series_id, period, round(value + 1, 2) AS value FROM mon")
def read_partition(spark, d):
    return _r(tables.read_table(spark, _stored_twice(spark, d), "observations", "ord").select("series_id", "period", "value"), 2)


@query("SELECT 'n' || n_nationkey AS entity_id, 'nation' AS entity_type, n_name AS name, CAST(NULL AS VARCHAR) AS attributes FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT 'r' || r_regionkey, 'region', r_name, NULL FROM region")
def replace_and_append(spark, d):
    """A table that is replaced, and then appended to."""
    root, nations = new_path(spark), A.table(spark, d, "nation")
    entities = nations.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("entity_id"), F.lit("nation").alias("entity_type"), F.col("n_name").alias("name"))
    tables.replace_table(entities, root, "entities")
    tables.replace_table(entities.where(F.substring("entity_id", 2, 9).cast("int") % 2 == 0), root, "entities")
    tables.append_table(A.table(spark, d, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("entity_id"), F.lit("region").alias("entity_type"), F.col("r_name").alias("name")), root, "entities")
    return tables.read_table(spark, root, "entities")


# models -----------------------------------------------------------------------------------------------------------

_Q = "q AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY period) AS ix, ln(price) AS lp, ln(output) AS lo FROM macro)"
_CONST = {"const": "1.0"}


def _macro(spark, d) -> DataFrame:
    return A.macro(spark, d).withColumns({"lp": F.ln("price"), "lo": F.ln("output")})


def _terms_sql(rel: str, group: str, order: str, xs: dict[str, str], y: str, lags: str | None = None, weight: str = "1.0", only: tuple[str, ...] = (), digits: int = 4) -> str:
    """A row for each group and term: coefficient, error, statistic, p-value, r2 and rows."""
    parts = []
    for name in only or xs:
        p = O.p_student("coef / se", "dof") if lags is None else O.p_normal("coef / se")
        parts.append(f"SELECT {group}, '{name}' AS term, round(coef, {digits}) AS coef, round(se, {digits}) AS se, round(coef / se, {digits}) AS stat, round({p}, {digits}) AS p_value, round(r2, {digits}) AS r2, CAST(n AS BIGINT) AS n FROM {O.term(rel, group, order, xs, name, y, lags, weight)}")
    return " UNION ALL ".join(parts)


def _terms_of(df: DataFrame, digits: int = 4) -> DataFrame:
    return _r(df, digits, "coef", "se", "stat", "p_value", "r2").withColumn("n", F.col("n").cast("long"))


@query(_with(A.MACRO, _Q) + "SELECT entity, 'const' AS term, round(regr_intercept(lo, lp), 5) AS coef, round(regr_r2(lo, lp), 6) AS r2, CAST(regr_count(lo, lp) AS BIGINT) AS n FROM q GROUP BY 1 UNION ALL SELECT entity, 'lp', round(regr_slope(lo, lp), 5), round(regr_r2(lo, lp), 6), regr_count(lo, lp) FROM q GROUP BY 1")
def ols_simple(spark, d):
    out = regression.grouped_ols(_macro(spark, d), ["entity"], "lo", ["lp"])
    return out.select("entity", "term", F.round("coef", 5).alias("coef"), F.round("r2", 6).alias("r2"), F.col("n").cast("long").alias("n"))


@query(_with(A.MACRO, _Q) + """SELECT entity, round((syy2 * sx1y - s12 * sx2y) / (s11 * syy2 - s12 * s12), 5) AS b_lp, round((s11 * sx2y - s12 * sx1y) / (s11 * syy2 - s12 * s12), 5) AS b_rate FROM
(SELECT entity, regr_sxx(lo, lp) AS s11, regr_sxx(lo, rate) AS syy2, regr_sxy(lp, rate) AS s12, regr_sxy(lo, lp) AS sx1y, regr_sxy(lo, rate) AS sx2y FROM q GROUP BY 1)""")
def ols_multi(spark, d):
    out = regression.grouped_ols(_macro(spark, d), ["entity"], "lo", ["lp", "rate"])
    return out.groupBy("entity").agg(*[F.round(F.max(F.when(F.col("term") == t, F.col("coef"))), 5).alias(f"b_{t}") for t in ("lp", "rate")])


@query(_with(A.MACRO, _Q) + _terms_sql("q", "entity", "ix", _CONST | {"lp": "lp", "rate": "rate"}, "lo"))
def ols_terms(spark, d):
    """All terms with their errors and tests."""
    return _terms_of(regression.grouped_ols(_macro(spark, d), ["entity"], "lo", ["lp", "rate"]))


@query(_with(A.MACRO, _Q) + """, w AS (SELECT *, CASE WHEN year(period) = 1997 THEN 1.0 / 9 ELSE 1.0 END AS w FROM q), m AS (SELECT entity, sum(w * lp) / sum(w) AS mx, sum(w * lo) / sum(w) AS my FROM w GROUP BY 1)
SELECT entity, round(sum(w * (lp - mx) * (lo - my)) / sum(w * (lp - mx) * (lp - mx)), 5) AS slope FROM w JOIN m USING (entity) GROUP BY 1""")
def wls(spark, d):
    rows = _macro(spark, d).withColumn("w", F.when(F.year("period") == 1997, 1 / 9).otherwise(1.0))
    return regression.grouped_ols(rows, ["entity"], "lo", ["lp"], weight="w").where("term = 'lp'").select("entity", F.round("coef", 5).alias("slope"))


@query(_with(A.MACRO, _Q) + _terms_sql("q", "entity", "ix", _CONST | {"lp": "lp", "rate": "rate"}, "lo", weight="CASE WHEN year(period) = 1997 THEN 1.0 / 9 ELSE 1.0 END"))
def wls_terms(spark, d):
    rows = _macro(spark, d).withColumn("w", F.when(F.year("period") == 1997, 1 / 9).otherwise(1.0))
    return _terms_of(regression.grouped_ols(rows, ["entity"], "lo", ["lp", "rate"], weight="w"))


_HAC = """, b AS (SELECT entity, regr_slope(lo, lp) AS b, regr_intercept(lo, lp) AS a, avg(lp) AS mx, regr_sxx(lo, lp) AS sxx FROM q GROUP BY 1),
s AS (SELECT q.entity, ix, (lp - mx) * (lo - a - b * lp) AS s, sxx FROM q JOIN b USING (entity)),
g AS (SELECT x.entity, any_value(x.sxx) AS sxx, sum(CASE WHEN x.ix = y.ix THEN 1.0 ELSE 2.0 END * (1 - (x.ix - y.ix) / 5.0) * x.s * y.s) AS meat FROM s x JOIN s y ON x.entity = y.entity AND x.ix - y.ix BETWEEN 0 AND 4 GROUP BY 1)
SELECT entity, round(sqrt(meat) / sxx, 5) AS se FROM g"""


@query(_with(A.MACRO, _Q) + _HAC)
def hac_se(spark, d):
    out = regression.grouped_ols(_macro(spark, d), ["entity"], "lo", ["lp"], order="period", lags=4)
    return out.where("term = 'lp'").select("entity", F.round("se", 5).alias("se"))


@query(_with(A.MACRO, _Q) + _terms_sql("q", "entity", "ix", _CONST | {"lp": "lp", "rate": "rate"}, "lo", "3"))
def hac_terms(spark, d):
    return _terms_of(regression.grouped_ols(_macro(spark, d), ["entity"], "lo", ["lp", "rate"], order="period", lags=3))


def _wald_sql(group: str, of: str, p) -> str:
    return f"SELECT {group}, round(coef, 4) AS estimate, round(se, 4) AS se, round((coef - 1) / se, 4) AS stat, round({p}, 4) AS p_value FROM {of}"


@query(_with(A.MACRO, _Q) + _wald_sql("entity", O.term("q", "entity", "ix", _CONST | {"lp": "lp"}, "lp", "lo", "4"), O.p_normal("(coef - 1) / se")))
def wald_test(spark, d):
    fitted = regression.fit(_macro(spark, d), ["entity"], "lo", ["lp"], order="period", lags=4)
    return _r(regression.wald(fitted, ["entity"], {"lp": 1.0}, 1.0), 4, "estimate", "se", "stat", "p_value")


@query(_with(A.MACRO, _Q) + _wald_sql("entity", O.term("q", "entity", "ix", _CONST | {"lp": "lp"}, "lp", "lo"), O.p_student("(coef - 1) / se", "dof")))
def wald_student(spark, d):
    return _r(regression.wald(regression.fit(_macro(spark, d), ["entity"], "lo", ["lp"]), ["entity"], {"lp": 1.0}, 1.0), 4, "estimate", "se", "stat", "p_value")


def _pairs(spark, d) -> DataFrame:
    return A.macro(spark, d).select(F.col("entity").alias("pair"), "period", F.col("price").alias("fx"), F.col("rate").alias("home"), F.lit(5.0).alias("abroad"))


_PARITY = "pr AS (" + " UNION ALL ".join(f"SELECT entity AS pair, {h} AS horizon, period, 100 * (ln(lead(price, {h}) OVER w) - ln(price)) AS change, rate - 5 AS differential FROM macro WINDOW w AS (PARTITION BY entity ORDER BY period)" for h in (1, 4)) + "), pc AS (SELECT * FROM pr WHERE change IS NOT NULL QUALIFY count(*) OVER (PARTITION BY pair, horizon) >= 20)"


@query(_with(A.MACRO, _PARITY) + _terms_sql("pc", "pair, horizon", "period", _CONST | {"differential": "differential"}, "change", "horizon"))
def uip(spark, d):
    """Interest parity over two horizons; the tables have too few quarters for the usual least of rows."""
    return _terms_of(macro.uip(_pairs(spark, d), [1, 4], least_rows=20)[0])


_MONTHLY_PARITY = "pr AS (" + " UNION ALL ".join(f"SELECT series_id AS pair, {h} AS horizon, period, 100 * (ln(lead(value, {h}) OVER w) - ln(value)) AS change, 4.0 - month(period) / 4 AS differential FROM mon WINDOW w AS (PARTITION BY series_id ORDER BY period)" for h in (1, 12)) + f"), pc AS (SELECT * FROM pr WHERE change IS NOT NULL QUALIFY count(*) OVER (PARTITION BY pair, horizon) >= {macro.LEAST_PARITY})"


@query(_with(A.MON, _MONTHLY_PARITY) + _wald_sql("pair, horizon", O.term("pc", "pair, horizon", "period", _CONST | {"differential": "differential"}, "differential", "change", "horizon"), O.p_normal("(coef - 1) / se")))
def uip_test(spark, d):
    coefficients, test = macro.uip(A.monthly(spark, d).select(F.col("series_id").alias("pair"), "period", F.col("value").alias("fx"), F.lit(4.0).alias("home"), (F.month("period") / 4).alias("abroad")), [1, 12])
    return _r(test, 4, "estimate", "se", "stat", "p_value")


@query("WITH RECURSIVE " + A.MON + "," + O.hp("mon", "series_id") + " SELECT series_id, period, round(value / 1e6, 5) AS value, round(trend / 1e6, 5) AS trend, round((value - trend) / 1e6, 5) AS cycle FROM hp")
def hp_filter(spark, d):
    out = macro.hp_filter(A.monthly(spark, d), ["series_id"])
    return _r(out.withColumns({c: F.col(c) / 1e6 for c in ("value", "trend", "cycle")}), 5, "value", "trend", "cycle")


def _hamilton(rel: str, group: str, value: str) -> str:
    """Common tables ham_x, ham (group, period, gap)."""
    lags = ", ".join(f"lag({value}, {8 + k}) OVER w AS l{k}" for k in range(4))
    xs = _CONST | {f"l{k}": f"l{k}" for k in range(4)}
    return f"""
ham_x AS (SELECT * FROM (SELECT {group}, period, {value} AS own, {lags} FROM {rel} WINDOW w AS (PARTITION BY {group} ORDER BY period)) WHERE own IS NOT NULL AND l0 IS NOT NULL AND l1 IS NOT NULL AND l2 IS NOT NULL AND l3 IS NOT NULL QUALIFY count(*) OVER (PARTITION BY {group}) >= 9),
ham AS (SELECT {group}, period, e_y AS gap FROM {O.residuals("ham_x", group, xs, {"y": "own"})})"""


@query(_with(A.NAT, _hamilton("nat", "series_id", "value")) + "SELECT series_id, period, round(value, 1) AS value, round(gap, 1) AS gap FROM nat LEFT JOIN ham USING (series_id, period)")
def hamilton_gap(spark, d):
    return _r(macro.hamilton_gap(A.monthly_nations(spark, d), ["series_id"]), 1, "value", "gap")


_GDP = "gdp AS (SELECT entity, period, ln(output) AS value FROM macro)"
_HP_GAP = A.MACRO + ", " + _GDP + "," + O.hp("gdp", "entity") + ", gaps AS (SELECT entity, period, (exp(value - trend) - 1) * 100 AS gap FROM hp)"
_HAMILTON_GAP = A.MACRO + ", " + _GDP + "," + _hamilton("gdp", "entity", "value") + ", gaps AS (SELECT entity, period, gap * 100 AS gap FROM gdp LEFT JOIN ham USING (entity, period))"
_GAPS = "SELECT entity, period, round(gap, 4) AS gap FROM gaps"


def _output_gap(spark, d, method: str) -> DataFrame:
    return _r(macro.output_gap(A.macro(spark, d).select("entity", "period", F.col("output").alias("value")), ["entity"], method), 4, "gap")


@query("WITH RECURSIVE " + _HP_GAP + _GAPS)
def output_gap(spark, d):
    return _output_gap(spark, d, "hp")


@query("WITH " + _HAMILTON_GAP + _GAPS)
def output_gap_hamilton(spark, d):
    return _output_gap(spark, d, "hamilton")


def _rule(spark, d, method: str = "hp") -> DataFrame:
    panel = A.macro(spark, d)
    params = panel.select("entity").distinct().withColumns({"r_star": F.lit(2.0), "pi_star": F.lit(2.0), "a_pi": F.lit(0.5), "a_y": F.lit(0.5)})
    return macro.taylor_rule(panel, params, method=method)


_RULE = """, tr AS (SELECT entity, period, inflation, gap, rate, 2 + inflation + 0.5 * (inflation - 2) + 0.5 * gap AS prescribed
FROM (SELECT entity, period, rate, (price / lag(price, 4) OVER (PARTITION BY entity ORDER BY period) - 1) * 100 AS inflation FROM macro) JOIN gaps USING (entity, period) WHERE inflation IS NOT NULL AND gap IS NOT NULL AND rate IS NOT NULL) """
_RULE_ROWS = "SELECT entity, period, round(inflation, 4) AS inflation, round(gap, 4) AS gap, round(rate, 4) AS rate, round(prescribed, 4) AS prescribed, round(rate - prescribed, 4) AS deviation FROM tr"
_RULE_SAID = "SELECT entity, round(corr(rate, prescribed), 4) AS correlation, round(avg(abs(rate - prescribed)), 4) AS mean_abs_deviation, count(*) AS n FROM tr GROUP BY 1"
_RULE_FIT = ", tk AS (SELECT * FROM tr QUALIFY count(*) OVER (PARTITION BY entity) >= 13) " + _terms_sql("tk", "entity", "period", _CONST | {"inflation": "inflation", "gap": "gap"}, "rate")


@query("WITH RECURSIVE " + _HP_GAP + _RULE + _RULE_ROWS)
def taylor_rule(spark, d):
    return _r(_rule(spark, d), 4, "inflation", "gap", "rate", "prescribed", "deviation")


@query("WITH RECURSIVE " + _HP_GAP + _RULE + _RULE_SAID)
def taylor_diagnostics(spark, d):
    return _r(macro.taylor_diagnostics(_rule(spark, d)), 4, "correlation", "mean_abs_deviation")


@query("WITH RECURSIVE " + _HP_GAP + _RULE + _RULE_FIT)
def taylor_estimate(spark, d):
    return _terms_of(macro.taylor_estimate(_rule(spark, d)))


@query("WITH " + _HAMILTON_GAP + _RULE + _RULE_ROWS)
def taylor_rule_hamilton(spark, d):
    return _r(_rule(spark, d, "hamilton"), 4, "inflation", "gap", "rate", "prescribed", "deviation")


def _terms(spark, d) -> DataFrame:
    panel = A.macro(spark, d)
    long = panel.select("entity", "period", F.explode(F.array(*[F.struct(F.lit(s).alias("source"), (100 * F.ln(s)).alias("value")) for s in ("price", "output")], F.struct(F.lit("rate").alias("source"), F.col("rate").alias("value")))).alias("x")).select("entity", "period", "x.*")
    spec = [("base", "y", "price", 0), ("base", "past", "price", 1), ("base", "ahead", "price", 2), ("base", "ahead", "price", 3), ("base", "slack", "output", 1), ("other", "y", "price", 0), ("other", "past", "price", 1), ("other", "ahead", "price", 4), ("other", "slack", "rate", 1)]
    terms = spark.createDataFrame(spec, "spec string, term string, source string, lag int")
    return macro.build_terms(long, terms)


_SPECS = """tm AS (
SELECT 'base' AS spec, entity, period, p AS y, lag(p) OVER w AS past, CASE WHEN lag(p, 2) OVER w IS NULL THEN lag(p, 3) OVER w WHEN lag(p, 3) OVER w IS NULL THEN lag(p, 2) OVER w ELSE (lag(p, 2) OVER w + lag(p, 3) OVER w) / 2 END AS ahead, lag(o) OVER w AS slack
FROM (SELECT entity, period, 100 * ln(price) AS p, 100 * ln(output) AS o FROM macro) WINDOW w AS (PARTITION BY entity ORDER BY period)
UNION ALL SELECT 'other', entity, period, p, lag(p) OVER w, lag(p, 4) OVER w, lag(rate) OVER w FROM (SELECT entity, period, 100 * ln(price) AS p, rate FROM macro) WINDOW w AS (PARTITION BY entity ORDER BY period)),
ds AS (SELECT * FROM tm WHERE y IS NOT NULL AND past IS NOT NULL AND ahead IS NOT NULL AND slack IS NOT NULL QUALIFY count(*) OVER (PARTITION BY spec, entity) >= 12)"""


@query(_with(A.MACRO, "p AS (SELECT entity, period, 100 * ln(price) AS v FROM macro)") + """, a AS (SELECT entity, period, lag(v, 2) OVER w AS x, lag(v, 3) OVER w AS y FROM p WINDOW w AS (PARTITION BY entity ORDER BY period))
SELECT entity, period, round(CASE WHEN x IS NULL THEN y WHEN y IS NULL THEN x ELSE (x + y) / 2 END, 5) AS value FROM a""")
def build_terms(spark, d):
    return _r(_terms(spark, d).where("spec = 'base' AND term = 'ahead'").select("entity", "period", "value"), 5)


@query(_with(A.MACRO) + """SELECT spec, entity, period, term, round(value, 4) AS value FROM (
SELECT 'a' AS spec, entity, period, 'year' AS term, lag((price / lag4 - 1) * 100, 1) OVER w AS value FROM (SELECT *, lag(price, 4) OVER w AS lag4 FROM macro WINDOW w AS (PARTITION BY entity ORDER BY period)) WINDOW w AS (PARTITION BY entity ORDER BY period)
UNION ALL SELECT 'a', entity, period, 'moved', CASE WHEN y IS NULL THEN x WHEN x IS NULL THEN y ELSE (x + y) / 2 END FROM (SELECT *, lag(moved, 1) OVER w AS x, lag(moved, 2) OVER w AS y FROM (SELECT entity, period, rate - lag(rate) OVER w AS moved FROM macro WINDOW w AS (PARTITION BY entity ORDER BY period)) WINDOW w AS (PARTITION BY entity ORDER BY period))
UNION ALL SELECT 'a', entity, period, 'level', rate FROM macro
UNION ALL SELECT 'b', entity, period, 'growth', 100 * (ln(output) - ln(lag(output) OVER w)) FROM macro WINDOW w AS (PARTITION BY entity ORDER BY period)
UNION ALL SELECT 'b', entity, period, 'yearly', (pow(1 + lag(rate, 3) OVER w / 100, 4) - 1) * 100 FROM macro WINDOW w AS (PARTITION BY entity ORDER BY period))""")
def term_transforms(spark, d):
    """Terms that transform their source before they lag it."""
    panel = A.macro(spark, d)
    long = panel.select("entity", "period", F.explode(F.array(*[F.struct(F.lit(s).alias("source"), F.col(s).alias("value")) for s in ("price", "output", "rate")])).alias("x")).select("entity", "period", "x.*")
    spec = [("a", "year", "price", 1, "yoy"), ("a", "moved", "rate", 1, "diff"), ("a", "moved", "rate", 2, "diff"), ("a", "level", "rate", 0, None), ("b", "growth", "output", 0, "log_diff"), ("b", "yearly", "rate", 3, "annualised_quarterly")]
    return _r(macro.build_terms(long, spark.createDataFrame(spec, "spec string, term string, source string, lag int, transform string")), 4)


def _design(spark, d) -> DataFrame:
    return macro.design(_terms(spark, d), ["y", "past", "ahead", "slack"], ["spec", "entity"])


@query(_with(A.MACRO, _SPECS) + "SELECT spec, entity, period, round(y, 5) AS y, round(past, 5) AS past, round(ahead, 5) AS ahead, round(slack, 5) AS slack FROM ds")
def term_design(spark, d):
    return _r(_design(spark, d).select("spec", "entity", "period", "y", "past", "ahead", "slack"), 5, "y", "past", "ahead", "slack")


@query(_with(A.MACRO, _Q) + """, z AS (SELECT entity, 100 * lp - ahead AS y, past - ahead AS x FROM (SELECT entity, lp, 100 * lag(lp, 1) OVER w AS past, (100 * lag(lp, 2) OVER w + 100 * lag(lp, 3) OVER w) / 2 AS ahead FROM q WINDOW w AS (PARTITION BY entity ORDER BY ix)) WHERE ahead IS NOT NULL)
SELECT entity, round(regr_slope(y, x), 4) AS past, round(1 - regr_slope(y, x), 4) AS ahead FROM z GROUP BY 1""")
def restricted_ols(spark, d):
    """Two inflation terms that sum to one; without the first lags, whose mean is of one value only."""
    w = Window.partitionBy("entity").orderBy("period")
    rows = _macro(spark, d).withColumns({"y": 100 * F.col("lp"), "past": 100 * F.lag("lp", 1).over(w), "ahead": 50 * (F.lag("lp", 2).over(w) + F.lag("lp", 3).over(w))})
    out = regression.restricted(rows, ["entity"], "y", ["past", "ahead"], "ahead")
    return out.groupBy("entity").agg(*[F.round(F.max(F.when(F.col("term") == t, F.col("coef"))), 4).alias(t) for t in ("past", "ahead")])


_MOVED = ", dm AS (SELECT spec, entity, period, y - ahead AS y, past - ahead AS past, slack FROM ds) "
_MOVED_XS = _CONST | {"past": "past", "slack": "slack"}


@query(_with(A.MACRO, _SPECS) + _MOVED + _terms_sql("dm", "spec, entity", "period", _MOVED_XS, "y", "4")
       + f" UNION ALL SELECT spec, entity, 'ahead', round(1 - coef, 4), round(se, 4), round((1 - coef) / se, 4), round({O.p_normal('(1 - coef) / se')}, 4), round(r2, 4), CAST(n AS BIGINT) FROM {O.term('dm', 'spec, entity', 'period', _MOVED_XS, 'past', 'y', '4')}")
def phillips(spark, d):
    return _terms_of(macro.phillips(_design(spark, d), ["spec", "entity"], ["past", "ahead"], "ahead", ["slack"], "y", 4)[0])


# the sum of both coefficients is the one of ahead once past enters as past - ahead
_VERTICAL = O.term("ds", "spec, entity", "period", _CONST | {"past": "past - ahead", "slack": "slack", "both": "ahead"}, "both", "y")


@query(_with(A.MACRO, _SPECS) + " " + _wald_sql("spec, entity", _VERTICAL, O.p_student("(coef - 1) / se", "dof")))
def phillips_vertical(spark, d):
    return _r(macro.phillips(_design(spark, d), ["spec", "entity"], ["past", "ahead"], "ahead", ["slack"], "y")[1], 4, "estimate", "se", "stat", "p_value")


_OOS_XS = _CONST | {"past": "past", "slack": "slack"}


@query(_with(A.MACRO, _SPECS) + f""", cut AS (SELECT DISTINCT period AS cutoff FROM ds WHERE period >= DATE '1999-01-01'),
seen AS (SELECT ds.*, cutoff FROM ds JOIN cut ON period < cutoff QUALIFY count(*) OVER (PARTITION BY spec, entity, cutoff) >= 12),
fc AS (SELECT * FROM {O.system("seen", "spec, entity, cutoff", _OOS_XS, {"y": "y"})}),
now AS (SELECT *, lag(y) OVER (PARTITION BY spec, entity ORDER BY period) AS before FROM ds),
er AS (SELECT spec, entity, y, b_y_const + b_y_past * past + b_y_slack * slack AS model, ahead AS survey, before FROM now JOIN fc USING (spec, entity) WHERE period = cutoff AND before IS NOT NULL)
SELECT spec, entity, round(sqrt(avg((y - model) * (y - model))), 4) AS rmse_model, round(sqrt(avg((y - survey) * (y - survey))), 4) AS rmse_survey, round(sqrt(avg((y - before) * (y - before))), 4) AS rmse_random_walk, count(*) AS n FROM er GROUP BY 1, 2""")
def expanding_oos(spark, d):
    rows = _design(spark, d)
    cutoffs = rows.select(F.col("period").alias("cutoff")).where("period >= DATE '1999-01-01'").distinct()
    return _r(macro.expanding_oos(rows, cutoffs, ["spec", "entity"], "y", ["past", "slack"], "ahead")[1], 4, "rmse_model", "rmse_survey", "rmse_random_walk")


def _oos_sql(gaps: str) -> str:
    """Backtests with a filter on every truncated sample, each spelt out as a series of its own."""
    return f"""WITH RECURSIVE {A.NAT},
pr AS (SELECT *, lag(y) OVER w AS past, lag(y, 2) OVER w AS survey FROM (SELECT *, 100 * (ln(value) - ln(lag(value) OVER w)) AS y FROM nat WINDOW w AS (PARTITION BY series_id ORDER BY period)) WINDOW w AS (PARTITION BY series_id ORDER BY period)),
grid AS (SELECT series_id || '#' || CAST(cutoff AS VARCHAR) AS key, series_id, cutoff, period, 100 * ln(value) AS value FROM nat JOIN (SELECT series_id, period AS cutoff FROM nat WHERE period >= DATE '1997-07-01') USING (series_id) WHERE period <= cutoff),
{gaps},
tr AS (SELECT grid.key, grid.series_id, cutoff, period, lag(gap) OVER (PARTITION BY grid.key ORDER BY period) AS slack FROM grid LEFT JOIN gaps USING (key, period)),
whole AS (SELECT tr.*, y, past, survey FROM tr JOIN pr USING (series_id, period) WHERE y IS NOT NULL AND past IS NOT NULL AND slack IS NOT NULL),
seen AS (SELECT * FROM whole WHERE period < cutoff QUALIFY count(*) OVER (PARTITION BY key) >= 12),
fc AS (SELECT * FROM {O.system("seen", "key", _OOS_XS, {"y": "y"})}),
er AS (SELECT series_id, y, b_y_const + b_y_past * past + b_y_slack * slack AS model, survey, past AS before FROM whole JOIN fc USING (key) WHERE period = cutoff AND survey IS NOT NULL)
SELECT series_id, round(sqrt(avg((y - model) * (y - model))), 3) AS rmse_model, round(sqrt(avg((y - survey) * (y - survey))), 3) AS rmse_survey, round(sqrt(avg((y - before) * (y - before))), 3) AS rmse_random_walk, count(*) AS n FROM er GROUP BY 1"""


def _oos(spark, d, method: str) -> DataFrame:
    w = Window.partitionBy("series_id").orderBy("period")
    rows = A.monthly_nations(spark, d).withColumn("y", 100 * (F.ln("value") - F.ln(F.lag("value").over(w))))
    rows = rows.withColumns({"past": F.lag("y").over(w), "survey": F.lag("y", 2).over(w)})
    cutoffs = rows.select(F.col("period").alias("cutoff")).where("cutoff >= DATE'1997-07-01'")
    return _r(backtest.filtered_oos(rows, cutoffs, ["series_id"], "y", ["past"], "survey", "value", 1, method)[1], 3, "rmse_model", "rmse_survey", "rmse_random_walk")


@query(_oos_sql(O.hp("grid", "key").lstrip() + ", gaps AS (SELECT key, period, value - trend AS gap FROM hp)"))
def oos_two_sided(spark, d):
    return _oos(spark, d, "hp")


@query(_oos_sql(_hamilton("grid", "key", "value").lstrip() + ", gaps AS (SELECT key, period, gap FROM ham)"))
def oos_one_sided(spark, d):
    return _oos(spark, d, "hamilton")


@query(_with(A.OBS, A.MON, "every AS (SELECT series_id FROM obs UNION ALL SELECT series_id FROM mon)", A.dimension_sql("every")) + """, r AS (SELECT * FROM (VALUES ('D', 0), ('B', 1), ('W', 2), ('M', 3), ('Q', 4), ('A', 5)) v(f, k)),
t AS (SELECT series_id, freq, "to", a.k AS have, b.k AS want FROM dim, (VALUES ('D'), ('B'), ('W'), ('M'), ('Q'), ('A'), ('Z')) v("to") LEFT JOIN r a ON a.f = freq LEFT JOIN r b ON b.f = "to")
SELECT series_id, freq, "to", CASE WHEN want IS NULL THEN 'unknown frequency in ' || freq || ' -> ' || "to" ELSE freq || ' can''t become ' || "to" || ': values would have to be invented' END AS error FROM t WHERE want IS NULL OR want < have""")
def refused_conversions(spark, d):
    """Conversions of every series to every frequency that would invent values, or that nobody knows."""
    every = A.dimension(A.bitemporal(spark, d).select("series_id").union(A.monthly(spark, d).select("series_id")))
    pairs = every.select("series_id", "freq", F.explode(F.array(*map(F.lit, [*calendar.RANK, "Z"]))).alias("to"))
    return pairs.withColumn("error", transforms.conversion_error("freq", "to")).where("error IS NOT NULL")


_LP = "lpx AS (SELECT * FROM (SELECT series_id AS entity, period, ln(value) AS output, CAST(month(period) % 5 AS DOUBLE) AS shock FROM nat))," + O.lagged("lpx", "entity", ["output", "shock"], 2, "lpl") + ", lpm AS (" + " UNION ALL ".join(f"SELECT l.entity, l.period, {h} AS h, m.moved, l.shock, l1_output, l2_output, l1_shock, l2_shock FROM lpl l JOIN (SELECT entity, period, lead(output, {h}) OVER (PARTITION BY entity ORDER BY period) - output AS moved FROM lpx) m USING (entity, period) WHERE moved IS NOT NULL" for h in range(9)) + f"), lpk AS (SELECT * FROM lpm QUALIFY count(*) OVER (PARTITION BY entity, h) >= {macro.LEAST_PROJECTION})"
_LP_XS = _CONST | {c: c for c in ("l1_output", "l2_output", "l1_shock", "l2_shock")} | {"shock": "shock"}


@query(_with(A.NAT, _LP) + f" SELECT entity, 'output' AS response, h, round(coef, 5) + 0.0 AS coef, round(se, 5) AS se, round(coef - 1.96 * se, 5) + 0.0 AS low, round(coef + 1.96 * se, 5) + 0.0 AS high, CAST(n AS BIGINT) AS n FROM {O.term('lpk', 'entity, h', 'period', _LP_XS, 'shock', 'moved', 'greatest(h, 1)')}")
def local_projections(spark, d):
    panel = A.monthly_nations(spark, d).select(F.col("series_id").alias("entity"), "period", F.ln("value").alias("output"), (F.month("period") % 5).cast("double").alias("shock"))
    out = _r(macro.local_projections(panel, ["entity"], ["output"], "shock", ["output", "shock"], horizon=8, lags=2), 5, "coef", "se", "low", "high")
    return out.withColumns({c: F.col(c) + 0.0 for c in ("coef", "low", "high")})


def _var(spark, d) -> DataFrame:
    return _macro(spark, d).select("entity", "period", "lp", "lo", "rate")


def _fitted(spark, d) -> DataFrame:
    return var.var_fit(_var(spark, d), ["entity"], ["lp", "lo", "rate"], 2)


_THREE, _TWO = ["lp", "lo", "rate"], ["lp", "rate"]
_VAR3 = _with(A.MACRO, _Q, O.lagged("q", "entity", _THREE, 2, "vl"), f"vf AS (SELECT * FROM {O.var_system('vl', 'entity', _THREE, 2)})")
_VAR2 = _with(A.MACRO, _Q, O.lagged("q", "entity", _TWO, 1, "vl"), f"vf AS (SELECT * FROM {O.var_system('vl', 'entity', _TWO, 1)})")


def _var_terms_sql(columns: list[str], lags: int) -> str:
    names = {"const": "const"} | {f"l{p}_{c}": f"L{p}.{c}" for p in range(1, lags + 1) for c in columns}
    return " UNION ALL ".join(f"SELECT entity, '{y}' AS equation, '{shown}' AS term, round(b_{y}_{x}, 4) AS coef FROM vf" for y in columns for x, shown in names.items())


@query(_with(A.MACRO, _Q) + "SELECT entity, 'lp' AS equation, round(regr_slope(lp, p), 5) AS coef FROM (SELECT entity, lp, lag(lp) OVER (PARTITION BY entity ORDER BY ix) AS p FROM q) WHERE p IS NOT NULL GROUP BY 1")
def var_one(spark, d):
    """A system of one variable and one lag is a plain regression."""
    out = var.var_coefficients(var.var_fit(_var(spark, d), ["entity"], ["lp"], 1), ["entity"])
    return out.where("term = 'L1.lp'").select("entity", "equation", F.round("coef", 5).alias("coef"))


@query(_VAR3 + _var_terms_sql(_THREE, 2))
def var_coefficients(spark, d):
    return _r(var.var_coefficients(_fitted(spark, d), ["entity"]), 4, "coef")


_DET3 = O.determinant([[f"ssr_{a}_{b} / n" for b in _THREE] for a in _THREE])


@query(_VAR3.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + "," + O.spectral_radius("vf", "entity", _THREE, 2) + f" SELECT entity, CAST(n AS BIGINT) AS n, 2 AS lags, 'lp,lo,rate' AS recursive_order, round(max_root, 4) AS max_root, round(-n / 2.0 * (3 * ln(2 * pi()) + ln({_DET3}) + 3), 4) AS log_likelihood FROM vf JOIN radius USING (entity)")
def var_diagnostics(spark, d):
    return _r(var.var_diagnostics(_fitted(spark, d), ["entity"]), 4, "max_root", "log_likelihood")


@query(_VAR2 + """SELECT entity, CAST(n AS BIGINT) AS n, 1 AS lags, 'lp,rate' AS recursive_order, round(CASE WHEN tr * tr / 4 >= de THEN greatest(abs(tr / 2 + sqrt(greatest(tr * tr / 4 - de, 0))), abs(tr / 2 - sqrt(greatest(tr * tr / 4 - de, 0)))) ELSE sqrt(de) END, 4) AS max_root,
round(-n / 2.0 * (2 * ln(2 * pi()) + ln((ssr_lp_lp * ssr_rate_rate - ssr_lp_rate * ssr_lp_rate) / n / n) + 2), 4) AS log_likelihood
FROM (SELECT *, b_lp_l1_lp + b_rate_l1_rate AS tr, b_lp_l1_lp * b_rate_l1_rate - b_lp_l1_rate * b_rate_l1_lp AS de FROM vf)""")
def var_two_diagnostics(spark, d):
    return _r(var.var_diagnostics(var.var_fit(_var(spark, d), ["entity"], _TWO, 1), ["entity"]), 4, "max_root", "log_likelihood")


def _criteria_sql(lags: int) -> str:
    xs = _CONST | {f"l{p}_{c}": f"l{p}_{c}" for p in range(1, lags + 1) for c in _THREE}
    free = 9 * lags + 3
    det = O.determinant([[f"ssr_{a}_{b} / n" for b in _THREE] for a in _THREE])
    return f"SELECT entity, {lags} AS lags, ln({det}) + 2.0 * {free} / n AS aic, ln({det}) + ln(n) * {free} / n AS bic, ln({det}) + 2 * ln(ln(n)) * {free} / n AS hqic FROM {O.system('vl', 'entity', xs, {c: c for c in _THREE})}"


@query(_with(A.MACRO, _Q, O.lagged("q", "entity", _THREE, 3, "vl"), "cr AS (" + " UNION ALL ".join(map(_criteria_sql, (1, 2, 3))) + ")") + "SELECT entity, lags, round(aic, 4) AS aic, round(bic, 4) AS bic, round(hqic, 4) AS hqic, row_number() OVER (PARTITION BY entity ORDER BY aic, lags) = 1 AS chosen FROM cr")
def var_select(spark, d):
    return _r(var.var_select(_var(spark, d), ["entity"], ["lp", "lo", "rate"], 3), 4, "aic", "bic", "hqic")


def _troubled(spark, d) -> DataFrame:
    """The system with one entity whose rate never moves and one that lacks a quarter."""
    return _var(spark, d).withColumn("rate", F.when(F.col("entity") == "n1", 5.0).otherwise(F.col("rate"))).where("NOT (entity = 'n2' AND period = DATE'1995-04-01')")


_TROUBLED = """, tb AS (SELECT entity, period, lp, lo, CASE WHEN entity = 'n1' THEN 5.0 ELSE rate END AS rate FROM q WHERE NOT (entity = 'n2' AND period = DATE '1995-04-01')),
ho AS (SELECT entity, count(*) AS k, min(period) AS first FROM (SELECT entity, CAST(unnest(generate_series(a, b, INTERVAL 3 MONTH)) AS DATE) AS period FROM (SELECT entity, min(period) AS a, max(period) AS b FROM tb GROUP BY 1)) ANTI JOIN tb USING (entity, period) GROUP BY 1)"""


@query(_with(A.MACRO, _Q) + _TROUBLED + """ SELECT entity, 'not regular at Q: ' || k || ' periods, first ' || first || ' hole' AS error FROM ho
UNION ALL SELECT entity, CASE WHEN count(*) < 12 THEN CAST(greatest(count(*) - 2, 0) AS VARCHAR) || ' complete rows, 10 are needed' ELSE 'singular' END FROM tb ANTI JOIN ho USING (entity) GROUP BY 1 HAVING count(*) < 12 OR any_value(entity) = 'n1'""")
def var_refused(spark, d):
    """One singular, one short or one gappy group ends no job: each has its row."""
    return var.var_errors(_troubled(spark, d), ["entity"], _THREE, 2, "Q")


@query(_with(A.MACRO, _Q) + _TROUBLED + ", sound AS (SELECT * FROM tb ANTI JOIN ho USING (entity) WHERE entity <> 'n1'), " + O.lagged("sound", "entity", _THREE, 2, "vl") + f", vf AS (SELECT * FROM {O.var_system('vl', 'entity', _THREE, 2)} WHERE n >= 10) " + _var_terms_sql(_THREE, 2))
def var_of_the_sound(spark, d):
    return _r(var.var_coefficients(var.var_fit(_troubled(spark, d), ["entity"], _THREE, 2, "Q"), ["entity"]), 4, "coef")


# what was known on each day, spelt out: every observation once for each day
_KNOWN = A.OBS + """, days AS (SELECT DISTINCT CAST(ts AS DATE) AS "asof" FROM events),
grid AS (SELECT "asof", series_id, period, value / 100 AS value FROM obs JOIN days ON realtime_start <= "asof" AND (realtime_end IS NULL OR realtime_end > "asof") WHERE value IS NOT NULL)"""
_LAG = lambda k: f"""lg{k} AS (SELECT "asof", series_id, period + {k} AS period, value AS l{k} FROM grid)"""


def _versions(spark, d) -> DataFrame:
    return A.bitemporal(spark, d).where("value IS NOT NULL").withColumn("value", F.col("value") / 100)


def _on_days(spark, d, fits: DataFrame) -> DataFrame:
    return vintages.as_of_grid(fits, _days(spark, d)).drop("realtime_start", "realtime_end")


@query(_with(_KNOWN, _LAG(1)) + """SELECT "asof", series_id, count(*) AS n, round(regr_intercept(value, l1), 4) AS const, round(regr_slope(value, l1), 4) AS slope, round(regr_r2(value, l1), 4) AS r2
FROM grid JOIN lg1 USING ("asof", series_id, period) GROUP BY 1, 2 HAVING count(*) >= 8""")
def ols_every_asof(spark, d):
    """A series on its value of the day before, as it would have been fitted on each day."""
    fits = sweeps.fit_over_time(sweeps.lagged_vintages(_versions(spark, d), "D", [1]), ["series_id"], "value", ["value_l1"], least_rows=8)
    out = _on_days(spark, d, fits).select("asof", "series_id", "n", F.col("beta")[0].alias("const"), F.col("beta")[1].alias("slope"), "r2")
    return _r(out, 4, "const", "slope", "r2")


@query(_with(_KNOWN, _LAG(1), _LAG(2)) + """, rs AS (SELECT "asof", series_id, value - l2 AS y, l1 - l2 AS x FROM grid JOIN lg1 USING ("asof", series_id, period) JOIN lg2 USING ("asof", series_id, period)),
rf AS (SELECT "asof", series_id, count(*) AS n, regr_slope(y, x) AS b FROM rs GROUP BY 1, 2 HAVING count(*) >= 8)
SELECT "asof", series_id, n, 'value_l1' AS term, round(b, 4) AS coef FROM rf UNION ALL SELECT "asof", series_id, n, 'value_l2', round(1 - b, 4) FROM rf""")
def restricted_every_asof(spark, d):
    """Two lags whose coefficients sum to one, on each day."""
    rows = sweeps.lagged_vintages(_versions(spark, d), "D", [1, 2])
    fits = sweeps.restricted_over_time(rows, ["series_id"], "value", ["value_l1", "value_l2"], "value_l2", least_rows=8)
    return _r(_on_days(spark, d, fits).where("term <> 'const'"), 4, "coef").select("asof", "series_id", "n", "term", "coef")


_VAR_DAYS = O.system("vr", '"asof"', {"const": "1.0", "l1_a": "l1_a", "l1_b": "l1_b"}, {"a": "a", "b": "b"})


@query(_with(_KNOWN) + """, ab AS (SELECT "asof", period, a.value AS a, b.value AS b FROM (SELECT * FROM grid WHERE series_id = 'ev:click') a JOIN (SELECT * FROM grid WHERE series_id = 'ev:view') b USING ("asof", period)),
vr AS (SELECT ab.*, z.a AS l1_a, z.b AS l1_b FROM ab JOIN ab z ON ab."asof" = z."asof" AND ab.period = z.period + 1 QUALIFY count(*) OVER (PARTITION BY ab."asof") >= 8)
SELECT "asof", CAST(n AS BIGINT) AS n, equation, term, round(coef, 4) AS coef FROM (""" + " UNION ALL ".join(f"""SELECT "asof", n, '{y}' AS equation, '{t}' AS term, b_{y}_{x} AS coef FROM {_VAR_DAYS}""" for y in "ab" for x, t in (("const", "const"), ("l1_a", "L1.a"), ("l1_b", "L1.b"))) + ")")
def var_every_asof(spark, d):
    """An autoregression of two revised series, on each day."""
    obs = _versions(spark, d)
    panel = sweeps.joined_vintages({name: obs.where(F.col("series_id") == s) for name, s in (("a", "ev:click"), ("b", "ev:view"))}).withColumn("pair", F.lit("click, view"))
    fits = sweeps.var_over_time(panel, ["pair"], ["a", "b"], "D").where("n >= 8")
    terms = var.var_coefficients(fits, ["pair", "realtime_start", "realtime_end", "n"])
    return _r(_on_days(spark, d, terms).select("asof", "n", "equation", "term", "coef"), 4, "coef")


_IRF = _VAR3.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + "," + O.irf("vf", "entity", _THREE, 2, 12)


@query(_IRF + " SELECT entity, shock, response, h, round(value, 5) + 0.0 AS value FROM irf_long")
def var_irf(spark, d):
    return _r(var.var_irf(_fitted(spark, d), ["entity"], 12), 5).withColumn("value", F.col("value") + 0.0)


@query(_IRF + """, cum AS (SELECT *, sum(value * value) OVER (PARTITION BY entity, response, shock ORDER BY h) AS v FROM irf_long)
SELECT entity, shock, response, h, round(v / sum(v) OVER (PARTITION BY entity, response, h), 5) AS share FROM cum""")
def var_fevd(spark, d):
    return _r(var.var_fevd(var.var_irf(_fitted(spark, d), ["entity"], 12), ["entity"]), 5, "share")


@query(_with(A.MACRO) + "SELECT entity, response, h, 1.0::DOUBLE AS share FROM (SELECT DISTINCT entity FROM macro), (VALUES ('lp'), ('lo'), ('rate')) r(response), (SELECT unnest(range(13))::INTEGER AS h)")
def var_fevd_sums(spark, d):
    fevd = var.var_fevd(var.var_irf(_fitted(spark, d), ["entity"], 12), ["entity"])
    return fevd.groupBy("entity", "response", "h").agg(F.round(F.sum("share"), 6).alias("share"))


_BAND = ("low", "median", "high")
_PATHS = _VAR3.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + "," + O.irf("vf", "entity", _THREE, 2, 20) + "," + O.rotations(_THREE, 2000, 1) + """,
paths AS (SELECT entity, draw, s, response, h, sum(value * q) AS v FROM irf_long JOIN rot USING (shock) GROUP BY ALL),
held AS (SELECT entity, draw, s, side FROM paths, (VALUES (1), (-1)) t(side) WHERE h <= 3 AND response IN ('lp', 'rate') GROUP BY ALL HAVING bool_and(side * v * CASE response WHEN 'lp' THEN -1 ELSE 1 END > 0))"""


@query(_PATHS + """
SELECT entity, response, h, round(quantile_cont(side * v, 0.16), 4) + 0.0 AS low, round(quantile_cont(side * v, 0.5), 4) + 0.0 AS median, round(quantile_cont(side * v, 0.84), 4) + 0.0 AS high, count(*) AS n_accepted FROM paths JOIN held USING (entity, draw, s) GROUP BY ALL""")
def sign_restricted(spark, d):
    bands = var.sign_restricted(_fitted(spark, d), ["entity"], {"lp": -1, "rate": 1}, 2000, 1, 3, 20)[0]
    return _r(bands, 4, *_BAND).withColumns({c: F.col(c) + 0.0 for c in _BAND})


@query(_PATHS + " SELECT entity, count(draw) AS accepted, CAST(12000 AS BIGINT) AS tried, count(draw) / 12000.0 AS rate FROM (SELECT DISTINCT entity FROM irf_long) LEFT JOIN held USING (entity) GROUP BY 1")
def sign_acceptance(spark, d):
    return var.sign_restricted(_fitted(spark, d), ["entity"], {"lp": -1, "rate": 1}, 2000, 1, 3, 20)[1]


# results ----------------------------------------------------------------------------------------------------------

_MELT = """SELECT 'run' AS model_run_id, 'customers' AS table_name, CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS INTEGER) AS row_ix, * FROM customer"""


def _melted(spark, d) -> DataFrame:
    return results.melt(A.table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), "customers", "run", ["c_custkey"])


@query(f"""WITH m AS ({_MELT}) SELECT model_run_id, table_name, row_ix, 'c_custkey' AS column_name, CAST(c_custkey AS DOUBLE) AS value_num, CAST(NULL AS VARCHAR) AS value_txt FROM m
UNION ALL SELECT model_run_id, table_name, row_ix, 'c_acctbal', c_acctbal, NULL FROM m UNION ALL SELECT model_run_id, table_name, row_ix, 'c_mktsegment', NULL, c_mktsegment FROM m""")
def melt(spark, d):
    return _melted(spark, d)


@query(f"WITH m AS ({_MELT}) SELECT model_run_id, table_name, row_ix, CAST(c_custkey AS DOUBLE) AS c_custkey, c_acctbal, c_mktsegment FROM m")
def unmelt(spark, d):
    return results.unmelt(_melted(spark, d), ["c_custkey", "c_acctbal", "c_mktsegment"], ["c_custkey", "c_acctbal"])


@query("SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, c_acctbal, c_mktsegment, CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS INTEGER) AS row_ix FROM customer")
def saved_result(spark, d):
    """A run's table, saved and loaded."""
    root = new_path(spark)
    run = {"model_run_id": "r", "model_id": "m", "model_version": "1", "asof": "2024-01-01", "seed": 1, "vintage_kind": "true", "created_at": "2024-01-02 00:00:00", "params": {"a": 1}}
    results.save_result(root, run, {"customers": (A.table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), ["c_custkey"])})
    return results.load_result(tables.read_table(spark, root, "model_outputs"), "r", "customers", ["c_custkey", "c_acctbal", "c_mktsegment"], ["c_custkey", "c_acctbal"])


def _runs(spark, d) -> DataFrame:
    return A.table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("model_run_id"), F.col("o_orderpriority").alias("model_id"), F.col("o_orderstatus").alias("spec_id"), F.to_date("o_orderdate").alias("asof"), F.to_date("o_orderdate").alias("created_at"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS model_run_id, o_orderstatus AS spec_id, CAST(o_orderdate AS DATE) AS created_at FROM orders WHERE o_orderpriority = '1-URGENT'")
def list_runs(spark, d):
    return results.list_runs(_runs(spark, d), "1-URGENT").select("model_run_id", "spec_id", "created_at")


@query("SELECT o_orderstatus AS spec_id, column_name, count(*) AS n, round(sum(value_num), 2) AS total FROM orders JOIN (SELECT l_orderkey, 'quantity' AS column_name, l_quantity AS value_num FROM lineitem) ON l_orderkey = o_orderkey GROUP BY 1, 2")
def compare_specs(spark, d):
    outputs = A.table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("model_run_id"), F.lit("coefficients").alias("table_name"), F.lit("quantity").alias("column_name"), F.col("l_quantity").cast("double").alias("value_num"))
    return macro.compare_specs(_runs(spark, d), outputs).groupBy("spec_id", "column_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value_num"), 2).alias("total"))
