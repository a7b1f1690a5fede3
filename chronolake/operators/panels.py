"""Panels: several series aligned on periods, long until the edge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import period_start
from . import catalog, transforms, vintages


#: Columns of a panel at most.
MOST_LABELS = 10_000


def trim(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Periods from ``start`` to ``end``, both included."""
    if start is not None:
        df = df.where(F.col("period") >= F.lit(str(start)).cast("date"))
    return df.where(F.col("period") <= F.lit(str(end)).cast("date")) if end is not None else df


def get(obs: DataFrame, series: DataFrame, concepts: DataFrame, ids: Sequence[str] | DataFrame, start: str | None = None, end: str | None = None, asof: str | None = None, kind: str = "mixed", freq: str | None = None, agg: str | None = None, transform: str | None = None) -> DataFrame:
    """Series as of a day, converted, transformed and trimmed, in this order: a change at ``start`` has what it needs before it."""
    if agg is not None and freq is None:
        raise ValueError("agg goes with freq")
    if isinstance(ids, str):
        raise TypeError("ids is a list of series ids, not one of them")
    wanted = ids.select("series_id").distinct() if isinstance(ids, DataFrame) else obs.sparkSession.createDataFrame([(i,) for i in ids], "series_id string")
    rows = obs.join(wanted, "series_id", "left_semi")
    rows = vintages.read_as_of(rows, series, asof, kind if asof is not None else "latest").select("series_id", "period", "value")
    if freq is not None:
        if agg is None:
            rows = transforms.resample_by_concept(rows, series, concepts, freq)
        else:
            chosen = series.select("concept_id").distinct().withColumn("default_agg", F.lit(agg))
            rows = transforms.resample_by_concept(rows, series.withColumn("concept_id", F.coalesce("concept_id", F.lit(""))), chosen.select(F.coalesce("concept_id", F.lit("")).alias("concept_id"), "default_agg").distinct(), freq)
    if transform is not None:
        if freq is None:
            own = [r[0] for r in series.join(wanted, "series_id", "left_semi").select("freq").distinct().collect()]
            if len(own) != 1:
                raise ValueError("a transform needs series of one frequency, or freq")
            freq = own[0]
        rows = transforms.transform(rows, transform, freq)
    return trim(rows, start, end)


def panel_keys(keys: Sequence[str | tuple[str, str]], entities: Sequence[str] | None = None) -> list[tuple[str | None, str, str]]:
    """(entity, key, label) of concepts, series ids, (concept, entity) pairs, or concepts for several entities."""
    pairs = [k for k in keys if not isinstance(k, str)]
    if pairs and entities:
        raise ValueError("pairs name their entities already")
    if pairs:
        return [(None, k, k) if isinstance(k, str) else (k[1], k[0], f"{k[0]}@{k[1]}") for k in keys]
    if entities:
        return [(e, k, k if ":" in k else f"{k}@{e}") for e in entities for k in keys]
    return [(None, k, k) for k in keys]


def label_rows(rows: DataFrame, keys: list[tuple[str | None, str, str]], series: DataFrame) -> DataFrame:
    """Rows of the keys' series with their labels."""
    frame = series.sparkSession.createDataFrame(keys, "entity_id string, key string, label string")
    found, _ = catalog.resolve(frame, series)
    named = found.join(frame.withColumnRenamed("entity_id", "_e").withColumnRenamed("key", "_k"), F.col("key").eqNullSafe(F.col("_k")) & F.col("entity_id").eqNullSafe(F.col("_e")))
    return rows.join(named.select("series_id", "label"), "series_id")


def panel(rows: DataFrame, labels: Sequence[str], how: str = "outer", group: Sequence[str] = ()) -> DataFrame:
    """One column per label, one row per (group, period); ``inner`` keeps the periods that every label has."""
    if how not in ("outer", "inner"):
        raise ValueError("how is outer or inner")
    rows = rows.where(F.col("label").isin(list(labels)))
    wide = rows.groupBy(*group, "period").pivot("label", list(labels)).agg(F.first("value"))
    if how == "inner":
        has = rows.groupBy(*group, "period").agg(F.countDistinct("label").alias("_n")).where(F.col("_n") == len(set(labels))).drop("_n")
        wide = wide.join(has, [*group, "period"], "left_semi")
    return wide


def panel_grid(obs: DataFrame, dates: DataFrame, labelled: DataFrame, labels: Sequence[str]) -> DataFrame:
    """The panel as of many days at once; ``labelled`` has (series_id, label)."""
    rows = vintages.as_of_grid(obs.join(labelled, "series_id"), dates)
    return panel(rows, labels, "outer", ["asof"])


def missing_inputs(rows: DataFrame, requests: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Required labels of ``requests`` (label, required) that the panel, or one of its groups, does not have.

    The labels that are asked for are a list in each group's row, as they would be in an application's settings.
    """
    need = requests.where(F.coalesce("required", F.lit(True))).select("label").distinct()
    if not group:
        return need.join(rows.select("label").distinct(), "label", "left_anti")
    asked = [r[0] for r in need.limit(MOST_LABELS + 1).collect()]
    if len(asked) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels are no panel")
    per = rows.groupBy(*group).agg(F.collect_set(F.when(F.col("label").isin(asked), F.col("label"))).alias("_has"))  # bounded by what is asked for
    return per.select(*group, F.explode(F.array_except(F.array(*map(F.lit, asked)).cast("array<string>"), "_has")).alias("label"))


def _step(freq: str) -> Column:
    return F.expr({"M": "INTERVAL 1 MONTH", "Q": "INTERVAL 3 MONTH", "A": "INTERVAL 1 YEAR", "W": "INTERVAL 7 DAY"}[freq])


def grid_violations(df: DataFrame, freq: str, group: Sequence[str] = ("series_id",)) -> DataFrame:
    """(group, period, violation): periods off the grid of M, Q, A or W, and holes between the first and the last one."""
    if freq in ("D", "B"):
        return df.select(*group, "period", F.lit("").alias("violation")).where("false")
    rows = df.select(*group, "period").distinct()
    start = period_start(F.col("period"), freq)
    off = rows.where(F.col("period") != start).select(*group, "period", F.lit("off the grid").alias("violation"))
    span = rows.groupBy(*group).agg(F.min(start).alias("a"), F.max(start).alias("b"))
    full = span.select(*group, F.explode(F.sequence("a", "b", _step(freq))).alias("period"))
    holes = full.join(rows.select(*group, start.alias("period")).distinct(), [*group, "period"], "left_anti")
    return off.unionByName(holes.select(*group, "period", F.lit("hole").alias("violation")))


def regular(df: DataFrame, freq: str, group: Sequence[str] = ("series_id",)) -> tuple[DataFrame, DataFrame]:
    """The rows of the groups on their grid, and (group, error) of the others: models shift by rows, so a hole would shift every lag."""
    first = grid_violations(df, freq, group).groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("period", "violation")).alias("_v"))
    told = F.concat(F.lit(f"not regular at {freq}: "), F.col("_n").cast("string"), F.lit(" periods, first "), F.col("_v.period").cast("string"), F.lit(" "), F.col("_v.violation"))
    bad = first.select(*group, told.alias("error"))
    same = [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in group]
    return df.alias("a").join(bad.alias("b"), same, "left_anti"), bad
