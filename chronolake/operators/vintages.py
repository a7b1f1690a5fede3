"""Bitemporal reads. Observations are (series_id, period, value, realtime_start, realtime_end); the interval
[realtime_start, realtime_end) is when a value was the known one, and a null end means it still is."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import published_at

#: A calendar of so many days is still broadcast; a longer one is joined like any other table.
MANY_DAYS = 400_000


def _date(day: str | dt.date | Column) -> Column:
    return day if isinstance(day, Column) else F.lit(str(day)).cast("date")


def known_on(day: str | dt.date | Column) -> Column:
    """Predicate: the row was the known value on a day."""
    day = _date(day)
    return (F.col("realtime_start") <= day) & (F.col("realtime_end").isNull() | (F.col("realtime_end") > day))


def latest(obs: DataFrame) -> DataFrame:
    return obs.where("realtime_end IS NULL")


def as_of(obs: DataFrame, day: str | dt.date) -> DataFrame:
    return obs.where(known_on(day))


def as_of_grid(obs: DataFrame, dates: DataFrame) -> DataFrame:
    """``as_of`` for every ``asof`` of ``dates`` in one pass; rows gain the column ``asof``.

    Dates are numbered, and a calendar says how many come before each day. So a row's first and last date follow
    from its interval by equi-joins, and the row is repeated for the dates it was known on, however many there are.
    Dates and calendar have no more rows than days from the first to the last date; up to ``MANY_DAYS`` of them are
    broadcast.
    """
    spark = obs.sparkSession
    dates = dates.select(F.col("asof").cast("date").alias("asof")).where("asof IS NOT NULL").distinct()
    first, last = dates.agg(F.min("asof"), F.max("asof")).first()
    if first is None:
        return obs.withColumn("asof", F.lit(None).cast("date")).where("false")
    small = F.broadcast if (last - first).days <= MANY_DAYS else lambda df: df
    ordered = Window.orderBy("asof")
    ranked = dates.select("asof", F.row_number().over(ordered).alias("_rank"))
    day, behind = _date(first), F.date_add(_date(last), 1)
    days = spark.range(1).select(F.explode(F.sequence(day, behind)).alias("_day"))
    seen = F.count("asof").over(Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1))
    calendar = days.join(dates, F.col("_day") == F.col("asof"), "left").select("_day", seen.alias("_before"))
    opens, ends = F.greatest(F.col("realtime_start"), day), F.least(F.coalesce("realtime_end", behind), behind)
    rows = obs.where((F.col("realtime_start") <= _date(last)) & (F.col("realtime_end").isNull() | (F.col("realtime_end") > day))).withColumns({"_opens": opens, "_ends": ends})
    rows = rows.join(small(calendar.select(F.col("_day").alias("_opens"), F.col("_before").alias("_from"))), "_opens").join(small(calendar.select(F.col("_day").alias("_ends"), F.col("_before").alias("_to"))), "_ends")
    rows = rows.where("_from < _to").withColumn("_rank", F.explode(F.sequence(F.col("_from") + 1, F.col("_to"))))
    return rows.join(small(ranked), "_rank").select(*obs.columns, "asof")


def first_release(obs: DataFrame) -> DataFrame:
    """The earliest row of each (series, period), whole, a missing first value included."""
    rows = obs.groupBy("series_id", "period").agg(F.min_by(F.struct(*obs.columns), "realtime_start").alias("first"))
    return rows.select("first.*")


def observations(obs: DataFrame, ids: Sequence[str] | DataFrame | None = None, day: str | dt.date | None = None, history: bool = False) -> DataFrame:
    """Rows of some series: current, as of a day, or all vintages; in order of series, period and start."""
    if isinstance(ids, str):
        raise TypeError("ids is a list of series ids, not one of them")
    if isinstance(ids, DataFrame):
        obs = obs.join(ids.select("series_id").distinct(), "series_id", "left_semi")
    elif ids is not None:
        obs = obs.where(F.col("series_id").isin(list(ids)) if ids else F.lit(False))
    if not history:
        obs = latest(obs) if day is None else as_of(obs, day)
    return obs.orderBy("series_id", "period", "realtime_start")


def vintages(obs: DataFrame, ids: Sequence[str] | DataFrame) -> DataFrame:
    return observations(obs, ids, history=True)


def revisions(obs: DataFrame) -> DataFrame:
    """Per series: rows beyond the current ones, and how far current values are from first ones on average."""
    per = obs.groupBy("series_id", "period").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("realtime_end").isNull()).alias("n_open"), F.min_by("value", "realtime_start").alias("first"), F.max(F.when(F.col("realtime_end").isNull(), F.col("value"))).alias("now"))
    return per.groupBy("series_id").agg(F.sum(F.col("n") - F.col("n_open")).alias("n_revisions"), F.avg(F.abs(F.col("now") - F.col("first"))).alias("mean_abs_revision"))


def availability(obs: DataFrame, series: DataFrame) -> DataFrame:
    """Per series: whether it has true vintages (its flag, else several starts), and since when it is known."""
    flag = F.col("has_vintages") if "has_vintages" in series.columns else F.lit(None).cast("boolean")
    seen = obs.groupBy("series_id").agg(F.countDistinct("realtime_start").alias("n_starts"), F.min("realtime_start").alias("known_since"))
    return series.select("series_id", flag.alias("flag")).join(seen, "series_id", "left").select("series_id", F.coalesce("flag", F.coalesce("n_starts", F.lit(0)) > 1).alias("has_vintages"), "known_since")


def _published(obs: DataFrame, series: DataFrame) -> DataFrame:
    own = series.select("series_id", "freq", "expected_lag_days")
    return obs.join(own, "series_id").withColumn("published", published_at(F.col("period"), F.col("freq"), F.col("expected_lag_days")))


def pseudo_as_of(obs: DataFrame, series: DataFrame, day: str | dt.date) -> tuple[DataFrame, DataFrame]:
    """Current values that were out by a day, and (series_id, error) of the series whose lag is unknown."""
    out = _published(latest(obs), series).where(F.col("published") <= _date(day)).drop("freq", "expected_lag_days", "published")
    errors = series.where("expected_lag_days IS NULL").join(obs.select("series_id").distinct(), "series_id", "left_semi").select("series_id", F.lit("expected_lag_days is not known").alias("error"))
    return out.select(*obs.columns), errors


def read_as_of(obs: DataFrame, series: DataFrame, day: str | dt.date | None, kind: str = "mixed") -> DataFrame:
    """Rows by kind of vintage, with the column ``vintage_kind``: latest, true, pseudo, or mixed (true where a series has vintages)."""
    if kind not in ("latest", "true", "pseudo", "mixed"):
        raise ValueError(f"unknown vintage kind {kind}")
    if kind == "latest" or day is None:
        return latest(obs).withColumn("vintage_kind", F.lit("latest"))
    known = availability(obs, series).select("series_id", "has_vintages")
    rows = _published(obs, series).join(known, "series_id")
    true, pseudo = known_on(day), F.col("realtime_end").isNull() & (F.col("published") <= _date(day))
    is_true = {"true": F.lit(True), "pseudo": F.lit(False), "mixed": F.col("has_vintages")}[kind]
    out = rows.where(F.when(is_true, true).otherwise(F.coalesce(pseudo, F.lit(False)))).withColumn("vintage_kind", F.when(is_true, "true").otherwise("pseudo"))
    return out.select(*obs.columns, "vintage_kind")


def as_of_artefacts(obs: DataFrame, series: DataFrame, day: str | dt.date) -> DataFrame:
    """Series without true vintages that look empty on a day only because collecting them began later."""
    seen = availability(obs, series).where(~F.col("has_vintages") & (F.col("known_since") > _date(day)))
    return seen.join(as_of(obs, day).select("series_id").distinct(), "series_id", "left_anti").select("series_id", "known_since")


def describe_split(rows: DataFrame) -> DataFrame:
    """One row like ``pseudo:2, true:1``: series by kind of vintage."""
    per = rows.groupBy("vintage_kind").agg(F.countDistinct("series_id").alias("n"))
    return per.agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "vintage_kind", "n"))), ", ").alias("split"))


def leakage(rows: DataFrame, day: str | dt.date | Column) -> DataFrame:
    """Rows that were not known yet on the day they are read for; has to be empty."""
    return rows.where(F.col("realtime_start") > _date(day))
