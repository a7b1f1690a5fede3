"""Freshness, findings and profiles of all series at once. ``obs`` may hold all vintages; open rows count."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .._spark import checkpoint
from ..functions.calendar import grid_size, next_period, published_at
from . import ranges, transforms

# Thresholds of the findings.
MOST_POINTS = 600
LEAST_FOR_SPIKE, SPIKE_FACTOR = 24, 12.0
FLAT_RUN = 12
GAP_SHARE = 0.05
SEVERITY = ("high", "medium", "low")


def _open(obs: DataFrame) -> DataFrame:
    return obs.where("realtime_end IS NULL") if "realtime_end" in obs.columns else obs


def _finding(df: DataFrame, name: str, severity: Column | str, detail: Column) -> DataFrame:
    return df.select("series_id", F.lit(name).alias("finding"), (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"), detail.cast("string").alias("detail"))


def freshness(obs: DataFrame, series: DataFrame, today: str | dt.date) -> DataFrame:
    """(series_id, last_period, expected_by, status, days_stale): ok, stale, no_data or unknown_lag."""
    day = F.lit(str(today)).cast("date")
    last = _open(obs).groupBy("series_id").agg(F.max("period").alias("last_period"))
    rows = series.select("series_id", "freq", "expected_lag_days").join(last, "series_id", "left")
    due = published_at(next_period(F.col("last_period"), "freq"), "freq", F.col("expected_lag_days"))
    rows = rows.withColumn("expected_by", due)
    status = F.when(F.col("last_period").isNull(), "no_data").when(F.col("expected_lag_days").isNull(), "unknown_lag").when(day > F.col("expected_by"), "stale").otherwise("ok")
    return rows.select("series_id", "last_period", "expected_by", status.alias("status"), F.greatest(F.datediff(day, "expected_by"), F.lit(0)).alias("days_stale"))


def no_data(obs: DataFrame, series: DataFrame) -> DataFrame:
    return _finding(series.join(_open(obs).select("series_id").distinct(), "series_id", "left_anti"), "no_data", "high", F.lit("no rows"))


def all_null(obs: DataFrame) -> DataFrame:
    rows = _open(obs).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_values")).where("n_values = 0")
    return _finding(rows, "all_null", "high", F.concat(F.col("n"), F.lit(" rows without a value")))


def stale(obs: DataFrame, series: DataFrame, today: str | dt.date) -> DataFrame:
    rows = freshness(obs, series, today).where("status = 'stale'")
    return _finding(rows, "stale", "high", F.concat(F.col("days_stale"), F.lit(" days late")))


def gaps(obs: DataFrame, series: DataFrame) -> DataFrame:
    """Periods missing between the first and the last one, on the grids of M, Q, A and W."""
    rows = _open(obs).groupBy("series_id").agg(F.min("period").alias("a"), F.max("period").alias("b"), F.countDistinct("period").alias("n"))
    rows = rows.join(series.select("series_id", "freq"), "series_id").withColumn("grid", grid_size(F.col("a"), F.col("b"), "freq"))
    rows = rows.withColumn("missing", F.col("grid") - F.col("n")).where("missing > 0")
    return _finding(rows, "gap", F.when(F.col("missing") / F.col("grid") > GAP_SHARE, "high").otherwise("medium"), F.col("missing"))


def _moves(values: DataFrame, group: Sequence[str] = ("series_id",)) -> DataFrame:
    """Values with the move to each (``d``), and the size of those that came straight back."""
    w = Window.partitionBy(*group).orderBy("period")
    moved, back = F.col("value") - F.lag("value").over(w), F.lead("value").over(w) - F.col("value")
    moves = values.withColumns({"d": moved, "back": back})
    size = F.when(F.signum("d") * F.signum("back") < 0, F.least(F.abs("d"), F.abs("back"))).otherwise(0.0)
    return moves.withColumn("size", F.when(F.col("back").isNotNull(), size))


def spikes(obs: DataFrame, in_ranges: int | None = None, held: int = ranges.HELD) -> DataFrame:
    """(series_id, period, size, scale) of the largest move that came straight back, where it stands out.

    The scale is the median of all moves but the two largest; with a scale of 0 any such move stands out. Series of up
    to ``held`` moves are sorted by size; of longer ones the median is selected by rounds of counts, without a sort.
    With ``in_ranges`` moves are taken in so many ranges of (series, period), so a long series is no task's own.
    """
    values = _open(obs).where("value IS NOT NULL").select("series_id", "period", "value")
    moves = _moves(values) if in_ranges is None else checkpoint(ranges.in_ranges(values, _moves, 1, 1, ranges=in_ranges))
    moves = moves.where("d IS NOT NULL").withColumn("d", F.abs("d"))
    both = moves.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("size").isNotNull(), F.struct("size", (-F.unix_date("period")).alias("early")))).alias("w"))
    both = both.where(F.col("n") + 1 >= LEAST_FOR_SPIKE)  # so that moves are left without the two largest
    # of the moves numbered 3 to n by falling size, the middle one or the mean of the middle two
    lower, upper = F.floor((F.col("n") + 3) / 2), F.ceil((F.col("n") + 3) / 2)
    if in_ranges is None:
        k = F.row_number().over(Window.partitionBy("series_id").orderBy(F.col("d").desc()))
        ranked = moves.select("series_id", "d", k.alias("k")).join(both, "series_id").where((F.col("k") == lower) | (F.col("k") == upper))
    else:
        both = checkpoint(both)
        wanted = both.select("series_id", F.explode(F.array_distinct(F.array(F.col("n") + 1 - lower, F.col("n") + 1 - upper))).alias("k"))
        ranked = ranges.ranked_values(moves.select("series_id", "d"), wanted, value="d", held=held).select("series_id", F.col("value").alias("d")).join(both, "series_id")
    rows = ranked.groupBy("series_id").agg(F.avg("d").alias("scale"), F.first("w").alias("w"))
    rows = rows.select("series_id", F.date_from_unix_date((-F.col("w.early")).cast("int")).alias("period"), F.col("w.size").alias("size"), "scale")
    return rows.where(F.when(F.col("scale") > 0, F.col("size") > SPIKE_FACTOR * F.col("scale")).otherwise(F.col("size") > 0))


def flat_runs(obs: DataFrame, in_ranges: int | None = None) -> DataFrame:
    """(series_id, run, before): series whose last values are one long run, longer than any run up to the one before the last.

    With ``in_ranges`` runs are found in so many ranges of (series, period), and the ranges' summaries joined up.
    """
    values = _open(obs).where("value IS NOT NULL").select("series_id", "period", "value")
    if in_ranges is not None:
        rows = ranges.last_runs(values, ranges=in_ranges)
    else:
        w = Window.partitionBy("series_id").orderBy("period")
        values = values.withColumn("moved", F.coalesce((F.col("value") != F.lag("value").over(w)).cast("int"), F.lit(0)))
        runs = values.withColumn("k", F.sum("moved").over(w)).groupBy("series_id", "k").agg(F.count(F.lit(1)).alias("n"))
        lengths = runs.withColumn("last", F.max("k").over(Window.partitionBy("series_id")))
        rows = lengths.groupBy("series_id").agg(F.max(F.when(F.col("k") == F.col("last"), F.col("n"))).alias("run"), F.coalesce(F.max(F.when(F.col("k") < F.col("last") - 1, F.col("n"))), F.lit(0)).alias("before"))
    return rows.where((F.col("run") >= FLAT_RUN) & (F.col("run") > F.greatest("before", F.lit(FLAT_RUN - 1))))


def audit(obs: DataFrame, series: DataFrame, today: str | dt.date) -> DataFrame:
    """All findings (series_id, finding, severity, detail); a series without any value gets no further ones."""
    empty = all_null(obs).select("series_id")
    rest = obs.join(empty, "series_id", "left_anti")
    spike, flat = spikes(rest), flat_runs(rest)
    found = [
        no_data(obs, series), all_null(obs), stale(rest, series, today), gaps(rest, series),
        _finding(spike, "isolated_spike", "low", F.col("period")), _finding(flat, "flat", "medium", F.col("run")),
    ]
    return reduce(DataFrame.unionByName, found)


def severity_rank(severity: Column) -> Column:
    return reduce(lambda c, k: c.when(severity == SEVERITY[k], k), range(1, len(SEVERITY)), F.when(severity == SEVERITY[0], 0))


def rank_findings(findings: DataFrame) -> DataFrame:
    """Findings by severity and series."""
    return findings.orderBy(severity_rank(F.col("severity")), "series_id", "finding")


def worst_severity(findings: DataFrame) -> DataFrame:
    return findings.groupBy("series_id").agg(F.min_by("severity", severity_rank(F.col("severity"))).alias("severity"), F.count(F.lit(1)).alias("n_findings"))


def profile(obs: DataFrame, series: DataFrame) -> DataFrame:
    """Per series: values, revisions, first and last period, last, smallest and largest value."""
    per = obs.groupBy("series_id").agg(
        F.count_if(F.col("realtime_end").isNull()).alias("n_obs"), F.count_if(F.col("realtime_end").isNotNull()).alias("n_revisions"),
        *[f(F.when(F.col("realtime_end").isNull(), F.col(c))).alias(n) for f, c, n in ((F.min, "period", "first_period"), (F.max, "period", "last_period"), (F.min, "value", "min_value"), (F.max, "value", "max_value"))],
        F.max_by("value", F.when(F.col("realtime_end").isNull() & F.col("value").isNotNull(), F.col("period"))).alias("last_value"),
    )
    return series.select("series_id").join(per, "series_id", "left").withColumn("n_obs", F.coalesce("n_obs", F.lit(0))).withColumn("n_revisions", F.coalesce("n_revisions", F.lit(0)))


def thin(obs: DataFrame, freq: str, most_points: int = MOST_POINTS) -> DataFrame:
    """Points for a chart: months of daily and weekly series, then every so manieth point, rounded."""
    rows = _open(obs).where("value IS NOT NULL").select("series_id", "period", "value")
    if freq in ("D", "B", "W"):
        rows = transforms.resample(rows, freq, "M", "last", drop_incomplete=False)
    own = Window.partitionBy("series_id")
    rows = rows.withColumn("k", F.row_number().over(own.orderBy("period")) - 1).withColumn("n", F.count(F.lit(1)).over(own))
    return rows.where(F.col("k") % F.ceil(F.col("n") / most_points) == 0).select("series_id", "period", F.round("value", 6).alias("value"))


def totals(obs: DataFrame, series: DataFrame, findings: DataFrame) -> DataFrame:
    """One row of totals."""
    a = obs.agg(F.count(F.lit(1)).alias("n_observations"), F.count_if(F.col("realtime_end").isNull()).alias("n_open"), F.min("period").alias("earliest"), F.max("period").alias("latest"))
    b = series.agg(F.count(F.lit(1)).alias("n_series"), F.countDistinct("source").alias("n_sources"))
    c = findings.agg(F.count(F.lit(1)).alias("n_findings"), F.count_if(F.col("severity") == "high").alias("n_high"), F.count_if(F.col("finding") == "stale").alias("n_stale"))
    return a.join(b).join(c)  # one row each


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    return runs.orderBy(F.col("started_at").desc(), "run_id").limit(n)


def mask_restricted(points: DataFrame, series: DataFrame) -> DataFrame:
    """Values of series that may not be passed on are hidden, their other columns stay."""
    may = series.select("series_id", "redistributable")
    rows = points.join(may, "series_id", "left")
    return rows.withColumn("value", F.when(F.coalesce("redistributable", F.lit(True)), F.col("value"))).drop("redistributable")
