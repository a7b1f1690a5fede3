"""Fits at every as-of date at once: a sweep over the days on which what is known changes.

A fit needs sums over the rows that were known on a day. A row with a validity interval is added to them on the day it
opens and taken off on the day it ends, so the sums of all days are running sums over two events a row; rows are not
repeated for the days they were known on, and their number does not depend on how many days are asked for. A row made
of several observations (lags, other series) is valid where all its parts are: on the intersection of their intervals.

Fits are bitemporal themselves: a row for each run of days without a change, with ``realtime_start`` and
``realtime_end``, so ``vintages.as_of`` and ``as_of_grid`` read them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import next_period
from . import regression as R
from . import var

SPAN = ("realtime_start", "realtime_end")


def _met(left: DataFrame, right: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of both with equal ``on`` for as long as both are valid; ``columns`` come from the right side.

    Versions of a key on one side do not overlap, so two keys of m and n versions meet in m + n - 1 rows at most.
    """
    a, b = left.alias("a"), right.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in on]
    start, end = F.greatest("a.realtime_start", "b.realtime_start"), F.least("a.realtime_end", "b.realtime_end")  # open ends are null, which least passes over
    kept = [F.col(f"a.{c}") for c in left.columns if c not in SPAN]
    out = a.join(b, same).select(*kept, *[F.col(f"b.{c}") for c in columns], start.alias("realtime_start"), end.alias("realtime_end"))
    return out.where("realtime_end IS NULL OR realtime_start < realtime_end")


def lagged_vintages(obs: DataFrame, freq: str, lags: Sequence[int], columns: Sequence[str] = ("value",), group: Sequence[str] = ("series_id",)) -> DataFrame:
    """Versions of each period beside those so many periods before: ``value_l1``, ...; by the calendar of ``freq``."""
    out = obs.select(*group, "period", *columns, *SPAN)
    for k in lags:
        later = F.col("period")
        for _ in range(k):
            later = next_period(later, freq)
        names = [f"{c}_l{k}" for c in columns]
        before = obs.select(*group, later.alias("period"), *[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)], *SPAN)
        out = _met(out, before, [*group, "period"], names)
    return out


def joined_vintages(frames: dict[str, DataFrame], on: Sequence[str] = ("period",)) -> DataFrame:
    """Versions of several series side by side, a column each."""
    out = None
    for name, obs in frames.items():
        one = obs.select(*on, F.col("value").alias(name), *SPAN)
        out = one if out is None else _met(out, one, on, [name])
    return out


def swept(rows: DataFrame, group: Sequence[str], sums: Sequence[Column]) -> DataFrame:
    """(group, realtime_start, realtime_end, _s0, _s1, ...): sums of columns over the rows known in each run of days.

    The last ones are sums over what is still known; a run of days on which nothing is known has sums of nothing left.
    """
    names = [f"_s{i}" for i in range(len(sums))]
    rows = rows.where("realtime_end IS NULL OR realtime_start < realtime_end").select(*group, *SPAN, *[s.alias(n) for s, n in zip(sums, names, strict=True)])
    events = F.array(F.struct(F.col("realtime_start").alias("day"), F.lit(1).alias("sign")), F.struct(F.col("realtime_end").alias("day"), F.lit(-1).alias("sign")))
    moved = rows.select(*group, *names, F.explode(events).alias("_e")).where("_e.day IS NOT NULL")
    per_day = moved.groupBy(*group, F.col("_e.day").alias("realtime_start")).agg(*[F.sum(F.col("_e.sign") * F.col(n)).alias(n) for n in names])
    w = Window.partitionBy(*group).orderBy("realtime_start")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    return per_day.select(*group, "realtime_start", F.lead("realtime_start").over(w).alias("realtime_end"), *[F.sum(n).over(run).alias(n) for n in names])


def fit_over_time(rows: DataFrame, group: Sequence[str], y: str, xs: Sequence[str], weight: str | None = None, least_rows: int = 0) -> DataFrame:
    """``regression.fit`` of the rows known in each run of days, with its ``realtime_start`` and ``realtime_end``."""
    names = [R.CONSTANT, *xs]
    complete = rows.dropna(subset=[y, *xs, *([weight] if weight else [])])
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    ins = [F.lit(1.0) if n == R.CONSTANT else F.col(n).cast("double") for n in names]
    sums = swept(complete, group, R._products(ins, F.col(y).cast("double"), w))
    n_sums = len(sums.columns) - len(group) - 2
    packed = sums.select(*group, *SPAN, *R._packed([F.col(f"_s{i}") for i in range(n_sums)], len(names))).where(F.col("n") >= max(least_rows, len(names)))
    return R._solved(packed, [*group, *SPAN], len(names), True).withColumn("terms", F.array(*map(F.lit, names))).select(*group, *SPAN, "terms", "beta", "cov", "n", "dof", "r2", "ssr")


def restricted_over_time(rows: DataFrame, group: Sequence[str], y: str, over: Sequence[str], anchor: str, others: Sequence[str] = (), weight: str | None = None, least_rows: int = 0) -> DataFrame:
    """(group, realtime_start, realtime_end, term, coef, n): coefficients of ``over`` sum to one, by substitution of ``anchor``."""
    if anchor not in over:
        raise ValueError("the anchor is one of the restricted terms")
    free = [x for x in over if x != anchor]
    moved = rows.withColumns({y: F.col(y) - F.col(anchor), **{x: F.col(x) - F.col(anchor) for x in free}})
    fits = fit_over_time(moved, group, y, [*free, *others], weight, least_rows)
    rest = 1 - sum((F.col("beta")[i + 1] for i in range(len(free))), F.lit(0.0))
    told = F.array(*[F.struct(F.lit(t).alias("term"), F.col("beta")[i].alias("coef")) for i, t in enumerate([R.CONSTANT, *free, *others])], F.struct(F.lit(anchor).alias("term"), rest.alias("coef")))
    return fits.select(*group, *SPAN, "n", F.explode(told).alias("_t")).select(*group, *SPAN, "_t.term", "_t.coef", "n")


def var_over_time(panel: DataFrame, group: Sequence[str], system: Sequence[str], freq: str, lags: int = 1) -> DataFrame:
    """``var.var_fit`` of the rows known in each run of days; ``panel`` has versions of each (group, period) with the system's columns."""
    rows = lagged_vintages(panel, freq, range(1, lags + 1), system, group)
    cols = [F.lit(1.0), *[F.col(f"{c}_l{p}").cast("double") for p in range(1, lags + 1) for c in system], *[F.col(c).cast("double") for c in system]]
    rows = rows.dropna(subset=[*system, *[f"{c}_l{p}" for p in range(1, lags + 1) for c in system]])
    pairs = R._triangle(len(cols))
    sums = swept(rows, group, [F.lit(1).cast("long"), *[cols[i] * cols[j] for i, j in pairs]])
    sums = sums.select(*group, *SPAN, F.col("_s0").alias("n"), F.array(*[F.col(f"_s{i + 1}") for i in range(len(pairs))]).alias("cross"))
    return var._fitted(sums, [*group, *SPAN], system, lags)
