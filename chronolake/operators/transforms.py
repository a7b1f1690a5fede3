"""Frequency conversion, rates and levels. Rows are (series_id, period, value) and whatever else groups them.

Shifts count rows, not calendar periods; ``panels.grid_violations`` finds series where that differs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.calendar import PER_YEAR, RANK, YEAR_LAG, _by_freq, period_end, period_start
from ..functions.values import annualize

GROUP = ("series_id",)


def _value(how: str) -> Column:
    v = F.col("value")
    if how in ("last", "eop"):
        return F.max_by(v, F.when(v.isNotNull(), F.col("period")))
    if how == "compound":
        return (F.product(1 + v / 100) - 1) * 100
    return {"mean": F.avg, "sum": F.sum}[how](v)


AGGREGATIONS = ("last", "eop", "mean", "sum", "compound")


def check_conversion(freq: str, to: str, how: str | None = None) -> None:
    if freq not in RANK or to not in RANK:
        raise ValueError(f"unknown frequency in {freq} -> {to}")
    if RANK[to] < RANK[freq]:
        raise ValueError(f"{freq} can't become {to}: values would have to be invented")
    if how is not None and how not in AGGREGATIONS:
        raise ValueError(f"unknown aggregation {how}")


def conversion_error(freq: Column | str, to: Column | str) -> Column:
    """Why a series of one frequency cannot become one of another, row by row; null where it can."""
    freq, to = (F.col(c) if isinstance(c, str) else c for c in (freq, to))
    rank = lambda c: _by_freq(c, {f: F.lit(r) for f, r in RANK.items()})
    known = F.coalesce(freq.isin(*RANK), F.lit(False)) & F.coalesce(to.isin(*RANK), F.lit(False))
    name = lambda c: F.coalesce(c, F.lit("null"))
    return F.when(~known, F.concat(F.lit("unknown frequency in "), name(freq), F.lit(" -> "), name(to))).when(rank(to) < rank(freq), F.concat(freq, F.lit(" can't become "), to, F.lit(": values would have to be invented")))


def resample(df: DataFrame, freq: str, to: str, how: str, group: Sequence[str] = GROUP, drop_incomplete: bool = True) -> DataFrame:
    """One value per coarser period; empty periods are left out, never filled.

    From M and Q, the last period goes if the source does not reach its end; a source period without value
    counts as reached.
    """
    check_conversion(freq, to, how)
    if freq == to:
        return df
    out = df.groupBy(*group, period_start(F.col("period"), to).alias("bucket")).agg(_value(how).alias("value"), F.max("period").alias("reached"))
    if drop_incomplete and freq in YEAR_LAG:
        # a period that an earlier row of the series lies behind is complete as far as this rule goes
        later = F.max("reached").over(Window.partitionBy(*group))
        out = out.withColumn("last", later).where(period_end(F.col("bucket"), to) <= period_end(F.col("last"), freq))
    return out.where("value IS NOT NULL").select(*group, F.col("bucket").alias("period"), "value")


def resample_by_concept(df: DataFrame, series: DataFrame, concepts: DataFrame, to: str) -> DataFrame:
    """Every series by its own frequency and its concept's default aggregation, in one pass; finer ``to`` leaves a series out."""
    how = series.join(concepts.select("concept_id", "default_agg"), "concept_id", "left").select("series_id", "freq", F.coalesce("default_agg", F.lit("last")).alias("how"))
    rank = _by_freq("freq", {f: F.lit(r) for f, r in RANK.items()})
    rows = df.join(how, "series_id").where(rank <= RANK[to])
    bucket = F.when(F.col("freq") == to, F.col("period")).otherwise(period_start(F.col("period"), to))
    out = rows.groupBy("series_id", "freq", "how", bucket.alias("bucket")).agg(*[_value(a).alias(f"_{a}") for a in AGGREGATIONS], F.max("period").alias("reached"))
    choice = F.coalesce(*[F.when(F.col("how") == a, F.col(f"_{a}")) for a in AGGREGATIONS])
    last = F.max("reached").over(Window.partitionBy("series_id"))
    out = out.withColumn("last", last).withColumn("value", choice)
    complete = ~F.col("freq").isin(*YEAR_LAG) | (F.col("freq") == to) | (period_end(F.col("bucket"), to) <= period_end(F.col("last"), "freq"))
    return out.where(complete & F.col("value").isNotNull()).select("series_id", F.col("bucket").alias("period"), "value")


def _w(group: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*group).orderBy("period")


def _shift(freq: str, horizon: str) -> int:
    if horizon == "period":
        return 1
    if freq not in YEAR_LAG:
        raise ValueError(f"a year has no whole number of {freq} rows")
    return YEAR_LAG[freq]


def _with(df: DataFrame, value: Column) -> DataFrame:
    return df.withColumn("value", value)


def pct_change(df: DataFrame, freq: str, horizon: str = "period", group: Sequence[str] = GROUP) -> DataFrame:
    """Percent change over a row or a year of rows; null from zero."""
    return _with(df, (F.try_divide("value", F.lag("value", _shift(freq, horizon)).over(_w(group))) - 1) * 100)


def mom_ann(df: DataFrame, freq: str, group: Sequence[str] = GROUP) -> DataFrame:
    return _with(df, annualize((F.try_divide("value", F.lag("value").over(_w(group))) - 1) * 100, freq))


def log_diff(df: DataFrame, freq: str, horizon: str = "period", annual: bool = False, group: Sequence[str] = GROUP) -> DataFrame:
    """100 times the difference of logs; null where a value is not positive."""
    n = _shift(freq, horizon)
    log = F.when(F.col("value") > 0, F.ln("value"))
    return _with(df, (log - F.lag(log, n).over(_w(group))) * 100 * (PER_YEAR[freq] / n if annual else 1.0))


def diff(df: DataFrame, n: int = 1, group: Sequence[str] = GROUP) -> DataFrame:
    return _with(df, F.col("value") - F.lag("value", n).over(_w(group)))


def lag(df: DataFrame, n: int = 1, group: Sequence[str] = GROUP) -> DataFrame:
    return _with(df, F.lag("value", n).over(_w(group)))


def rebase(df: DataFrame, base: str, group: Sequence[str] = GROUP) -> tuple[DataFrame, DataFrame]:
    """Values with the base period at 100, and (group, error) of the series whose base is absent, zero or missing."""
    day = F.lit(str(base)).cast("date")
    at = F.max(F.when(F.col("period") == day, F.col("value"))).over(Window.partitionBy(*group))
    rows = df.withColumn("_base", at)
    good = F.col("_base").isNotNull() & (F.col("_base") != 0)
    out = rows.where(good).withColumn("value", F.col("value") / F.col("_base") * 100).drop("_base")
    bases = df.groupBy(*group).agg(F.max(F.when(F.col("period") == day, F.col("value"))).alias("_base"))
    return out, bases.where("_base IS NULL OR _base = 0").select(*group, F.lit("base period is absent, zero or missing").alias("error"))


def deflate(nominal: DataFrame, deflator: DataFrame, base: str | None = None, on: Sequence[str] = ("period",)) -> DataFrame:
    """Nominal values over a price index times 100, where both stand; the index may be rebased first."""
    prices = deflator.select(*on, F.col("value").alias("_price"))
    if base is not None:
        at = prices.where(F.col("period") == F.lit(str(base)).cast("date")).select(*[c for c in on if c != "period"], F.col("_price").alias("_at"))
        others = [c for c in on if c != "period"]
        prices = (prices.join(at, others) if others else prices.crossJoin(F.broadcast(at.limit(1)))).withColumn("_price", F.try_divide("_price", "_at") * 100).drop("_at")
    rows = nominal.join(prices.where("_price IS NOT NULL AND _price <> 0"), list(on))
    return rows.withColumn("value", F.col("value") / F.col("_price") * 100).select(*nominal.columns)


def rolling_compound(df: DataFrame, n: int = 12, group: Sequence[str] = GROUP) -> DataFrame:
    """Rates in percent chained over n rows; null until there are n values."""
    w = _w(group).rowsBetween(1 - n, 0)
    return _with(df, F.when(F.count("value").over(w) == n, (F.product(1 + F.col("value") / 100).over(w) - 1) * 100))


TRANSFORMS = {
    "yoy": lambda df, freq, group: pct_change(df, freq, "year", group),
    "mom": lambda df, freq, group: pct_change(df, freq, "period", group),
    "mom_ann": lambda df, freq, group: mom_ann(df, freq, group),
    "log_diff": lambda df, freq, group: log_diff(df, freq, "period", False, group),
    "log_diff_ann": lambda df, freq, group: log_diff(df, freq, "period", True, group),
    "diff": lambda df, freq, group: diff(df, 1, group),
}


def transform(df: DataFrame, name: str, freq: str, group: Sequence[str] = GROUP) -> DataFrame:
    if name not in TRANSFORMS:
        raise ValueError(f"unknown transform {name}; there are {sorted(TRANSFORMS)}")
    return TRANSFORMS[name](df, freq, group)
