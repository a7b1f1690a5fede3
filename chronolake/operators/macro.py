"""Macro analyses, each fitted for every group at once: filters, policy rules, parity, price equations, local projections."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .._spark import ship
from ..functions.values import annualize_quarterly
from . import projections
from . import regression as R
from . import transforms as T

# Smoothing of the two-sided filter, horizon and lags of the one-sided one, and the least rows of each fit.
SMOOTHING = 1600.0
HAMILTON = (8, 4)
LEAST_TREND = 8
LEAST_TAYLOR, LEAST_PARITY, LEAST_PRICE, LEAST_PROJECTION = 13, 30, 12, 20
# Months whose observations count less in a price equation, and their weight.
PANDEMIC, PANDEMIC_WEIGHT = ("2020-04-01", "2022-12-31"), 1 / 9
LOG_LEVEL = 20.0


def _w(group: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*group).orderBy("period")


def hp_trend(y: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Solve (I + s K'K) trend = y for the second-difference K: a banded elimination, linear in the length.

    ``y`` is one series, or a row for each of several series of one length, which go through the steps together.
    """
    y = np.asarray(y, float)
    n = y.shape[-1]
    if n < 4:
        return y.copy()
    main, one, two = np.ones(n), np.zeros(n), np.zeros(n)
    for i in range(n - 2):
        for a, ka in enumerate((1.0, -2.0, 1.0)):
            main[i + a] += smoothing * ka * ka
            if a < 2:
                one[i + a] += smoothing * ka * (-2.0 if a == 0 else 1.0)
        two[i] += smoothing
    d, l1, l2, z = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros_like(y)
    for i in range(n):
        d[i] = main[i] - (l1[i - 1] ** 2 * d[i - 1] if i > 0 else 0) - (l2[i - 2] ** 2 * d[i - 2] if i > 1 else 0)
        l1[i] = (one[i] - (l1[i - 1] * l2[i - 1] * d[i - 1] if i > 0 else 0)) / d[i] if i + 1 < n else 0
        l2[i] = two[i] / d[i] if i + 2 < n else 0
        z[..., i] = y[..., i] - (l1[i - 1] * z[..., i - 1] if i > 0 else 0) - (l2[i - 2] * z[..., i - 2] if i > 1 else 0)
    x = z / d
    for i in range(n - 2, -1, -1):
        x[..., i] -= l1[i] * x[..., i + 1] + (l2[i] * x[..., i + 2] if i + 2 < n else 0)
    return x


def hp_filter(df: DataFrame, group: Sequence[str], smoothing: float = SMOOTHING) -> DataFrame:
    """(group, period, value, trend, cycle): the two-sided filter of each group's values; too few values have no trend.

    Every trend depends on all values of its group, so a group is one row of arrays, and its length, not the table's,
    has to fit a task. Groups of one length in a batch are solved together.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.asarray(v, float) for v in batch.column(batch.num_columns - 1).to_pylist()]
            trends = [np.full(len(v), np.nan) for v in values]
            for n in {len(v) for v in values if len(v) >= LEAST_TREND}:
                own = [i for i, v in enumerate(values) if len(v) == n]
                for i, trend in zip(own, hp_trend(np.stack([values[i] for i in own]), smoothing), strict=True):
                    trends[i] = trend
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([t.tolist() for t in trends], pa.list_(pa.float64()))], [*batch.schema.names, "_trend"])

    rows = df.where("value IS NOT NULL").groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("period", F.col("value").cast("double").alias("value")))).alias("_rows"))
    rows = rows.select(*group, F.col("_rows.period").alias("_period"), F.col("_rows.value").alias("_value"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    found = rows.mapInArrow(run, f"{types}, _trend array<double>")
    out = found.select(*group, F.explode(F.arrays_zip("_period", "_value", "_trend")).alias("_r"))
    trend = F.when(~F.isnan("_r._trend"), F.col("_r._trend"))
    return out.select(*group, F.col("_r._period").alias("period"), F.col("_r._value").alias("value"), trend.alias("trend"), (F.col("_r._value") - trend).alias("cycle"))


def log_or_level(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """100 ln of values where all of a group are positive and their mean is beyond 20, else the values."""
    own = Window.partitionBy(*group)
    logs = (F.min("value").over(own) > 0) & (F.avg("value").over(own) > LOG_LEVEL)
    return df.withColumn("value", F.when(logs, 100 * F.ln(F.when(F.col("value") > 0, F.col("value")))).otherwise(F.col("value")))


def hamilton_gap(df: DataFrame, group: Sequence[str], h: int = HAMILTON[0], p: int = HAMILTON[1]) -> DataFrame:
    """(group, period, value, gap): residuals of a value on those h to h + p - 1 rows before; null where that can't be fitted."""
    xs = [f"_l{k}" for k in range(p)]
    rows = df.select(*group, "period", "value").withColumns({x: F.lag("value", h + k).over(_w(group)) for k, x in enumerate(xs)})
    fitted = R.fit(rows, group, "value", xs, least_rows=p + 5)
    near = R.predict(rows.dropna(), fitted, group, xs).select(*group, "period", (F.col("value") - F.col("fitted")).alias("gap"))
    return df.select(*group, "period", "value").join(near, [*group, "period"], "left")


def output_gap(df: DataFrame, group: Sequence[str], method: str = "hp") -> DataFrame:
    """(group, period, gap) in percent of a positive output series."""
    logs = df.withColumn("value", F.ln(F.when(F.col("value") > 0, F.col("value"))))
    if method == "hp":
        return hp_filter(logs, group).select(*group, "period", ((F.exp(F.col("value") - F.col("trend")) - 1) * 100).alias("gap"))
    if method == "hamilton":
        return hamilton_gap(logs, group).select(*group, "period", (F.col("gap") * 100).alias("gap"))
    raise ValueError(f"unknown gap method {method}")


def taylor_rule(panel: DataFrame, params: DataFrame, group: Sequence[str] = ("entity",), method: str = "hp") -> DataFrame:
    """(group, period, inflation, gap, rate, prescribed, deviation) of quarterly price, output and rate.

    ``params`` has the group and r_star, pi_star, a_pi, a_y.
    """
    gap = output_gap(panel.select(*group, "period", F.col("output").alias("value")), group, method)
    rows = panel.withColumn("inflation", (F.try_divide("price", F.lag("price", 4).over(_w(group))) - 1) * 100).join(gap, [*group, "period"])
    rows = rows.where("inflation IS NOT NULL AND gap IS NOT NULL AND rate IS NOT NULL").join(params, list(group))
    rule = F.col("r_star") + F.col("inflation") + F.col("a_pi") * (F.col("inflation") - F.col("pi_star")) + F.col("a_y") * F.col("gap")
    return rows.select(*group, "period", "inflation", "gap", "rate", rule.alias("prescribed")).withColumn("deviation", F.col("rate") - F.col("prescribed"))


def taylor_diagnostics(rule: DataFrame, group: Sequence[str] = ("entity",)) -> DataFrame:
    varies = (F.min("rate") < F.max("rate")) & (F.min("prescribed") < F.max("prescribed"))
    pair = lambda a, b: F.avg(F.col(a) * F.col(b)) - F.avg(a) * F.avg(b)
    correlation = F.when(varies, F.try_divide(pair("rate", "prescribed"), F.sqrt(F.greatest(pair("rate", "rate") * pair("prescribed", "prescribed"), F.lit(0.0)))))
    return rule.groupBy(*group).agg(correlation.alias("correlation"), F.avg(F.abs("deviation")).alias("mean_abs_deviation"), F.count(F.lit(1)).alias("n"))


def taylor_estimate(rule: DataFrame, group: Sequence[str] = ("entity",)) -> DataFrame:
    return R.grouped_ols(rule, group, "rate", ["inflation", "gap"], least_rows=LEAST_TAYLOR)


def parity_rows(panel: DataFrame, horizons: Sequence[int], group: Sequence[str] = ("pair",)) -> DataFrame:
    """(group, horizon, period, change, differential): 100 times the log change of fx over each horizon on today's differential."""
    moved = F.array(*[F.struct(F.lit(h).alias("horizon"), (100 * (F.lead(F.ln("fx"), h).over(_w(group)) - F.ln("fx"))).alias("change")) for h in horizons])
    long = panel.withColumn("_m", moved).select(*panel.columns, F.explode("_m").alias("_m"))
    return long.select(*group, "period", "_m.horizon", "_m.change", (F.col("home") - F.col("abroad")).alias("differential"))


def uip(panel: DataFrame, horizons: Sequence[int], group: Sequence[str] = ("pair",), least_rows: int = LEAST_PARITY) -> tuple[DataFrame, DataFrame]:
    """Coefficients of the change on the differential, Newey-West over the horizon; and the test of a slope of one."""
    by = [*group, "horizon"]
    fitted = R.fit(parity_rows(panel, horizons, group), by, "change", ["differential"], order="period", lags="horizon", most_lags=max(horizons), least_rows=least_rows)
    return R.coefficients(fitted, by), R.wald(fitted, by, {"differential": 1.0}, 1.0)


#: What a term of a specification may be of its source, before it is lagged.
TERM_TRANSFORMS = (*T.TRANSFORMS, "annualised_quarterly", "hamilton_gap", "hp_gap")


def _transformed(long: DataFrame, name: str | None, freq: str) -> DataFrame:
    by = ["entity", "source"]
    if name is None:
        return long
    if name == "annualised_quarterly":
        return long.withColumn("value", annualize_quarterly(F.col("value")))
    if name == "hamilton_gap":
        return hamilton_gap(log_or_level(long, by), by).select(*by, "period", F.col("gap").alias("value"))
    if name == "hp_gap":
        return long.select(*by, "period").join(hp_filter(log_or_level(long, by), by).select(*by, "period", F.col("cycle").alias("value")), [*by, "period"], "left")
    return T.transform(long, name, freq, by)


def build_terms(long: DataFrame, terms: DataFrame, group: Sequence[str] = ("spec", "entity"), freq: str = "Q") -> DataFrame:
    """(group, period, term, value) of specification terms: one row per (spec, term, source, lag) and maybe transform.

    ``long`` has entity, source, period, value, a row each. A source is transformed first (``TERM_TRANSFORMS``; a null
    leaves it as it is), then lagged by rows; several lags of a term are averaged, missing ones left out of the mean.
    All lags of a row come from one window.
    """
    if "transform" not in terms.columns:
        terms = terms.withColumn("transform", F.lit(None).cast("string"))
    names = sorted({r[0] for r in terms.select("transform").distinct().limit(len(TERM_TRANSFORMS) + 2).collect()}, key=str)
    if unknown := [n for n in names if n is not None and n not in TERM_TRANSFORMS]:
        raise ValueError(f"unknown transform {unknown[0]}; there are {TERM_TRANSFORMS}")
    lags = sorted(r[0] for r in terms.select("lag").distinct().collect())
    w = Window.partitionBy("entity", "source").orderBy("period")
    at = F.create_map(*[x for k in lags for x in (F.lit(k), F.lag("value", k).over(w))])
    out = None
    for name in names:
        wanted = terms.where(F.col("transform").eqNullSafe(F.lit(name)))
        long_of = long.select("entity", "source", "period", "value").join(wanted.select("source").distinct(), "source", "left_semi")
        one = _transformed(long_of, name, freq).select("entity", "source", "period", at.alias("_at")).join(wanted, "source")
        one = one.select(*group, "period", "term", F.try_element_at("_at", F.col("lag")).alias("value"))
        out = one if out is None else out.unionAll(one)
    return out.groupBy(*group, "period", "term").agg(F.avg("value").alias("value"))


def design(terms: DataFrame, names: Sequence[str], group: Sequence[str], start: str | None = None, end: str | None = None, least_rows: int = LEAST_PRICE) -> DataFrame:
    """Terms as columns, complete rows of the sample, groups with enough of them."""
    wide = terms.groupBy(*group, "period").pivot("term", list(names)).agg(F.first("value")).dropna(subset=list(names))
    if start is not None:
        wide = wide.where(F.col("period") >= F.lit(start).cast("date"))
    if end is not None:
        wide = wide.where(F.col("period") <= F.lit(end).cast("date"))
    enough = wide.groupBy(*group).count().where(F.col("count") >= least_rows).select(*group)
    return wide.join(enough, list(group), "left_semi")


def pandemic_weight(period: Column) -> Column:
    return F.when(period.between(F.lit(PANDEMIC[0]).cast("date"), F.lit(PANDEMIC[1]).cast("date")), PANDEMIC_WEIGHT).otherwise(1.0)


def phillips(rows: DataFrame, group: Sequence[str], over: Sequence[str], anchor: str, others: Sequence[str], y: str = "inflation", lags: int | None = None) -> tuple[DataFrame, DataFrame]:
    """A price equation whose inflation terms sum to one, and the unrestricted test that they do."""
    weighted = rows.withColumn("_weight", pandemic_weight(F.col("period")))
    options = {"weight": "_weight", "least_rows": LEAST_PRICE} | ({"order": "period", "lags": lags} if lags is not None else {})
    return R.restricted(weighted, group, y, over, anchor, others, **options), R.verticality(weighted, group, y, over, others, **options)


def expanding_oos(rows: DataFrame, cutoffs: DataFrame, group: Sequence[str], y: str, xs: Sequence[str], survey: str) -> tuple[DataFrame, DataFrame]:
    """One-step forecasts at every cut-off from the rows before it, and their errors against a survey and the last value.

    ``cutoffs`` has the column ``cutoff``. Fits are running sums over the periods, so each cut-off costs a row of a
    group. Regressors that depend on the sample, such as a filter's gap, go through ``backtest.filtered_oos``.
    """
    by = [*group, "cutoff"]
    days = cutoffs.select(F.col("cutoff").cast("date").alias("cutoff")).distinct()
    at = rows.withColumns({"cutoff": F.col("period"), "_before": F.lag(y).over(_w(group))})
    fitted = R.fit_before(at, group, y, xs, "cutoff", days, LEAST_PRICE)
    now = at.join(days, "cutoff", "left_semi").dropna(subset=[*xs, y, survey, "_before"])
    out = R.predict(now, fitted, by, xs, name="model").select(*by, F.col(y).alias("actual"), "model", F.col(survey).alias("survey"), F.col("_before").alias("random_walk"))
    return out, oos_errors(out, group)


def oos_errors(out: DataFrame, group: Sequence[str]) -> DataFrame:
    """(group, rmse_model, rmse_survey, rmse_random_walk, n) of forecasts."""
    rmse = [F.sqrt(F.avg(F.pow(F.col("actual") - F.col(c), 2))).alias(f"rmse_{c}") for c in ("model", "survey", "random_walk")]
    return out.groupBy(*group).agg(*rmse, F.count(F.lit(1)).alias("n"))


def local_projections(panel: DataFrame, group: Sequence[str], responses: Sequence[str], shock: str, system: Sequence[str], horizon: int = 20, lags: int = 4) -> DataFrame:
    """(group, response, h, coef, se, low, high, n): what a response has moved by h rows after a shock.

    The left side is the change since the shock, so h = 0 of a variable that moves with it is its own change of 0;
    controls are ``lags`` lags of the whole system; Newey-West over h.
    """
    own = projections.local_projections(panel, group, responses, shock, system, horizon, lags, LEAST_PROJECTION)
    return own.select(*group, "response", "h", "coef", "se", (F.col("coef") - 1.96 * F.col("se")).alias("low"), (F.col("coef") + 1.96 * F.col("se")).alias("high"), "n")


def compare_specs(model_runs: DataFrame, model_outputs: DataFrame, table: str = "coefficients") -> DataFrame:
    """Outputs of one table of all runs, side by side with the runs' specifications."""
    return model_runs.select("model_run_id", "model_id", "spec_id", "asof").join(model_outputs.where(F.col("table_name") == table), "model_run_id")
