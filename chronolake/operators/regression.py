"""Least squares for every group of a frame at once.

Spark sums the cross products of each group; what is left, a k x k solve with k of a dozen at most, runs
over the summed rows. Newey-West terms are sums as well: one window over the rows of a group has the scores of
up to L rows before at hand, so rows are moved once, whatever L is. Fits on growing samples are running sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .._spark import ship

CONSTANT = "const"


def _t_tail(t: float, dof: float) -> float:
    """Two-sided p-value of Student's t: the incomplete beta function by its continued fraction."""
    x, a, b = dof / (dof + t * t), dof / 2, 0.5
    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) if x > 0 else 0.0

    def fraction(p: float, q: float, y: float) -> float:
        c, d = 1.0, 1 / (1 - (p + q) * y / (p + 1) or 1e-300)
        out = d
        for m in range(1, 300):
            for num in (m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))):
                d = 1 / (1 + num * d or 1e-300)
                c = 1 + num / c or 1e-300
                out *= c * d
            if abs(c * d - 1) < 1e-14:
                break
        return out

    return front * fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * fraction(b, a, 1 - x) / b


@F.pandas_udf(T.DoubleType())
def p_value(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """Two-sided; by the normal distribution where ``dof`` is null."""
    return pd.Series([None if s is None or math.isnan(s) else math.erfc(abs(s) / math.sqrt(2)) if d is None or math.isnan(d) else _t_tail(s, d) for s, d in zip(stat, dof, strict=True)], dtype="float64")


def _triangle(n: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(n) for j in range(i, n)]


def _square(upper: Sequence[float], n: int) -> np.ndarray:
    out = np.zeros((n, n))
    for v, (i, j) in zip(upper, _triangle(n), strict=True):
        out[i, j] = out[j, i] = v
    return out


def solvable(xx: np.ndarray) -> np.ndarray | None:
    """The scale that brings the diagonal of cross products to one; None if they are singular all the same."""
    scale = np.sqrt(np.maximum(np.diag(xx), 1e-300))
    scaled = xx / np.outer(scale, scale)
    return None if not np.isfinite(scaled).all() or np.linalg.cond(scaled) > 1e13 else scale


def _products(ins: list[Column], y: Column, w: Column) -> list[Column]:
    """What is summed over rows: products of regressors with each other and with y, squares of y, y, weights, rows."""
    return [*[w * ins[i] * ins[j] for i, j in _triangle(len(ins))], *[w * x * y for x in ins], w * y * y, w * y, w, F.lit(1).cast("long")]


def _packed(sums: Sequence[Column], k: int) -> list[Column]:
    """The sums of ``_products`` as the columns that ``_solved`` reads."""
    m = k * (k + 1) // 2
    return [F.array(*sums[:m]).alias("_xx"), F.array(*sums[m : m + k]).alias("_xy"), *[s.alias(n) for s, n in zip(sums[m + k :], ("_yy", "_y", "_w", "n"), strict=True)]]


def fit(df: DataFrame, group: Sequence[str], y: str, xs: Sequence[str], weight: str | None = None, order: str | None = None, lags: int | str | None = None, constant: bool = True, least_rows: int = 0, most_lags: int | None = None, only: str | None = None) -> DataFrame:
    """One row per group: ``terms``, ``beta``, ``cov`` (row by row), ``n``, ``dof``, ``r2``, ``ssr``.

    With ``lags`` (a number, or a column that is constant in a group, with ``most_lags`` at most) the covariance is
    Newey-West over rows in the order of ``order``, and ``dof`` is null, which means normal p-values. Rows with a null
    are left out, and groups of fewer than ``least_rows`` rows or with a singular design. With ``only`` one term's
    Newey-West variance is computed, from one number a row instead of one for each term; the others are null.
    """
    names = ([CONSTANT] if constant else []) + list(xs)
    k = len(names)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    ins = [F.lit(1.0) if n == CONSTANT else F.col(n).cast("double") for n in names]
    keep = list(dict.fromkeys([*group, y, *xs, *([weight] if weight else []), *([order] if order else []), *([lags] if isinstance(lags, str) else [])]))
    rows = df.select(*keep).dropna(subset=[y, *xs, *([weight] if weight else [])])
    out_y = F.col(y).cast("double")
    sums = rows.groupBy(*group).agg(*_packed([F.sum(p) for p in _products(ins, out_y, w)], k)).where(F.col("n") >= max(least_rows, k))
    fitted = _solved(sums, group, k, constant)
    if lags is not None:
        if isinstance(lags, str) and most_lags is None:
            most_lags = rows.agg(F.max(lags)).first()[0] or 0
        fitted = _newey_west(rows, fitted, group, out_y, ins, w, order, lags, most_lags if isinstance(lags, str) else int(lags), None if only is None else names.index(only))
    terms = F.array(*[F.lit(n) for n in names])
    return fitted.withColumn("terms", terms).select(*group, "terms", "beta", "cov", "n", "dof", "r2", "ssr")


def fit_errors(df: DataFrame, group: Sequence[str], y: str, xs: Sequence[str], weight: str | None = None, constant: bool = True, least_rows: int = 0, **_) -> DataFrame:
    """(group, error) of the groups that ``fit`` leaves out with the same arguments: too few complete rows, or a singular design."""
    least = max(least_rows, len(xs) + constant)
    complete = F.lit(True)
    for c in [y, *xs, *([weight] if weight else [])]:
        complete = complete & F.col(c).isNotNull()
    counts = df.groupBy(*group).agg(F.count_if(complete).alias("_n"))
    fits = fit(df, group, y, xs, weight, constant=constant, least_rows=least_rows).select(*group, F.lit(True).alias("_fits"))
    out = counts.alias("a").join(fits.alias("b"), _same(group, "a", "b"), "left").where("_fits IS NULL")
    said = F.when(F.col("_n") < least, F.concat(F.col("_n").cast("string"), F.lit(f" complete rows, {least} are needed"))).otherwise("singular")
    return out.select(*[F.col(f"a.{g}").alias(g) for g in group], said.alias("error"))


def fit_before(df: DataFrame, group: Sequence[str], y: str, xs: Sequence[str], order: str, at: DataFrame, least_rows: int = 0) -> DataFrame:
    """(group, order, beta, n) for each value of ``order`` in ``at``: the fit on a group's rows that come before it.

    Cross products are summed for each (group, order) and then run up, so a value of ``order`` costs one row.
    """
    names = [CONSTANT, *xs]
    ins = [F.lit(1.0) if n == CONSTANT else F.col(n).cast("double") for n in names]
    rows = df.select(*dict.fromkeys([*group, order, y, *xs])).dropna(subset=[y, *xs])
    products = [F.sum(p).alias(f"_s{i}") for i, p in enumerate(_products(ins, F.col(y).cast("double"), F.lit(1.0)))]
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*group, order).agg(*products)
    sums = sums.select(*group, order, *_packed([F.sum(f"_s{i}").over(before) for i in range(len(products))], len(names)))
    sums = sums.join(at.select(order).distinct(), order, "left_semi").where(F.col("n") >= max(least_rows, len(names)))
    return _solved(sums, [*group, order], len(names), True).select(*group, order, "beta", "n")


def _solved(sums: DataFrame, group: Sequence[str], k: int, constant: bool) -> DataFrame:
    """(group, beta, cov, _inv, n, dof, r2, ssr) from packed sums; singular groups are left out."""
    ship(sums.sparkSession)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for _, r in pdf.iterrows():
                xx, xy = _square(r["_xx"], k), np.asarray(r["_xy"], float)
                scale = solvable(xx)
                if scale is None:
                    continue
                scaled = xx / np.outer(scale, scale)
                inv = np.linalg.inv(scaled) / np.outer(scale, scale)
                beta = np.linalg.solve(scaled, xy / scale) / scale
                ssr = max(float(r["_yy"] - beta @ xy), 0.0)
                total = float(r["_yy"] - (r["_y"] ** 2 / r["_w"] if constant else 0.0))
                dof = int(r["n"]) - k
                cov = inv * (ssr / dof) if dof > 0 else np.full((k, k), np.nan)
                out.append([*[r[g] for g in group], beta.tolist(), cov.ravel().tolist(), inv.ravel().tolist(), int(r["n"]), float(dof), 1 - ssr / total if total > 0 else None, ssr])
            yield pd.DataFrame(out, columns=[*group, "beta", "cov", "_inv", "n", "dof", "r2", "ssr"])

    types = ", ".join(f"`{g}` {sums.schema[g].dataType.simpleString()}" for g in group)
    return sums.mapInPandas(solve, f"{types}{', ' if types else ''}beta array<double>, cov array<double>, _inv array<double>, n long, dof double, r2 double, ssr double")


def _same(group: Sequence[str], left: str, right: str) -> Column:
    out = F.lit(True)
    for g in group:
        out = out & F.col(f"{left}.{g}").eqNullSafe(F.col(f"{right}.{g}"))
    return out


def _newey_west(rows: DataFrame, fitted: DataFrame, group: Sequence[str], y: Column, ins: list[Column], w: Column, order: str, lags: int | str, most: int, only: int | None) -> DataFrame:
    """``fitted`` with the Bartlett-weighted covariance of the scores.

    The window gives each score its ``most`` forerunners. Their weighted sum, with half of the score itself, times the
    score is the row's share of the covariance's upper half. For one term the score is what the row adds to its
    coefficient's error, a number.
    """
    k = len(ins)
    residual = y - sum((F.col("beta")[i] * x for i, x in enumerate(ins)), F.lit(0.0))
    own = rows.alias("a").join(fitted.select(*group, "beta", "_inv").alias("b"), _same(group, "a", "b")).select("a.*", "b.beta", "b._inv")
    depth = F.col(lags).cast("int") if isinstance(lags, str) else F.lit(most)
    score = F.array(*[w * x * residual for x in ins]) if only is None else w * residual * sum((F.col("_inv")[only * k + i] * x for i, x in enumerate(ins)), F.lit(0.0))
    scores = own.select(*group, F.col(order).alias("_order"), depth.alias("_lags"), score.alias("s"))
    span = Window.partitionBy(*group).orderBy("_order").rowsBetween(-most, 0)
    scores = scores.withColumn("_past", F.collect_list("s").over(span))  # most + 1 scores at the most
    back = lambda i: F.size("_past") - 1 - i
    weight = lambda i: F.when(back(i) == 0, 0.5).otherwise(F.greatest(1 - back(i) / (F.col("_lags") + 1), F.lit(0.0)))
    if only is not None:
        summed = F.aggregate(F.transform("_past", lambda s, i: s * weight(i)), F.lit(0.0), lambda a, s: a + s)
        variance = scores.groupBy(*group).agg(F.sum(2 * F.col("s") * summed).alias("_variance"))
        cov = F.array(*[F.col("m._variance") if i == only * k + only else F.lit(None).cast("double") for i in range(k * k)])
        kept = [F.col(f"f.{c}") for c in fitted.columns if c not in ("cov", "dof")]
        return fitted.alias("f").join(variance.alias("m"), _same(group, "f", "m")).select(*kept, cov.alias("cov"), F.lit(None).cast("double").alias("dof"))
    weighted = F.transform("_past", lambda s, i: F.transform(s, lambda x: x * weight(i)))
    summed = F.aggregate(weighted, F.array(*[F.lit(0.0)] * k), lambda a, s: F.zip_with(a, s, lambda p, q: p + q))
    scores = scores.withColumn("_v", summed)
    meat = scores.groupBy(*group).agg(F.array(*[F.sum(F.col("s")[i] * F.col("_v")[j] + F.col("s")[j] * F.col("_v")[i]) for i, j in _triangle(k)]).alias("_meat"))
    joined = fitted.alias("f").join(meat.alias("m"), _same(group, "f", "m")).select("f.*", "m._meat")

    def sandwich(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cov = [(inv := np.asarray(i, float).reshape(k, k)) @ _square(m, k) @ inv for i, m in zip(pdf["_inv"], pdf["_meat"], strict=True)]
            yield pdf.drop(columns=["_meat"]).assign(cov=[c.ravel().tolist() for c in cov], dof=None)

    return joined.mapInPandas(sandwich, joined.drop("_meat").schema)


def coefficients(fitted: DataFrame, group: Sequence[str]) -> DataFrame:
    """(group, term, coef, se, stat, p_value, n, r2), a row for each term."""
    ship(fitted.sparkSession)
    k = F.size("terms")
    rows = fitted.select(*group, "cov", "n", "dof", "r2", k.alias("_k"), F.posexplode(F.arrays_zip("terms", "beta")).alias("_i", "t"))
    se = F.sqrt(F.greatest(F.col("cov")[F.col("_i") * F.col("_k") + F.col("_i")], F.lit(0.0)))
    rows = rows.select(*group, F.col("t.terms").alias("term"), F.col("t.beta").alias("coef"), se.alias("se"), "n", "dof", "r2").withColumn("stat", F.try_divide("coef", "se"))
    return rows.withColumn("p_value", p_value("stat", "dof")).select(*group, "term", "coef", "se", "stat", "p_value", "n", "r2")


def wald(fitted: DataFrame, group: Sequence[str], weights: dict[str, float], value: float = 0.0) -> DataFrame:
    """(group, estimate, se, stat, p_value) of a linear hypothesis: the weighted sum of coefficients equals ``value``."""
    of = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    r = F.transform("terms", lambda t: F.coalesce(F.try_element_at(of, t), F.lit(0.0)))
    rows = fitted.withColumn("_r", r).withColumn("_k", F.size("terms"))
    estimate = F.aggregate(F.zip_with("_r", "beta", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    variance = F.aggregate(F.transform("cov", lambda c, i: c * F.col("_r")[F.floor(i / F.col("_k")).cast("int")] * F.col("_r")[i % F.col("_k")]), F.lit(0.0), lambda a, x: a + x)
    rows = rows.select(*group, estimate.alias("estimate"), F.sqrt(F.greatest(variance, F.lit(0.0))).alias("se"), "dof")
    return rows.withColumn("stat", F.try_divide(F.col("estimate") - value, "se")).withColumn("p_value", p_value("stat", "dof")).drop("dof")


def grouped_ols(df: DataFrame, group: Sequence[str], y: str, xs: Sequence[str], **options) -> DataFrame:
    return coefficients(fit(df, group, y, xs, **options), group)


def predict(df: DataFrame, fitted: DataFrame, group: Sequence[str], xs: Sequence[str], constant: bool = True, name: str = "fitted") -> DataFrame:
    """``df`` with the fitted value of its group."""
    ins = ([F.lit(1.0)] if constant else []) + [F.col(f"a.{x}") for x in xs]
    value = sum((F.col("b.beta")[i] * x for i, x in enumerate(ins)), F.lit(0.0))
    return df.alias("a").join(fitted.select(*group, "beta").alias("b"), _same(group, "a", "b")).select("a.*", value.alias(name))


def restricted(df: DataFrame, group: Sequence[str], y: str, over: Sequence[str], anchor: str, others: Sequence[str] = (), **options) -> DataFrame:
    """Coefficients of ``over`` restricted to sum to one, by substitution of ``anchor``; its own coefficient and error follow."""
    if anchor not in over:
        raise ValueError("the anchor is one of the restricted terms")
    free = [x for x in over if x != anchor]
    moved = df.withColumns({y: F.col(y) - F.col(anchor), **{x: F.col(x) - F.col(anchor) for x in free}})
    fitted = fit(moved, group, y, [*free, *others], **options)
    implied = wald(fitted, group, dict.fromkeys(free, 1.0), 1.0)
    own = implied.select(*group, F.lit(anchor).alias("term"), (1 - F.col("estimate")).alias("coef"), "se")
    own = own.withColumn("stat", F.try_divide("coef", "se"))
    own = own.alias("a").join(fitted.select(*group, "n", "dof", "r2").alias("b"), _same(group, "a", "b")).select("a.*", "b.n", "b.dof", "b.r2")
    own = own.withColumn("p_value", p_value("stat", "dof"))
    return coefficients(fitted, group).unionByName(own.select(*group, "term", "coef", "se", "stat", "p_value", "n", "r2"))


def verticality(df: DataFrame, group: Sequence[str], y: str, over: Sequence[str], others: Sequence[str] = (), **options) -> DataFrame:
    """The unrestricted companion: the sum of the coefficients and the test that it is one."""
    return wald(fit(df, group, y, [*over, *others], **options), group, dict.fromkeys(over, 1.0), 1.0)
