"""Vector autoregressions for every group: one sum of cross products each, everything else on k x k rows.

A group that cannot be fitted ends no job: it has no fit, and ``var_errors`` says why. With ``freq`` groups off the grid
or with holes in it are refused as well, since lags count rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .._spark import ship
from . import panels
from .regression import _same, _square, _triangle, solvable

#: Draws of one fit that a task makes together.
DRAWS = 100


def _sums(panel: DataFrame, group: Sequence[str], system: Sequence[str], lags: int) -> DataFrame:
    """(group, n, cross): cross products of a constant, ``lags`` lags of the system, and the system itself; complete rows only."""
    ship(panel.sparkSession)
    w = Window.partitionBy(*group).orderBy("period")
    names = [f"_l{p}_{c}" for p in range(1, lags + 1) for c in system]
    rows = panel.withColumns({f"_l{p}_{c}": F.lag(c, p).over(w) for p in range(1, lags + 1) for c in system}).dropna(subset=[*system, *names])
    cols = [F.lit(1.0), *map(F.col, names), *map(F.col, system)]
    return rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(cols[i] * cols[j]) for i, j in _triangle(len(cols))]).alias("cross"))


def _types(df: DataFrame, group: Sequence[str]) -> str:
    return ", ".join(f"`{g}` {df.schema[g].dataType.simpleString()}" for g in group)


def _solve(cross: np.ndarray, n: int, k: int, p: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Coefficients (1 + kp, k) and the sum of squared residuals (k, k); None for a singular design or singular residuals."""
    m = 1 + k * p
    xx, xy, yy = cross[:m, :m], cross[:m, -k:], cross[-k:, -k:]
    scale = solvable(xx)
    if scale is None:
        return None
    beta = np.linalg.solve(xx / np.outer(scale, scale), xy / scale[:, None]) / scale[:, None]
    ssr = yy - beta.T @ xy
    ssr = (ssr + ssr.T) / 2
    own = np.diag(ssr)
    if (own <= 1e-12 * np.maximum(np.diag(yy), 1e-300)).any() or solvable(ssr) is None or np.linalg.eigvalsh(ssr / np.sqrt(np.outer(own, own)))[0] <= 1e-12:
        return None
    return beta, ssr


def var_fit(panel: DataFrame, group: Sequence[str], system: Sequence[str], lags: int = 4, freq: str | None = None) -> DataFrame:
    """(group, n, beta, sigma, max_root, log_likelihood); the order of ``system`` is the recursive order."""
    if freq is not None:
        panel = panels.regular(panel, freq, group)[0]
    return _fitted(_sums(panel, group, system, lags), group, system, lags)


def var_errors(panel: DataFrame, group: Sequence[str], system: Sequence[str], lags: int = 4, freq: str | None = None) -> DataFrame:
    """(group, error) of the groups that ``var_fit`` leaves out."""
    rows, errors = panels.regular(panel, freq, group) if freq is not None else (panel, None)
    sums = _sums(rows, group, system, lags)
    known = sums.select(*group, "n").alias("s").join(_fitted(sums, group, system, lags).select(*group, F.lit(True).alias("fits")).alias("f"), _same(group, "s", "f"), "left").select("s.*", "f.fits")
    every = rows.select(*group).distinct().alias("a").join(known.alias("k"), _same(group, "a", "k"), "left").select("a.*", "k.n", "k.fits").where("fits IS NULL")
    least = len(system) * (lags + 1) + 1
    said = F.when(F.coalesce("n", F.lit(0)) < least, F.concat(F.coalesce("n", F.lit(0)).cast("string"), F.lit(f" complete rows, {least} are needed"))).otherwise("singular")
    out = every.select(*group, said.alias("error"))
    return out if errors is None else out.unionByName(errors)


def _fitted(sums: DataFrame, group: Sequence[str], system: Sequence[str], lags: int) -> DataFrame:
    k = len(system)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for _, r in pdf.iterrows():
                n, dof = int(r["n"]), int(r["n"]) - k * lags - 1
                if dof < k:
                    continue
                if (solved := _solve(_square(r["cross"], 1 + k * lags + k), n, k, lags)) is None:
                    continue
                beta, ssr = solved
                companion = np.eye(k * lags, k=-k)
                companion[:k] = beta[1:].T
                sign, log_det = np.linalg.slogdet(ssr / n)
                out.append([*[r[g] for g in group], n, beta.ravel().tolist(), (ssr / dof).ravel().tolist(), float(np.abs(np.linalg.eigvals(companion)).max()), float(-n / 2 * (k * np.log(2 * np.pi) + log_det + k)) if sign > 0 else None])
            yield pd.DataFrame(out, columns=[*group, "n", "beta", "sigma", "max_root", "log_likelihood"])

    fitted = sums.mapInPandas(run, f"{_types(sums, group)}, n long, beta array<double>, sigma array<double>, max_root double, log_likelihood double")
    return fitted.withColumn("lags", F.lit(lags)).withColumn("system", F.array(*map(F.lit, system)))


def var_coefficients(fitted: DataFrame, group: Sequence[str]) -> DataFrame:
    """(group, equation, term, coef)."""
    k = F.size("system")
    rows = fitted.select(*group, "system", k.alias("k"), F.posexplode("beta").alias("i", "coef"))
    at = F.floor(F.col("i") / F.col("k")).cast("int")
    lag = (F.floor((at - 1) / F.col("k")) + 1).cast("int")
    source = F.get("system", (at - 1) % F.col("k"))
    return rows.select(*group, F.get("system", F.col("i") % F.col("k")).alias("equation"), F.when(at == 0, "const").otherwise(F.concat(F.lit("L"), lag, F.lit("."), source)).alias("term"), "coef")


def var_select(panel: DataFrame, group: Sequence[str], system: Sequence[str], max_lags: int, criterion: str = "aic", freq: str | None = None) -> DataFrame:
    """(group, lags, aic, bic, hqic, chosen) for 1 to ``max_lags`` lags on their common sample; singular ones are left out."""
    if freq is not None:
        panel = panels.regular(panel, freq, group)[0]
    if criterion not in ("aic", "bic", "hqic"):
        raise ValueError(f"unknown criterion {criterion}")
    k = len(system)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for _, r in pdf.iterrows():
                n, cross = int(r["n"]), _square(r["cross"], 1 + k * max_lags + k)
                for p in range(1, max_lags + 1):
                    if n <= 1 + k * p:
                        continue
                    own = [*range(1 + k * p), *range(1 + k * max_lags, 1 + k * max_lags + k)]
                    if (solved := _solve(cross[np.ix_(own, own)], n, k, p)) is None:
                        continue
                    ssr = solved[1]
                    log_det, free = np.linalg.slogdet(ssr / n)[1], k * k * p + k
                    out.append([*[r[g] for g in group], p, log_det + 2 * free / n, log_det + np.log(n) * free / n, log_det + 2 * np.log(np.log(n)) * free / n])
            yield pd.DataFrame(out, columns=[*group, "lags", "aic", "bic", "hqic"])

    rows = _sums(panel, group, system, max_lags).mapInPandas(run, f"{_types(panel, group)}, lags int, aic double, bic double, hqic double")
    best = F.min(F.struct(criterion, "lags")).over(Window.partitionBy(*group))
    return rows.withColumn("chosen", F.col("lags") == best["lags"])


def _responses(beta: np.ndarray, impact: np.ndarray, k: int, p: int, horizon: int) -> np.ndarray:
    """(horizon + 1, response, shock)."""
    blocks = [beta[1 + k * i : 1 + k * (i + 1)].T for i in range(p)]
    moving = [np.eye(k)]
    for h in range(1, horizon + 1):
        moving.append(sum(blocks[i] @ moving[h - 1 - i] for i in range(min(p, h))))
    return np.stack([m @ impact for m in moving])


def var_irf(fitted: DataFrame, group: Sequence[str], horizon: int = 24) -> DataFrame:
    """(group, shock, response, h, value): responses to one standard deviation of each recursive shock."""
    ship(fitted.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for _, r in pdf.iterrows():
                names, p = list(r["system"]), int(r["lags"])
                k = len(names)
                found = _responses(np.asarray(r["beta"]).reshape(-1, k), np.linalg.cholesky(np.asarray(r["sigma"]).reshape(k, k)), k, p, horizon)
                out += [[*[r[g] for g in group], names[s], names[v], h, float(found[h, v, s])] for h in range(horizon + 1) for v in range(k) for s in range(k)]
            yield pd.DataFrame(out, columns=[*group, "shock", "response", "h", "value"])

    return fitted.mapInPandas(run, f"{_types(fitted, group)}, shock string, response string, h int, value double")


def var_fevd(irf: DataFrame, group: Sequence[str]) -> DataFrame:
    """(group, shock, response, h, share) of the forecast error variance up to h; shares of a response sum to one."""
    w = Window.partitionBy(*group, "response", "shock").orderBy("h")
    rows = irf.withColumn("v", F.sum(F.col("value") * F.col("value")).over(w))
    return rows.withColumn("share", F.try_divide("v", F.sum("v").over(Window.partitionBy(*group, "response", "h")))).select(*group, "shock", "response", "h", "share")


def var_diagnostics(fitted: DataFrame, group: Sequence[str]) -> DataFrame:
    return fitted.select(*group, "n", "lags", F.array_join("system", ",").alias("recursive_order"), "max_root", "log_likelihood")


def _uniform(seed: int, name: str, i: Column) -> Column:
    """In (0, 1), from 52 bits of the digest of ``seed:name:i``; every engine that has MD5 gives the same."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{name}:"), i.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / 2.0**52


def normal(seed: int, i: Column) -> Column:
    """The i-th standard normal number of a seed: a function of its number, whatever was drawn before it."""
    return F.sqrt(-2 * F.ln(_uniform(seed, "radius", i))) * F.cos(2 * math.pi * _uniform(seed, "angle", i))


def sign_restricted(fitted: DataFrame, group: Sequence[str], signs: dict[str, int], draws: int, seed: int = 0, restrict_to: int = 3, horizon: int = 24) -> tuple[DataFrame, DataFrame]:
    """Median and 16 to 84 band of the responses whose signs hold up to ``restrict_to``; and the acceptance per group.

    Each fit is repeated for runs of ``DRAWS`` draws, which are dealt over the tasks. The numbers of a draw are functions
    of the seed and their place (``normal``), row by row of its matrix, so results do not depend on how they are dealt.
    """
    few = fitted.select(*group, "system", "lags", "beta", "sigma")
    rows = few.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1), F.lit(DRAWS)))).repartition(*group, "draw")
    square = F.size("system") * F.size("system")
    own = F.sequence(F.col("draw") * square, F.least(F.col("draw") + DRAWS, F.lit(draws)) * square - 1)
    rows = rows.withColumn("normals", F.transform(own, lambda i: normal(seed, i)))
    ship(fitted.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for _, r in pdf.iterrows():
                names, p, first = list(r["system"]), int(r["lags"]), int(r["draw"])
                k, many = len(names), range(first, min(first + DRAWS, draws))
                q, tri = np.linalg.qr(np.asarray(r["normals"]).reshape(len(many), k, k))
                q = q * np.sign(np.diagonal(tri, axis1=1, axis2=2))[:, None, :]
                moving = _responses(np.asarray(r["beta"]).reshape(-1, k), np.linalg.cholesky(np.asarray(r["sigma"]).reshape(k, k)), k, p, horizon)
                found = np.einsum("hvi,dis->dhvs", moving, q)  # draw, h, response, shock
                for side in (1, -1):
                    held = np.ones((len(many), k), bool)
                    for v, s in signs.items():
                        held &= (side * s * found[:, : restrict_to + 1, names.index(v)] > 0).all(1)
                    out += [[*[r[g] for g in group], many[d], int(c), side, names, (side * found[d, :, :, c]).ravel().tolist()] for d, c in np.argwhere(held).tolist()]
            yield pd.DataFrame(out, columns=[*group, "draw", "shock_column", "side", "system", "path"])

    kept = rows.mapInPandas(run, f"{_types(fitted, group)}, draw long, shock_column int, side int, system array<string>, path array<double>")
    sizes = few.select(*group, "system")
    long = kept.select(*group, "system", F.posexplode("path").alias("i", "value"))
    k = F.size("system")
    bands = long.groupBy(*group, F.get("system", F.col("i") % k).alias("response"), F.floor(F.col("i") / k).cast("int").alias("h")).agg(F.percentile("value", F.array(F.lit(0.16), F.lit(0.5), F.lit(0.84))).alias("b"), F.count(F.lit(1)).alias("n_accepted"))
    bands = bands.select(*group, "response", "h", F.col("b")[0].alias("low"), F.col("b")[1].alias("median"), F.col("b")[2].alias("high"), "n_accepted")
    rate = sizes.join(kept.groupBy(*group).agg(F.count(F.lit(1)).alias("accepted")), list(group), "left")
    rate = rate.select(*group, F.coalesce("accepted", F.lit(0)).alias("accepted"), (F.lit(2 * draws) * F.size("system")).alias("tried"))
    return bands, rate.withColumn("rate", F.col("accepted") / F.col("tried"))
