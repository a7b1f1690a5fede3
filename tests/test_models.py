"""Backtests with filters, groups that cannot be fitted, and fits at every as-of date, against plain loops."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chronolake.operators import backtest, macro, panels, regression, sweeps, var, vintages


def quarters(n, start=1980):
    return [dt.date(start + k // 4, 3 * (k % 4) + 1, 1) for k in range(n)]


def test_a_filter_is_computed_anew_at_every_cutoff(spark):
    rng = np.random.default_rng(1)
    n, days, groups = 60, quarters(60), {}
    for g in ("log", "level", "short"):
        size = 15 if g == "short" else n
        src = np.exp(np.cumsum(rng.normal(0, 0.02, size)) + 5) if g != "level" else np.cumsum(rng.normal(size=size))
        groups[g] = {"src": [None if i in (4, 30) else float(v) for i, v in enumerate(src)], "y": np.cumsum(rng.normal(size=size)).tolist(), "x": rng.normal(size=size).tolist(), "w": [0.5 if i % 5 == 0 else 1.0 for i in range(size)]}
        groups[g]["y"][20 % size] = None
    rows = [(g, days[i], d["y"][i], d["x"][i], d["src"][i], d["w"][i], 0.25) for g, d in groups.items() for i in range(len(d["y"]))]
    rng.shuffle(rows)
    df = spark.createDataFrame([tuple(r) for r in rows], "g string, period date, y double, x double, src double, w double, survey double")
    cutoffs = df.select(F.col("period").alias("cutoff")).where(F.col("period") >= days[35])

    def gaps(values, method):
        known = [i for i, v in enumerate(values) if v is not None]
        v = np.array([values[i] for i in known])
        v = 100 * np.log(v) if (v > 0).all() and v.mean() > 20 else v
        if method == "hp":
            return dict(zip(known, v - macro.hp_trend(v), strict=True))
        x = np.array([[1, *(v[i - 8 - j] - v[0] for j in range(4))] for i in range(11, len(v))])
        return dict(zip(known[11:], v[11:] - v[0] - x @ np.linalg.lstsq(x, v[11:] - v[0], rcond=None)[0], strict=True))

    for method in backtest.METHODS:
        out, rmse = backtest.filtered_oos(df, cutoffs, ["g"], "y", ["x"], "survey", "src", 1, method, "w")
        got = {(r.g, r.cutoff): (r.actual, r.model, r.random_walk) for r in out.collect()}
        want = {}
        for g in ("log", "level"):
            d = groups[g]
            for t in range(35, n):
                gap = gaps(d["src"][: t + 1], method)  # the history is cut and filtered again
                rows = [s for s in range(t) if s - 1 in gap and d["y"][s] is not None]
                if t - 1 not in gap:
                    continue
                a, w = np.array([[1, d["x"][s], gap[s - 1]] for s in rows]), np.sqrt([d["w"][s] for s in rows])
                beta = np.linalg.lstsq(a * w[:, None], np.array([d["y"][s] for s in rows]) * w, rcond=None)[0]
                want[g, days[t]] = (d["y"][t], float(beta @ [1, d["x"][t], gap[t - 1]]), d["y"][t - 1])
        assert got.keys() == want.keys() and len(want) == 2 * 25
        assert all(got[k] == pytest.approx(want[k], abs=1e-7) for k in want)
        assert {r.g: r.n for r in rmse.collect()} == {"log": 25, "level": 25}
    plan = backtest.filtered_oos(df, cutoffs, ["g"], "y", ["x"], "survey", "src")[0]._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError):
        backtest.filtered_oos(df, cutoffs, ["g"], "y", ["x"], "survey", "src", method="other")


def test_shuffled_rows_do_not_grow_with_cutoffs(spark):
    n = 3000
    df = spark.range(n).selectExpr("'g' AS g", "date_add(DATE'1900-01-01', CAST(id AS INT)) AS period", "rand(1) AS y", "rand(2) AS x", "rand(3) AS src", "0.5D AS survey")
    out, rmse = backtest.filtered_oos(df, df.select(F.col("period").alias("cutoff")), ["g"], "y", ["x"], "survey", "src")
    assert out.count() > n - 20  # a copy of the history for each would be 4.5 million rows
    assert rmse.first().rmse_model < 0.5


def test_terms_are_transformed_before_they_are_lagged(spark):
    values = [100.0, 110.0, 99.0, 120.0, 130.0, 125.0]
    long = spark.createDataFrame([("e", "p", d, v) for d, v in zip(quarters(6), values, strict=True)], "entity string, source string, period date, value double")
    terms = spark.createDataFrame([("s", "year", "p", 1, "yoy"), ("s", "raw", "p", 0, None), ("s", "move", "p", 1, "diff"), ("s", "move", "p", 2, "diff"), ("s", "ahead", "p", -1, None)], "spec string, term string, source string, lag int, transform string")
    got = {}
    for r in macro.build_terms(long, terms).orderBy("period").collect():
        got.setdefault(r.term, []).append(r.value)
    assert got["raw"] == values and got["ahead"] == [*values[1:], None]
    assert got["year"] == [None] * 5 + [pytest.approx(30.0)]
    assert got["move"] == [None, None, 10.0, -0.5, 5.0, 15.5]
    with pytest.raises(ValueError):
        macro.build_terms(long, terms.withColumn("transform", F.lit("other")))


def test_one_bad_group_ends_no_job(spark):
    rng = np.random.default_rng(2)
    rows = []
    for g in ("fine", "constant", "hole", "short", "twins", "empty"):
        for i, d in enumerate(quarters(8 if g == "short" else 40)):
            u, v = rng.normal(size=2)
            u, v = (u, 3.0) if g == "constant" else (u, 2 * u) if g == "twins" else (u, None) if g == "empty" else (u, v)
            if not (g == "hole" and i in (11, 17)):
                rows.append((g, d, float(u), None if v is None else float(v)))
    df = spark.createDataFrame(rows, "entity string, period date, u double, v double")
    fitted = var.var_fit(df, ["entity"], ["u", "v"], 2, "Q")
    assert [r.entity for r in fitted.collect()] == ["fine"]
    errors = {r.entity: r.error for r in var.var_errors(df, ["entity"], ["u", "v"], 2, "Q").collect()}
    assert errors == {"constant": "singular", "twins": "singular", "short": "6 complete rows, 7 are needed", "empty": "0 complete rows, 7 are needed", "hole": "not regular at Q: 2 periods, first 1982-10-01 hole"}
    assert {r.entity for r in var.var_fit(df, ["entity"], ["u", "v"], 2).collect()} == {"fine", "hole"}
    assert var.var_irf(fitted, ["entity"], 3).count() == 16
    assert {r.entity for r in var.var_select(df, ["entity"], ["u", "v"], 2).collect()} >= {"fine"}
    errors = {r.entity: r.error for r in regression.fit_errors(df, ["entity"], "u", ["v"], least_rows=10).collect()}
    assert errors == {"constant": "singular", "short": "8 complete rows, 10 are needed", "empty": "0 complete rows, 10 are needed"}
    good, bad = panels.regular(df, "Q", ["entity"])
    assert good.select("entity").distinct().count() == 5 and bad.first().entity == "hole"


def test_fits_of_every_day(spark):
    """Each day's fit on what was known that day, against fits on each day's own rows."""
    rng = np.random.default_rng(4)
    versions = []
    for s in ("a", "b"):
        for k in range(30):
            day = dt.date(2024, 1, 1) + dt.timedelta(k)
            starts = sorted({0, *rng.integers(0, 12, 2).tolist()})
            for i, start in enumerate(starts):
                end = day + dt.timedelta(starts[i + 1]) if i + 1 < len(starts) else (day + dt.timedelta(15) if k == 3 else None)
                versions.append((s, day, float(rng.normal()), day + dt.timedelta(start), end))
    obs = spark.createDataFrame(versions, "series_id string, period date, value double, realtime_start date, realtime_end date")
    fits = sweeps.fit_over_time(sweeps.lagged_vintages(obs, "D", [1, 2]), ["series_id"], "value", ["value_l1", "value_l2"], least_rows=6)
    days = [dt.date(2024, 1, 1) + dt.timedelta(k) for k in range(0, 50)]
    frame = spark.createDataFrame([(d,) for d in days], "asof date")
    got = {(r.series_id, r["asof"]): (r.n, list(r.beta)) for r in vintages.as_of_grid(fits, frame).collect()}
    seen = 0
    for s in ("a", "b"):
        for d in days:
            known = {p: v for i, p, v, a, e in versions if i == s and a <= d and (e is None or e > d)}
            rows = [(v, known[p - dt.timedelta(1)], known[p - dt.timedelta(2)]) for p, v in known.items() if p - dt.timedelta(1) in known and p - dt.timedelta(2) in known]
            if len(rows) < 6:
                assert (s, d) not in got
                continue
            x = np.array([[1, b, c] for _, b, c in rows])
            beta = np.linalg.lstsq(x, np.array([r[0] for r in rows]), rcond=None)[0]
            n, mine = got[s, d]
            assert n == len(rows) and mine == pytest.approx(beta.tolist(), abs=1e-8)
            seen += 1
    assert seen > 60
    sums = sweeps.swept(obs, ["series_id"], [F.lit(1).cast("long")])
    assert sums.count() <= 2 * len(versions)  # whatever days are asked for


def test_projections_equal_separate_fits(spark):
    """Sliding products against a regression of its own for each horizon, on rows repeated for all of them."""
    rng = np.random.default_rng(7)
    rows = []
    for g, n in (("a", 90), ("b", 60), (None, 50), ("short", 12)):
        for d in quarters(n):
            y, z, s = (None if rng.random() < 0.03 else float(v) for v in rng.normal(size=3))
            rows.append((g, d, y, z, s))
    rng.shuffle(rows)
    panel = spark.createDataFrame([tuple(r) for r in rows], "g string, period date, y double, z double, s double")
    horizon, lags = 5, 2
    w = Window.partitionBy("g").orderBy("period")
    controls = {f"{c}_{k}": F.lag(c, k).over(w) for c in ("y", "s") for k in (1, 2)}
    wide = panel.withColumns(controls)
    moved = F.array(*[F.struct(F.lit(r).alias("response"), F.lit(h).alias("h"), (F.lead(r, h).over(w) - F.col(r)).alias("moved")) for r in ("y", "z") for h in range(horizon + 1)])
    long = wide.withColumn("moves", moved).withColumn("m", F.explode("moves")).select("g", "period", "s", *controls, "m.*").withColumn("depth", F.greatest("h", F.lit(1)))
    by = ["g", "response", "h"]
    fitted = regression.fit(long, by, "moved", ["s", *controls], order="period", lags="depth", most_lags=horizon, least_rows=macro.LEAST_PROJECTION, only="s")
    want = {(r.g, r.response, r.h): (r.n, r.coef, r.se) for r in regression.coefficients(fitted, by).where("term = 's'").collect()}
    out = macro.local_projections(panel, ["g"], ["y", "z"], "s", ["y", "s"], horizon, lags)
    got = {(r.g, r.response, r.h): (r.n, r.coef, r.se) for r in out.collect()}
    assert got.keys() == want.keys() and len(want) == 36
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
