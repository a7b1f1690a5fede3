"""Transforms, audits, parsers, models and the result store on small series."""

import datetime as dt
import hashlib
import json
import math
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronolake.functions import values
from chronolake.operators import audits, macro, regression, results, transforms, var
from chronolake.sources import archive, payloads, tables
from chronolake.streaming import intake

S = "series_id string, period date, value double"


def months(n, start=2020):
    return [dt.date(start + k // 12, k % 12 + 1, 1) for k in range(n)]


@pytest.fixture
def series(spark):
    def make(vals, dates=None, name="s"):
        return spark.createDataFrame([(name, d, None if v is None else float(v)) for d, v in zip(dates or months(len(vals)), vals, strict=True)], S)

    return make


def got(df):
    return [r.value for r in df.orderBy("series_id", "period").collect()]


def test_resampling(series):
    df = series([1, 2, None, 4, None, None, 7, 8])
    assert got(transforms.resample(df, "M", "Q", "last")) == [2, 4]  # the last quarter is not complete
    assert got(transforms.resample(df, "M", "Q", "sum", drop_incomplete=False)) == [3, 4, 15]
    assert got(transforms.resample(df, "M", "Q", "mean")) == [1.5, 4]
    assert got(transforms.resample(series([10, 10, 10]), "M", "Q", "compound")) == [pytest.approx(33.1)]
    assert got(transforms.resample(series([-200, 10, None]), "M", "Q", "compound")) == [pytest.approx(-210)]
    assert got(transforms.resample(series([None, None, None]), "M", "Q", "sum")) == []
    for freq, to, how in (("Q", "M", "last"), ("M", "Z", "last"), ("M", "Q", "first")):
        with pytest.raises(ValueError):
            transforms.resample(df, freq, to, how)


def test_rates(series):
    df = series([100, 110, 0, 5] + [100] * 9)
    assert got(transforms.transform(df, "mom", "M"))[:4] == [None, pytest.approx(10), -100, None]
    assert got(transforms.transform(df, "yoy", "M"))[12] == 0
    assert got(transforms.log_diff(df, "M"))[1:4] == [pytest.approx(100 * math.log(1.1)), None, None]
    assert got(transforms.transform(df, "mom_ann", "M"))[1] == pytest.approx((1.1**12 - 1) * 100)
    assert got(transforms.diff(df, 2))[2] == -100
    with pytest.raises(ValueError):
        transforms.transform(df, "yoy", "D")
    with pytest.raises(ValueError):
        transforms.transform(df, "other", "M")
    based, errors = transforms.rebase(df.unionAll(df.withColumn("series_id", F.lit("z")).where("value <> 110")), "2020-02-01")
    assert got(based)[0] == pytest.approx(100 / 1.1) and [r.series_id for r in errors.collect()] == ["z"]
    chained = got(transforms.rolling_compound(series([1.0] * 14), 12))
    assert chained[10] is None and chained[11] == pytest.approx((1.01**12 - 1) * 100)


def test_numbers(spark):
    cases = {"0,21": 0.21, "1.234,56": 1234.56, "1,234.56": 1234.56, "1,234": 1.234, "1.234.567": 1234567, "1,234,567": 1234567, "-3,5 %": -3.5, "(12.5)": -12.5, "1 234,5": 1234.5, "..": None, " N/A ": None, "-": None, "5e3": 5000, ".5": 0.5, "1234,567,890": None}
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, t string").select("i", values.to_number(F.col("t")).alias("v"), values.bad_number(F.col("t")).alias("bad")).orderBy("i").collect()
    assert [r.v for r in rows] == list(cases.values())
    assert [list(cases)[r.i] for r in rows if r.bad] == ["1234,567,890"]
    assert spark.range(1).select(values.redact(F.lit("u?API-Key=ab c&x=1&pwd=z"))).first()[0] == "u?API-Key=REDACTED c&x=1&pwd=REDACTED"


def raw(spark, body, **more):
    row = {"series_id": "s", "body": body if isinstance(body, str) else json.dumps(body)} | more
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'boolean' if isinstance(v, bool) else 'string'}" for k, v in row.items()))


def parsed(df):
    return [(str(r.period), r.value, r.error) for r in df.orderBy("ordinal").collect()]


def test_parsers(spark):
    page = {"observations": [{"date": "2024-01-01", "value": "1.5", "realtime_start": "2024-02-01", "realtime_end": "2024-03-01"}, {"date": "2024-01-01", "value": ".", "realtime_start": "2024-03-02", "realtime_end": "9999-12-31"}]}
    out = payloads.parse_fred(raw(spark, [page, {"observations": []}], vintaged=True)).orderBy("ordinal").collect()
    assert [(r.value, str(r.realtime_start), str(r.realtime_end)) for r in out] == [(1.5, "2024-02-01", "2024-03-02"), (None, "2024-03-02", "None")]
    assert payloads.parse_fred(raw(spark, page, vintaged=False)).first().realtime_start is None
    assert payloads.parse_fred(raw(spark, {"error_code": 400, "error_message": "no"}, vintaged=True)).first().error == "no"
    assert payloads.parse_fred(raw(spark, "<html>", vintaged=True)).first().error
    assert parsed(payloads.parse_sgs(raw(spark, [{"data": "02/01/2024", "valor": "0,21"}]))) == [("2024-01-02", 0.21, None)]
    assert parsed(payloads.parse_sgs(raw(spark, [[{"data": "02/01/2024", "valor": "1"}], [{"data": "03/01/2024", "valor": ""}]]))) == [("2024-01-02", 1.0, None), ("2024-01-03", None, None)]
    assert payloads.parse_sgs(raw(spark, "<html>")).first().error
    assert parsed(payloads.parse_focus(raw(spark, {"value": [{"Data": "2024-01-02", "Mediana": 3.5}, {"Data": "2024-01-03", "Media": 1}]}))) == [("2024-01-02", 3.5, None)]
    table = [{"D1C": "Brasil (Código)", "D3C": "Trimestre (Código)", "V": "Valor"}, {"D1C": "1", "D3C": "202402", "V": "7"}]
    assert parsed(payloads.parse_sidra(raw(spark, table, freq="Q"))) == [("2024-04-01", 7.0, None)]
    assert parsed(payloads.parse_sidra(raw(spark, table, freq="M"))) == [("2024-02-01", 7.0, None)]
    assert payloads.parse_sidra(raw(spark, table, freq="A")).first().error == "bad period"
    assert parsed(payloads.parse_ipea(raw(spark, {"value": [{"VALDATA": "2024-01-01T00:00:00-03:00", "VALVALOR": None}]}))) == [("2024-01-01", None, None)]
    assert payloads.parse_ipea(raw(spark, {"value": []})).first().error == "empty list"
    docs = {"series": {"docs": [{"@frequency": "quarterly", "period": ["2024-Q3"], "value": [1.5]}]}}
    assert parsed(payloads.parse_dbnomics(raw(spark, docs, freq="Q"))) == [("2024-07-01", 1.5, None)]
    assert payloads.parse_dbnomics(raw(spark, docs, freq="M")).first().error
    text = "banner\n\nday,x,v\n31/01/2024,9,1.5\r\n\"29/02/2024\",9,2\n,,\n"
    assert parsed(payloads.parse_csv(raw(spark, text), "day", "v", 2, "dd/MM/yyyy", True)) == [("2024-01-01", 1.5, None), ("2024-02-01", 2.0, None)]
    assert parsed(payloads.parse_csv(raw(spark, "2024-01-01,5"), 0, 1)) == [("2024-01-01", 5.0, None)]
    assert payloads.parse_csv(raw(spark, text), "no", "v", 2).first().error


def test_bodies_are_read_whole_or_not_at_all(spark):
    def one(df):
        rows = df.collect()
        assert len(rows) == 1 and rows[0].value is None and rows[0].period is None
        return rows[0].ordinal, rows[0].error

    good = {"data": "02/01/2024", "valor": "0,21"}
    assert one(payloads.parse_sgs(raw(spark, [good, {"data": "03/01/2024", "valor": "oops"}, good]))) == (1, "bad number: oops")
    assert one(payloads.parse_sgs(raw(spark, [good, {"data": "31/02/2024", "valor": "1"}]))) == (1, "bad period")
    page = {"observations": [{"date": "2024-01-01", "value": "1"}, {"date": "2024-01-02", "value": "1.2.3"}]}
    assert one(payloads.parse_fred(raw(spark, page, vintaged=False)))[1] == "bad number: 1.2.3"
    assert one(payloads.parse_ipea(raw(spark, {"value": [{"VALDATA": "x", "VALVALOR": 1}]}))) == (0, "bad period")
    assert payloads.parse_sgs(raw(spark, [])).count() == 0
    both = raw(spark, [good, {"data": "x", "valor": "1"}]).unionByName(raw(spark, [good]).withColumn("series_id", F.lit("t")))
    assert {(r.series_id, r.value, r.error) for r in payloads.parse_sgs(both).collect()} == {("s", None, "bad period"), ("t", 0.21, None)}


def test_quoted_csv(spark):
    text = '﻿"when","how, much",note\r\n2024-01-01,"1,234.50","a ""b"", c"\r\n2024-02-01,n/a,"two\nlines"\r\n"2024-03-01",2.5 ,\r\n,9,\r\n2024-04-01,(b),x\r\n'
    assert parsed(payloads.parse_csv(raw(spark, text), "when", "how, much")) == [("2024-01-01", 1234.5, None), ("2024-02-01", None, None), ("2024-03-01", 2.5, None), ("2024-04-01", None, None)]
    assert parsed(payloads.parse_csv(raw(spark, '"x;y";2024-01-01;"1"'), 1, 2, separator=";")) == [("2024-01-01", 1.0, None)]
    assert parsed(payloads.parse_csv(raw(spark, "a|2024-01-01|7"), 1, 2, separator="|")) == [("2024-01-01", 7.0, None)]
    assert one_error(payloads.parse_csv(raw(spark, "2024-13-01,7"))) == "bad period"


def one_error(df):
    (row,) = df.collect()
    return row.error


def test_parsers_compile(spark, capfd):
    """No stage is too large for generated code, and numbers are not pasted into it."""
    page = {"observations": [{"date": f"2024-01-{k:02}", "value": "1,5"} for k in range(1, 29)]}
    plan = payloads.parse_fred(raw(spark, page, vintaged=False))._jdf.queryExecution()
    assert plan.executedPlan().toString().count("rlike") + plan.executedPlan().toString().count("RLIKE") <= 12
    assert payloads.parse_fred(raw(spark, page, vintaged=False)).agg(F.sum("value")).first()[0] == 42
    assert "grows beyond 64 KB" not in capfd.readouterr().err


def test_raw_index(spark):
    rows = spark.createDataFrame([("x", "x:a/1", "r1", dt.datetime(2024, 1, d), "u?key=1", b) for d, b in ((1, "p"), (2, "p"), (3, "q"))], "source string, series_id string, run_id string, fetched_at timestamp, url string, body string")
    index = archive.raw_index(rows).orderBy("fetched_at")
    assert [r.stored for r in index.collect()] == [True, False, True] and index.first().path.startswith("raw/x/x__a__1/") and index.first().url == "u?key=REDACTED"
    assert [r.stored for r in archive.raw_index(rows.where("body = 'q'"), index).collect()] == [False]


def test_audits(spark, series):
    wave = [10 + k % 3 for k in range(40)]
    spike = series(wave[:20] + [500] + wave[21:], name="spike")
    shift = series(wave[:20] + [x + 500 for x in wave[20:]], name="shift")
    flat = series(wave[:20] + [7] * 20, name="flat")
    quiet = series([5] * 30, name="quiet").unionAll(series([5] * 12 + [6] + [5] * 12, name="held"))
    df = spike.unionAll(shift).unionAll(flat).unionAll(quiet)
    found = audits.spikes(df).collect()
    assert {(r.series_id, str(r.period)) for r in found} == {("spike", "2021-09-01"), ("held", "2021-01-01"), ("flat", "2020-03-01")}  # without ordinary moves any return stands out
    assert {r.series_id: (r.run, r.before) for r in audits.flat_runs(df).collect()} == {"flat": (20, 1), "quiet": (30, 0)}
    meta = spark.createDataFrame([(n, "M", 15, "x") for n in ("spike", "shift", "flat", "quiet", "held", "hole", "void", "none")], "series_id string, freq string, expected_lag_days int, source string")
    hole = series([1, 2, 3], [dt.date(2020, 1, 1), dt.date(2020, 2, 1), dt.date(2020, 6, 1)], "hole")
    void = series([None, None], name="void")
    every = df.unionAll(hole).unionAll(void).withColumn("realtime_start", F.lit("2024-01-01").cast("date")).withColumn("realtime_end", F.lit(None).cast("date"))
    findings = {(r.series_id, r.finding, r.severity) for r in audits.audit(every, meta, "2020-03-01").collect()}
    assert {("hole", "gap", "high"), ("void", "all_null", "high"), ("none", "no_data", "high"), ("flat", "flat", "medium"), ("spike", "isolated_spike", "low")} <= findings
    fresh = {r.series_id: (r.status, str(r.expected_by), r.days_stale) for r in audits.freshness(every, meta, "2020-08-20").collect()}
    assert fresh["hole"] == ("stale", "2020-08-15", 5) and fresh["none"][0] == "no_data" and fresh["spike"][0] == "ok"
    assert audits.thin(every, "M", 10).where("series_id = 'spike'").count() == 10
    assert audits.worst_severity(audits.audit(every, meta, "2020-03-01")).where("series_id = 'hole'").first().severity == "high"


def panel(spark, n=120, groups=3, seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        x = rng.standard_normal((n, 2))
        y = 1 + 2 * x[:, 0] - x[:, 1] + rng.standard_normal(n) * 0.3
        out += [(f"g{g}", d, *map(float, row), float(v)) for d, row, v in zip(months(n, 2000), x, y, strict=True)]
    return spark.createDataFrame(out, "g string, period date, x1 double, x2 double, y double")


def dense(df, g):
    rows = df.where(F.col("g") == g).orderBy("period").collect()
    x = np.array([[1, r.x1, r.x2] for r in rows])
    return x, np.array([r.y for r in rows])


def test_least_squares_and_newey_west(spark):
    df = panel(spark)
    plain = {(r.g, r.term): r for r in regression.grouped_ols(df, ["g"], "y", ["x1", "x2"]).collect()}
    robust = {(r.g, r.term): r for r in regression.grouped_ols(df, ["g"], "y", ["x1", "x2"], order="period", lags=3).collect()}
    for g in ("g0", "g1", "g2"):
        x, y = dense(df, g)
        inv = np.linalg.inv(x.T @ x)
        beta = inv @ x.T @ y
        u = y - x @ beta
        s = x * u[:, None]
        meat = s.T @ s
        for lag in (1, 2, 3):
            part = s[lag:].T @ s[:-lag]
            meat += (1 - lag / 4) * (part + part.T)
        for k, t in enumerate(("const", "x1", "x2")):
            assert plain[g, t].coef == pytest.approx(beta[k]) and plain[g, t].se == pytest.approx(math.sqrt((inv * (u @ u) / (len(y) - 3))[k, k]))
            assert robust[g, t].se == pytest.approx(math.sqrt((inv @ meat @ inv)[k, k])) and robust[g, t].coef == pytest.approx(beta[k])
    one = {r.g: r for r in regression.grouped_ols(df, ["g"], "y", ["x1", "x2"], order="period", lags=3, only="x2").collect() if r.term == "x2"}
    assert all(one[g].se == pytest.approx(robust[g, "x2"].se) and one[g].coef == pytest.approx(robust[g, "x2"].coef) for g in one)
    assert plain["g0", "x1"].p_value < 1e-10 and plain["g0", "x1"].n == 120
    assert regression.grouped_ols(df.withColumn("x2", F.col("x1") * 2), ["g"], "y", ["x1", "x2"]).count() == 0  # singular


def test_student_tails():
    # known quantiles of Student's t
    for t, dof, p in ((12.706204736, 1, 0.05), (2.228138852, 10, 0.05), (2.063898562, 24, 0.05), (1.0, 1e6, 0.317310750)):
        assert regression._t_tail(t, dof) == pytest.approx(p, rel=1e-5)
    assert regression._t_tail(0.0, 5) == 1


def test_restrictions(spark):
    rows = panel(spark).withColumn("y", 0.7 * F.col("x1") + 0.3 * F.col("x2"))
    out = {r.term: r.coef for r in regression.restricted(rows, ["g"], "y", ["x1", "x2"], "x2").where("g = 'g1'").collect()}
    assert out["x1"] == pytest.approx(0.7) and out["x1"] + out["x2"] == pytest.approx(1)
    test = regression.verticality(panel(spark), ["g"], "y", ["x1", "x2"]).first()
    assert test.estimate == pytest.approx(1, abs=0.2) and 0 <= test.p_value <= 1
    with pytest.raises(ValueError):
        regression.restricted(rows, ["g"], "y", ["x1"], "x2")


def test_parity_of_exact_data(spark):
    """A rate that moves by the differential and a premium gives a slope of one."""
    rng, log, rows = np.random.default_rng(1), 0.0, []
    for d in months(80):
        home = float(rng.uniform(0, 5))
        rows.append(("p", d, math.exp(log), home, 1.0))
        log += (home - 1.0 + 0.25) / 100
    coefs, test = macro.uip(spark.createDataFrame(rows, "pair string, period date, fx double, home double, abroad double"), [1])
    out = {r.term: r.coef for r in coefs.collect()}
    assert out["differential"] == pytest.approx(1) and out["const"] == pytest.approx(0.25) and test.first().estimate == pytest.approx(1)


def test_filters(spark, series):
    y = np.random.default_rng(2).standard_normal(60).cumsum()
    k = np.diff(np.eye(60), 2, axis=0)
    assert np.allclose(macro.hp_trend(y, 1600.0), np.linalg.solve(np.eye(60) + 1600 * k.T @ k, y))
    out = macro.hp_filter(series(list(y)), ["series_id"]).orderBy("period").collect()
    assert out[5].trend + out[5].cycle == pytest.approx(y[5])
    assert macro.hp_filter(series([1, 2, 3]), ["series_id"]).where("trend IS NOT NULL").count() == 0
    gap = [r.gap for r in macro.hamilton_gap(series(list(y)), ["series_id"]).orderBy("period").collect()]
    x = np.array([[1, *y[t - 11 : t - 7][::-1]] for t in range(11, 60)])
    assert gap[:11] == [None] * 11 and np.allclose(gap[11:], y[11:] - x @ np.linalg.lstsq(x, y[11:], rcond=None)[0])
    with pytest.raises(ValueError):
        macro.output_gap(series([1.0]), ["series_id"], "other")


def test_taylor(spark):
    q = [dt.date(2000 + k // 4, 3 * (k % 4) + 1, 1) for k in range(40)]
    rows = [("e", d, 100 * 1.02 ** (k / 4), 100.0 * 1.01**k, 4.0) for k, d in enumerate(q)]
    params = spark.createDataFrame([("e", 2.0, 2.0, 0.5, 0.5)], "entity string, r_star double, pi_star double, a_pi double, a_y double")
    rule = macro.taylor_rule(spark.createDataFrame(rows, "entity string, period date, price double, output double, rate double"), params)
    assert rule.count() == 36 and rule.agg(F.max(F.abs("deviation"))).first()[0] == pytest.approx(0, abs=1e-6)  # on trend, at target
    assert macro.taylor_diagnostics(rule).first().n == 36


def test_local_projections(spark):
    rng = np.random.default_rng(3)
    e, y, rows = rng.standard_normal(400), 0.0, []
    for k, d in enumerate(months(400, 1980)):
        y = 0.5 * y + e[k]
        rows.append(("e", d, float(y), float(e[k])))
    out = macro.local_projections(spark.createDataFrame(rows, "entity string, period date, y double, shock double"), ["entity"], ["y"], "shock", ["y"], 4, 2)
    found = {r.h: r for r in out.collect()}
    assert found[0].coef == pytest.approx(0, abs=1e-9)
    for h in range(1, 5):  # the response falls from 1 to 0.5^h
        assert found[h].coef == pytest.approx(0.5**h - 1, abs=0.2)


def test_normal_numbers(spark):
    """Moments of numbers by their place, and none that belongs to two seeds or places."""
    z = spark.range(20000).select(var.normal(3, F.col("id")).alias("a"), var.normal(4, F.col("id")).alias("b"), var.normal(3, F.col("id") + 1).alias("c")).toPandas()
    assert abs(z.mean()).max() < 0.03 and abs(z.std() - 1).max() < 0.03 and abs((z**4).mean() - 3).max() < 0.3
    assert abs(z.corr().to_numpy() - np.eye(3)).max() < 0.03
    assert z["a"].nunique() == 20000


def test_var(spark):
    rng = np.random.default_rng(4)
    a, z, rows = np.array([[0.5, 0.1], [0.2, 0.4]]), np.zeros(2), []
    for d in months(600, 1970):
        z = a @ z + rng.standard_normal(2) @ np.array([[1, 0.5], [0, 1]])
        rows.append(("e", d, float(z[0]), float(z[1])))
    df = spark.createDataFrame(rows, "entity string, period date, u double, v double")
    fitted = var.var_fit(df, ["entity"], ["u", "v"], 1).checkpoint()
    coef = {(r.equation, r.term): r.coef for r in var.var_coefficients(fitted, ["entity"]).collect()}
    assert np.allclose([[coef["u", "L1.u"], coef["u", "L1.v"]], [coef["v", "L1.u"], coef["v", "L1.v"]]], a, atol=0.12)
    assert 0 < fitted.first().max_root < 1 and var.var_diagnostics(fitted, ["entity"]).first().n == 599
    irf = {(r.shock, r.response, r.h): r.value for r in var.var_irf(fitted, ["entity"], 3).collect()}
    assert irf["v", "u", 0] == 0 and irf["u", "u", 0] > 0
    fevd = var.var_fevd(var.var_irf(fitted, ["entity"], 3), ["entity"])
    assert all(r.s == pytest.approx(1) for r in fevd.groupBy("response", "h").agg(F.sum("share").alias("s")).collect())
    chosen = var.var_select(df, ["entity"], ["u", "v"], 4, "bic").where("chosen").first()
    assert chosen.lags == 1
    bands, rate = var.sign_restricted(fitted, ["entity"], {"u": 1, "v": -1}, 40, 7, 1, 4)
    again, _ = var.sign_restricted(fitted, ["entity"], {"u": 1, "v": -1}, 40, 7, 1, 4)
    key = lambda r: (r.response, r.h)
    assert sorted(bands.collect(), key=key) == sorted(again.collect(), key=key)  # the seed decides
    fit, kept = fitted.first(), []
    beta, chol = np.array(fit.beta).reshape(-1, 2), np.linalg.cholesky(np.array(fit.sigma).reshape(2, 2))
    uniform = lambda kind, i: (int(hashlib.md5(f"7:{kind}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    for draw in range(40):  # one draw at a time
        z = [math.sqrt(-2 * math.log(uniform("radius", i))) * math.cos(2 * math.pi * uniform("angle", i)) for i in range(4 * draw, 4 * draw + 4)]
        q, tri = np.linalg.qr(np.reshape(z, (2, 2)))
        impact, path = chol @ (q * np.sign(np.diag(tri))), []
        for _ in range(5):
            path.append(impact)
            impact = beta[1:].T @ impact
        for c, side in ((c, side) for c in (0, 1) for side in (1, -1)):
            own = side * np.stack(path)[:, :, c]
            if (own[:2, 0] > 0).all() and (own[:2, 1] < 0).all():
                kept.append(own)
    assert rate.first().accepted == len(kept)
    for b in bands.collect():
        assert (b.low, b["median"], b.high) == pytest.approx(np.quantile(np.stack(kept)[:, b.h, ["u", "v"].index(b.response)], [0.16, 0.5, 0.84]))
    assert rate.first().tried == 160 and 0 < rate.first().accepted <= 160
    assert all(b.low <= b["median"] <= b.high and (b.h > 1 or (b.low > 0) == (b.response == "u")) for b in bands.collect())


def test_backtests_do_not_look_ahead(spark):
    df = panel(spark, 60, 1).withColumn("survey", F.lit(0.0))
    cutoffs = df.select(F.col("period").alias("cutoff")).where("period >= DATE'2003-01-01'")
    out, rmse = macro.expanding_oos(df, cutoffs, ["g"], "y", ["x1", "x2"], "survey")
    one = out.orderBy("cutoff").first()
    x, y = dense(df, "g0")
    beta = np.linalg.lstsq(x[:36], y[:36], rcond=None)[0]
    assert one.model == pytest.approx(x[36] @ beta) and one.random_walk == pytest.approx(y[35]) and rmse.first().n == 24
    assert rmse.first().rmse_model < rmse.first().rmse_random_walk


def test_terms(spark):
    long = spark.createDataFrame([("e", "p", d, float(k)) for k, d in enumerate(months(6))], "entity string, source string, period date, value double")
    terms = spark.createDataFrame([("s", "t", "p", 1), ("s", "t", "p", 2)], "spec string, term string, source string, lag int")
    assert [r.value for r in macro.build_terms(long, terms).orderBy("period").collect()] == [None, 0.0, 0.5, 1.5, 2.5, 3.5]


def test_result_store(spark, tmp_path):
    df = spark.createDataFrame([("b", 2.0, True, dt.date(2024, 1, 1)), ("a", None, None, None)], "name string, x double, ok boolean, day date")
    cells = results.melt(df, "t", "r", ["name"])
    assert {(c.row_ix, c.column_name, c.value_num, c.value_txt) for c in cells.collect()} == {(0, "name", None, "a"), (0, "x", None, None), (0, "ok", None, None), (0, "day", None, None), (1, "name", None, "b"), (1, "x", 2.0, None), (1, "ok", None, "true"), (1, "day", None, "2024-01-01")}
    root = str(tmp_path)
    run = {"model_run_id": "r", "model_id": "m", "model_version": "1", "asof": "2024-01-01", "seed": 1, "vintage_kind": "true", "created_at": "2024-01-02 00:00:00", "params": {"a": 1}}
    results.save_result(root, run, {"t": (df, ["name"])})
    back = results.load_result(tables.read_table(spark, root, "model_outputs"), "r", "t", ["name", "x", "ok", "day"], ["x"])
    assert [(r.name, r.x, r.ok, r.day) for r in back.collect()] == [("a", None, None, None), ("b", 2.0, "true", "2024-01-01")]
    assert results.list_runs(tables.read_table(spark, root, "model_runs"), "m").first().params == '{"a":"1"}'


def test_intake(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "store")
    folder.mkdir()

    def drop(name, day, vals):
        body = json.dumps([{"data": f"01/{m:02}/2024", "valor": str(v)} for m, v in vals.items()])
        (folder / name).write_text(json.dumps({"source": "sgs", "series_id": "sgs:1", "freq": "M", "vintaged": False, "fetched_at": f"{day}T12:00:00Z", "body": body}) + "\n")

    def run():
        intake.start(spark, str(folder), root, str(tmp_path / "state"), payloads.parse_sgs).awaitTermination(120)
        return sorted((str(r.period), r.value, str(r.realtime_start), str(r.realtime_end)) for r in tables.read_table(spark, root, "observations").collect())

    drop("1.json", "2024-03-01", {1: 1.0, 2: 2.0})
    assert run() == [("2024-01-01", 1.0, "2024-03-01", "None"), ("2024-02-01", 2.0, "2024-03-01", "None")]
    drop("2.json", "2024-04-01", {1: 1.0, 2: 2.5, 3: 3.0})
    after = [("2024-01-01", 1.0, "2024-03-01", "None"), ("2024-02-01", 2.0, "2024-03-01", "2024-04-01"), ("2024-02-01", 2.5, "2024-04-01", "None"), ("2024-03-01", 3.0, "2024-04-01", "None")]
    assert run() == after
    drop("3.json", "2024-05-01", {1: 1.0, 2: "oops", 3: 3.0})  # nothing of it is applied
    assert run() == after
    said = {r.run_id: (r.rows_fetched, r.rows_new, r.rows_revised, r.rows_closed, r.error) for r in tables.read_table(spark, root, "run_series").collect()}
    assert [said[k] for k in sorted(said)] == [(2, 2, 0, 0, None), (3, 1, 1, 1, None), (0, 0, 0, 0, "bad number: oops")]
    assert [r.status for r in tables.read_table(spark, root, "runs").orderBy("run_id").collect()] == ["ok", "ok", "failed"]
    assert [r.stored for r in tables.read_table(spark, root, "raw_index").orderBy("run_id").collect()] == [True, True, True]
    assert not any((tmp_path / "store" / "_staged").iterdir())


def test_intake_of_published_vintages(spark, tmp_path):
    """By the flag of the body: vintages are upserted, snapshots diffed; and a batch that is run again changes nothing."""
    root = str(tmp_path / "store")
    early = {"realtime_start": "2024-02-01", "realtime_end": "2024-02-29"}
    vintage = [{"date": "2024-01-01", "value": "1"} | early, {"date": "2024-01-01", "value": "2", "realtime_start": "2024-03-01", "realtime_end": "9999-12-31"}]
    bad = [{"date": "2024-01-01", "value": "1", "realtime_start": "2024-03-02", "realtime_end": "2024-03-01"}, {"date": "2024-01-01", "value": "1", "realtime_start": "2024-05-02", "realtime_end": "2024-03-01"}]
    missing = [{"date": f"20{k}-01-01", "value": "."} | early for k in range(10, 25)]
    bodies = {"fred:v": (True, vintage), "fred:s": (False, [{"date": "2024-01-01", "value": "7"}]), "fred:bad": (True, bad), "fred:none": (True, []), "fred:missing": (True, missing), "fred:page": (False, None)}
    batch = spark.createDataFrame([("fred", s, "M", v, dt.datetime(2024, 6, 1, 12), "<html>" if x is None else json.dumps({"observations": x})) for s, (v, x) in bodies.items()], intake.RAW)
    for _ in range(2):
        intake.apply_batch(root, payloads.parse_fred)(batch, 4)
        rows = sorted((r.series_id, r.value, str(r.realtime_start), str(r.realtime_end)) for r in tables.read_table(spark, root, "observations").collect())
        assert rows == [("fred:s", 7.0, "2024-06-01", "None"), ("fred:v", 1.0, "2024-02-01", "2024-03-01"), ("fred:v", 2.0, "2024-03-01", "None")]
        said = {r.series_id: (r.rows_new, r.error) for r in tables.read_table(spark, root, "run_series").collect()}
        assert said == {"fred:v": (2, None), "fred:s": (1, None), "fred:bad": (0, "empty validity interval"), "fred:none": (0, "empty response; no changes applied"), "fred:missing": (0, "every value is missing"), "fred:page": (0, "body is not JSON")}
        run = tables.read_table(spark, root, "runs").collect()
        assert [(r.run_id, r.status, r.n_series, r.n_errors) for r in run] == [("batch-4-2024-06-01", "partial", 6, 4)]


def test_workers_do_not_need_the_folder(spark, tmp_path):
    """A Python worker that has the shipped archive alone finds the functions that tasks run."""
    from pyspark import cloudpickle

    from chronolake._spark import archive, ship

    ship(spark)
    assert any(f.endswith("chronolake.zip") for f in spark.sparkContext.listFiles)

    def task():
        return macro.__file__, macro.hp_trend(np.arange(20.0)).tolist()

    (tmp_path / "task").write_bytes(cloudpickle.dumps(task))
    (tmp_path / "worker").mkdir()
    path = archive(str(tmp_path / "worker"))
    worker = f"""
import pickle, sys
sys.path[:] = [{path!r}, *(p for p in sys.path if 'site-packages' in p or p.startswith((sys.prefix, sys.base_prefix)))]
where, trend = pickle.load(open({str(tmp_path / "task")!r}, "rb"))()
assert where.startswith({path!r}), where
assert max(abs(x - i) for i, x in enumerate(trend)) < 1e-6
print("all right")
"""
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", worker], cwd=tmp_path / "worker", env=environment, capture_output=True, text=True, timeout=120)
    assert "all right" in ran.stdout, ran.stderr[-3000:]
