"""Reads and writes of validity intervals on small scenarios."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chronolake.functions import calendar
from chronolake.operators import catalog, panels, regression, scd, vintages
from chronolake.sources import tables

OBS = "series_id string, period date, value double, realtime_start date, realtime_end date"


def D(text):
    return dt.date.fromisoformat(text) if text else None


@pytest.fixture
def obs(spark):
    def make(rows):
        return spark.createDataFrame([(s, D(p), v, D(a), D(b)) for s, p, v, a, b in rows], OBS)

    return make


@pytest.fixture
def snap(spark):
    def make(rows):
        return spark.createDataFrame([(s, D(p), v) for s, p, v in rows], "series_id string, period date, value double")

    return make


def rows_of(df):
    return sorted([(r.series_id, str(r.period), r.value, str(r.realtime_start), str(r.realtime_end) if r.realtime_end else "") for r in df.collect()], key=str)


BASE = [("a", "2024-01-01", 1.0, "2024-02-01", "2024-03-01"), ("a", "2024-01-01", 2.0, "2024-03-01", None), ("a", "2024-02-01", None, "2024-03-01", None), ("b", "2024-01-01", 5.0, "2024-02-10", None)]


def test_reads(obs):
    o = obs(BASE)
    assert vintages.latest(o).count() == 3
    assert rows_of(vintages.as_of(o, "2024-02-29"))[0][2] == 1.0
    assert rows_of(vintages.as_of(o, "2024-03-01"))[0][2] == 2.0  # the end is exclusive
    assert vintages.as_of(o, "2024-01-31").count() == 0
    assert [r[2] for r in rows_of(vintages.first_release(o))] == [1.0, None, 5.0]  # a missing first value is a release
    assert vintages.observations(o, []).count() == 0
    assert vintages.vintages(o, ["a"]).count() == 3
    with pytest.raises(TypeError):
        vintages.observations(o, "a")
    assert {r.series_id: r.n_revisions for r in vintages.revisions(o).collect()} == {"a": 1, "b": 0}


def test_grids_equal_single_reads(spark, obs, monkeypatch):
    o = obs(BASE + [("d", "2024-01-01", 1.0, "2020-01-01", "2020-02-01"), ("d", "2024-01-01", 2.0, "2030-01-01", None), ("d", "2023-01-01", 3.0, "2023-12-05", "2023-12-06")])
    dates = spark.sql("SELECT explode(sequence(DATE'2023-12-01', DATE'2025-02-01', INTERVAL 9 DAY)) AS asof UNION ALL SELECT DATE'2023-12-01' UNION ALL SELECT NULL")
    days = [r.asof for r in dates.where("asof IS NOT NULL").distinct().collect()]
    want = sorted(str((*r, day)) for day in days for r in vintages.as_of(o, day).collect())
    for most in (vintages.MANY_DAYS, 3):
        monkeypatch.setattr(vintages, "MANY_DAYS", most)
        grid = vintages.as_of_grid(o, dates)
        assert grid.columns == [*o.columns, "asof"]
        assert sorted(str(tuple(r)) for r in grid.collect()) == want
    assert vintages.leakage(vintages.as_of_grid(o, dates), F.col("asof")).count() == 0
    assert vintages.as_of_grid(o, dates.limit(0)).count() == 0


def test_kinds_of_vintage(spark, obs):
    o = obs(BASE)
    series = spark.createDataFrame([("a", "M", 10), ("b", "M", None)], "series_id string, freq string, expected_lag_days int")
    assert {r.series_id: r.has_vintages for r in vintages.availability(o, series).collect()} == {"a": True, "b": False}
    pseudo, errors = vintages.pseudo_as_of(o, series, "2024-02-10")
    assert [(r.series_id, str(r.period)) for r in pseudo.collect()] == [("a", "2024-01-01")]  # the day itself counts
    assert [r.series_id for r in errors.collect()] == ["b"]
    mixed = vintages.read_as_of(o, series, "2024-03-15", "mixed")
    assert {(r.series_id, r.vintage_kind) for r in mixed.collect()} == {("a", "true")}
    assert vintages.read_as_of(o, series, "2024-01-01", "latest").count() == 3
    assert vintages.describe_split(mixed).first().split == "true:1"
    assert [r.series_id for r in vintages.as_of_artefacts(o, series, "2024-02-05").collect()] == ["b"]
    with pytest.raises(ValueError):
        vintages.read_as_of(o, series, "2024-03-15", "other")


def test_snapshot(obs, snap):
    cur = obs(BASE + [("c", "2024-01-01", 7.0, "2024-02-01", None)])
    inc = snap([("a", "2024-01-01", 2.0 + 1e-13), ("a", "2024-02-01", 3.0), ("a", "2024-03-01", None), ("b", "2024-01-01", 6.0)])
    after, errors = scd.apply_snapshot(cur, inc, "2024-04-01")
    after = after.checkpoint()
    assert errors.count() == 0
    assert rows_of(after) == sorted([
        ("a", "2024-01-01", 1.0, "2024-02-01", "2024-03-01"), ("a", "2024-01-01", 2.0, "2024-03-01", ""), ("a", "2024-02-01", None, "2024-03-01", "2024-04-01"), ("a", "2024-02-01", 3.0, "2024-04-01", ""),
        ("a", "2024-03-01", None, "2024-04-01", ""), ("b", "2024-01-01", 5.0, "2024-02-10", "2024-04-01"), ("b", "2024-01-01", 6.0, "2024-04-01", ""), ("c", "2024-01-01", 7.0, "2024-02-01", ""),
    ], key=str)
    assert scd.invariant_violations(after).count() == 0
    counts = {r.series_id: (r.rows_fetched, r.rows_new, r.rows_revised, r.rows_closed) for r in scd.diff_counts(scd.classify(cur, inc)).collect()}
    assert counts == {"a": (3, 1, 1, 1), "b": (1, 0, 1, 1)}
    # the same day again replaces, and leaves no closed row of that day
    again, _ = scd.apply_snapshot(after, snap([("a", "2024-01-01", 2.0), ("a", "2024-02-01", 4.0), ("a", "2024-03-01", None), ("b", "2024-01-01", 6.0)]), "2024-04-01")
    again = again.checkpoint()
    assert again.count() == 8 and again.where("value = 3").count() == 0 and again.where("value = 4 AND realtime_end IS NULL").count() == 1
    # and an equal snapshot changes nothing
    same, _ = scd.apply_snapshot(again, vintages.latest(again).select("series_id", "period", "value"), "2024-05-01")
    assert sorted(map(str, same.collect())) == sorted(map(str, again.collect()))


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan.count("Join")


def test_plans(spark, obs, snap):
    o, inc = obs(BASE * 3), snap([("a", "2024-01-01", 2.0), ("b", "2024-01-01", 6.0)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # one join of stored and incoming values, and one with what is known of each series
        shuffles, joins = exchanges(scd.apply_snapshot(o, inc, "2024-04-01", guarded=False)[0])
        assert joins <= 3 and shuffles <= 6
        plan = vintages.as_of_grid(o, spark.sql("SELECT explode(sequence(DATE'2020-01-01', DATE'2024-02-01', INTERVAL 1 DAY)) AS asof"))._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        rows = spark.range(50).selectExpr("CAST(id % 2 AS STRING) AS g", "DATE'2020-01-01' + CAST(id AS INT) AS period", "CAST(id % 7 AS DOUBLE) AS x", "CAST(id % 5 AS DOUBLE) AS y")
        robust = regression.fit(rows, ["g"], "y", ["x"], order="period", lags=6)
        assert exchanges(robust)[1] == 2 and "explode(" not in robust._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_vanished_and_covered(spark, obs, snap):
    cur = obs([("a", f"2024-{m:02}-01", float(m), "2024-12-31", None) for m in range(1, 13)])
    inc = snap([("a", f"2024-{m:02}-01", float(m)) for m in range(2, 13)])
    gone, errors = scd.apply_snapshot(cur, inc, "2025-01-15")
    assert errors.count() == 0 and gone.where("realtime_end IS NOT NULL").count() == 1
    covers = spark.createDataFrame([("a", D("2024-02-01"))], "series_id string, covers_from date")
    kept, _ = scd.apply_snapshot(cur, inc, "2025-01-15", covers=covers)
    assert kept.where("realtime_end IS NOT NULL").count() == 0


def test_guards(obs, snap):
    cur = obs([("many", f"2024-{m:02}-01", 1.0, "2024-12-31", None) for m in range(1, 13)] + [("late", "2024-01-01", 1.0, "2025-06-01", None), ("all", "2024-01-01", 1.0, "2024-12-31", None)])
    inc = snap([("many", "2024-01-01", 1.0), ("late", "2024-01-01", 2.0), ("all", "2024-02-01", 2.0)] + [("none", f"2024-{m:02}-01", None) for m in range(1, 13)])
    after, errors = scd.apply_snapshot(cur, inc, "2025-01-15")
    assert {r.series_id: r.error for r in errors.collect()} == {"many": "too many periods vanished", "late": "run date before a stored vintage", "all": "too many periods vanished", "none": "every value is missing"}
    assert sorted(map(str, after.collect())) == sorted(map(str, cur.collect()))


def test_normalising(spark):
    inc = spark.createDataFrame([("a", D("2024-01-01"), 1.0, 1), ("a", D("2024-01-01"), float("nan"), 2), ("a", None, 3.0, 3)], "series_id string, period date, value double, arrival int")
    assert [(str(r.period), r.value) for r in scd.normalize_snapshot(inc).collect()] == [("2024-01-01", None)]
    rows = spark.createDataFrame([("a", D("2024-01-01"), 1.0, D("2024-02-01"), D("9999-12-31"), 1), ("a", D("2024-01-01"), 1.0, D("2024-03-01"), D("2024-03-01"), 2)], "series_id string, period date, value double, realtime_start date, realtime_end date, arrival int")
    kept, bad = scd.normalize_vintages(rows)
    assert [r.realtime_end for r in kept.collect()] == [None] and bad.count() == 1
    with pytest.raises(ValueError):
        scd.normalize_vintages(inc)


def test_upsert(obs):
    cur = obs(BASE)
    inc = obs([("a", "2024-01-01", 2.5, "2024-03-01", "2024-04-01"), ("a", "2024-01-01", 3.0, "2024-04-01", None)])
    after = scd.upsert_vintages(cur, inc)
    assert after.count() == 5 and scd.invariant_violations(after).count() == 0
    assert {(r.value, str(r.realtime_end)) for r in after.where("realtime_start = DATE'2024-03-01' AND period = DATE'2024-01-01'").collect()} == {(2.5, "2024-04-01")}
    assert [tuple(r)[1:] for r in scd.vintage_counts(cur, inc).collect()] == [(2, 1, 1, 1)]


def test_invariants(obs):
    bad = obs([("a", "2024-01-01", 1.0, "2024-02-01", None), ("a", "2024-01-01", 2.0, "2024-02-01", None), ("b", "2024-01-01", 1.0, "2024-02-01", "2024-04-01"), ("b", "2024-01-01", 2.0, "2024-03-01", None), ("c", "2024-01-01", 1.0, "2024-02-01", "2024-02-01")])
    assert {(r.series_id, r.violation) for r in scd.invariant_violations(bad).collect()} == {("a", "repeated start"), ("a", "open before a later row"), ("b", "overlap"), ("c", "empty interval")}


def test_run_status(spark):
    counts = spark.createDataFrame([("a", 1, 1, 0, 0)], "series_id string, rows_fetched long, rows_new long, rows_revised long, rows_closed long")
    none = spark.createDataFrame([], "series_id string, error string")
    one = spark.createDataFrame([("b", "x")], "series_id string, error string")
    assert scd.run_summary(counts, none).first().status == "ok"
    assert scd.run_summary(counts, one).first().status == "partial"
    assert scd.run_summary(counts.limit(0), one).first().status == "failed"


def test_log_equals_repeated_snapshots(spark, obs, snap):
    log = spark.createDataFrame([("a", D("2024-01-01"), D(f"2024-02-{d:02}"), v, d) for d, v in ((1, 1.0), (2, 1.0), (3, 2.0), (5, None), (6, None), (7, 2.0))], "series_id string, period date, realtime_start date, value double, arrival int")
    cur = obs([]).limit(0)
    for d, v in ((1, 1.0), (2, 1.0), (3, 2.0), (5, None), (6, None), (7, 2.0)):
        cur, _ = scd.apply_snapshot(cur, snap([("a", "2024-01-01", v)]), f"2024-02-{d:02}", guarded=False)
        cur = cur.checkpoint()
    assert sorted(map(str, scd.intervals_from_log(log).collect())) == sorted(map(str, cur.collect()))


def test_calendar(spark):
    days = spark.createDataFrame([(D(x),) for x in ("2024-02-28", "2024-03-01", "2024-03-02", "2024-03-03", "2024-12-31")], "day date")
    get = lambda c: [str(r[0]) for r in days.select(c).collect()]
    day = F.col("day")
    assert get(calendar.period_start(day, "B")) == ["2024-02-28", "2024-03-01", "2024-03-01", "2024-03-01", "2024-12-31"]
    assert get(calendar.period_start(day, "W")) == ["2024-02-26", "2024-02-26", "2024-02-26", "2024-02-26", "2024-12-30"]
    assert get(calendar.period_end(calendar.period_start(day, "Q"), "Q")) == ["2024-03-31"] * 4 + ["2024-12-31"]
    assert get(calendar.next_period(day, "B"))[:3] == ["2024-02-29", "2024-03-04", "2024-03-04"]
    assert get(calendar.next_period(calendar.period_start(day, "A"), "A")) == ["2025-01-01"] * 5


def test_catalog(spark):
    series = spark.createDataFrame([("x:1", "br", "cpi", "x", "Prices", "index", ["old:1"]), ("x:2", "us", "cpi", "x", "Prices", None, None), ("bad", "us", "cpi", "x", "T", None, ["x:1"])], "series_id string, entity_id string, concept_id string, source string, title string, unit string, aliases array<string>")
    found, lost = catalog.resolve(spark.createDataFrame([("br", "cpi"), (None, "x:2"), ("us", "x:1"), ("us", "gdp")], "entity_id string, key string"), series.where("series_id <> 'bad'"))
    assert {(r.key, r.series_id) for r in found.collect()} == {("cpi", "x:1"), ("x:2", "x:2")}
    assert {(r.key, r.error) for r in lost.collect()} == {("x:1", "series belongs to br"), ("gdp", "unknown key")}
    kinds = {r.violation for r in catalog.catalog_violations(series, spark.createDataFrame([("gdp",)], "concept_id string"), spark.createDataFrame([("br",)], "entity_id string")).collect()}
    assert kinds == {"malformed id", "alias is an id", "undefined concept", "undefined entity", "concept mapped twice"}
    a, b = catalog.fingerprint(series).first(), catalog.fingerprint(series.orderBy("title")).first()
    assert a == b != catalog.fingerprint(series.unionAll(series.limit(1)).unionAll(series.limit(1))).first()
    assert [r.series_id for r in catalog.search(series, "PRICE").collect()] == ["x:1", "x:2"]


def test_panels(spark):
    rows = spark.createDataFrame([("a", D("2024-01-01"), 1.0), ("a", D("2024-02-01"), 2.0), ("b", D("2024-02-01"), 3.0)], "label string, period date, value double")
    assert [tuple(r)[1:] for r in panels.panel(rows, ["a", "b"]).orderBy("period").collect()] == [(1.0, None), (2.0, 3.0)]
    assert panels.panel(rows, ["a", "b"], "inner").count() == 1
    assert panels.panel_keys(["cpi", "x:1"], ["br"]) == [("br", "cpi", "cpi@br"), ("br", "x:1", "x:1")]
    with pytest.raises(ValueError):
        panels.panel_keys([("cpi", "br")], ["br"])
    grid = spark.createDataFrame([("s", D("2024-01-01")), ("s", D("2024-02-02")), ("s", D("2024-04-01"))], "series_id string, period date")
    assert {(str(r.period), r.violation) for r in panels.grid_violations(grid, "M").collect()} == {("2024-02-02", "off the grid"), ("2024-03-01", "hole")}


def test_tables(spark, tmp_path):
    root = str(tmp_path)
    assert tables.read_table(spark, root, "observations").count() == 0
    one = spark.createDataFrame([("x:1", D("2024-01-01"), 1.0, D("2024-02-01")), ("y:1", D("2024-01-01"), 2.0, D("2024-02-01"))], "series_id string, period date, value double, realtime_start date").withColumns({"observed_at": F.lit("2024-02-01").cast("timestamp"), "run_id": F.lit("r")})
    tables.replace_table(one, root, "observations")
    tables.replace_table(one.where("series_id = 'x:1'").withColumn("value", F.lit(9.0)), root, "observations")  # only its partition
    assert {(r.series_id, r.value) for r in tables.read_table(spark, root, "observations").collect()} == {("x:1", 9.0), ("y:1", 2.0)}
    assert tables.read_table(spark, root, "observations", "y").count() == 1
    with pytest.raises(ValueError):
        tables.conform(one.drop("run_id"), "observations")
    assert "value: not double" in tables.rejected(one.withColumn("value", F.lit("x")), "observations").first().reason
    for bad in (one.withColumn("value", F.lit("x")), one.withColumn("period", F.lit(None).cast("date"))):
        with pytest.raises(Exception, match="observations"):
            tables.replace_table(bad, root, "observations")  # and the table is as it was
    assert {(r.series_id, r.value) for r in tables.read_table(spark, root, "observations").collect()} == {("x:1", 9.0), ("y:1", 2.0)}
    tables.install_views(tables.read_table(spark, root, "observations"))
    assert tables.query(spark, "SELECT * FROM obs_asof(CAST(:d AS DATE))", d="2024-02-01").count() == 2
    assert spark.table("obs_latest").count() == spark.table("obs_first_release").count() == 2
