"""Series too long for a task: ranges with a halo, summaries of runs, selection by counts, against plain windows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronolake.operators import audits, ranges, transforms

S = "series_id string, period date, value double"


def rows_of(df):
    return sorted((r.series_id, r.period, None if r.value is None else round(r.value, 8)) for r in df.collect())


def test_one_series_of_all_rows_is_dealt_evenly(spark):
    n = 400_000
    df = spark.range(n).selectExpr("'hot' AS series_id", "date_add(DATE'1000-01-01', CAST(id AS INT)) AS period", "CAST(hash(id) % 1000 AS DOUBLE) / 100 AS value")
    few = spark.range(50).selectExpr("concat('s', id) AS series_id", "DATE'2020-01-01' AS period", "1.0D AS value")
    df = df.unionByName(few)
    per_range = [r["count"] for r in ranges.ranged(df, ["series_id"], "period", 8).groupBy("_range").count().collect()]
    assert len(per_range) == 8 and max(per_range) < 1.6 * n / 8
    mine = ranges.in_ranges(df, lambda rows, group: transforms.rolling_compound(rows, 12, group), 11, ranges=8)
    plain = transforms.rolling_compound(df, 12)
    both = mine.withColumnRenamed("value", "v").join(plain, ["series_id", "period"], "full")
    assert both.count() == n + 50
    assert both.where("NOT (v <=> value) AND (abs(v - value) > 1e-9 OR v IS NULL OR value IS NULL)").count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_halos_come_from_several_ranges(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(f"s{s}", dt.date(2000, 1, 1) + dt.timedelta(int(k)), None if rng.random() < 0.1 else float(rng.integers(0, 4))) for s in range(4) for k in range(int(rng.integers(1, 40)))]
    rows.append((None, dt.date(2000, 1, 1), 1.0))
    df = spark.createDataFrame(rows, S)
    key = lambda r: tuple((x is not None, x) for x in r)
    for f, before, after in (
        (lambda d, g: transforms.lag(d, 5, g), 5, 0), (lambda d, g: transforms.diff(d, 1, g), 1, 0), (lambda d, g: transforms.lag(d, -3, g), 0, 3), (lambda d, g: transforms.rolling_compound(d, 7, g), 6, 0),
    ):
        mine, plain = ranges.in_ranges(df, f, before, after, ranges=32), f(df, ["series_id"])
        clean = lambda d: sorted(([r.series_id, r.period, None if r.value is None else round(r.value, 9)] for r in d.collect()), key=key)
        assert clean(mine) == clean(plain)
    assert ranges.in_ranges(df.where("false"), lambda d, g: transforms.lag(d, 1, g), 1, ranges=4).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_runs_by_ranges(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(12):
        values = np.repeat(rng.integers(0, 3, 14), rng.integers(1, 16, 14)).astype(float)
        rows += [(f"s{s}", dt.date(2000, 1, 1) + dt.timedelta(k), None if rng.random() < 0.05 else float(v)) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, S)

    def plain(values):
        runs = []
        for v in values:
            if runs and runs[-1][0] == v:
                runs[-1][1] += 1
            else:
                runs.append([v, 1])
        return runs[-1][1], max((n for _, n in runs[:-2]), default=0)

    want = {f"s{s}": plain([v for i, _, v in rows if i == f"s{s}" and v is not None]) for s in range(12)}
    for n in (1, 7, 60):
        assert {r.series_id: (r.run, r.before) for r in ranges.last_runs(df.where("value IS NOT NULL"), ranges=n).collect()} == want
    order = lambda d: sorted(map(tuple, d.collect()))
    assert order(audits.flat_runs(df, 16)) == order(audits.flat_runs(df))


def test_selection_by_counts(spark):
    rng = np.random.default_rng(5)
    groups = {"even": rng.normal(size=6000), "ties": np.repeat([1.0, 2.0, 3.0], 1500), "far": np.concatenate([rng.normal(size=500) * 1e-9, rng.normal(size=500) * 1e12]), "one": np.array([7.0])}
    rows = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "series_id string, value double")
    wanted = [(g, int(k)) for g, vs in groups.items() for k in sorted({1, len(vs), (len(vs) + 1) // 2, len(vs) // 3 + 1})]
    got = ranges.ranked_values(rows, spark.createDataFrame(wanted, "series_id string, k long"), held=50).collect()
    assert {(r.series_id, r.k): r.value for r in got} == {(g, k): float(np.sort(groups[g])[k - 1]) for g, k in wanted}
    assert len(got) == len(wanted)


def test_spikes_by_ranges(spark):
    rng = np.random.default_rng(3)
    rows = []
    for s in range(6):
        values = np.cumsum(rng.normal(size=200))
        values[50 + s] += 100 * (s % 2)
        rows += [(f"s{s}", dt.date(2000, 1, 1) + dt.timedelta(k), float(v)) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, S)
    rounded = lambda d: sorted((r.series_id, r.period, round(r["size"], 9), round(r.scale, 9)) for r in d.collect())
    assert rounded(audits.spikes(df, 9, 10)) == rounded(audits.spikes(df)) != []
    assert df.where(F.col("series_id") == "s1").count() == 200
