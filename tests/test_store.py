"""The bucketed store: what a batch touches, what its plans move, and that it loses nothing."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from chronolake.operators import scd
from chronolake.sources import payloads, store, tables
from chronolake.streaming import intake

DAY, NEXT = "2024-04-01", "2024-05-01"
OBS = "series_id string, period date, value double, realtime_start date, realtime_end date, observed_at timestamp, run_id string"


def rows(spark, series=6, years=5, seed=1):
    """Open rows of every month, and a closed one before each second of them."""
    rng, out = random.Random(seed), []
    for s in range(series):
        for i in range(12 * years):
            p = dt.date(2010 + i // 12, i % 12 + 1, 1)
            if i % 2:
                out.append((f"src{s % 2}:{s}", p, rng.random(), dt.date(2024, 1, 1), dt.date(2024, 2, 1), None, "a"))
            out.append((f"src{s % 2}:{s}", p, None if i % 17 == 3 else float(i), dt.date(2024, 2, 1), None, None, "a"))
    stamp = F.lit("2024-01-01").cast("timestamp")
    return spark.createDataFrame(out, OBS).withColumn("observed_at", stamp)


def filled(spark, root, cur, buckets=8):
    name = store.open_store(spark, root, buckets)
    store.replace_blocks(cur, root, name, [tuple(r) for r in store.placed(cur, buckets).select("source", "bucket").distinct().collect()], "first", buckets)
    return name


def listed(root):
    return {os.path.join(top, f): os.stat(os.path.join(top, f)).st_mtime_ns for top, _, names in os.walk(f"{root}/observations") for f in names if f.endswith(".parquet")}


def content(df, *columns):
    return sorted(map(repr, df.select(*(columns or ("series_id", "period", "value", "realtime_start", "realtime_end", "run_id"))).collect()))


def snapshot(cur):
    """The open values, but for a changed one, a vanished one and a new one in a year of src0:0 and src1:1."""
    now = cur.where("realtime_end IS NULL").select("series_id", "period", "value")
    here = "series_id IN ('src0:0', 'src1:1') AND year(period) = 2013"
    now = now.where(f"NOT ({here} AND month(period) = 3)").withColumn("value", F.when(F.expr(f"{here} AND month(period) = 7"), F.lit(99.0)).otherwise(F.col("value")))
    return now.unionByName(now.where("series_id = 'src0:0' AND period = DATE '2013-05-01'").withColumn("period", F.lit("2013-05-15").cast("date")))


def test_blocks_give_what_the_whole_diff_gives(spark):
    cur = rows(spark)
    inc = snapshot(cur)
    blocks = scd.compare_blocks(cur, inc)
    assert content(blocks.where("differs"), "series_id", "year") == sorted(["Row(series_id='src0:0', year=2013)", "Row(series_id='src1:1', year=2013)"])
    assert scd.differing(inc, blocks).count() == 12 + 11  # of 359 fetched rows
    changes = scd.block_changes(cur, inc, blocks)
    assert content(changes, "series_id", "period", "old", "new", "class") == content(scd.classify(cur, inc).where("class <> 'keep'"), "series_id", "period", "old", "new", "class")
    assert content(scd.block_counts(blocks, changes), *scd.diff_counts(scd.classify(cur, inc)).columns) == content(scd.diff_counts(scd.classify(cur, inc)), *scd.diff_counts(scd.classify(cur, inc)).columns)
    want, errors = scd.apply_snapshot(cur, inc, DAY, "b")
    assert not errors.count()
    assert content(scd.apply_changes(cur, changes, DAY, "b")) == content(want)


@pytest.mark.parametrize("kind", ["late", "missing", "gone", "all gone", "empty"])
def test_block_guards_are_the_guards(spark, kind):
    cur = rows(spark)
    inc, day = snapshot(cur), DAY
    if kind == "late":
        day = "2024-01-15"
    elif kind == "missing":
        inc = inc.withColumn("value", F.when(F.col("series_id") != "src0:2", F.col("value")))
    elif kind == "gone":
        inc = inc.where("series_id <> 'src0:2' OR year(period) > 2012")
    elif kind == "all gone":
        inc = inc.where("series_id <> 'src0:2'").unionByName(spark.createDataFrame([("src0:2", dt.date(1990, 1, 1), 1.0)], inc.schema))
    else:
        inc = inc.where("false")
    blocks = scd.compare_blocks(cur, inc)
    got = scd.block_guards(blocks, scd.block_changes(cur, inc, blocks), day)
    assert content(got, "series_id", "error") == content(scd.snapshot_guards(cur, inc, day), "series_id", "error")
    assert bool(got.count()) == (kind != "empty")


def test_digests_tell_values_not_rows(spark):
    """Order, -0, NaN and null make no difference; a repeated open row and a swap of two values do."""
    cols = "series_id string, period date, value double, realtime_start date, realtime_end date"
    day = lambda m: dt.date(2020, m, 1)
    cur = spark.createDataFrame([(s, day(m), v, day(1), None) for s, own in {"a": (0.0, None, 2.0), "b": (1.0, 2.0, 3.0), "c": (1.0, 1.0, 1.0)}.items() for m, v in enumerate(own, 1)], cols)
    cur = cur.unionByName(cur.where("series_id = 'c' AND month(period) = 1"))
    inc = spark.createDataFrame([("a", day(3), 2.0), ("a", day(2), float("nan")), ("a", day(1), -0.0), ("b", day(1), 2.0), ("b", day(2), 1.0), ("b", day(3), 3.0), *(("c", day(m), 1.0) for m in (1, 2, 3))], "series_id string, period date, value double")
    assert content(scd.compare_blocks(cur, inc), "series_id", "differs") == ["Row(series_id='a', differs=False)", "Row(series_id='b', differs=True)", "Row(series_id='c', differs=True)"]


def test_stored_side_is_not_moved(spark, tmp_path):
    """Digests and joins by series and year, or by series, year and period, read the buckets where they lie."""
    cur = rows(spark)
    name = filled(spark, str(tmp_path), cur)
    stored = store.read_blocks(spark, name, ["src0", "src1"])
    changes = spark.createDataFrame([("src0:0", dt.date(2013, 3, 1), 2013, 1.0, None, "vanished")], "series_id string, period date, year int, old double, new double, class string")
    new = spark.createDataFrame([("src0:0", dt.date(2013, 3, 1), 1.0, dt.date(2024, 3, 1), None, 2013)], "series_id string, period date, value double, realtime_start date, realtime_end date, year int")
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        with store.co_located(spark):
            for df in (scd.apply_changes(stored, changes, DAY, block=["year"]), scd.upsert_vintages(stored, new, block=["year"]), stored.groupBy("series_id", "year").count()):
                plan = df._jdf.queryExecution().executedPlan().toString()
                above, moved = [], False  # no exchange between a scan of the table and the top
                for line in plan.split("\n"):
                    depth = len(line) - len(line.lstrip(" :+-"))
                    above = [a for a in above if a[0] < depth] + [(depth, line)]
                    if "FileScan" in line and "Bucketed: true" in line:
                        moved |= any("Exchange" in a for _, a in above)
                assert "Bucketed: true" in plan and not moved, plan
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_a_batch_writes_its_buckets_only(spark, tmp_path):
    root, folder = str(tmp_path / "store"), tmp_path / "in"
    cur = rows(spark)
    name = filled(spark, root, cur)
    assert content(tables.read_table(spark, root, "observations")) == content(cur)
    files = listed(root)
    changed = {str(p): v for p, v in ((r.period, r.value) for r in cur.where("series_id = 'src0:0' AND realtime_end IS NULL").collect())}
    changed["2013-07-01"], changed["2014-12-15"] = 99.0, 5.0
    body = json.dumps([{"data": f"{p[8:]}/{p[5:7]}/{p[:4]}", "valor": "" if v is None else str(v)} for p, v in changed.items()])
    batch = spark.createDataFrame([("src0", "src0:0", "M", False, dt.datetime(2024, 4, 1, 12), body)], intake.RAW)
    intake.apply_batch(root, payloads.parse_sgs, buckets=8)(batch, 1)
    after = listed(root)
    own = {r.bucket for r in store.placed(cur.where("series_id = 'src0:0' AND year(period) IN (2013, 2014)"), 8).select("bucket").distinct().collect()}
    touched = {f for f in {*files, *after} if files.get(f) != after.get(f)}
    assert touched and {f.split("/observations/")[1].rsplit("/", 1)[0] for f in touched} == {f"source=src0/bucket={b}" for b in own}
    inc = spark.createDataFrame([("src0:0", dt.date.fromisoformat(p), v) for p, v in changed.items()], "series_id string, period date, value double")
    assert content(tables.read_table(spark, root, "observations").drop("run_id"), "series_id", "period", "value", "realtime_start", "realtime_end") == content(scd.apply_snapshot(cur, inc, DAY)[0], "series_id", "period", "value", "realtime_start", "realtime_end")
    again = listed(root)
    intake.apply_batch(root, payloads.parse_sgs, buckets=8)(batch, 1)  # the same batch once more
    assert listed(root) == again
    assert [(r.rows_fetched, r.rows_new, r.rows_revised, r.rows_closed) for r in tables.read_table(spark, root, "run_series").collect()] == [(61, 1, 1, 1)]
    assert name and not os.path.exists(f"{root}/_staged/batch-1-2024-04-01")


def test_lost_attempts_and_emptied_buckets(spark, tmp_path):
    root = str(tmp_path)
    cur = rows(spark, 2, 1)
    name = filled(spark, root, cur)
    all_buckets = [tuple(r) for r in store.placed(cur, 8).select("source", "bucket").distinct().collect()]
    # an attempt that wrote its rows and was lost: the next one finishes it
    new = cur.withColumn("value", F.lit(7.0))
    staged = f"{root}/_staged/run"
    spark.createDataFrame(all_buckets, "source string, bucket int").write.parquet(f"{staged}/touched")
    store.placed(new, 8).write.parquet(f"{staged}/rows")
    store.recover(spark, root, name, "run", 8)
    assert content(tables.read_table(spark, root, "observations")) == content(new) and not os.path.exists(staged)
    # one that did not write them in full is forgotten
    os.makedirs(f"{staged}/rows")
    store.recover(spark, root, name, "run", 8)
    assert content(tables.read_table(spark, root, "observations")) == content(new) and not os.path.exists(staged)
    # a bucket may lose its last row
    source, bucket = all_buckets[0]
    left = store.placed(new, 8).where(~((F.col("source") == source) & (F.col("bucket") == bucket)))
    store.replace_blocks(left.where("false"), root, name, [(source, bucket)], "gone", 8)
    assert content(store.read_blocks(spark, name, ["src0", "src1"])) == content(left)


def test_other_numbers_of_buckets_are_refused(spark, tmp_path):
    filled(spark, str(tmp_path), rows(spark, 1, 1))
    with pytest.raises(ValueError, match="3 buckets"):
        store.open_store(spark, str(tmp_path), 3)
