"""Windows over series of any length: ranges of (series, period) instead of whole series.

A window by series sorts a series in one task, however long it is. Here rows are dealt into even ranges of (series,
period); a range gets the rows before it (and after it) that a window reaches back (and forth) to, as its halo, and the
window runs by range and series. One series of all rows is then worked on by all tasks. Results are those of the plain
window, as long as it reaches no further than the halo.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .._spark import checkpoint

#: Rows that are sorted by value in one task at most.
HELD = 100_000
#: Splitters of a round of selection, and the ranks they may be off by, as shares.
SPLITTERS, ACCURACY = 128, 2_000


def ranged(df: DataFrame, group: Sequence[str], order: str, ranges: int | None = None) -> DataFrame:
    """``df`` with the column ``_range``: even ranges of (group, order), written so that they stay as they are."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return checkpoint(df.repartitionByRange(n, *group, order).withColumn("_range", F.spark_partition_id()))


def _halo(rows: DataFrame, group: Sequence[str], order: str, n: int, after: bool) -> DataFrame:
    """The ``n`` rows before (or after) each range of a group, as rows of that range; they may come from several ranges."""
    sign = -1 if after else 1
    counts = rows.groupBy("_range", *group).agg(F.count(F.lit(1)).alias("_rows"))
    spread = Window.partitionBy(*group)
    upto = F.sum("_rows").over(spread.orderBy(sign * F.col("_range")).rowsBetween(Window.unboundedPreceding, 0))
    counts = counts.withColumns({"_parts": F.count(F.lit(1)).over(spread), "_upto": upto}).where("_parts > 1")  # a boundary parts one group at most
    here, there = counts.alias("h"), counts.alias("t")
    same = [F.col(f"h.{g}").eqNullSafe(F.col(f"t.{g}")) for g in group]
    earlier = sign * F.col("t._range") < sign * F.col("h._range")
    short = n - (F.col("h._upto") - F.col("h._rows") - F.col("t._upto"))  # rows wanted from the end of range t
    wanted = here.join(there, [*same, earlier, short > 0]).select(*[F.col(f"h.{g}").alias(g) for g in group], F.col("t._range").alias("_from"), F.col("h._range").alias("_to"), short.alias("_short"))
    last = Window.partitionBy("_range", *group).orderBy(F.col(order).asc() if after else F.col(order).desc())
    ends = rows.withColumn("_last", F.row_number().over(last)).where(F.col("_last") <= n)
    w, e = wanted.alias("w"), ends.alias("e")
    same = [F.col(f"w.{g}").eqNullSafe(F.col(f"e.{g}")) for g in group]
    out = e.join(w, [*same, F.col("e._range") == F.col("w._from"), F.col("e._last") <= F.col("w._short")])
    return out.select(*[F.col("w._to").alias("_range") if c == "_range" else F.col(f"e.{c}").alias(c) for c in rows.columns])


def in_ranges(df: DataFrame, f: Callable[[DataFrame, list[str]], DataFrame], rows_before: int, rows_after: int = 0, group: Sequence[str] = ("series_id",), order: str = "period", ranges: int | None = None) -> DataFrame:
    """``f(rows, group)`` with ranges as one more group; it keeps all columns and rows, and looks no further than the halo."""
    rows = ranged(df, group, order, ranges)
    full = rows.withColumn("_halo", F.lit(False))
    for n, after in ((rows_before, False), (rows_after, True)):
        if n:
            full = full.unionByName(_halo(rows, group, order, n, after).withColumn("_halo", F.lit(True)))
    return f(full, ["_range", *group]).where(~F.col("_halo")).drop("_halo", "_range")


def last_runs(df: DataFrame, group: Sequence[str] = ("series_id",), order: str = "period", ranges: int | None = None) -> DataFrame:
    """(group, run, before): the length of a group's last run of equal values, and of the longest up to the one before the last.

    A range is summed up as its first and last run, the run before the last, and the longest of the others. Summaries of
    a group, one for each range, are joined up in order: the first run of one may go on the last one of those before.
    """
    rows = ranged(df.select(*group, order, "value"), group, order, ranges)
    w = Window.partitionBy("_range", *group).orderBy(order)
    moved = F.coalesce((F.col("value") != F.lag("value").over(w)).cast("int"), F.lit(0))
    runs = rows.withColumn("_moved", moved).withColumn("_k", F.sum("_moved").over(w)).groupBy("_range", *group, "_k").agg(F.count(F.lit(1)).alias("_n"), F.first("value").alias("_value"))
    runs = runs.withColumn("_last", F.max("_k").over(Window.partitionBy("_range", *group)))
    of = lambda where, c: F.max(F.when(where, F.col(c)))
    k, last = F.col("_k"), F.col("_last")
    part = runs.groupBy("_range", *group).agg(
        F.max("_k").alias("k"), of(k == 0, "_n").alias("first_n"), of(k == 0, "_value").alias("first_value"), of(k == last, "_n").alias("last_n"), of(k == last, "_value").alias("last_value"),
        F.coalesce(of((k == last - 1) & (k > 0), "_n"), F.lit(0)).alias("next_n"), F.coalesce(of((k > 0) & (k < last - 1), "_n"), F.lit(0)).alias("other_n"),
    )
    parts = part.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("_range", *[c for c in part.columns if c not in ("_range", *group)]))).alias("_parts"))  # one a range
    zero = F.lit(0).cast("long")

    def state(older, before, run, value):
        return F.struct(older.alias("older"), before.alias("before"), run.alias("run"), value.alias("value"))

    def step(s, p):
        goes_on = (s["run"] > 0) & (s["value"] == p["first_value"])
        older = F.when(goes_on, s["older"]).otherwise(F.greatest(s["older"], s["before"]))
        before = F.when(goes_on, s["before"]).otherwise(s["run"])
        run = p["first_n"] + F.when(goes_on, s["run"]).otherwise(zero)
        two = state(F.greatest(older, before), run, p["last_n"], p["last_value"])
        more = state(F.greatest(older, before, run, p["other_n"]), p["next_n"], p["last_n"], p["last_value"])
        return F.when(p["k"] == 0, state(older, before, run, p["first_value"])).when(p["k"] == 1, two).otherwise(more)

    folded = F.aggregate("_parts", state(zero, zero, zero, F.lit(None).cast("double")), step)
    return parts.select(*group, folded.alias("_s")).select(*group, F.col("_s.run").alias("run"), F.col("_s.older").alias("before"))


def ranked_values(rows: DataFrame, ranks: DataFrame, group: Sequence[str] = ("series_id",), value: str = "value", held: int = HELD) -> DataFrame:
    """(group, k, value): the k-th smallest value of a group, for the (group, k) of ``ranks``; exact, without sorting a group.

    Every round narrows each rank to the values strictly between two splitters, which a sketch of bounded size offers;
    partial counts below, at and above them verify it, or show that the value is a splitter itself. So a round leaves
    about a fiftieth of a group's values, however often one is repeated. What is left is sorted once it is ``held``
    values at most. Infinite values count as values, nulls do not.
    """
    rows = rows.select(*group, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    nothing = F.lit(None).cast("double")
    state = ranks.select(*group, F.col("k").cast("long").alias("k"), nothing.alias("_lo"), nothing.alias("_hi"), F.lit(0).cast("long").alias("_below"))
    grid = [i / SPLITTERS for i in range(SPLITTERS + 1)]
    found: list[DataFrame] = []

    def inside(of: DataFrame) -> DataFrame:
        a, b = rows.alias("a"), of.alias("b")
        same = [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in group]
        between = (F.col("b._lo").isNull() | (F.col("a._v") > F.col("b._lo"))) & (F.col("b._hi").isNull() | (F.col("a._v") < F.col("b._hi")))
        return a.join(b, [*same, between]).select("b.*", "a._v")

    while True:
        sketch = checkpoint(inside(state).groupBy(*state.columns).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", grid, ACCURACY).alias("_s")))
        wide = sketch.where(F.col("_n") > held)
        if wide.isEmpty():
            break
        at = F.floor((F.col("k") - F.col("_below")) * SPLITTERS / F.col("_n")).cast("int")
        split = wide.select(*state.columns, F.get("_s", F.greatest(at - 1, F.lit(0))).alias("_a"), F.get("_s", F.least(at + 2, F.lit(SPLITTERS))).alias("_b"))
        v = F.col("_v")
        counts = [F.count_if(v < F.col("_a")).alias("_less_a"), F.count_if(v <= F.col("_a")).alias("_upto_a"), F.count_if(v < F.col("_b")).alias("_less_b"), F.count_if(v <= F.col("_b")).alias("_upto_b")]
        rank = F.col("k") - F.col("_below")
        is_value = F.when(rank <= F.col("_upto_a"), F.col("_a")).when(rank > F.col("_less_b"), F.col("_b"))
        off = (rank <= F.col("_less_a")) | (rank > F.col("_upto_b"))
        counted = checkpoint(inside(split).groupBy(*split.columns).agg(*counts).withColumns({"_is": is_value, "_off": off}))
        if not counted.where("_off").isEmpty():
            raise RuntimeError("a splitter is further off than the sketch's bound")
        found.append(counted.where("_is IS NOT NULL").select(*group, "k", F.col("_is").alias("value")))
        narrowed = counted.where("_is IS NULL").select(*group, "k", F.col("_a").alias("_lo"), F.col("_b").alias("_hi"), (F.col("_below") + F.col("_upto_a")).alias("_below"))
        state = narrowed.unionByName(sketch.where(F.col("_n") <= held).select(*state.columns))
    nth = F.row_number().over(Window.partitionBy(*group, "k").orderBy("_v"))
    out = inside(state).withColumn("_i", nth).where(F.col("_i") == F.col("k") - F.col("_below")).select(*group, "k", F.col("_v").alias("value"))
    for one in found:
        out = out.unionByName(one)
    return out
