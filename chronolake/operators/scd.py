"""Bitemporal writes: snapshots and published vintages into validity intervals.

One full outer join on (series_id, period) meets every open stored value with its incoming one and gives the
rows that stay, end and open, so all series of a run are diffed at once and a long series is spread by its
periods; closed rows pass by. Guards come first: they are sums per series over a join of the same keys without
the other columns, and series that fail one keep their rows as they are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import OPEN_END, no_nan, same_value

# Periods, and their share of a series, beyond both of which vanishing is refused; periods of a snapshot
# that is refused without a single value.
MOST_VANISHED, MOST_VANISHED_SHARE = 10, 0.5
LEAST_ALL_MISSING = 12
KEYS = ("series_id", "period")


def _date(day: str | dt.date) -> Column:
    return F.lit(str(day)).cast("date")


def normalize_snapshot(inc: DataFrame) -> DataFrame:
    """(series_id, period, value): rows with a period; of repeated periods the one with the largest ``arrival``."""
    rows = inc.where("period IS NOT NULL").select("series_id", F.col("period").cast("date").alias("period"), no_nan(F.col("value")).alias("value"), "arrival")
    return rows.groupBy(*KEYS).agg(F.max_by(F.struct("value"), "arrival").alias("v")).select(*KEYS, "v.value")


def normalize_vintages(inc: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vintage rows with open ends as null, the last arrival of each (period, start); and the rows that are refused."""
    if "realtime_end" not in inc.columns:
        raise ValueError("vintages need realtime_end")
    end = F.col("realtime_end").cast("date")
    rows = inc.where("period IS NOT NULL").select("series_id", F.col("period").cast("date").alias("period"), no_nan(F.col("value")).alias("value"), F.col("realtime_start").cast("date").alias("realtime_start"), F.when(end < _date(OPEN_END), end).alias("realtime_end"), "arrival")
    bad = F.col("realtime_start").isNull() | F.coalesce(F.col("realtime_end") <= F.col("realtime_start"), F.lit(False))
    kept = rows.where(~bad).groupBy(*KEYS, "realtime_start").agg(F.max_by(F.struct("value", "realtime_end"), "arrival").alias("v"))
    return kept.select(*KEYS, "v.value", "realtime_start", "v.realtime_end"), rows.where(bad).drop("arrival").withColumn("error", F.lit("empty validity interval"))


def classify(cur: DataFrame, inc: DataFrame, covers: DataFrame | None = None) -> DataFrame:
    """Each open stored period against the snapshot, for the series that the snapshot has.

    ``class`` is keep, changed, vanished or new. ``covers`` (series_id, covers_from) limits both sides to the
    periods a snapshot claims to cover.
    """
    fetched = inc.select("series_id").distinct()
    open_rows = cur.where("realtime_end IS NULL").join(fetched, "series_id", "left_semi")
    stored = open_rows.select(*KEYS, F.col("value").alias("old"), F.col("realtime_start").alias("old_start"), F.lit(True).alias("is_stored"))
    new = inc.select(*KEYS, F.col("value").alias("new"), F.lit(True).alias("is_new"))
    both = stored.join(new, list(KEYS), "full_outer")
    if covers is not None:
        both = both.join(covers.select("series_id", "covers_from"), "series_id", "left").where("covers_from IS NULL OR period >= covers_from").drop("covers_from")
    kind = F.when(F.col("is_new").isNull(), "vanished").when(F.col("is_stored").isNull(), "new").when(same_value(F.col("old"), F.col("new")), "keep").otherwise("changed")
    return both.select(*KEYS, "old", "old_start", "new", kind.alias("class"))


def snapshot_guards(cur: DataFrame, inc: DataFrame, run_date: str | dt.date, covers: DataFrame | None = None) -> DataFrame:
    """(series_id, error) of the series whose snapshot must not be applied."""
    day = _date(run_date)
    late = cur.groupBy("series_id").agg(F.greatest(F.max("realtime_start"), F.max("realtime_end")).alias("latest"))
    late = late.join(inc.select("series_id").distinct(), "series_id", "left_semi").where(F.col("latest") > day).select("series_id", F.lit("run date before a stored vintage").alias("error"))
    got = inc.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_values"), F.max("period").alias("last"))
    if covers is not None:
        got = got.join(covers.select("series_id", "covers_from"), "series_id", "left")
    else:
        got = got.withColumn("covers_from", F.lit(None).cast("date"))
    empty = got.select("series_id", F.when((F.col("n") >= LEAST_ALL_MISSING) & (F.col("n_values") == 0), "every value is missing").when(F.col("last") < F.col("covers_from"), "every period is before the covered ones").alias("error")).where("error IS NOT NULL")
    seen = classify(cur, inc, covers).groupBy("series_id").agg(F.count_if(F.col("class") != "new").alias("considered"), F.count_if(F.col("class") == "vanished").alias("vanished"))
    many = (F.col("vanished") == F.col("considered")) | (F.col("vanished") > F.greatest(F.lit(MOST_VANISHED), MOST_VANISHED_SHARE * F.col("considered")))
    gone = seen.where((F.col("vanished") > 0) & many).select("series_id", F.lit("too many periods vanished").alias("error"))
    return late.unionByName(empty).unionByName(gone).groupBy("series_id").agg(F.min("error").alias("error"))


def apply_snapshot(cur: DataFrame, inc: DataFrame, run_date: str | dt.date, run_id: str = "", observed_at: Column | None = None, covers: DataFrame | None = None, guarded: bool = True) -> tuple[DataFrame, DataFrame]:
    """The stored rows after a snapshot, and (series_id, error) of the series that were left as they were.

    Changed values close and open again on the run date, vanished ones close, new ones open; what was opened
    on the run date itself is replaced. Closed rows, periods outside the coverage and series that the snapshot
    does not have pass through.
    """
    day = _date(run_date)
    observed_at = observed_at if observed_at is not None else F.lit(None).cast("timestamp")
    errors = snapshot_guards(cur, inc, run_date, covers) if guarded else cur.sparkSession.createDataFrame([], "series_id string, error string")
    taken = inc.select("series_id").distinct().join(errors.select("series_id"), "series_id", "left_anti")
    taken = taken.join(covers.select("series_id", "covers_from"), "series_id", "left") if covers is not None else taken.withColumn("covers_from", F.lit(None).cast("date"))
    # closed rows never change and take no part in the join
    stored = cur.where("realtime_end IS NULL").withColumn("_stored", F.lit(True))
    new = inc.select(*KEYS, F.col("value").alias("_value"), F.lit(True).alias("_new"))
    both = stored.join(new, list(KEYS), "full_outer").join(taken.withColumn("_taken", F.lit(True)), "series_id", "left")
    takes_part = F.col("_taken").isNotNull() & (F.col("covers_from").isNull() | (F.col("period") >= F.col("covers_from")))
    same = F.col("_stored").isNotNull() & F.col("_new").isNotNull() & same_value(F.col("value"), F.col("_value"))
    both = both.withColumns({"_ends": takes_part & F.col("_stored").isNotNull() & ~same, "_opens": takes_part & F.col("_new").isNotNull() & ~same})
    return cur.where("realtime_end IS NOT NULL").unionByName(_moved(both, cur, day, run_id, observed_at)), errors


def _moved(both: DataFrame, cur: DataFrame, day: Column, run_id: str, observed_at: Column) -> DataFrame:
    """Open rows (``_stored``) that stay or end (``_ends``) on a day, and the values (``_value``) that open (``_opens``)."""

    def row(columns: dict[str, Column]) -> Column:
        return F.struct(*[columns.get(c, F.col(c)).cast(cur.schema[c].dataType).alias(c) for c in cur.columns])

    left = F.when(F.col("_stored").isNotNull() & ~(F.col("_ends") & (F.col("realtime_start") == day)), row({"realtime_end": F.when(F.col("_ends"), day)}))
    opened = F.when(F.col("_opens"), row({"value": F.col("_value"), "realtime_start": day, "realtime_end": F.lit(None), "observed_at": observed_at, "run_id": F.lit(run_id)}))
    return both.select(F.explode(F.array_compact(F.array(left, opened))).alias("_row")).select("_row.*")


def apply_changes(cur: DataFrame, changes: DataFrame, run_date: str | dt.date, run_id: str = "", observed_at: Column | None = None, block: Sequence[str] = ()) -> DataFrame:
    """The stored rows after classified changes (``classify``) that have been let through; ``block`` are more join keys of both."""
    observed_at = observed_at if observed_at is not None else F.lit(None).cast("timestamp")
    stored = cur.where("realtime_end IS NULL").withColumn("_stored", F.lit(True))
    new = changes.select(*KEYS, *block, F.col("new").alias("_value"), "class")
    both = stored.join(new, [*KEYS, *block], "full_outer")
    both = both.withColumns({"_ends": F.coalesce(F.col("class").isin("changed", "vanished"), F.lit(False)), "_opens": F.coalesce(F.col("class").isin("changed", "new"), F.lit(False))})
    return cur.where("realtime_end IS NOT NULL").unionByName(_moved(both, cur, _date(run_date), run_id, observed_at))


def _digests(rows: DataFrame, value: str = "value", when: Column | None = None) -> list[Column]:
    """A count and two 64-bit digests of (period, value), whatever the order of rows; NaN and null, -0 and 0 are one."""
    same = F.coalesce(no_nan(F.col(value)) + F.lit(0.0), F.lit(float("nan")))
    picked = lambda c: c if when is None else F.when(when, c)
    return [
        F.count(picked(F.lit(1))).alias("n"),
        F.coalesce(F.bit_xor(picked(F.xxhash64("period", same))), F.lit(0).cast("long")).alias("d1"),
        F.coalesce(F.bit_xor(picked(F.xxhash64(F.lit("second"), same, "period"))), F.lit(0).cast("long")).alias("d2"),
    ]


def compare_blocks(cur: DataFrame, inc: DataFrame) -> DataFrame:
    """Digests of the open stored rows and of a snapshot by (series, year of the period), for the snapshot's series.

    (series_id, year, n_stored, latest, n_fetched, n_values, last, differs). A block that doesn't differ has the same
    periods and values on both sides (128 bits of digest and a count agree), so only others need a diff. One pass over
    the stored rows also gives what the guards ask of them. ``cur`` has ``year`` or gets it.
    """
    cur = cur if "year" in cur.columns else cur.withColumn("year", F.year("period"))
    late = F.greatest(F.max("realtime_start"), F.max("realtime_end")).alias("latest")
    # the snapshot's digests are a few rows a series; stored rows are summed up where they lie
    new = inc.withColumn("year", F.year("period")).groupBy("series_id", "year").agg(*_digests(inc), F.count("value").alias("n_values"), F.max("period").alias("last"))
    old = cur.groupBy("series_id", "year").agg(*_digests(cur, when=F.col("realtime_end").isNull()), late)
    old = old.join(inc.select("series_id").distinct(), "series_id", "left_semi").select("series_id", "year", F.col("n").alias("n_stored"), F.col("d1").alias("s1"), F.col("d2").alias("s2"), "latest")
    both = old.join(new, ["series_id", "year"], "full_outer")
    equal = (F.col("n_stored") == F.col("n")) & (F.col("s1") == F.col("d1")) & (F.col("s2") == F.col("d2"))
    empty = (F.coalesce("n_stored", F.lit(0)) == 0) & F.col("n").isNull()
    return both.select("series_id", "year", F.coalesce("n_stored", F.lit(0)).alias("n_stored"), "latest", F.coalesce("n", F.lit(0)).alias("n_fetched"), F.coalesce("n_values", F.lit(0)).alias("n_values"), "last", (~F.coalesce(equal, F.lit(False)) & ~empty).alias("differs"))


def differing(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """The rows of blocks that differ, with their year."""
    rows = rows if "year" in rows.columns else rows.withColumn("year", F.year("period"))
    return rows.join(blocks.where("differs").select("series_id", "year"), ["series_id", "year"], "left_semi")


def block_changes(cur: DataFrame, inc: DataFrame, blocks: DataFrame) -> DataFrame:
    """``classify`` of the blocks that differ, without what stays: (series_id, period, year, old, new, class)."""
    stored = differing(cur, blocks).where("realtime_end IS NULL").select(*KEYS, "year", F.col("value").alias("old"), F.lit(True).alias("is_stored"))
    new = differing(inc, blocks).select(*KEYS, "year", F.col("value").alias("new"), F.lit(True).alias("is_new"))
    both = stored.join(new, [*KEYS, "year"], "full_outer")
    kind = F.when(F.col("is_new").isNull(), "vanished").when(F.col("is_stored").isNull(), "new").when(same_value(F.col("old"), F.col("new")), None).otherwise("changed")
    return both.withColumn("class", kind).where("class IS NOT NULL").select(*KEYS, "year", "old", "new", "class")


def block_guards(blocks: DataFrame, changes: DataFrame, run_date: str | dt.date) -> DataFrame:
    """``snapshot_guards`` from compared blocks and their changes: no row of the table is looked at again."""
    gone = changes.where("class = 'vanished'").groupBy("series_id").agg(F.count(F.lit(1)).alias("vanished"))
    sums = blocks.groupBy("series_id").agg(F.sum("n_stored").alias("considered"), F.max("latest").alias("latest"), F.sum("n_fetched").alias("n"), F.sum("n_values").alias("n_values"))
    sums = sums.join(gone, "series_id", "left")
    many = (F.col("vanished") == F.col("considered")) | (F.col("vanished") > F.greatest(F.lit(MOST_VANISHED), MOST_VANISHED_SHARE * F.col("considered")))
    said = F.array_min(F.array_compact(F.array(
        F.when(F.col("latest") > _date(run_date), "run date before a stored vintage"),
        F.when((F.col("n") >= LEAST_ALL_MISSING) & (F.col("n_values") == 0), "every value is missing"),
        F.when((F.col("vanished") > 0) & many, "too many periods vanished"),
    )))
    return sums.select("series_id", said.alias("error")).where("error IS NOT NULL")


def block_counts(blocks: DataFrame, changes: DataFrame) -> DataFrame:
    """``diff_counts`` from compared blocks and their changes."""
    kind = F.col("class")
    moved = changes.groupBy("series_id").agg(F.count_if(kind == "new").alias("rows_new"), F.count_if(kind == "changed").alias("rows_revised"), F.count_if(kind.isin("changed", "vanished")).alias("rows_closed"))
    fetched = blocks.groupBy("series_id").agg(F.sum("n_fetched").alias("rows_fetched")).join(moved, "series_id", "left")
    return fetched.select("series_id", "rows_fetched", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("rows_new", "rows_revised", "rows_closed")])


def upsert_vintages(cur: DataFrame, inc: DataFrame, run_id: str = "", observed_at: Column | None = None, block: Sequence[str] = ()) -> DataFrame:
    """Stored rows after published vintages: incoming ones win on value and end by (series, period, start), the rest stays.

    ``block`` are more join keys of both.
    """
    observed_at = observed_at if observed_at is not None else F.lit(None).cast("timestamp")
    keys = [*KEYS, *block, "realtime_start"]
    new = inc.select(*keys, F.col("value").alias("_value"), F.col("realtime_end").alias("_end"), F.lit(True).alias("_new"))
    both = cur.withColumn("_old", F.lit(True)).join(new, keys, "full_outer")
    touched = F.col("_new").isNotNull() & (F.col("_old").isNull() | ~same_value(F.col("value"), F.col("_value")) | ~F.col("realtime_end").eqNullSafe(F.col("_end")))
    out = {
        "value": F.when(F.col("_new").isNotNull(), F.when(touched, F.col("_value")).otherwise(F.col("value"))).otherwise(F.col("value")),
        "realtime_end": F.when(F.col("_new").isNotNull(), F.col("_end")).otherwise(F.col("realtime_end")),
        "observed_at": F.when(touched, observed_at).otherwise(F.col("observed_at")) if "observed_at" in cur.columns else None,
        "run_id": F.when(touched, F.lit(run_id)).otherwise(F.col("run_id")) if "run_id" in cur.columns else None,
    }
    return both.select(*[(out[c] if out.get(c) is not None else F.col(c)).alias(c) for c in cur.columns])


def invariant_violations(obs: DataFrame) -> DataFrame:
    """(series_id, period, violation): repeated keys, several open rows, empty intervals, overlaps."""
    w = Window.partitionBy(*KEYS).orderBy("realtime_start", F.col("realtime_end").asc_nulls_last())
    rows = obs.select(*KEYS, "realtime_start", "realtime_end", F.lead("realtime_start").over(w).alias("next"))
    kinds = F.array_compact(F.array(
        F.when(F.col("next") == F.col("realtime_start"), "repeated start"),
        F.when(F.col("realtime_end").isNull() & F.col("next").isNotNull(), "open before a later row"),
        F.when(F.col("realtime_end") <= F.col("realtime_start"), "empty interval"),
        F.when(F.col("realtime_end") > F.col("next"), "overlap"),
    ))
    return rows.select(*KEYS, F.explode(kinds).alias("violation")).distinct()


def diff_counts(changes: DataFrame) -> DataFrame:
    """Per series of classified rows: fetched, new, revised (changed) and closed (changed or vanished)."""
    kind = F.col("class")
    return changes.groupBy("series_id").agg(F.count_if(kind != "vanished").alias("rows_fetched"), F.count_if(kind == "new").alias("rows_new"), F.count_if(kind == "changed").alias("rows_revised"), F.count_if(kind.isin("changed", "vanished")).alias("rows_closed"))


def vintage_changes(cur: DataFrame, inc: DataFrame, block: Sequence[str] = ()) -> DataFrame:
    """Published vintages with whether they are ``new``, ``revised`` in value, and close an open end (``closes``), or move one."""
    keys = [*KEYS, *block, "realtime_start"]
    old = cur.select(*keys, F.col("value").alias("_value"), F.col("realtime_end").alias("_end"), F.lit(True).alias("_old"))
    there = F.col("_old").isNotNull()
    return inc.join(old, keys, "left").select(
        *inc.columns, (~there).alias("new"), (there & ~same_value(F.col("value"), F.col("_value"))).alias("revised"),
        (there & F.col("_end").isNull() & F.col("realtime_end").isNotNull()).alias("closes"), (there & ~F.col("_end").eqNullSafe(F.col("realtime_end"))).alias("moves"),
    )


def vintage_counts(cur: DataFrame, inc: DataFrame) -> DataFrame:
    """The same counts for published vintages; closed are open ends that became set."""
    return counted_vintages(vintage_changes(cur, inc))


def counted_vintages(changes: DataFrame) -> DataFrame:
    return changes.groupBy("series_id").agg(F.count(F.lit(1)).alias("rows_fetched"), F.count_if("new").alias("rows_new"), F.count_if("revised").alias("rows_revised"), F.count_if("closes").alias("rows_closed"))


def run_summary(counts: DataFrame, errors: DataFrame) -> DataFrame:
    """One row: series, errors, summed counts, and ok, partial or failed."""
    both = counts.select("series_id", "rows_fetched", "rows_new", "rows_revised", "rows_closed", F.lit(0).alias("bad")).unionByName(errors.select("series_id", *[F.lit(0).cast("long").alias(c) for c in ("rows_fetched", "rows_new", "rows_revised", "rows_closed")], F.lit(1).alias("bad")))
    sums = both.agg(F.countDistinct("series_id").alias("n_series"), F.coalesce(F.sum("bad"), F.lit(0)).alias("n_errors"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows_fetched", "rows_new", "rows_revised", "rows_closed")])
    return sums.withColumn("status", F.when(F.col("n_errors") == 0, "ok").when(F.col("n_errors") >= F.col("n_series"), "failed").otherwise("partial"))


def series_coverage(obs: DataFrame, before: DataFrame, touched: DataFrame, now: Column) -> DataFrame:
    """First and last open period per series of ``before``; ``last_updated`` moves for touched series only."""
    span = obs.where("realtime_end IS NULL").groupBy("series_id").agg(F.min("period").alias("first_period"), F.max("period").alias("last_period"))
    rows = before.select("series_id", "last_updated").join(span, "series_id", "left").join(touched.select("series_id").distinct().withColumn("_touched", F.lit(True)), "series_id", "left")
    return rows.select("series_id", "first_period", "last_period", F.when(F.col("_touched"), now).otherwise(F.col("last_updated")).alias("last_updated"))


def select_series(series: DataFrame, ids: list[str] | None = None, sources: list[str] | None = None) -> DataFrame:
    """Series by id or alias, and by source."""
    if ids is not None:
        series = series.where(F.col("series_id").isin(ids) | F.arrays_overlap(F.coalesce("aliases", F.array().cast("array<string>")), F.array(*[F.lit(i) for i in ids]).cast("array<string>")))
    return series.where(F.col("source").isin(sources)) if sources is not None else series


def intervals_from_log(readings: DataFrame, at: str = "realtime_start") -> DataFrame:
    """Validity intervals from a log of daily readings (series_id, period, day, value, arrival), in one window pass.

    The last reading of a day counts; readings equal to the one before open nothing.
    """
    daily = readings.groupBy(*KEYS, F.col(at).alias("realtime_start")).agg(F.max_by(F.struct("value"), "arrival").alias("v")).select(*KEYS, "realtime_start", "v.value")
    w = Window.partitionBy(*KEYS).orderBy("realtime_start")
    moved = daily.withColumn("_prev", F.lag(F.struct("value")).over(w)).where(F.col("_prev").isNull() | ~same_value(F.col("value"), F.col("_prev.value"))).drop("_prev")
    return moved.withColumn("realtime_end", F.lead("realtime_start").over(w)).select(*KEYS, "value", "realtime_start", "realtime_end")
