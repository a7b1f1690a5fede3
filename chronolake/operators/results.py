"""A store of result tables: melted to cells, appended with their run, pivoted back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .._spark import checkpoint
from ..sources.tables import append_table


def melt(df: DataFrame, table: str, run_id: str, order: Sequence[str]) -> DataFrame:
    """(model_run_id, table_name, row_ix, column_name, value_num, value_txt): a cell per row and column.

    Numbers stay numbers, booleans become true and false, dates ISO text; a missing value is null in both. Rows are
    numbered in ``order``: dealt by ranges of it, sorted and numbered within each, and moved on by the rows of the
    ranges before, of which there is one count a range.
    """
    ranged = checkpoint(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_at", 33)  # how these ids are made: the range in the upper bits, the place below
    counts = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = F.broadcast(counts.select("_part", before.alias("_before")))  # a row for each partition
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ranged.withColumn("_part", part).join(ranges, "_part").withColumn("_ix", (F.col("_before") + place).cast("int"))
    cells = []
    for f in df.schema:
        number = isinstance(f.dataType, T.NumericType)
        num, txt = (F.col(f.name).cast("double"), F.lit(None).cast("string")) if number else (F.lit(None).cast("double"), F.col(f.name).cast("string"))
        cells.append(F.struct(F.lit(f.name).alias("column_name"), num.alias("value_num"), txt.alias("value_txt")))
    long = numbered.select("_ix", F.explode(F.array(*cells)).alias("c"))
    return long.select(F.lit(run_id).alias("model_run_id"), F.lit(table).alias("table_name"), F.col("_ix").alias("row_ix"), "c.column_name", "c.value_num", "c.value_txt")


def unmelt(cells: DataFrame, columns: Sequence[str], numbers: Sequence[str] = ()) -> DataFrame:
    """Wide again, a row for each (run, table, row_ix); ``numbers`` come back as doubles, the others as text."""
    value = F.struct("value_num", "value_txt")
    wide = cells.groupBy("model_run_id", "table_name", "row_ix").pivot("column_name", list(columns)).agg(F.first(value))
    return wide.select("model_run_id", "table_name", "row_ix", *[F.col(f"`{c}`.{'value_num' if c in numbers else 'value_txt'}").alias(c) for c in columns])


def save_result(root: str, run: dict, tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> None:
    """Append a run and its tables (frame, order of rows); the run's ``params`` are kept as JSON."""
    spark = next(iter(tables.values()))[0].sparkSession
    params = run.get("params") or {}
    row = spark.range(1).select(*[F.lit(v if not isinstance(v, (dt.date, dt.datetime)) else str(v)).alias(k) for k, v in run.items() if k != "params"])
    row = row.withColumn("params", F.to_json(F.create_map(*[F.lit(str(x)) for kv in params.items() for x in kv])) if params else F.lit(None).cast("string"))
    for name, (df, order) in tables.items():
        append_table(melt(df, name, run["model_run_id"], order), root, "model_outputs")
    append_table(row, root, "model_runs")  # last: a run without its outputs is never listed


def load_result(outputs: DataFrame, run_id: str, table: str, columns: Sequence[str], numbers: Sequence[str] = ()) -> DataFrame:
    cells = outputs.where((F.col("model_run_id") == run_id) & (F.col("table_name") == table))
    return unmelt(cells, columns, numbers).orderBy("row_ix").drop("model_run_id", "table_name")


def list_runs(runs: DataFrame, model: str | None = None) -> DataFrame:
    """Runs, newest first."""
    return (runs.where(F.col("model_id") == model) if model is not None else runs).orderBy(F.col("created_at").desc(), "model_run_id")
