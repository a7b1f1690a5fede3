"""Agency payloads to observations.

Every parser takes a frame with ``series_id`` and ``body`` (text), and what its format needs beside them,
and returns ``(series_id, ordinal, period, value, realtime_start, realtime_end, error)``. A body is read whole
or not at all: one that can't be read, or has a bad cell, gives one row with an error and nothing else. So no
period of it is taken for a vanished one, and one series never stops the others.

A body's items stay an array of its row until they are checked, so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import exclusive_end, is_missing, to_number

COLUMNS = ("series_id", "ordinal", "period", "value", "realtime_start", "realtime_end", "error")


class Cell(NamedTuple):
    """What an item says, before its number is read."""

    period: Column
    text: Column
    start: Column | None = None
    end: Column | None = None


def _out(rows: DataFrame, items: Column, cell: Callable[[Column], Cell], failed: Column | None = None, lenient: bool = False) -> DataFrame:
    """Items as rows, unless the body failed or one of them is bad; with ``lenient`` a text that is no number is a missing one.

    The steps are columns of their own, each computed once: numbers are long expressions.
    """

    def date(c: Column | None) -> Column:
        return (F.lit(None) if c is None else c).cast("date")

    def read(item: Column, i: Column) -> Column:
        c = cell(item)
        return F.struct(i.alias("ordinal"), date(c.period).alias("period"), c.text.cast("string").alias("text"), date(c.start).alias("start"), date(c.end).alias("end"))

    def numbered(c: Column) -> Column:
        return F.struct(c["ordinal"].alias("ordinal"), c["period"].alias("period"), c["text"].alias("text"), to_number(c["text"]).alias("value"), c["start"].alias("start"), c["end"].alias("end"))

    rows = rows.withColumns({"_failed": F.lit(None).cast("string") if failed is None else failed, "_items": items})
    rows = rows.select("series_id", "_failed", F.when(F.col("_failed").isNull(), F.transform("_items", read)).alias("_cells"))
    rows = rows.withColumn("_cells", F.transform("_cells", numbered))
    unread = lambda c: F.lit(False) if lenient else c["value"].isNull() & ~is_missing(c["text"])
    rows = rows.withColumn("_bad", F.get(F.filter("_cells", lambda c: c["period"].isNull() | unread(c)), F.lit(0)))
    bad = F.when(F.col("_bad").isNotNull(), F.when(F.col("_bad.period").isNull(), "bad period").otherwise(F.concat(F.lit("bad number: "), F.col("_bad.text"))))
    rows = rows.select("series_id", F.coalesce("_failed", bad).alias("error"), "_bad.ordinal", "_cells")
    rows = rows.select("series_id", "error", "ordinal", F.explode_outer(F.when(F.col("error").isNull(), F.col("_cells"))).alias("c")).where("c IS NOT NULL OR error IS NOT NULL")
    return rows.select("series_id", F.coalesce("c.ordinal", "ordinal").alias("ordinal"), "c.period", "c.value", F.col("c.start").alias("realtime_start"), F.col("c.end").alias("realtime_end"), "error")


def _not_json(parsed: Column, what: str) -> Column:
    return F.when(parsed.isNull(), F.lit(f"body is not {what}"))


def parse_fred(raw: DataFrame) -> DataFrame:
    """One page or an array of pages of observations; ``vintaged`` says whether validity dates are read."""
    item = "array<struct<realtime_start:string,realtime_end:string,date:string,value:string>>"
    page = f"struct<error_message:string,observations:{item}>"
    pages = F.when(F.ltrim("body").startswith("["), F.from_json("body", f"array<{page}>")).otherwise(F.array(F.from_json("body", page)))
    rows = raw.withColumn("pages", pages)
    unread = F.col("pages").isNull() | F.exists("pages", lambda p: p.isNull()) | ~F.ltrim("body").rlike(r"^[\[{]")
    failed = F.when(unread, "body is not JSON").otherwise(F.array_max(F.transform("pages", lambda p: p["error_message"])))

    def cell(x: Column) -> Cell:
        vintaged = F.col("vintaged")
        return Cell(x["date"].try_cast("date"), x["value"], F.when(vintaged, x["realtime_start"].try_cast("date")), F.when(vintaged, exclusive_end(x["realtime_end"].try_cast("date"))))

    return _out(rows, F.flatten(F.transform("pages", lambda p: F.coalesce(p["observations"], F.array().cast(item)))), cell, failed)


def parse_sgs(raw: DataFrame) -> DataFrame:
    """``[{data: dd/mm/yyyy, valor}]``, or a list of such lists."""
    item = "struct<data:string,valor:string>"
    nested = F.ltrim("body").rlike(r"^\[\s*\[")
    items = F.when(nested, F.flatten(F.from_json("body", f"array<array<{item}>>"))).otherwise(F.from_json("body", f"array<{item}>"))
    rows = raw.withColumn("items", F.when(F.ltrim("body").startswith("["), items))
    return _out(rows, F.col("items"), lambda x: Cell(F.try_to_date(x["data"], "dd/MM/yyyy"), x["valor"]), _not_json(F.col("items"), "a JSON array"))


def parse_focus(raw: DataFrame, default_statistic: str = "Mediana") -> DataFrame:
    """One statistic of ``{value: [{Data, ...}]}``; rows without it are left out. ``statistic`` may name another one."""
    statistic = F.coalesce(F.col("statistic"), F.lit(default_statistic)) if "statistic" in raw.columns else F.lit(default_statistic)
    rows = raw.withColumn("items", F.from_json("body", "struct<value:array<map<string,string>>>")["value"]).withColumn("name", statistic)
    own = F.filter("items", lambda x: F.try_element_at(x, F.col("name")).isNotNull())
    return _out(rows, own, lambda x: Cell(F.try_element_at(x, F.lit("Data")).try_cast("date"), F.try_element_at(x, F.col("name"))), _not_json(F.col("items"), "an OData list"))


def parse_sidra(raw: DataFrame) -> DataFrame:
    """Row 0 names the columns; the period is the code column labelled as a time, read by the series' ``freq``."""
    rows = raw.withColumn("items", F.from_json("body", "array<map<string,string>>")).withColumn("header", F.get("items", F.lit(0)))
    keys = F.map_keys(F.map_filter("header", lambda k, v: k.endswith("C") & v.rlike("^(Mês|Trimestre|Ano)")))
    rows = rows.withColumn("key", F.get(keys, F.lit(0)))
    failed = F.when(F.col("items").isNull(), "body is not a JSON list").when(~F.coalesce(F.array_contains(F.map_keys("header"), "V"), F.lit(False)), "no header row").when(F.col("key").isNull(), "no period column")

    def cell(x: Column) -> Cell:
        code, freq = F.try_element_at(x, F.col("key")), F.col("freq")
        year, part = F.substring(code, 1, 4).try_cast("int"), F.substring(code, 5, 2).try_cast("int")
        period = (
            F.when((freq == "M") & code.rlike(r"^\d{6}$") & part.between(1, 12), F.make_date(year, part, F.lit(1)))
            .when((freq == "Q") & code.rlike(r"^\d{6}$") & part.between(1, 4), F.make_date(year, part * 3 - 2, F.lit(1)))
            .when((freq == "A") & code.rlike(r"^\d{4}$"), F.make_date(year, F.lit(1), F.lit(1)))
        )
        return Cell(period, F.try_element_at(x, F.lit("V")))

    return _out(rows, F.slice("items", F.lit(2), F.greatest(F.size("items") - 1, F.lit(0))), cell, failed)


def parse_ipea(raw: DataFrame) -> DataFrame:
    """``{value: [{VALDATA, VALVALOR}]}``; the date stands before the T and is never shifted; an empty list is an error."""
    rows = raw.withColumn("items", F.from_json("body", "struct<value:array<struct<VALDATA:string,VALVALOR:string>>>")["value"])
    failed = F.coalesce(_not_json(F.col("items"), "an OData list"), F.when(F.size("items") == 0, F.lit("empty list")))
    return _out(rows, F.col("items"), lambda x: Cell(F.substring_index(x["VALDATA"], "T", 1).try_cast("date"), x["VALVALOR"]), failed)


def parse_dbnomics(raw: DataFrame) -> DataFrame:
    """Parallel arrays of periods and values; their frequency has to be the series' own ``freq``."""
    rows = raw.withColumn("doc", F.get(F.from_json("body", "struct<series:struct<docs:array<struct<`@frequency`:string,period:array<string>,value:array<string>>>>>")["series"]["docs"], F.lit(0)))
    known = F.create_map(*[F.lit(x) for x in ("annual", "A", "quarterly", "Q", "monthly", "M", "daily", "D")])
    own = F.try_element_at(known, F.col("doc")["@frequency"])
    failed = F.when(F.col("doc").isNull(), "no series in the body").when(own.isNull(), "unknown frequency").when(own != F.col("freq"), "another frequency than the series has")

    def cell(x: Column) -> Cell:
        p, freq = x["p"], F.col("freq")
        quarter = F.regexp_extract(p, r"^\d{4}-Q([1-4])$", 1).try_cast("int")
        period = F.when(freq == "Q", F.make_date(F.substring(p, 1, 4).try_cast("int"), quarter * 3 - 2, F.lit(1))).when(freq == "A", F.concat(p, F.lit("-01-01")).try_cast("date")).when(freq == "M", F.concat(p, F.lit("-01")).try_cast("date")).otherwise(p.try_cast("date"))
        return Cell(period, x["v"])

    return _out(rows, F.arrays_zip(F.col("doc.period").alias("p"), F.col("doc.value").alias("v")), cell, failed)


def _split(text: Column, separator: str) -> Column:
    """Parts of a text between separators that do not stand in double quotes."""
    sep = re.escape(separator)
    return F.regexp_extract_all(F.concat(F.lit(separator), text), F.lit(rf'{sep}((?:[^"{sep}]++|"[^"]*+"|")*+)'), F.lit(1))


def _unquoted(cell: Column) -> Column:
    cell = F.btrim(cell)
    return F.when(cell.rlike(r'(?s)^".*"$'), F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))).otherwise(cell)


def parse_csv(raw: DataFrame, date_col: str | int = 0, value_col: str | int = 1, skip: int = 0, date_format: str = "yyyy-MM-dd", period_is_end: bool = False, separator: str = ",") -> DataFrame:
    """Lines behind ``skip`` banner lines; columns by position (no header) or by the names in the header line.

    Cells may be quoted, with separators, line breaks and doubled quotes inside. Rows without a date are left out; a
    cell that is no number, such as a footnote's mark, is a missing value, as files have them on purpose.
    """
    lines = F.transform(_split(F.regexp_replace("body", "^﻿", ""), "\n"), lambda x: F.rtrim(F.regexp_replace(x, "\r$", "")))
    rows = raw.withColumn("lines", F.filter(lines, lambda x, i: (i >= skip) & (F.length(x) > 0)))
    rows = rows.withColumn("cells", F.transform("lines", lambda x: F.transform(_split(x, separator), _unquoted))).withColumn("header", F.get("cells", F.lit(0)))
    if isinstance(date_col, str):
        rows = rows.withColumns({"d": F.array_position("header", date_col).cast("int"), "v": F.array_position("header", value_col).cast("int")})
        failed = F.when((F.col("d") == 0) | (F.col("v") == 0) | F.col("d").isNull(), F.lit("columns not found"))
        data = F.slice("cells", F.lit(2), F.greatest(F.size("cells") - 1, F.lit(0)))
    else:
        rows = rows.withColumns({"d": F.lit(date_col + 1), "v": F.lit(value_col + 1)})
        failed, data = None, F.col("cells")
    dated = F.filter(data, lambda x: F.coalesce(F.get(x, F.col("d") - 1), F.lit("")) != "")

    def cell(x: Column) -> Cell:
        date = F.try_to_date(F.get(x, F.col("d") - 1), date_format)
        return Cell(F.trunc(date, "month") if period_is_end else date, F.get(x, F.col("v") - 1))

    return _out(rows, dated, cell, failed, lenient=True)


PARSERS = {"fred": parse_fred, "sgs": parse_sgs, "focus": parse_focus, "sidra": parse_sidra, "ipea": parse_ipea, "dbnomics": parse_dbnomics, "csv": parse_csv}
