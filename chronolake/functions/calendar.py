"""Calendar arithmetic on period starts. Frequencies: D, B (weekdays), W (Mondays), M, Q, A."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Frequencies from fine to coarse, and their periods and rows in a year.
RANK = {"D": 0, "B": 1, "W": 2, "M": 3, "Q": 4, "A": 5}
#: Periods of a frequency in a year.
PER_YEAR = {"D": 365.25, "B": 252.0, "W": 52.0, "M": 12.0, "Q": 4.0, "A": 1.0}
#: Rows in a year, for frequencies whose years have whole numbers of them.
YEAR_LAG = {"M": 12, "Q": 4, "A": 1}
_UNIT = {"W": "week", "M": "month", "Q": "quarter", "A": "year"}


def _by_freq(freq: Column | str, choices: dict[str, Column], otherwise: Column | None = None) -> Column:
    if isinstance(freq, str) and freq in RANK:
        return choices.get(freq, otherwise)
    freq = F.col(freq) if isinstance(freq, str) else freq
    out = None
    for f, c in choices.items():
        out = F.when(freq == f, c) if out is None else out.when(freq == f, c)
    return out if otherwise is None else out.otherwise(otherwise)


def period_start(date: Column, freq: Column | str) -> Column:
    """Start of the period that holds a date; Saturday and Sunday belong to the Friday before."""
    weekend = F.greatest(F.weekday(date) - 4, F.lit(0))
    starts = {f: F.trunc(date, unit) for f, unit in _UNIT.items()}
    return _by_freq(freq, {"D": date, "B": F.date_sub(date, weekend)} | starts)


def period_end(period: Column, freq: Column | str) -> Column:
    """Last day of the period that starts at ``period``."""
    return _by_freq(freq, {
        "D": period, "B": period, "W": F.date_add(period, 6), "M": F.last_day(period),
        "Q": F.last_day(F.add_months(F.trunc(period, "quarter"), 2)), "A": F.make_date(F.year(period), F.lit(12), F.lit(31)),
    })


def next_period(period: Column, freq: Column | str) -> Column:
    """Start of the next period; weekdays skip the weekend."""
    day = F.weekday(period)
    return _by_freq(freq, {
        "D": F.date_add(period, 1), "B": F.date_add(period, F.when(day == 4, 3).when(day == 5, 2).otherwise(1)), "W": F.date_add(period, 7),
        "M": F.add_months(F.trunc(period, "month"), 1), "Q": F.add_months(F.trunc(period, "quarter"), 3), "A": F.add_months(F.trunc(period, "year"), 12),
    })


def published_at(period: Column, freq: Column | str, lag_days: Column) -> Column:
    """The day a value is out: so many days after its period ends; null for an unknown lag."""
    return F.date_add(period_end(period, freq), lag_days)


def grid_size(first: Column, last: Column, freq: Column | str) -> Column:
    """Periods from ``first`` to ``last``, both counted; null for D and B, which have no fixed grid."""
    months = F.months_between(F.trunc(last, "month"), F.trunc(first, "month")).cast("long")
    return _by_freq(freq, {"M": months + 1, "Q": F.floor(months / 3) + 1, "A": F.floor(months / 12) + 1, "W": F.floor(F.datediff(last, first) / 7) + 1}).cast("long")


def run_date(instant: Column, zone: str) -> Column:
    """Calendar date of a UTC instant in a zone."""
    return F.to_date(F.from_utc_timestamp(instant, zone))
