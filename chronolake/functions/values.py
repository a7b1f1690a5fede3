"""Values as agencies write them, equality of values, rates, and text clean-up; all plain column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .calendar import PER_YEAR, _by_freq

# Texts that stand for a missing number, in lower case.
MISSING = ("", ".", "..", "...", "-", "--", "n/a", "na", "nan", "x", "null")
# Names of parameters that carry credentials.
SECRET_PARAMETERS = r"(?i)((?:api[_-]?key|apikey|access[_-]?token|token|secret|password|passwd|pwd|key)=)([^&\s\"']+)"
#: Values closer than this are the same.
TOLERANCE = 1e-12
#: An end date that means "still valid".
OPEN_END = "9999-12-31"


def no_nan(value: Column) -> Column:
    """NaN as NULL; only NULL means missing from here on."""
    value = value.cast("double")
    return F.when(~F.isnan(value), value)


def to_number(text: Column) -> Column:
    """A number in agency notation; null for a missing marker and for what is no number (see ``bad_number``).

    Decimal comma or point, grouped thousands, percent signs, blanks and negative parentheses. ``1,234`` has a
    decimal comma, ``1,234,567`` has none.
    """

    def signed(t: Column) -> Column:
        negative = t.startswith("(") & t.endswith(")")
        number = _let(F.when(negative, t.substr(F.lit(2), F.length(t) - 2)).otherwise(t), lambda u: _let(plain(u), number_of))
        return F.when(negative, -number).otherwise(number)

    def plain(t: Column) -> Column:
        grouped = lambda sep: t.rlike(rf"^[+-]*[^{sep}]{{1,3}}({sep}\d{{3}}){{2,}}$")
        dot, comma = t.contains("."), t.contains(",")
        # with both, whichever comes last has the decimals behind it
        comma_last = F.length(F.substring_index(t, ",", -1)) < F.length(F.substring_index(t, ".", -1))
        drop_dots, drop_commas = F.replace(t, F.lit("."), F.lit("")), F.replace(t, F.lit(","), F.lit(""))
        return (
            F.when(dot & comma & comma_last, F.replace(drop_dots, F.lit(","), F.lit(".")))
            .when(dot & comma, drop_commas)
            .when(comma & grouped(","), drop_commas)
            .when(comma, F.replace(t, F.lit(","), F.lit(".")))
            .when(dot & grouped(r"\."), drop_dots)
            .otherwise(t)
        )

    def number_of(t: Column) -> Column:
        return F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), t.try_cast("double"))

    return _let(_bare(text), signed)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _bare(text: Column) -> Column:
    return F.trim(F.regexp_replace(text.cast("string"), r"[%\s ]", ""))


def is_missing(text: Column) -> Column:
    return text.isNull() | F.lower(_bare(text)).isin(*MISSING)


def bad_number(text: Column) -> Column:
    """True for a text that is neither missing nor a number."""
    return ~is_missing(text) & to_number(text).isNull()


def exclusive_end(end: Column) -> Column:
    """From the last day of validity to the first day after; null for an open end."""
    end = F.to_date(end)
    return F.when(end < F.lit(OPEN_END).cast("date"), F.date_add(end, 1))


def same_value(a: Column, b: Column) -> Column:
    """Both missing, or within the tolerance."""
    return a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= TOLERANCE, F.lit(False))


def annualize(rate: Column, freq: Column | str, periods: Column | int = 1) -> Column:
    """A rate in percent over ``periods`` periods, compounded to a year."""
    per_year = _by_freq(freq, {f: F.lit(n) for f, n in PER_YEAR.items()})
    return (F.pow(1 + rate / 100, per_year / periods) - 1) * 100


def annualize_quarterly(rate: Column) -> Column:
    return annualize(rate, "Q", 1)


def redact(text: Column) -> Column:
    """Values of credential-looking parameters replaced."""
    return F.regexp_replace(text, SECRET_PARAMETERS, "$1REDACTED")


def path_safe(name: Column) -> Column:
    return F.replace(F.replace(name, F.lit(":"), F.lit("__")), F.lit("/"), F.lit("__"))


def attribute(json_text: Column, key: str) -> Column:
    """One attribute of an entity's JSON text."""
    return F.get_json_object(json_text, f"$.{key}")
