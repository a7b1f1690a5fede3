"""Backtests on growing samples whose regressors depend on the sample: a filter recomputed at every cut-off.

At a cut-off the slack of a price equation is the gap of a series that ends there, so all its past values change. The
history is not copied for each cut-off. Rows of a group stream once, in order, through a state of fixed size that holds
what every truncation needs:

* The two-sided filter solves a banded system. Forward elimination never looks ahead, so all truncations share it but for
  their last two rows; backwards, each trend is a linear function of the two trends after it. A gap is therefore carried
  as a linear function of the last two trends of the sample, and so are the sums of gaps times other terms (a vector
  each) and of gaps times gaps (a matrix); one more value moves them all by one 3 x 3 matrix.
* The one-sided filter is a regression on own lags, so a gap is a fixed row of values times the coefficients at the
  cut-off, and the sums are running products of those rows.

Rows are shuffled once, by group, however many cut-offs there are. Memory does not grow with the length of a series; one
series is one task's work.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import isfinite, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .._spark import ship
from .macro import HAMILTON, LEAST_PRICE, LEAST_TREND, LOG_LEVEL, SMOOTHING, oos_errors
from .regression import solvable

METHODS = ("hp", "hamilton")


class TwoSided:
    """Gaps of the two-sided filter as functions (p, q, r) of the sample's last two trends: p x[n-2] + q x[n-1] + r."""

    size = 3

    def __init__(self, smoothing: float = SMOOTHING) -> None:
        self.s, self.n = smoothing, 0
        self.steps: list[tuple[float, float, float, float]] = []  # pivot, both factors and right side of the last three rows
        self.y = 0.0

    def push(self, value: float) -> tuple[np.ndarray, np.ndarray]:
        """The new value's gap, and the matrix that moves all functions so far to the new last two trends."""
        s, i = self.s, self.n
        main = 1 + s * (1 if i == 0 else 5 if i == 1 else 6)
        beside = s * (-2 if i == 0 else -4)
        d, one, z = main, beside, value
        if i:
            d1, a1, b1, z1 = self.steps[-1]
            d, one, z = d - a1 * a1 * d1, one - a1 * b1 * d1, z - a1 * z1
        if i > 1:
            d2, _, b2, z2 = self.steps[-2]
            d, z = d - b2 * b2 * d2, z - b2 * z2
        move = np.array([[0.0, 0, 0], [1, 0, 0], [0, 0, 1]])
        if i > 1:  # the trend two rows back is settled by the two after it
            before = self.steps[-2]
            move[0] = -before[1], -before[2], before[3] / before[0]
        self.steps = [*self.steps[-2:], (d, one / d, s / d, z)]
        self.n, self.y = i + 1, value
        return np.array([0.0, -1.0, value]), move

    def ends(self) -> np.ndarray | None:
        """The last two trends of the sample as it stands."""
        if self.n < LEAST_TREND:
            return None
        s = self.s
        (d3, a3, b3, z3), (d2, _, _, z2), _ = self.steps  # rows n - 3, n - 2, n - 1 as if more were to come
        d2 -= s  # the last two rows have fewer neighbours
        one = (-2 * s - a3 * b3 * d3) / d2
        d1 = 1 + s - one * one * d2 - b3 * b3 * d3
        last = (self.y - one * z2 - b3 * z3) / d1
        return np.array([z2 / d2 - one * last, last, 1.0])


class OneSided:
    """Gaps of a regression on own lags as functions of (1, - coefficients): the value, one, and the lagged values."""

    def __init__(self, h: int = HAMILTON[0], p: int = HAMILTON[1]) -> None:
        self.h, self.p, self.size = h, p, p + 2
        self.past: list[float] = []
        self.first: float | None = None
        self.products, self.n = np.zeros((p + 2, p + 2)), 0

    def push(self, value: float) -> tuple[np.ndarray | None, None]:
        if self.first is None:
            self.first = value
        self.past = [*self.past[-(self.h + self.p - 1) :], value - self.first]  # a shift leaves residuals alone and products small
        if len(self.past) < self.h + self.p:
            return None, None
        row = np.array([self.past[-1], 1.0, *self.past[-1 - self.h : -1 - self.h - self.p : -1]])
        self.products += np.outer(row, row)
        self.n += 1
        return row, None

    def ends(self) -> np.ndarray | None:
        if self.n < self.p + 5:
            return None
        xx, xy = self.products[1:, 1:], self.products[1:, 0]
        scale = solvable(xx)
        if scale is None:
            return None
        return np.concatenate([[1.0], -np.linalg.solve(xx / np.outer(scale, scale), xy / scale) / scale])


class _Gaps:
    """The gaps of a group's rows that are still needed, and sums over the training rows of a gap times other terms."""

    def __init__(self, kind, n_terms: int, lag: int) -> None:
        self.filter, self.lag = kind, lag
        self.recent: list[np.ndarray | None] = [None] * (lag + 2)  # of the last rows
        self.lines, self.square = np.zeros((n_terms, kind.size)), np.zeros((kind.size, kind.size))

    def push(self, value: float | None) -> None:
        if value is None:
            self.recent = [*self.recent[1:], None]
            return
        gap, move = self.filter.push(value)
        if move is not None:
            self.recent = [None if e is None else e @ move for e in self.recent]
            self.lines, self.square = self.lines @ move, move.T @ self.square @ move
        self.recent = [*self.recent[1:], gap]

    def add(self, terms: np.ndarray, weight: float) -> bool:
        """The row before the last one joins the training rows, with the gap ``lag`` rows before it."""
        gap = self.recent[-2 - self.lag]
        if gap is None:
            return False
        self.lines += np.outer(terms, gap)
        self.square += weight * np.outer(gap, gap)
        return True


class Sample:
    """One group's growing sample."""

    def __init__(self, method: str, n_terms: int, lag: int, smoothing: float, least_rows: int) -> None:
        kind = (lambda: TwoSided(smoothing)) if method == "hp" else OneSided
        self.levels, self.logs = _Gaps(kind(), n_terms + 1, lag), _Gaps(kind(), n_terms + 1, lag)
        self.products, self.n, self.least = np.zeros((n_terms + 1, n_terms + 1)), 0, least_rows
        self.total, self.values, self.positive = 0.0, 0, True
        self.before: tuple[np.ndarray, float] | None = None

    def row(self, source: float | None, y: float | None, xs: Sequence[float | None], weight: float | None, wanted: bool) -> float | None:
        """Takes a row in; the forecast of its ``y`` by the fit on the rows before it, where it is wanted and possible."""
        self.levels.push(source)
        if source is not None:
            self.total, self.values, self.positive = self.total + source, self.values + 1, self.positive and source > 0
        self.logs.push(100 * log(source) if source is not None and self.positive else None)
        if self.before is not None:
            terms, w = self.before
            joined = self.levels.add(w * terms, w)
            if joined:
                self.logs.add(w * terms, w)
                self.products += w * np.outer(terms, terms)
                self.n += 1
        whole = not any(v is None or not isfinite(v) for v in (y, weight, *xs))
        self.before = (np.array([1.0, *xs, y]), weight) if whole else None
        if not wanted or any(v is None for v in xs):
            return None
        own = self.logs if self.positive and self.values and self.total / self.values > LOG_LEVEL else self.levels
        gap = own.recent[-1 - own.lag]
        ends = own.filter.ends()
        if self.n < self.least or gap is None or ends is None:
            return None
        crossed, squared = own.lines @ ends, ends @ own.square @ ends
        k = len(xs) + 1
        xx = np.block([[self.products[:k, :k], crossed[:k, None]], [crossed[None, :k], np.array([[squared]])]])
        xy = np.append(self.products[:k, k], crossed[k])
        scale = solvable(xx)
        if scale is None:
            return None
        beta = np.linalg.solve(xx / np.outer(scale, scale), xy / scale) / scale
        return float(beta @ [1.0, *xs, gap @ ends])


def filtered_oos(rows: DataFrame, cutoffs: DataFrame, group: Sequence[str], y: str, xs: Sequence[str], survey: str, source: str, lag: int = 1, method: str = "hp", weight: str | None = None, start: str | None = None, smoothing: float = SMOOTHING, least_rows: int = LEAST_PRICE) -> tuple[DataFrame, DataFrame]:
    """One-step forecasts at every cut-off, with the gap of ``source`` recomputed on the values up to it, and their errors.

    ``rows`` has group, period, y, the other regressors ``xs``, the survey and ``source``, one row a period, and maybe a
    weight; the gap enters ``lag`` rows later. ``cutoffs`` has the column ``cutoff``. Training rows lie before a cut-off,
    from ``start`` on; those with a null are left out, and cut-offs with fewer than ``least_rows`` of them, a singular fit
    or no gap. As in ``log_or_level`` the gap is of 100 times the log where all values so far are positive with a mean
    beyond 20. Returns what ``macro.expanding_oos`` does.
    """
    if method not in METHODS:
        raise ValueError(f"unknown gap method {method}; there are {METHODS}")
    if lag < 0:
        raise ValueError("a gap of later rows is not known at a cut-off")
    ship(rows.sparkSession)
    days = cutoffs.select(F.col("cutoff").cast("date").alias("_cutoff")).distinct()
    inside = F.lit(True) if start is None else F.col("period") >= F.lit(start).cast("date")
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    own = rows.join(days, rows["period"] == days["_cutoff"], "left").select(
        *group, "period", F.col("_cutoff").isNotNull().alias("_wanted"), number(source).alias("_source"), number(y).alias("_y"),
        F.when(inside, number(weight) if weight else F.lit(1.0)).alias("_weight"), number(survey).alias("_survey"), F.array(*map(number, xs)).alias("_xs"),
    )
    k, at = len(xs), len(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sample, last = None, None, None
        for batch in batches:
            out = []
            for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                period, wanted, source_value, actual, w, survey_value, regressors = values[at:]
                if sample is None or values[:at] != key:
                    key, sample, last = values[:at], Sample(method, k + 1, lag, smoothing, least_rows), None
                told = wanted and None not in (actual, survey_value, last)
                model = sample.row(source_value, actual, regressors, w, told)
                if model is not None:
                    out.append((*key, period, actual, model, survey_value, last))
                last = actual
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], f.type) for c, f in enumerate(fields)], schema=fields)

    result = "cutoff date, actual double, model double, survey double, random_walk double"
    types = "".join(f"`{g}` {rows.schema[g].dataType.simpleString()}, " for g in group)
    fields = pa.schema([*((g, to_arrow_type(rows.schema[g].dataType)) for g in group), ("cutoff", pa.date32()), *((c, pa.float64()) for c in ("actual", "model", "survey", "random_walk"))])
    out = own.repartition(*group).sortWithinPartitions(*group, "period").mapInArrow(run, types + result)
    return out, oos_errors(out, group)

