"""Local projections by sliding cross products: rows are never repeated for horizons.

The rows of a group stream in order, run by run, past the last ``horizon`` ones. A row that comes in closes a pair with
each of those: with the one h rows before, the change that the regression of horizon h explains. So one pass over the
panel adds up the cross products of all horizons, and a second one, with the coefficients at its head, the Newey-West
sums of their scores. Each pass moves the panel's rows once, by group; memory follows the horizon, not the series.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .._spark import ship
from .regression import solvable


class Pairs:
    """Runs of a group's rows with the ``horizon`` rows before them: regressors (k of them) and responses."""

    def __init__(self, k: int, responses: int, horizon: int) -> None:
        self.horizon = horizon
        self.x, self.y = np.full((horizon, k), np.nan), np.full((horizon, responses), np.nan)

    def push(self, x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(response, h, regressors, changes) of the complete pairs that a run of rows closes, in order."""
        self.x, self.y = np.concatenate([self.x, x]), np.concatenate([self.y, y])
        known = np.isfinite(self.x).all(1)
        for h in range(self.horizon + 1):
            at = slice(self.horizon - h, len(self.x) - h)
            own, moved = self.x[at], y - self.y[at]
            whole = known[at, None] & np.isfinite(moved)
            for r in range(y.shape[1]):
                yield r, h, own[whole[:, r]], moved[whole[:, r], r]
        self.x, self.y = self.x[len(x) :], self.y[len(y) :]


class Sums:
    """Cross products of every response and horizon."""

    def __init__(self, k: int, responses: int, horizon: int) -> None:
        self.pairs = Pairs(k, responses, horizon)
        self.xx, self.xy = np.zeros((responses, horizon + 1, k, k)), np.zeros((responses, horizon + 1, k))
        self.n = np.zeros((responses, horizon + 1), np.int64)

    def push(self, x: np.ndarray, y: np.ndarray) -> None:
        for r, h, own, moved in self.pairs.push(x, y):
            self.xx[r, h] += own.T @ own
            self.xy[r, h] += moved @ own
            self.n[r, h] += len(own)

    def solved(self, of: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Coefficients, and the row of the inverse that gives the one of term ``of``; not numbers where there is no fit."""
        beta, row = np.full(self.xy.shape, np.nan), np.full(self.xy.shape, np.nan)
        for at in zip(*np.nonzero(self.n >= max(least, self.xy.shape[-1])), strict=True):
            if (scale := solvable(self.xx[at])) is not None:
                inverse = np.linalg.inv(self.xx[at] / np.outer(scale, scale)) / np.outer(scale, scale)
                beta[at], row[at] = inverse @ self.xy[at], inverse[of]
        return beta, row


class Scores:
    """Bartlett-weighted sums of the scores of one term, horizon h over max(h, 1) lags."""

    def __init__(self, beta: np.ndarray, row: np.ndarray) -> None:
        responses, size, k = beta.shape
        self.pairs, self.beta, self.row = Pairs(k, responses, size - 1), np.nan_to_num(beta), np.nan_to_num(row)
        self.past = {(r, h): np.zeros(max(h, 1)) for r in range(responses) for h in range(size)}
        self.variance = np.zeros((responses, size))

    def push(self, x: np.ndarray, y: np.ndarray) -> None:
        for r, h, own, moved in self.pairs.push(x, y):
            score = (own @ self.row[r, h]) * (moved - own @ self.beta[r, h])
            lags = max(h, 1)
            every = np.concatenate([self.past[r, h], score])
            crossed = np.array([score @ every[lags - k : len(every) - k] for k in range(1, lags + 1)])
            self.variance[r, h] += score @ score + 2 * (1 - np.arange(1, lags + 1) / (lags + 1)) @ crossed
            self.past[r, h] = every[len(every) - lags :]


def local_projections(panel: DataFrame, group: Sequence[str], responses: Sequence[str], shock: str, system: Sequence[str], horizon: int, lags: int, least_rows: int) -> DataFrame:
    """(group, response, h, coef, se, n); ``macro.local_projections`` says what they are."""
    ship(panel.sparkSession)
    w = Window.partitionBy(*group).orderBy("period")
    controls = [F.lag(c, p).over(w) for c in system for p in range(1, lags + 1)]
    number = lambda c: F.coalesce(c.cast("double"), F.lit(float("nan")))
    rows = panel.select(*group, "period", F.array(*map(number, [F.lit(1.0), F.col(shock), *controls])).alias("_x"), F.array(*map(number, map(F.col, responses))).alias("_y"))
    shape = (len(responses), horizon + 1, 2 + len(controls))
    at = len(group)
    types = "".join(f"`{g}` {panel.schema[g].dataType.simpleString()}, " for g in group)
    keys = [(g, to_arrow_type(panel.schema[g].dataType)) for g in group]
    floats = pa.list_(pa.float64())

    def streamed(batches: Iterator[pa.RecordBatch], begin, end) -> Iterator[list[tuple]]:
        """What ``end`` makes of each group's state; ``begin`` makes one from a group's first row."""
        key, state = None, None
        for batch in batches:
            out: list[tuple] = []
            keys = list(zip(*(batch.column(c).to_pylist() for c in range(at)), strict=True)) if at else [()] * batch.num_rows
            x, y = (batch.column(at + c) for c in (1, 2))
            starts = [i for i in range(batch.num_rows) if i == 0 or keys[i] != keys[i - 1]]
            for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                if state is None or keys[a] != key:
                    if state is not None:
                        out += end(key, state)
                    key, state = keys[a], begin(batch, a)
                own = [c.slice(a, b - a).drop_null() for c in (x, y)]  # the row of coefficients has none
                if len(own[0]):
                    state.push(*(c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1) for c in own))
            yield out
        if state is not None:
            yield end(key, state)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*keys, ("_beta", floats), ("_row", floats), ("_n", pa.list_(pa.int64()))])

        def end(key: tuple, sums: Sums) -> list[tuple]:
            beta, row = sums.solved(1, least_rows)
            return [(*key, beta.ravel().tolist(), row.ravel().tolist(), sums.n.ravel().tolist())]

        for out in streamed(batches, lambda batch, i: Sums(shape[2], shape[0], horizon), end):
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], f.type) for c, f in enumerate(schema)], schema=schema)

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*keys, ("_beta", floats), ("_n", pa.list_(pa.int64())), ("_variance", floats)])

        def begin(batch: pa.RecordBatch, i: int) -> Scores:
            beta, row = (np.array(batch.column(at + c)[i].as_py()).reshape(shape) for c in (3, 4))
            scores = Scores(beta, row)
            scores.told = beta[:, :, 1].ravel().tolist(), batch.column(at + 5)[i].as_py()
            return scores

        for out in streamed(batches, begin, lambda key, s: [(*key, *s.told, s.variance.ravel().tolist())]):
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], f.type) for c, f in enumerate(schema)], schema=schema)

    arrays = "_beta array<double>, _row array<double>, _n array<bigint>"
    fitted = rows.repartition(*group).sortWithinPartitions(*group, "period").mapInArrow(fit, f"{types}{arrays}")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("_beta", "array<double>"), ("_row", "array<double>"), ("_n", "array<bigint>"))]
    head = fitted.select(*group, F.lit(None).cast(panel.schema["period"].dataType).alias("period"), F.lit(None).cast("array<double>").alias("_x"), F.lit(None).cast("array<double>").alias("_y"), F.lit(True).alias("_head"), "_beta", "_row", "_n")
    both = head.unionAll(rows.select("*", F.lit(False).alias("_head"), *none))
    both = both.repartition(*group).sortWithinPartitions(*group, F.col("_head").desc(), "period").drop("_head")
    found = both.mapInArrow(errors, f"{types}_beta array<double>, _n array<bigint>, _variance array<double>")
    long = found.select(*group, F.posexplode(F.arrays_zip("_beta", "_n", "_variance")).alias("_i", "_r")).where(~F.isnan("_r._beta"))
    response = F.get(F.array(*map(F.lit, responses)), F.floor(F.col("_i") / (horizon + 1)).cast("int"))
    return long.select(*group, response.alias("response"), (F.col("_i") % (horizon + 1)).alias("h"), F.col("_r._beta").alias("coef"), F.sqrt(F.greatest(F.col("_r._variance"), F.lit(0.0))).alias("se"), F.col("_r._n").alias("n"))
