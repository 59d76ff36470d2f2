"""Seasons of a packed daily series by local regression (LOESS).

One round takes each season out in turn from what the others leave: every place of the season is smoothed
over its cycles and one cycle beyond both ends; what is slower than the season is removed by moving means
and a regression; the trend is a regression over what the season leaves; and this is repeated ``INNER`` times.
A regression fits a line to the nearest ``q`` days with tricube weights at every ``jump``-th day; days between
are interpolated. The line's value at a day is a weighted sum of the window, in closed form.

Spark spreads the (series, origin) rows; a row's arithmetic is numpy in the task, because the same sums as
column expressions nest so deep that resolving them alone took 7 s, and ran 50 times as long.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

# ---------------------------------------------------------------- fixed values
# cycles that the smoothing of a place sees, season by season
CYCLES = (11, 15)
INNER = 2
PART = 10  # a regression is fitted at every (q / PART)-th day, rounded up
# ------------------------------------------------------------------------------


def odd(x: float) -> int:
    """The next odd whole number."""
    n = int(np.ceil(x))
    return n + 1 - n % 2


def windows(period: int, cycles: int) -> dict[str, int]:
    """Days that the regressions of trend and low pass see."""
    return {"trend": odd(1.5 * period / (1 - 1.5 / cycles)), "low": odd(period)}


def jump_of(q: int) -> int:
    return -(-q // PART)


def loess(y: np.ndarray, q: int, jump: int, beyond: int = 0) -> np.ndarray:
    """Smoothed values of the places -``beyond`` to n - 1 + ``beyond``, for each row of ``y``."""
    n = y.shape[-1]
    first, last, seen = -beyond, n - 1 + beyond, min(q, n)
    places = np.unique(np.append(np.arange(first, last + 1, jump), last))
    left = np.clip(places - (q - 1) // 2, 0, n - seen)
    near = left[:, None] + np.arange(seen)
    d = (near - places[:, None]).astype(float)
    far = np.abs(d) / (np.abs(d).max(axis=1, keepdims=True) + max(0, q - n) // 2)
    w = np.where(far <= 0.001, 1.0, np.where(far <= 0.999, (1 - far**3) ** 3, 0.0))
    s0, s1, s2 = (s[:, None] for s in (w.sum(axis=1), (w * d).sum(axis=1), (w * d * d).sum(axis=1)))
    spread = s0 * s2 - s1 * s1
    line = spread > 1e-6 * s0 * s0
    w *= np.where(line, (s2 - s1 * d) / np.where(line, spread, 1.0), 1 / s0)
    fits = (y[..., near] * w).sum(axis=-1)
    at = np.arange(first, last + 1)
    low = np.minimum((at - first) // jump, max(0, len(places) - 2))
    high = np.minimum(low + 1, len(places) - 1)
    share = (at - places[low]) / np.maximum(places[high] - places[low], 1)
    return fits[..., low] + (fits[..., high] - fits[..., low]) * share


def moving_mean(y: np.ndarray, width: int) -> np.ndarray:
    upto = np.concatenate([[0.0], np.cumsum(y)])
    return (upto[width:] - upto[:-width]) / width


def season(y: np.ndarray, period: int, cycles: int, inner: int = INNER) -> np.ndarray:
    """The season of a series of two periods or more."""
    n, wide = len(y), windows(period, cycles)
    trend = np.zeros(n)
    for _ in range(inner):
        plain, longer = y - trend, np.empty(n + 2 * period)
        # places with one cycle more than the others come first
        more = n % period
        for some in (range(more), range(more, period)):
            if some:
                rows = np.stack([plain[i::period] for i in some])
                for i, smooth in zip(some, loess(rows, cycles, jump_of(cycles), 1)):
                    longer[i::period] = smooth
        low = moving_mean(moving_mean(moving_mean(longer, period), period), 3)
        out = longer[period : period + n] - loess(low, wide["low"], jump_of(wide["low"]))
        trend = loess(y - out, wide["trend"], jump_of(wide["trend"]))
    return out


def seasons_out(jobs: DataFrame, periods: Sequence[int], cycles: Sequence[int] = CYCLES, inner: int = INNER) -> DataFrame:
    """``jobs`` (values and others) with the seasons taken out of values; their last cycles are season_<period>."""
    added = StructType([StructField(f"season_{p}", ArrayType(DoubleType())) for p in periods])
    schema = StructType([*jobs.schema.fields, *added.fields])
    types, at = to_arrow_schema(schema), jobs.columns.index("values")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a series at a time
                row = batch.slice(i, 1)
                rest, tails = row.column(at).values[row.column(at).offsets[0].as_py() : row.column(at).offsets[1].as_py()].to_numpy(), []
                for period, seen in zip(periods, cycles):
                    part = season(rest, period, seen, inner)
                    rest = rest - part
                    tails.append(part[-period:])
                columns = [pa.array([rest], types[at].type) if c == at else row.column(c) for c in range(row.num_columns)]
                yield pa.RecordBatch.from_arrays(columns + [pa.array([t], types[len(columns)].type) for t in tails], schema=types)

    return jobs.mapInArrow(split, schema)
