"""Mergeable moments of all numeric columns, taken in one pass over Arrow batches.

A task keeps count, total, mean, sum of squared deviations, minimum and maximum of every column
in typed arrays and returns one row per column; the rows of the tasks are merged by Spark. So a
table of some hundred columns is read once, never unpivoted, and nothing but one row per task and
column is shuffled.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tasks carry the code of their functions, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A decimal of up to this many digits fits one machine word without its point.
WORD_DIGITS = 18
TOTAL = pa.decimal128(38, 0)
SCHEMA = (
    "column_name string, task long, n long, total decimal(38,0), scale int, "
    "mean double, m2 double, min double, max double"
)


def _whole(cells: pa.Array) -> tuple[np.ndarray | list[int], int] | None:
    """Integers or decimals without their point, and the places behind it; None for other numbers."""
    if pa.types.is_integer(cells.type):
        return cells.to_numpy(zero_copy_only=False).astype(np.int64), 0
    if not pa.types.is_decimal(cells.type):
        return None
    if cells.type.precision > WORD_DIGITS:
        return [int(x.scaleb(cells.type.scale)) for x in cells.to_pylist()], cells.type.scale
    words = np.frombuffer(cells.buffers()[1], np.int64)  # low and high word of each cell
    return words[2 * cells.offset : 2 * (cells.offset + len(cells)) : 2], cells.type.scale


def _exact_sum(values: np.ndarray | list[int]) -> int:
    if isinstance(values, list):
        return sum(values)
    low = np.int64(0xFFFFFFFF)
    return (int((values >> np.int64(32)).sum()) << 32) + int((values & low).sum())


class _Moments:
    """Moments of one column so far; ``total`` is exact and None for floating-point numbers."""

    def __init__(self) -> None:
        self.n, self.total, self.scale = 0, None, 0
        self.mean = self.m2 = 0.0
        self.low, self.high = math.inf, -math.inf
        self.nan = False

    def add(self, cells: pa.Array) -> None:
        cells = cells.drop_null() if cells.null_count else cells
        n = len(cells)
        if not n:
            return
        whole = _whole(cells)
        if whole is None:
            x = cells.to_numpy(zero_copy_only=False).astype(np.float64)
            mean = float(x.mean())
            known = x[~np.isnan(x)]
            self.nan |= len(known) < n
        else:
            values, self.scale = whole
            total = _exact_sum(values)
            self.total = (self.total or 0) + total
            unit = 10**self.scale
            mean = total / n / unit
            x = np.asarray(values, np.float64) / unit
            ends = (min(values), max(values)) if isinstance(values, list) else (values.min(), values.max())
            known = np.array([int(end) / unit for end in ends])
        spread = x - mean
        m2 = float(spread @ spread)
        both = self.n + n
        step = mean - self.mean
        self.m2 += m2 + step * step * self.n * n / both
        self.mean += step * n / both
        self.n = both
        if len(known):
            self.low, self.high = min(self.low, float(known.min())), max(self.high, float(known.max()))

    def row(self) -> tuple:
        """NaN counts as the largest number."""
        if not self.n:
            return 0, None, 0, None, None, None, None
        known = self.low <= self.high
        low, high = self.low if known else math.nan, math.nan if self.nan else self.high
        return self.n, self.total, self.scale, self.mean, self.m2, low, high


def _taken(names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments, rows = [_Moments() for _ in names], 0
        with np.errstate(all="ignore"):
            for batch in batches:
                rows += batch.num_rows
                for column, cells in zip(moments, batch.columns, strict=True):
                    column.add(cells)
        if rows:
            task = TaskContext.get().partitionId()
            n, total, scale, mean, m2, low, high = map(list, zip(*(m.row() for m in moments), strict=True))
            kinds = [pa.int64(), TOTAL, pa.int32(), *[pa.float64()] * 4]
            arrays = [pa.array(x, kind) for x, kind in zip((n, total, scale, mean, m2, low, high), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(names)), pa.array([task] * len(names), pa.int64()), *arrays],
                names=["column_name", "task", "n", "total", "scale", "mean", "m2", "min", "max"],
            )

    return take


def _merged(parts: Column) -> Column:
    """Mean and sum of squared deviations of all parts, in the order of the tasks."""

    def add(a: Column, b: Column) -> Column:
        n, step = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + step * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + step * step * a["n"] * b["n"] / n).alias("m2"),
        )

    def part(p: Column) -> Column:
        return F.struct(p["n"].cast("double").alias("n"), p["mean"].alias("mean"), p["m2"].alias("m2"))

    ordered = F.array_sort(parts)
    none = F.struct(*(F.lit(0.0).alias(c) for c in ("n", "mean", "m2")))
    return F.aggregate(F.transform(ordered, part), none, add)


def moments(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``column_name, n, mean, stddev, min, max`` of the named numeric columns, from one scan.

    Totals of integers and decimals are exact, so their means do not depend on the tasks; the
    deviations are merged in the order of the tasks. A column without values has n = 0, a table
    without rows no row. ``stddev`` is NULL for one value; NaN is above all numbers.
    """
    kinds = dict(zip(df.columns, (f.dataType for f in df.schema.fields), strict=True))
    cells = [F.col(f"`{c}`") if isinstance(kinds[c], T.NumericType) else F.col(f"`{c}`").cast("double") for c in names]
    parts = df.select(*cells).mapInArrow(_taken(tuple(names)), SCHEMA)
    known = F.when(F.col("n") > 0, F.struct("task", "n", "mean", "m2"))
    merged = parts.groupBy("column_name").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("scale").alias("scale"),
        _merged(F.collect_list(known)).alias("both"), F.min("min").alias("min"), F.max("max").alias("max"),
    )  # one entry per task in the list
    exact = F.col("total").cast("double") / F.col("n") / F.pow(F.lit(10.0), F.col("scale"))
    return merged.select(
        "column_name", "n",
        F.when(F.col("n") > 0, F.coalesce(exact, F.col("both.mean"))).alias("mean"),
        F.when(F.col("n") > 1, F.sqrt(F.col("both.m2") / (F.col("n") - 1))).alias("stddev"),
        "min", "max",
    )
