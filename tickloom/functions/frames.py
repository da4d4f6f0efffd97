"""Window frames with the "frame must be full" rule.

Every operator takes ``keys`` and ``order``. A daily panel has at most one row per
instrument and calendar day, so a window over ``instrument`` alone is bounded by the
calendar (366 rows a year). Long intraday series go through ``blocks.in_blocks``, which
calls the same operators with ``keys=[instrument, block]``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

KEYS = ("instrument",)
ORDER = "date"


def series(keys: Sequence[str] = KEYS, order: str = ORDER) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def last_rows(n: int, keys: Sequence[str] = KEYS, order: str = ORDER) -> WindowSpec:
    return series(keys, order).rowsBetween(-(n - 1), 0)


def next_rows(n: int, keys: Sequence[str] = KEYS, order: str = ORDER) -> WindowSpec:
    return series(keys, order).rowsBetween(1, n)


def when_full(x: Column, value: Column, w: WindowSpec, n: int) -> Column:
    """``value`` over ``w``, NULL until the frame holds ``n`` non-null ``x``."""
    return F.when(F.count(x).over(w) == n, value.over(w))


def roll_mean(x: Column, n: int, keys=KEYS, order=ORDER) -> Column:
    return when_full(x, F.avg(x), last_rows(n, keys, order), n)


def roll_sum(x: Column, n: int, keys=KEYS, order=ORDER) -> Column:
    return when_full(x, F.sum(x), last_rows(n, keys, order), n)


def roll_std(x: Column, n: int, keys=KEYS, order=ORDER) -> Column:
    return when_full(x, F.stddev_samp(x), last_rows(n, keys, order), n)


def roll_max(x: Column, n: int, keys=KEYS, order=ORDER) -> Column:
    return when_full(x, F.max(x), last_rows(n, keys, order), n)


def roll_min(x: Column, n: int, keys=KEYS, order=ORDER) -> Column:
    return when_full(x, F.min(x), last_rows(n, keys, order), n)


def prior(x: Column, k: int = 1, keys=KEYS, order=ORDER) -> Column:
    return F.lag(x, k).over(series(keys, order))


def row_mean(cols: Sequence[Column]) -> Column:
    """Mean of the non-null columns of a row, NULL if none."""
    present = F.array_compact(F.array(*cols))
    total = F.aggregate(present, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(F.size(present) > 0, total / F.size(present))


def add_row_number(df: DataFrame, keys=KEYS, order=ORDER) -> DataFrame:
    """0-based ``_n`` within the series, unless a block wrapper has set it already."""
    if "_n" in df.columns:
        return df
    return df.withColumn("_n", (F.row_number().over(series(keys, order)) - 1).cast("long"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing in the source files; SQL aggregates need NULL."""
    fixes = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema.fields
        if f.dataType.typeName() in ("double", "float")
    }
    return df.withColumns(fixes) if fixes else df
