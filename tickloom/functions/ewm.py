"""Exponentially weighted mean: y0 = x0, y[t] = (1-a) y[t-1] + a x[t].

Spark has no recursive window, but the recursion is a weighted prefix sum. A series is
cut into sub-blocks of ``reach(a)`` rows. Inside one, a prefix window gives
``c[j] = q^j * sum(w_i x_i q^-i)`` with q = 1-a, w = 1 for the first value of the series
and a otherwise; the sub-block before adds ``q^(j+1) * c_end``. Anything older carries a
weight below 1e-20, under double rounding. No join, no extra shuffle, no Python.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.frames import KEYS, ORDER, add_row_number

_NEGLIGIBLE = 1e-20


def reach(alpha: float) -> int:
    """Rows after which an old value weighs less than 1e-20."""
    return max(2, math.ceil(math.log(_NEGLIGIBLE) / math.log1p(-alpha)))


def span_alpha(span: int) -> float:
    return 2.0 / (span + 1.0)


def prefix_means(x: np.ndarray, alpha: float, before: float | None = None) -> np.ndarray:
    """The same recursion on an array, carried on from ``before``; None: the first value seeds it.

    Works by prefix sums of ``reach(alpha)`` values at a time, so the loop runs over blocks.
    """
    out = np.empty(len(x))
    y, length = (x[0] if before is None and len(x) else before), reach(alpha)
    for lo in range(0, len(x), length):
        part = x[lo : lo + length]
        decay = (1.0 - alpha) ** np.arange(1, len(part) + 1)
        out[lo : lo + length] = decay * (y + alpha * np.cumsum(part / decay))
        y = out[lo + len(part) - 1]
    return out


def with_ewm(
    df: DataFrame,
    specs: Mapping[str, tuple[str, float, int]],
    keys: Sequence[str] = KEYS,
    order: str = ORDER,
) -> DataFrame:
    """Add columns ``{out: (column, alpha, lead)}``.

    ``lead`` is the number of leading NULL rows of the input (1 after a difference); the
    first value after them seeds the mean. Interior NULLs must be filtered out before.
    """
    df = add_row_number(df, keys, order)
    for out, (name, alpha, lead) in specs.items():
        q, length = 1.0 - alpha, reach(alpha)
        n = F.col("_n") - lead
        sub, j = f"_sub_{out}", F.col(f"_j_{out}")
        df = df.withColumn(sub, F.floor(n / length)).withColumn(f"_j_{out}", F.pmod(n, F.lit(length)))
        weight = F.when(n == 0, F.lit(1.0)).otherwise(F.lit(alpha))
        scaled = F.when(n >= 0, weight * F.col(name) * F.pow(F.lit(q), -j))
        inside = (
            Window.partitionBy(*keys, sub).orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
        )
        df = df.withColumn(f"_c_{out}", F.sum(scaled).over(inside) * F.pow(F.lit(q), j))
        before = Window.partitionBy(*keys).orderBy(sub).rangeBetween(-1, -1)
        end = F.max(F.when(j == length - 1, F.col(f"_c_{out}"))).over(before)
        carried = F.pow(F.lit(q), j + 1) * F.coalesce(end, F.lit(0.0))
        df = df.withColumn(out, F.when(n >= 0, F.col(f"_c_{out}") + carried)).drop(
            sub, f"_j_{out}", f"_c_{out}"
        )
    return df
