"""All pairs of entities without a cross join.

Each entity is put in one of ``n_blocks`` blocks by key hash and copied once per block
pair it takes part in, so the pairs meet through an equality on the block pair. Series
statistics go through ``pair_statistics``: one bounded vector per entity is copied, not one
row per pair and date, and numpy works on a block pair inside a task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_BLOCK = 256
_CHUNK_VALUES = 4_000_000


def _with_blocks(df: DataFrame, key: str, per_block: int) -> DataFrame:
    """Add ``_b`` and the number of blocks ``_nb``, sized from the distinct key count."""
    n = df.select(key).distinct().agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / per_block)).cast("int").alias("_nb")
    )
    return df.crossJoin(F.broadcast(n)).withColumn(
        "_b", F.pmod(F.xxhash64(key), F.col("_nb")).cast("int")
    )


def _cells(df: DataFrame) -> DataFrame:
    """One copy per block pair (p <= q) that holds the row's block."""
    other = F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))
    return df.withColumn("_o", other).withColumns(
        {"_p": F.least("_b", "_o"), "_q": F.greatest("_b", "_o")}
    )


def pair_join(
    df: DataFrame, key: str, columns: Sequence[str], per_block: int = PER_BLOCK
) -> DataFrame:
    """Rows (key_i, key_j, col_i..., col_j...) for key_i < key_j; one input row per key."""
    cells = _cells(_with_blocks(df.select(key, *columns), key, per_block))
    keep = ["_p", "_q", "_b"]
    left = cells.select(*keep, *[F.col(c).alias(f"{c}_i") for c in (key, *columns)])
    right = cells.select(
        *[F.col(k).alias(f"{k}r") for k in keep], *[F.col(c).alias(f"{c}_j") for c in (key, *columns)]
    )
    apart = (F.col("_p") == F.col("_q")) | (F.col("_b") != F.col("_br"))
    on = (F.col("_p") == F.col("_pr")) & (F.col("_q") == F.col("_qr"))
    return (
        left.join(right, on & apart & (F.col(f"{key}_i") < F.col(f"{key}_j")))
        .drop("_p", "_q", "_b", "_pr", "_qr", "_br")
    )


Kernel = Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray]]


def pair_statistics(
    series: DataFrame,
    kernel: Kernel,
    fields: str,
    keep: Callable[[dict[str, np.ndarray]], np.ndarray] | None = None,
    per_block: int = PER_BLOCK,
) -> DataFrame:
    """Rows (instrument_i, instrument_j, *fields) for every pair i < j.

    ``series`` has instrument, t and v, where t numbers calendar dates from 0, so one vector
    is bounded by the calendar. ``kernel(A, B)`` gets two (pairs x dates) arrays with NaN for
    no value and returns one array per field; ``keep`` drops pairs inside the task. With a
    ``side`` column only pairs across sides are formed, the smaller side first.
    """
    sided = "side" in series.columns
    who_cols = ["side", "instrument"] if sided else ["instrument"]
    vectors = series.where(F.col("v").isNotNull()).groupBy(*who_cols).agg(
        F.collect_list("t").alias("ts"), F.collect_list("v").alias("vs")
    )
    cells = _cells(_with_blocks(vectors, "instrument", per_block)).select(
        "_p", "_q", "_b", *who_cols, "ts", "vs"
    )
    names = [f.strip().split()[0] for f in fields.split(",")]

    def run(key: Any, pdf: pd.DataFrame) -> pd.DataFrame:
        p, q = key
        pdf = pdf.sort_values(who_cols, ignore_index=True)
        who = pdf["instrument"].to_numpy()
        length = 1 + max(int(np.max(t)) for t in pdf["ts"])
        x = np.full((len(pdf), length), np.nan)
        for i, (t, v) in enumerate(zip(pdf["ts"], pdf["vs"])):
            x[i, np.asarray(t, dtype=int)] = v
        ia, ib = np.triu_indices(len(pdf), 1)
        if p != q:
            blocks = pdf["_b"].to_numpy()
            cross = blocks[ia] != blocks[ib]
            ia, ib = ia[cross], ib[cross]
        if sided:
            side = pdf["side"].to_numpy()
            cross = side[ia] != side[ib]
            ia, ib = ia[cross], ib[cross]
        step = max(1, _CHUNK_VALUES // length)
        parts = []
        for s in range(0, len(ia), step):
            a, b = ia[s : s + step], ib[s : s + step]
            with np.errstate(all="ignore"):
                out = kernel(x[a], x[b])
                ok = keep(out) if keep else np.ones(len(a), dtype=bool)
            frame = {"instrument_i": who[a][ok], "instrument_j": who[b][ok]}
            frame.update({n: out[n][ok] for n in names})
            parts.append(pd.DataFrame(frame))
        if not parts:
            return pd.DataFrame(columns=["instrument_i", "instrument_j", *names])
        return pd.concat(parts, ignore_index=True)

    return cells.groupBy("_p", "_q").applyInPandas(
        run, f"instrument_i string, instrument_j string, {fields}"
    )


# ---- numpy pieces shared by the kernels -------------------------------------------------


def last_common(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Right-aligned last ``n`` columns where both have a value, and the common counts."""
    both = ~np.isnan(a) & ~np.isnan(b)
    order = np.argsort(both, axis=1, kind="stable")[:, -n:]
    a2, b2 = np.take_along_axis(a, order, 1), np.take_along_axis(b, order, 1)
    ok = np.take_along_axis(both, order, 1)
    return np.where(ok, a2, np.nan), np.where(ok, b2, np.nan), both.sum(axis=1)


def masked_pearson(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row-wise correlation over common values, and their number."""
    both = ~np.isnan(a) & ~np.isnan(b)
    n = both.sum(axis=1)
    am, bm = np.where(both, a, 0.0), np.where(both, b, 0.0)
    da = np.where(both, a - (am.sum(1) / n)[:, None], 0.0)
    db = np.where(both, b - (bm.sum(1) / n)[:, None], 0.0)
    den = np.sqrt((da * da).sum(1) * (db * db).sum(1))
    r = np.where(den > 0, (da * db).sum(1) / den, np.nan)
    return r, n


def masked_ranks(a: np.ndarray) -> np.ndarray:
    """Row-wise average-tie ranks, NaN kept."""
    return pd.DataFrame(a.T).rank().to_numpy().T


def ols(y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row-wise slope, intercept and count of y on x over common values."""
    both = ~np.isnan(y) & ~np.isnan(x)
    n = both.sum(axis=1)
    mx = np.where(both, x, 0.0).sum(1) / n
    my = np.where(both, y, 0.0).sum(1) / n
    dx = np.where(both, x - mx[:, None], 0.0)
    dy = np.where(both, y - my[:, None], 0.0)
    sxx = (dx * dx).sum(1)
    slope = np.where(sxx > 0, (dx * dy).sum(1) / sxx, np.nan)
    return slope, my - slope * mx, n
