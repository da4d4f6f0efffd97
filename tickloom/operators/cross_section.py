"""Features across instruments: benchmark, beta, ranks, universe."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.frames import KEYS, ORDER, last_rows, roll_std, row_mean, series
from tickloom.functions.ranks import ROWS_PER_BUCKET, quantiles_of, ranked_rows
from tickloom.operators.technical import TRADING_DAYS

BETA_WINDOWS = (30, 60, 126, 252)
MIN_OBSERVATIONS = 20
RANK_FEATURES = ("return_21d", "return_63d", "return_126d", "vol_cc_20d", "vol_cc_60d")


def market_return(df: DataFrame) -> DataFrame:
    """Equal-weight mean log return per date; map-side combined, so no date is hot."""
    return df.groupBy("date").agg(
        F.coalesce(F.avg("log_return"), F.lit(0.0)).alias("benchmark_return")
    )


def single_benchmark(df: DataFrame, window: int = 5, factor: float = 0.8, keys=KEYS, order=ORDER) -> DataFrame:
    """Stand-in benchmark of a single series: damped rolling mean of its own return."""
    w = last_rows(window, keys, order)
    mean = F.when(F.count("log_return").over(w) == window, F.avg("log_return").over(w))
    return df.withColumn("benchmark_return", F.coalesce(mean, F.lit(0.0)) * factor)


def join_benchmark(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Left join by date. The benchmark has one row per date; AQE broadcasts it if small."""
    return df.join(benchmark.select("date", "benchmark_return"), "date", "left")


def _pairs(order_cols: tuple[str, str]) -> tuple[Column, Column]:
    y, x = F.col(order_cols[0]), F.col(order_cols[1])
    both = y.isNotNull() & x.isNotNull()
    return F.when(both, y), F.when(both, x)


def _min_obs(window: int) -> int:
    return max(MIN_OBSERVATIONS, window // 3)


def beta_alpha(df: DataFrame, windows: Sequence[int] = BETA_WINDOWS, keys=KEYS, order=ORDER) -> DataFrame:
    """Rolling beta and alpha; partial windows count once enough pairs exist."""
    y, x = _pairs(("log_return", "benchmark_return"))
    out = {}
    for n in windows:
        w = last_rows(n, keys, order)
        var = F.var_samp(x).over(w)
        ok = (F.count(x).over(w) >= _min_obs(n)) & (var > 1e-10)
        out[f"beta_{n}d"] = F.when(ok, F.covar_samp(x, y).over(w) / var)
    df = df.withColumns(out)
    return df.withColumns(
        {
            f"alpha_{n}d": F.col("log_return") - F.col(f"beta_{n}d") * F.col("benchmark_return")
            for n in windows
        }
    )


def idiosyncratic_volatility(df: DataFrame, windows=BETA_WINDOWS, keys=KEYS, order=ORDER) -> DataFrame:
    return df.withColumns(
        {
            f"idio_vol_{n}d": roll_std(F.col(f"alpha_{n}d"), n, keys, order) * math.sqrt(TRADING_DAYS)
            for n in windows
        }
    )


def r_squared(df: DataFrame, windows=BETA_WINDOWS, keys=KEYS, order=ORDER) -> DataFrame:
    y, x = _pairs(("log_return", "benchmark_return"))
    out = {}
    for n in windows:
        w = last_rows(n, keys, order)
        spread = (F.var_samp(x).over(w) > 0) & (F.var_samp(y).over(w) > 0)
        ok = (F.count(x).over(w) >= _min_obs(n)) & spread
        out[f"r_squared_{n}d"] = F.when(ok, F.regr_r2(y, x).over(w))
    return df.withColumns(out)


MEASURES = ("rank", "pct_rank", "zscore", "decile")


def cross_ranks(
    df: DataFrame,
    features: Sequence[str] = RANK_FEATURES,
    measures: Sequence[str] = MEASURES,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Long table (instrument, date, feature, value, *measures).

    All features share one pass. Ranks come from one shuffle and sort of the rows; decile edges, means and deviations have one
    row per feature and date, which the calendar bounds, and are broadcast.
    """
    long = df.unpivot(["instrument", "date"], list(features), "feature", "value").where(
        F.col("value").isNotNull()
    )
    group = ["feature", "date"]
    table = ranked_rows(long, group, "value", rows_per_bucket)
    rank = F.col("_below") + (F.col("_upto") - F.col("_below") + 1) / 2.0
    out = {"rank": rank, "pct_rank": rank / F.col("_size")}
    if "decile" in measures:
        names = [f"_e{i}" for i in range(1, 10)]
        counted = table.withColumn("_c", F.col("_upto") - F.col("_below"))
        edges = quantiles_of(counted, group, "value", [i / 10 for i in range(1, 10)], names)
        table = table.join(F.broadcast(edges), group)
        bins = F.lit(1)
        for e in names:
            bins = bins + F.when(F.col("value") > F.col(e), 1).otherwise(0)
        out["decile"] = bins.cast("int")
    if "zscore" in measures:
        stats = long.groupBy(*group).agg(
            F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s")
        )
        table = table.join(F.broadcast(stats), group)
        out["zscore"] = (F.col("value") - F.col("_m")) / (F.col("_s") + 1e-10)
    return table.select(*group, "value", "instrument", *[out[m].alias(m) for m in measures])


def widen(long: DataFrame, features: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """Back to one row per (instrument, date): columns ``{feature}_{suffix}``."""
    aggs = [
        F.max(F.when(F.col("feature") == f, F.col(m))).alias(f"{f}_{suffix}")
        for f in features
        for m, suffix in measures.items()
    ]
    return long.groupBy("instrument", "date").agg(*aggs)


def composite_ranks(wide: DataFrame, features: Sequence[str] = RANK_FEATURES) -> DataFrame:
    """Mean return rank; quality as mean of inverted volatility ranks (NULL if any is)."""
    momentum = [F.col(f"{f}_rank") for f in features if "return" in f]
    quality = [
        1.0 - F.col(f"{f}_rank") if "vol" in f else F.col(f"{f}_rank")
        for f in features
        if "vol_cc" in f or "alpha" in f
    ]
    total = quality[0]
    for q in quality[1:]:
        total = total + q
    return wide.withColumns(
        {
            "momentum_composite_rank": row_mean(momentum),
            "quality_composite_rank": total / len(quality),
        }
    )


def universe_flags(
    df: DataFrame,
    min_price: float = 1.0,
    min_volume: float = 100_000.0,
    min_days: int = 15,
    keys=KEYS,
    order=ORDER,
) -> DataFrame:
    traded = F.count("close_adj").over(last_rows(21, keys, order))
    return df.withColumns(
        {
            "universe_price_filter": F.col("close_adj") >= min_price,
            "universe_volume_filter": F.col("volume") * F.col("close_adj") >= min_volume,
            "trading_days_21d": traded,
        }
    ).withColumn("universe_activity_filter", F.col("trading_days_21d") >= min_days).withColumn(
        "in_universe",
        F.col("universe_price_filter")
        & F.col("universe_volume_filter")
        & F.col("universe_activity_filter"),
    )


def universe_size(df: DataFrame) -> DataFrame:
    sizes = df.groupBy("date").agg(
        F.sum(F.col("in_universe").cast("int")).cast("long").alias("universe_size")
    )
    return df.join(sizes, "date", "left")
