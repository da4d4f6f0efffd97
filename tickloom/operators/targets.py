"""Forward-looking labels and market context."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.frames import KEYS, ORDER, last_rows, next_rows, prior, roll_std, series
from tickloom.functions.ranks import quantiles

HORIZONS = (1, 5, 10, 21)
VOL_HORIZONS = (5, 10, 21)


def forward_returns(df: DataFrame, horizons: Sequence[int] = HORIZONS, keys=KEYS, order=ORDER) -> DataFrame:
    w = series(keys, order)
    return df.withColumns(
        {f"target_return_{h}d": F.try_divide(F.lead("close_adj", h).over(w), F.col("close_adj")) - 1 for h in horizons}
    )


def forward_volatility(df: DataFrame, horizons: Sequence[int] = VOL_HORIZONS, keys=KEYS, order=ORDER) -> DataFrame:
    """Deviation of the next h log returns, annualised; NULL with fewer than h left."""
    out = {}
    for h in horizons:
        w = next_rows(h, keys, order)
        out[f"target_volatility_{h}d"] = F.when(
            F.count("log_return").over(w) == h, F.stddev_samp("log_return").over(w) * math.sqrt(252)
        )
    return df.withColumns(out)


def direction_labels(df: DataFrame, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    return df.withColumns({f"target_direction_{h}d": F.signum(f"target_return_{h}d") for h in horizons})


def quantile_labels(
    df: DataFrame, horizons: Sequence[int] = HORIZONS, low: float = 0.3, high: float = 0.7
) -> DataFrame:
    """-1, 0 or 1 by the instrument's own quantiles; 0 where the return is unknown."""
    cols = [f"target_return_{h}d" for h in horizons]
    long = df.select("instrument", *cols).unpivot(["instrument"], cols, "_t", "_x")
    edges = quantiles(long, ["instrument", "_t"], "_x", [low, high], ["_lo", "_hi"])
    wide = edges.groupBy("instrument").agg(
        *[F.max(F.when(F.col("_t") == c, F.col(s))).alias(f"{s}_{c}") for c in cols for s in ("_lo", "_hi")]
    )
    out = {
        c.replace("return", "class"): F.when(F.col(c) <= F.col(f"_lo_{c}"), -1)
        .when(F.col(c) >= F.col(f"_hi_{c}"), 1)
        .otherwise(0)
        for c in cols
    }
    return (
        df.join(wide, "instrument", "left")
        .withColumns(out)
        .drop(*[f"{s}_{c}" for c in cols for s in ("_lo", "_hi")])
    )


def next_level(df: DataFrame, column: str = "close", h: int = 1, keys=KEYS, order=ORDER) -> DataFrame:
    return df.withColumn("target", F.lead(column, h).over(series(keys, order))).where("target IS NOT NULL")


def market_context(df: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Log return and 20-row deviation of each benchmark symbol, joined by date.

    The context holds one row per date; AQE decides whether it is broadcast.
    """
    bench = df.where(F.col("instrument").isin(list(symbols))).select("instrument", "date", "close_adj")
    bench = bench.withColumn("_r", F.log(F.try_divide(F.col("close_adj"), prior(F.col("close_adj")))))
    bench = bench.withColumn("_v", roll_std(F.col("_r"), 20))
    aggs = []
    for s in symbols:
        hit = F.col("instrument") == s
        aggs += [
            F.max(F.when(hit, F.col("_r"))).alias(f"{s}_return"),
            F.max(F.when(hit, F.col("_v"))).alias(f"{s}_vol"),
        ]
    return df.join(bench.groupBy("date").agg(*aggs), "date", "left")


def excursions(df: DataFrame, h: int = 10, high_rows: int = 20, keys=KEYS, order=ORDER) -> DataFrame:
    """Worst and best excursion within h rows, and whether a breakout continued."""
    ahead = next_rows(h, keys, order)
    c = F.col("close_adj")
    before = series(keys, order).rowsBetween(-high_rows, -1)
    prior_high = F.when(F.count("close_adj").over(before) == high_rows, F.max("close_adj").over(before))
    future = F.lead("close_adj", h).over(series(keys, order))
    full = F.count("close_adj").over(ahead) == h
    return df.withColumns(
        {
            "max_adverse_excursion": F.when(full, F.try_divide(F.min("low").over(ahead), c) - 1),
            "max_favorable_excursion": F.when(full, F.try_divide(F.max("high").over(ahead), c) - 1),
            "breakout_continuation": F.when(
                future.isNotNull() & prior_high.isNotNull(), ((c > prior_high) & (future > c)).cast("int")
            ),
        }
    )


def volatility_classes(df: DataFrame, column: str = "target_volatility_21d") -> DataFrame:
    """Low, medium or high third of the forward volatility per instrument."""
    edges = quantiles(df, ["instrument"], column, [1 / 3, 2 / 3], ["_lo", "_hi"])
    x = F.col(column)
    label = F.when(x <= F.col("_lo"), "low").when(x <= F.col("_hi"), "med").when(x > F.col("_hi"), "high")
    return df.join(edges, "instrument", "left").withColumn("forward_vol_class", label).drop("_lo", "_hi")
