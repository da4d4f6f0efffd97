"""Cleaning and row-level quality of bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.frames import KEYS, ORDER, prior, series
from tickloom.functions.ranks import quantiles

PRICES = ("open", "high", "low", "close")


def resolve_adjusted_close(df: DataFrame) -> DataFrame:
    """``close_adj`` from adj_close, else adjusted_close, else close."""
    for name in ("adj_close", "adjusted_close", "close"):
        if name in df.columns:
            return df.withColumn("close_adj", F.col(name))
    raise ValueError("no close column")


def standard_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def repair_ohlc(df: DataFrame) -> DataFrame:
    """Widen high/low to hold open and close, clip negative volume, drop empty rows."""
    return df.dropna("all", subset=[*PRICES, "volume"]).withColumns(
        {
            "high": F.greatest("high", "open", "close"),
            "low": F.least("low", "open", "close"),
            "volume": F.when(F.col("volume") < 0, F.lit(0)).otherwise(F.col("volume")).cast("long"),
        }
    )


def threshold_filter(df: DataFrame, min_volume: float, min_price: float) -> DataFrame:
    if min_volume > 0:
        df = df.where(F.col("volume") >= min_volume)
    if min_price > 0:
        for c in PRICES:
            df = df.where(F.col(c) >= min_price)
    return df


def sufficient_history(df: DataFrame, min_rows: int = 100) -> DataFrame:
    """Instruments with enough rows: counts combine map-side, then a semi join."""
    enough = df.groupBy("instrument").count().where(F.col("count") >= min_rows)
    return df.join(enough, "instrument", "left_semi")


def winsorise(
    df: DataFrame,
    columns: Sequence[str] = (*PRICES, "volume"),
    low: float = 0.01,
    high: float = 0.99,
    min_rows: int = 10,
) -> DataFrame:
    """Clip every column to its instrument's quantiles if it has more than ``min_rows`` rows.

    The columns share one quantile pass in long form; no instrument is sorted in one task.
    """
    keep = [c for c in df.columns if c not in columns]
    long = df.select("instrument", *[F.col(c).cast("double") for c in columns]).unpivot(
        ["instrument"], list(columns), "_col", "_x"
    )
    edges = quantiles(long, ["instrument", "_col"], "_x", [low, high], ["_lo", "_hi"])
    limits = edges.groupBy("instrument").agg(
        *[F.max(F.when(F.col("_col") == c, F.col(s))).alias(f"{s}_{c}") for c in columns for s in ("_lo", "_hi")]
    )
    rows = df.groupBy("instrument").agg(F.count(F.lit(1)).alias("_rows"))
    joined = df.join(rows, "instrument").join(limits, "instrument", "left")
    clipped = [
        F.when(
            (F.col("_rows") > min_rows) & F.col(c).isNotNull(),
            F.least(F.greatest(F.col(c).cast("double"), F.col(f"_lo_{c}")), F.col(f"_hi_{c}")),
        )
        .otherwise(F.col(c).cast("double"))
        .alias(c)
        for c in columns
    ]
    return joined.select(*keep, *clipped)


def align_calendar(df: DataFrame, keys=KEYS, order=ORDER) -> DataFrame:
    """Rows with complete prices, volume carried forward from the instrument's earlier rows.

    Filling a date x instrument grid and dropping rows without prices gives the same rows
    without building the grid.
    """
    w = series(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("volume", F.last("volume", ignorenulls=True).over(w)).dropna(
        "any", subset=list(PRICES)
    )


def as_of_time(df: DataFrame, order: str = ORDER) -> DataFrame:
    return df.withColumn("as_of_time", F.col(order))


def row_quality_score(df: DataFrame, keys=KEYS, order=ORDER) -> DataFrame:
    """100 less half the missing-volume percent, less 2 per move over 50 % of the instrument."""
    missing = df.agg(
        (100 - 50 * F.avg(F.col("volume").isNull().cast("double"))).alias("_base")
    )
    move = F.abs(F.try_divide(F.col("close_adj"), prior(F.col("close_adj"), 1, keys, order)) - 1)
    moves = (
        df.withColumn("_m", move)
        .groupBy("instrument")
        .agg(F.sum(F.when(F.col("_m") > 0.5, 2.0).otherwise(0.0)).alias("_penalty"))
    )
    score = F.greatest(F.least(F.col("_base") - F.col("_penalty"), F.lit(100.0)), F.lit(0.0))
    return (
        df.join(moves, "instrument", "left")
        .crossJoin(F.broadcast(missing))
        .withColumn("data_quality_score", score)
        .drop("_base", "_penalty")
    )


OHLC_RULES = {
    "high < low": "high < low",
    "high < open": "high < open",
    "high < close": "high < close",
    "low > open": "low > open",
    "low > close": "low > close",
    "negative volume": "volume < 0",
    "open <= 0": "open <= 0",
    "high <= 0": "high <= 0",
    "low <= 0": "low <= 0",
    "close <= 0": "close <= 0",
    "close_adj <= 0": "close_adj <= 0",
}


def ohlc_violations(df: DataFrame) -> DataFrame:
    """Rows breaking each rule, counted in one pass, as (rule, n)."""
    names = list(OHLC_RULES)
    one = df.agg(*[F.count_if(F.expr(e)).alias(n) for n, e in OHLC_RULES.items()])
    return one.unpivot([], [F.col(f"`{n}`") for n in names], "rule", "n")
