"""Regime labels, calendar features and event proxies per instrument."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.frames import KEYS, ORDER, add_row_number, last_rows, prior, series
from tickloom.functions.ranks import quantiles

N_REGIMES = 4
MAX_DAYS_SINCE_EVENT = 90
TREND_THRESHOLD = 0.02


def quantile_regimes(df: DataFrame, feature: str, n_regimes: int = N_REGIMES) -> DataFrame:
    """Regime by quantile of one feature per instrument."""
    probs = [i / n_regimes for i in range(1, n_regimes)]
    names = [f"_q{i}" for i in range(len(probs))]
    edges = quantiles(df, ["instrument"], feature, probs, names)
    reached = F.lit(0)
    for name in names:
        reached = reached + F.when(F.col(feature) >= F.col(name), 1).otherwise(0)
    label = F.greatest(reached - 1, F.lit(0)).cast("int")
    return (
        df.join(edges, "instrument", "left")
        .withColumn("regime_raw", F.when(F.col(feature).isNotNull(), label))
        .drop(*names)
    )


def majority_filter(df: DataFrame, window: int = 3, column: str = "regime_raw", keys=KEYS, order=ORDER) -> DataFrame:
    """Most frequent label of the centred frame, the smallest on ties."""
    half = window // 2
    w = series(keys, order).rowsBetween(-half, half)
    return df.withColumn("regime_id", F.mode(column, True).over(w))


def regime_flags(df: DataFrame, n_regimes: int = N_REGIMES) -> DataFrame:
    return df.withColumns(
        {
            f"regime_{k}": F.coalesce((F.col("regime_id") == k).cast("int"), F.lit(0))
            for k in range(n_regimes)
        }
    )


def regime_persistence(df: DataFrame, keys=KEYS, order=ORDER) -> DataFrame:
    """Rows since the last change, and the running count of the label."""
    w = series(keys, order)
    change = (~F.col("regime_id").eqNullSafe(F.lag("regime_id").over(w))).cast("int")
    df = df.withColumn("_run", F.sum(change).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(*keys, "_run").orderBy(order)
    label = Window.partitionBy(*keys, "regime_id").orderBy(order)
    return df.withColumns(
        {
            "regime_persistence": F.row_number().over(run),
            "regime_occurrences": F.row_number().over(label),
        }
    ).drop("_run")


def calendar_encodings(df: DataFrame, date: str = "date") -> DataFrame:
    tau = 2 * math.pi
    d = F.col(date)
    dow, month, quarter = F.weekday(d), F.month(d), F.quarter(d)
    return df.withColumns(
        {
            "day_of_week": dow,
            "dow_sin": F.sin(tau * dow / 7),
            "dow_cos": F.cos(tau * dow / 7),
            "is_monday": (dow == 0).cast("int"),
            "is_friday": (dow == 4).cast("int"),
            "month_of_year": month,
            "month_sin": F.sin(tau * month / 12),
            "month_cos": F.cos(tau * month / 12),
            "is_january": (month == 1).cast("int"),
            "quarter": quarter,
            "quarter_sin": F.sin(tau * quarter / 4),
            "quarter_cos": F.cos(tau * quarter / 4),
        }
    )


def _turn_flag(df: DataFrame, unit: str, n: int, name: str) -> DataFrame:
    """First and last ``n`` distinct dates of each period with at least 2n dates."""
    dates = df.select("date").distinct().withColumn("_p", F.date_trunc(unit, "date"))
    up = Window.partitionBy("_p").orderBy("date")
    down = Window.partitionBy("_p").orderBy(F.desc("date"))
    near = (F.row_number().over(up) <= n) | (F.row_number().over(down) <= n)
    enough = F.count(F.lit(1)).over(Window.partitionBy("_p")) >= 2 * n
    flags = dates.select("date", (near & enough).cast("int").alias(name))
    return df.join(flags, "date")


def turn_of_month(df: DataFrame, n: int = 3) -> DataFrame:
    return _turn_flag(df, "month", n, "turn_of_month")


def turn_of_quarter(df: DataFrame, n: int = 5) -> DataFrame:
    return _turn_flag(df, "quarter", n, "turn_of_quarter")


def holiday_effects(df: DataFrame, date: str = "date") -> DataFrame:
    d = F.col(date)
    month_end = d == F.last_day(d)
    return df.withColumns(
        {
            "new_year_effect": ((F.month(d) == 1) & (F.dayofmonth(d) <= 10)).cast("int"),
            "year_end_effect": ((F.month(d) == 12) & (F.dayofmonth(d) >= 20)).cast("int"),
            "quarter_end": (month_end & (F.month(d) % 3 == 0)).cast("int"),
            "month_end": month_end.cast("int"),
        }
    )


def earnings_season(df: DataFrame, date: str = "date") -> DataFrame:
    d = F.col(date)
    hit = F.month(d).isin(1, 4, 7, 10) & F.dayofmonth(d).between(15, 29)
    return df.withColumn("potential_earnings_period", hit.cast("int"))


def high_volatility_event(df: DataFrame, feature: str = "vol_cc_20d", q: float = 0.9) -> DataFrame:
    """Above the quantile over all rows: a one-row table, joined without keys."""
    edge = quantiles(df, [], feature, [q], ["_edge"])
    hit = F.coalesce((F.col(feature) > F.col("_edge")).cast("int"), F.lit(0))
    return df.crossJoin(F.broadcast(edge)).withColumn("high_vol_event", hit).drop("_edge")


def high_volume_event(df: DataFrame, n: int = 20, q: float = 0.9, keys=KEYS, order=ORDER) -> DataFrame:
    w = last_rows(n, keys, order)
    edge = F.when(
        F.count("dollar_volume").over(w) == n, F.percentile("dollar_volume", F.lit(q)).over(w)
    )
    hit = F.coalesce((F.col("dollar_volume") > edge).cast("int"), F.lit(0))
    return df.withColumn("high_volume_event", hit)


def rows_since_event(
    df: DataFrame, flag: str, out: str, cap: int = MAX_DAYS_SINCE_EVENT, keys=KEYS, order=ORDER
) -> DataFrame:
    """Rows since the flag was last 1, at most ``cap``; the frame needs ``cap`` rows only."""
    df = add_row_number(df, keys, order)
    w = series(keys, order).rowsBetween(-cap, 0)
    at = F.max(F.when(F.col(flag) == 1, F.col("_n"))).over(w)
    return df.withColumn(out, F.coalesce(F.col("_n") - at, F.lit(cap)).cast("int"))


def rolling_percent_rank(df: DataFrame, feature: str, windows: Sequence[int] = (60, 126, 252), keys=KEYS, order=ORDER) -> DataFrame:
    """Average-tie rank of the row among its last n values, divided by n."""
    out = {}
    x = F.col(feature)
    for n in windows:
        w = last_rows(n, keys, order)
        held = F.collect_list(feature).over(w)
        score = F.aggregate(
            held,
            F.lit(0.5),
            lambda acc, v: acc + F.when(v < x, 1.0).when(v == x, 0.5).otherwise(0.0),
        )
        out[f"vol_regime_{n}d"] = F.when(F.size(held) == n, score / n)
    return df.withColumns(out)


def volatility_class(df: DataFrame, column: str) -> DataFrame:
    x = F.col(column)
    label = (
        F.when((x >= 0) & (x <= 0.33), "low_vol")
        .when((x > 0.33) & (x <= 0.66), "med_vol")
        .when((x > 0.66) & (x <= 1.0), "high_vol")
    )
    return df.withColumn(f"{column}_class", label)


def changed_flag(df: DataFrame, column: str, out: str, keys=KEYS, order=ORDER) -> DataFrame:
    """1 when the value differs from the row before; the first row counts as changed."""
    w = series(keys, order)
    first = F.row_number().over(w) == 1
    same = F.col(column).eqNullSafe(F.lag(column).over(w))
    return df.withColumn(out, F.when(first, 1).otherwise((~same).cast("int")))


def trend_class(df: DataFrame, column: str = "return_21d", limit: float = TREND_THRESHOLD) -> DataFrame:
    x = F.col(column)
    label = F.when(x <= -limit, "downtrend").when(x <= limit, "sideways").when(x > limit, "uptrend")
    return df.withColumn("trend_regime", label)


def fill_both_ways(df: DataFrame, columns: Sequence[str], keys=KEYS, order=ORDER) -> DataFrame:
    """Forward, then backward fill within a series."""
    w = series(keys, order)
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    return df.withColumns(
        {
            c: F.coalesce(
                F.last(c, ignorenulls=True).over(back), F.first(c, ignorenulls=True).over(ahead)
            )
            for c in columns
        }
    )


# points per event kind: fixed values
EVENT_WEIGHTS = {"earnings": 3, "8k": 2, "10k": 2, "10q": 2, "insider": 1, "dividend": 2, "split": 2}


def event_intensity(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Weighted sum of event flags; the first matching kind in the name sets the weight."""
    score = F.lit(0)
    for c in flags:
        weight = next((w for kind, w in EVENT_WEIGHTS.items() if kind in c.lower()), 0)
        score = score + F.coalesce(F.col(c).cast("int"), F.lit(0)) * weight
    return df.withColumn("corporate_event_intensity", score)
