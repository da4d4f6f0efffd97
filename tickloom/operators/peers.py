"""Features of a target against its peers.

``peers`` is a table (target, peer[, weight]). Rolling frames run over the calendar index
``t`` (a date without a value leaves the frame short, as in a date-indexed matrix), so a
frame is a range of ``t`` and no date x instrument grid is built. Everything stays long.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.ranks import quantiles
from tickloom.operators.select import thin_dates_by_count

MOMENTUM_WINDOWS = (5, 10, 20)
SPREAD_WINDOWS = (10, 20, 60)
REVERSION_WINDOWS = (5, 10, 20)
BASKET_WINDOWS = (5, 10, 20)


def calendar(df: DataFrame, value: str = "log_return", min_count: int = 2) -> DataFrame:
    """Rows on dates with enough instruments, with the date's index ``t``."""
    kept = thin_dates_by_count(df, value, min_count)
    dates = kept.select("date").distinct().withColumn("t", F.row_number().over(Window.orderBy("date")) - 1)
    return kept.join(dates, "date")


def _span(n: int, *keys: str):
    return Window.partitionBy(*keys).orderBy("t").rangeBetween(-(n - 1), 0)


def _full(x: Column, value: Column, n: int, *keys: str) -> Column:
    w = _span(n, *keys)
    return F.when(F.count(x).over(w) == n, value.over(w))


def pair_rows(df: DataFrame, peers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every target row once per peer, the peer's columns NULL where it has no row that date.

    The peer table is small next to the bars; AQE broadcasts it when its size allows.
    """
    mine = df.select(F.col("instrument").alias("target"), "date", "t", *[F.col(c).alias(f"{c}_t") for c in columns])
    theirs = df.select(F.col("instrument").alias("peer"), "t", *[F.col(c).alias(f"{c}_p") for c in columns])
    return mine.join(peers, "target").join(theirs, ["peer", "t"], "left")


def momentum_gaps(df: DataFrame, peers: DataFrame, windows: Sequence[int] = MOMENTUM_WINDOWS) -> DataFrame:
    """Long (target, peer, date, window, peer_momentum, target_momentum, relative_momentum)."""
    cols = {f"_m{n}": _full(F.col("log_return"), F.sum("log_return"), n, "instrument") for n in windows}
    moved = df.withColumns(cols)
    pairs = pair_rows(moved, peers, list(cols))
    per = F.array(
        *[
            F.struct(
                F.lit(n).alias("window"),
                F.col(f"_m{n}_p").alias("peer_momentum"),
                F.col(f"_m{n}_t").alias("target_momentum"),
            )
            for n in windows
        ]
    )
    return pairs.select("target", "peer", "date", F.inline(per)).withColumn(
        "relative_momentum", F.col("peer_momentum") - F.col("target_momentum")
    )


def average_peer_momentum(gaps: DataFrame) -> DataFrame:
    """Mean peer momentum per target, date and window; NULL if any peer has none."""
    all_held = F.count("peer_momentum") == F.count(F.lit(1))
    return (
        gaps.groupBy("target", "date", "window")
        .agg(
            F.when(all_held, F.avg("peer_momentum")).alias("avg_peer_momentum"),
            F.first("target_momentum").alias("_t"),
        )
        .withColumn("momentum_vs_peers", F.col("_t") - F.col("avg_peer_momentum"))
        .drop("_t")
    )


def spreads(df: DataFrame, peers: DataFrame, windows: Sequence[int] = SPREAD_WINDOWS) -> DataFrame:
    """Wide per pair and date: log-price spread, its z-scores and momentum."""
    logs = df.withColumn("_lp", F.log("close_adj"))
    s = F.col("spread")
    pairs = pair_rows(logs, peers, ["_lp"]).withColumn("spread", F.col("_lp_t") - F.col("_lp_p"))
    keys = ("target", "peer")
    out = {}
    for n in windows:
        mean = _full(s, F.avg(s), n, *keys)
        std = _full(s, F.stddev_samp(s), n, *keys)
        out[f"spread_zscore_{n}d"] = (s - mean) / (std + 1e-8)
        out[f"spread_momentum_{n}d"] = _full(s, F.avg(s), 5, *keys) - mean
    return pairs.withColumns(out).select("target", "peer", "date", "t", "spread", *out)


def _against_peers(df: DataFrame, peers: DataFrame) -> DataFrame:
    """Per target and date: own return, percent rank among target and peers, peer median and mean."""
    r, p = F.col("log_return_t"), F.col("log_return_p")
    pairs = pair_rows(df, peers, ["log_return"])
    n = F.count("log_return_p") + 1
    rank = F.count_if(p < r) + (F.count_if(p == r) + 2) / 2
    return pairs.groupBy("target", "date", "t").agg(
        F.first("log_return_t").alias("ret"),
        F.when(F.first("log_return_t").isNotNull(), rank / n).alias("pct_rank"),
        F.percentile("log_return_p", F.lit(0.5)).alias("peer_median"),
        F.avg("log_return_p").alias("basket"),
    )


def mean_reversion(df: DataFrame, peers: DataFrame, windows: Sequence[int] = REVERSION_WINDOWS) -> DataFrame:
    base = _against_peers(df, peers)
    dev = F.col("ret") - F.col("peer_median")
    out = {}
    for n in windows:
        out[f"return_rank_{n}d"] = _full(F.col("pct_rank"), F.avg("pct_rank"), n, "target")
        out[f"deviation_from_peers_{n}d"] = _full(dev, F.avg(dev), n, "target")
        out[f"mean_reversion_{n}d"] = _full(F.col("peer_median"), F.sum("peer_median"), n, "target") - _full(
            F.col("ret"), F.sum("ret"), n, "target"
        )
    return base.withColumns(out).select("target", "date", *out)


def basket_features(df: DataFrame, peers: DataFrame, windows: Sequence[int] = BASKET_WINDOWS) -> DataFrame:
    base = _against_peers(df, peers)
    r, b = F.col("ret"), F.col("basket")
    both = F.when(r.isNotNull() & b.isNotNull(), r)
    out = {}
    for n in windows:
        out[f"vs_basket_momentum_{n}d"] = _full(r, F.sum(r), n, "target") - _full(b, F.sum(b), n, "target")
        out[f"vol_vs_basket_{n}d"] = _full(r, F.stddev_samp(r), n, "target") / (
            _full(b, F.stddev_samp(b), n, "target") + 1e-8
        )
        out[f"beta_to_basket_{n}d"] = _full(both, F.covar_samp(r, b), n, "target") / (
            _full(b, F.var_samp(b), n, "target") + 1e-8
        )
    return base.withColumns(out).select("target", "date", *out)


def lagged_peer_signals(df: DataFrame, links: DataFrame) -> DataFrame:
    """Peer return ``lag`` calendar rows before the target's date; links: target, peer, lag."""
    mine = df.select(F.col("instrument").alias("target"), "date", "t")
    theirs = df.select(F.col("instrument").alias("peer"), F.col("t").alias("_tp"), F.col("log_return").alias("signal"))
    wanted = mine.join(links.select("target", "peer", "lag"), "target").withColumn("_tp", F.col("t") - F.col("lag"))
    return wanted.join(theirs, ["peer", "_tp"], "left").select("target", "peer", "lag", "date", "t", "signal")


def positive_signal_count(signals: DataFrame, threshold: float, n: int = 20) -> DataFrame:
    """Positive lead signals above a threshold within the last ``n`` rows of each link."""
    w = _span(n, "target", "peer")
    hit = F.sum(F.when(F.col("signal") > threshold, 1).otherwise(0)).over(w)
    return signals.withColumn("positive_signals", hit.cast("int"))


def merge_target_features(df: DataFrame, features: DataFrame) -> DataFrame:
    """Left join by instrument and date: only target rows get values."""
    return df.join(features.withColumnRenamed("target", "instrument"), ["instrument", "date"], "left")


def clean_features(df: DataFrame, features: Sequence[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Clip every feature at its quantiles over all rows, then carry values forward per target."""
    keep = [c for c in df.columns if c not in features]
    long = df.unpivot(keep, list(features), "feature", "value")
    edges = quantiles(long, ["feature"], "value", [low, high], ["_lo", "_hi"])
    clipped = long.join(edges, "feature", "left").withColumn(
        "value",
        F.when(F.col("value").isNotNull(), F.least(F.greatest("value", "_lo"), F.col("_hi"))),
    )
    w = Window.partitionBy("target", "feature").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return clipped.withColumn("value", F.last("value", ignorenulls=True).over(w)).drop("_lo", "_hi")


def weighted_peer_aggregates(df: DataFrame, peers: DataFrame) -> DataFrame:
    """Weighted peer return, relative strength, volatility ratio and EMA gap (peers: weight)."""
    w = F.col("weight")
    pairs = pair_rows(df, peers, ["log_return", "vol_cc_20d", "ema_12"])

    def mean(c: str) -> Column:
        held = F.col(f"{c}_p").isNotNull()
        return F.try_divide(F.sum(F.when(held, w * F.col(f"{c}_p"))), F.sum(F.when(held, w)))

    agg = pairs.groupBy("target", "date").agg(
        mean("log_return").alias("peer_return"),
        (F.first("log_return_t") - mean("log_return")).alias("relative_strength"),
        F.try_divide(F.first("vol_cc_20d_t"), mean("vol_cc_20d")).alias("peer_vol_ratio"),
        (F.first("ema_12_t") - mean("ema_12")).alias("momentum_gap"),
    )
    return agg
