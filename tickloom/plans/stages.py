"""Named stages: DataFrame -> DataFrame steps a user can add to and chain.

A stage declares the columns it needs. Between stages the result is written to a table in the
shared folder, because a stage reads its input several times (ranks, quantiles, benchmark) and
chained reads would multiply.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import cross_section as x
from tickloom.operators import hygiene as h
from tickloom.operators import models as ml
from tickloom.operators import news as nw
from tickloom.operators import peers as pe
from tickloom.operators import relationships as rel
from tickloom.operators import season as z
from tickloom.operators import targets as tg
from tickloom.operators import technical as t
from tickloom.session import materialise


@dataclass(frozen=True)
class Stage:
    name: str
    needs: tuple[str, ...]
    run: Callable[..., DataFrame]


STAGES: dict[str, Stage] = {}
_BARS = ("instrument", "date", "open", "high", "low", "close", "volume")


def stage(name: str, needs: Sequence[str]):
    """Register ``fn(df, **options) -> DataFrame`` under a name."""

    def wrap(fn: Callable[..., DataFrame]):
        STAGES[name] = Stage(name, tuple(needs), fn)
        return fn

    return wrap


def missing_columns(df: DataFrame, name: str) -> list[str]:
    return [c for c in STAGES[name].needs if c not in df.columns]


def run_stage(df: DataFrame, name: str, **options) -> DataFrame:
    if name not in STAGES:
        raise ValueError(f"unknown stage {name}; known: {sorted(STAGES)}")
    gone = missing_columns(df, name)
    if gone:
        raise ValueError(f"stage {name} needs columns {gone}")
    return STAGES[name].run(df, **options)


def run_stages(
    df: DataFrame, names: Sequence[str], options: dict[str, dict] | None = None, tables: bool = True
) -> DataFrame:
    """Chain stages; ``tables=False`` keeps one lazy plan, which suits short chains."""
    for name in names:
        if tables:
            df = materialise(df, f"before-{name}")
        df = df.transform(lambda d, n=name: run_stage(d, n, **(options or {}).get(n, {})))
    return df


@stage("hygiene", _BARS)
def hygiene(df: DataFrame, min_volume: float = 0.0, min_price: float = 0.0) -> DataFrame:
    """Adjusted close, winsorised bars, thresholds, calendar, as-of time and quality score."""
    df = materialise(h.winsorise(h.resolve_adjusted_close(df)), "winsorised")
    df = h.align_calendar(h.threshold_filter(df, min_volume, min_price))
    return h.row_quality_score(h.as_of_time(df))


@stage("base_features", (*_BARS, "close_adj"))
def base_features(df: DataFrame) -> DataFrame:
    return t.base_features(df)


@stage("cross_section", ("instrument", "date", "close_adj", "volume", "log_return"))
def cross_section(df: DataFrame, beta_windows: Sequence[int] = x.BETA_WINDOWS) -> DataFrame:
    """Benchmark, beta, alpha, universe flags and ranks of the features present."""
    df = x.join_benchmark(df, x.market_return(df))
    df = x.r_squared(x.idiosyncratic_volatility(x.beta_alpha(df, beta_windows), beta_windows), beta_windows)
    df = materialise(x.universe_size(x.universe_flags(df)), "universe")
    features = [f for f in x.RANK_FEATURES if f in df.columns]
    if not features:
        return df
    ranks = x.widen(x.cross_ranks(df, features), features, {"pct_rank": "rank", "zscore": "zscore", "decile": "decile"})
    return df.join(ranks, ["instrument", "date"], "left")


@stage("season", ("instrument", "date"))
def season(df: DataFrame) -> DataFrame:
    df = z.earnings_season(z.holiday_effects(z.calendar_encodings(df)))
    return z.turn_of_quarter(z.turn_of_month(df))


@stage("regimes", ("instrument", "date", "vol_cc_20d", "return_21d"))
def regimes(df: DataFrame, n_regimes: int = z.N_REGIMES, windows: Sequence[int] = (60, 126, 252)) -> DataFrame:
    df = z.majority_filter(z.quantile_regimes(df, "vol_cc_20d", n_regimes))
    df = z.regime_persistence(z.regime_flags(df, n_regimes))
    df = z.rolling_percent_rank(df, "vol_cc_20d", windows)
    for n in windows:
        df = z.volatility_class(df, f"vol_regime_{n}d")
    return z.trend_class(df)


@stage("targets", ("instrument", "date", "close_adj", "log_return"))
def targets(df: DataFrame, horizons: Sequence[int] = tg.HORIZONS) -> DataFrame:
    df = tg.forward_volatility(tg.forward_returns(df, horizons))
    return tg.quantile_labels(tg.direction_labels(df, horizons), horizons)


def _peers(df: DataFrame, window: int, min_abs: float) -> DataFrame:
    return rel.peer_map(rel.correlations(df, window=window, min_abs=min_abs), min_abs=min_abs)


@stage("relationships", ("instrument", "date", "log_return"))
def relationships(df: DataFrame, window: int = 126, min_abs: float = rel.MIN_CORRELATION) -> DataFrame:
    """Number of peers of each instrument and their mean absolute correlation; 0 and NULL without any."""
    peers = _peers(df, window, min_abs).groupBy("instrument").agg(
        F.count(F.lit(1)).alias("n_peers"), F.avg("weight").alias("peer_correlation")
    )
    return df.join(peers, "instrument", "left").withColumn("n_peers", F.coalesce("n_peers", F.lit(0)))


@stage("target_features", ("instrument", "date", "log_return"))
def target_features(
    df: DataFrame, window: int = 126, min_abs: float = rel.MIN_CORRELATION, momentum: Sequence[int] = pe.MOMENTUM_WINDOWS
) -> DataFrame:
    """Mean momentum of the peers of each instrument over several windows, and the gap to its own."""
    peers = _peers(df, window, min_abs).select(F.col("instrument").alias("target"), "peer")
    long = pe.average_peer_momentum(pe.momentum_gaps(pe.calendar(df), peers, momentum))
    wide = long.groupBy("target", "date").agg(
        *[
            F.max(F.when(F.col("window") == n, F.col(c))).alias(f"{c}_{n}d")
            for n in momentum
            for c in ("avg_peer_momentum", "momentum_vs_peers")
        ]
    )
    return pe.merge_target_features(df, wide)


@stage("news_sentiment", ("instrument", "date"))
def news_sentiment(df: DataFrame, news: DataFrame, windows: Sequence[int] = (3, 7, 14, 30), **options) -> DataFrame:
    """Daily sentiment of ``news`` and its averages beside every row; NULL on days without articles."""
    daily = nw.sentiment_averages(nw.daily_sentiment(news, **options), windows)
    return df.join(daily, ["instrument", "date"], "left")


@stage("training", ("instrument", "date"))
def training(df: DataFrame, features: Sequence[str], label: str, folds: int = 5, alpha: float = 1.0) -> DataFrame:
    """Out-of-fold ridge prediction of ``label`` per instrument, trained on earlier folds only."""
    pred = ml.grouped_ridge_cv(df, features, label, k=folds, alpha=alpha)
    return df.join(pred.select("instrument", "date", F.col("y_hat").alias("prediction")), ["instrument", "date"], "left")
