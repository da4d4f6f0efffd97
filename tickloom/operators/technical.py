"""Per-instrument features: returns, volatility, trend, range and liquidity."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.ewm import span_alpha, with_ewm
from tickloom.functions.frames import (
    KEYS,
    ORDER,
    add_row_number,
    last_rows,
    prior,
    roll_max,
    roll_mean,
    roll_min,
    roll_std,
    roll_sum,
    series,
    when_full,
)

TRADING_DAYS = 252
RETURN_WINDOWS = (5, 10, 20, 21, 60, 63, 126, 252)
VOL_WINDOWS = (5, 10, 20, 60)
SMA_WINDOWS = (10, 20, 50, 200)
EMA_SPANS = (12, 26, 50, 200)
VOLUME_WINDOWS = (5, 10, 20, 60)
AMIHUD_WINDOWS = (5, 20, 60)
TINY = 1e-10
_YEAR = math.sqrt(TRADING_DAYS)


def _c(name: str) -> Column:
    return F.col(name)


def returns(df: DataFrame, keys: Sequence[str] = KEYS, order: str = ORDER) -> DataFrame:
    """Simple and log return of the adjusted close."""
    before = prior(_c("close_adj"), 1, keys, order)
    return df.withColumns(
        {
            "simple_return": F.try_divide(_c("close_adj"), before) - 1,
            "log_return": F.log(F.try_divide(_c("close_adj"), before)),
        }
    )


def fallback_return(df: DataFrame, keys=KEYS, order=ORDER) -> DataFrame:
    """Simple return on the raw close, 0 on the first row."""
    change = F.try_divide(_c("close"), prior(_c("close"), 1, keys, order)) - 1
    return df.withColumn("log_ret", F.coalesce(change, F.lit(0.0)))


def rolling_returns(df: DataFrame, windows=RETURN_WINDOWS, keys=KEYS, order=ORDER) -> DataFrame:
    return df.withColumns({f"return_{n}d": roll_sum(_c("log_return"), n, keys, order) for n in windows})


def close_volatility(df: DataFrame, windows=VOL_WINDOWS, keys=KEYS, order=ORDER) -> DataFrame:
    return df.withColumns(
        {f"vol_cc_{n}d": roll_std(_c("log_return"), n, keys, order) * _YEAR for n in windows}
    )


def parkinson_volatility(df: DataFrame, windows=VOL_WINDOWS, keys=KEYS, order=ORDER) -> DataFrame:
    sq = F.pow(F.log(F.try_divide(_c("high"), _c("low"))), 2)
    return df.withColumns(
        {
            f"vol_parkinson_{n}d": F.sqrt(roll_mean(sq, n, keys, order) / (4 * math.log(2))) * _YEAR
            for n in windows
        }
    )


def garman_klass_volatility(df: DataFrame, windows=VOL_WINDOWS, keys=KEYS, order=ORDER) -> DataFrame:
    part = 0.5 * F.pow(F.log(F.try_divide(_c("high"), _c("low"))), 2) - (2 * math.log(2) - 1) * F.pow(
        F.log(F.try_divide(_c("close"), _c("open"))), 2
    )
    out = {}
    for n in windows:
        mean = roll_mean(part, n, keys, order)
        out[f"vol_gk_{n}d"] = F.when(mean >= 0, F.sqrt(mean) * _YEAR)
    return df.withColumns(out)


def moving_averages(df: DataFrame, windows=SMA_WINDOWS, keys=KEYS, order=ORDER) -> DataFrame:
    return df.withColumns({f"sma_{n}": roll_mean(_c("close_adj"), n, keys, order) for n in windows})


def exponential_averages(df: DataFrame, spans=EMA_SPANS, keys=KEYS, order=ORDER) -> DataFrame:
    return with_ewm(df, {f"ema_{s}": ("close_adj", span_alpha(s), 0) for s in spans}, keys, order)


def macd(df: DataFrame, fast=12, slow=26, signal=9, keys=KEYS, order=ORDER) -> DataFrame:
    df = with_ewm(
        df,
        {"_fast": ("close_adj", span_alpha(fast), 0), "_slow": ("close_adj", span_alpha(slow), 0)},
        keys,
        order,
    ).withColumn("macd", _c("_fast") - _c("_slow"))
    df = with_ewm(df, {"macd_signal": ("macd", span_alpha(signal), 0)}, keys, order)
    return df.withColumn("macd_histogram", _c("macd") - _c("macd_signal")).drop("_fast", "_slow")


def rsi(df: DataFrame, period: int = 14, keys=KEYS, order=ORDER) -> DataFrame:
    change = _c("close_adj") - prior(_c("close_adj"), 1, keys, order)
    df = df.withColumn("_d", change).withColumns(
        {
            "_gain": F.when(_c("_d").isNotNull(), F.greatest(_c("_d"), F.lit(0.0))),
            "_loss": F.when(_c("_d").isNotNull(), F.greatest(-_c("_d"), F.lit(0.0))),
        }
    )
    df = with_ewm(df, {"_ag": ("_gain", 1 / period, 1), "_al": ("_loss", 1 / period, 1)}, keys, order)
    return df.withColumn(
        f"rsi_{period}", 100 - 100 / (1 + _c("_ag") / (_c("_al") + TINY))
    ).drop("_d", "_gain", "_loss", "_ag", "_al")


def stochastic(df: DataFrame, period: int = 14, smooth: int = 3, keys=KEYS, order=ORDER) -> DataFrame:
    lo = roll_min(_c("low"), period, keys, order)
    hi = roll_max(_c("high"), period, keys, order)
    return df.withColumn("stoch_k", 100 * (_c("close_adj") - lo) / (hi - lo + TINY)).withColumn(
        "stoch_d", roll_mean(_c("stoch_k"), smooth, keys, order)
    )


def true_range(df: DataFrame, keys=KEYS, order=ORDER) -> DataFrame:
    before = prior(_c("close_adj"), 1, keys, order)
    return df.withColumn(
        "true_range",
        F.greatest(_c("high") - _c("low"), F.abs(_c("high") - before), F.abs(_c("low") - before)),
    )


def average_true_range(df: DataFrame, period: int = 14, keys=KEYS, order=ORDER) -> DataFrame:
    return with_ewm(
        true_range(df, keys, order), {f"atr_{period}": ("true_range", 1 / period, 0)}, keys, order
    )


def directional_index(df: DataFrame, period: int = 14, keys=KEYS, order=ORDER) -> DataFrame:
    """+DI, -DI and ADX; directional movement is 0 on the first row."""
    up = _c("high") - prior(_c("high"), 1, keys, order)
    down = prior(_c("low"), 1, keys, order) - _c("low")
    df = true_range(df, keys, order).withColumns({"_up": up, "_down": down})
    df = df.withColumns(
        {
            "_pdm": F.when((_c("_up") > _c("_down")) & (_c("_up") > 0), _c("_up")).otherwise(0.0),
            "_mdm": F.when((_c("_down") > _c("_up")) & (_c("_down") > 0), _c("_down")).otherwise(0.0),
        }
    )
    a = 1 / period
    df = with_ewm(
        df, {"_atr": ("true_range", a, 0), "_ps": ("_pdm", a, 0), "_ms": ("_mdm", a, 0)}, keys, order
    )
    df = df.withColumns(
        {
            "plus_di": 100 * _c("_ps") / (_c("_atr") + TINY),
            "minus_di": 100 * _c("_ms") / (_c("_atr") + TINY),
        }
    ).withColumn(
        "_dx", 100 * F.abs(_c("plus_di") - _c("minus_di")) / (_c("plus_di") + _c("minus_di") + TINY)
    )
    df = with_ewm(df, {"adx": ("_dx", a, 0)}, keys, order)
    return df.drop("_up", "_down", "_pdm", "_mdm", "_atr", "_ps", "_ms", "_dx")


def bollinger(df: DataFrame, n: int = 20, k: float = 2.0, keys=KEYS, order=ORDER) -> DataFrame:
    mid = roll_mean(_c("close_adj"), n, keys, order)
    sd = roll_std(_c("close_adj"), n, keys, order)
    return (
        df.withColumns({"bb_middle": mid, "_sd": sd})
        .withColumns(
            {"bb_upper": _c("bb_middle") + k * _c("_sd"), "bb_lower": _c("bb_middle") - k * _c("_sd")}
        )
        .withColumns(
            {
                "bb_width": F.try_divide(_c("bb_upper") - _c("bb_lower"), _c("bb_middle")),
                "bb_percent": F.try_divide(
                    _c("close_adj") - _c("bb_lower"), _c("bb_upper") - _c("bb_lower")
                ),
            }
        )
        .drop("_sd")
    )


def dollar_volume(df: DataFrame, keys=KEYS, order=ORDER) -> DataFrame:
    return df.withColumn("dollar_volume", _c("volume") * _c("close_adj"))


def volume_features(df: DataFrame, windows=VOLUME_WINDOWS, keys=KEYS, order=ORDER) -> DataFrame:
    df = dollar_volume(df)
    out = {}
    for n in windows:
        sma = roll_mean(_c("volume"), n, keys, order)
        out[f"volume_sma_{n}"] = sma
        out[f"volume_ratio_{n}"] = F.try_divide(_c("volume"), sma)
        out[f"dollar_vol_sma_{n}"] = roll_mean(_c("dollar_volume"), n, keys, order)
    return df.withColumns(out)


def amihud(df: DataFrame, windows=AMIHUD_WINDOWS, keys=KEYS, order=ORDER) -> DataFrame:
    part = F.abs(_c("log_return")) / (_c("volume") * _c("close_adj") + TINY)
    return df.withColumn("_ami", part).withColumns(
        {f"amihud_{n}d": roll_mean(_c("_ami"), n, keys, order) for n in windows}
    ).drop("_ami")


def roll_spread(df: DataFrame, n: int = 20, keys=KEYS, order=ORDER) -> DataFrame:
    """Twice the root of the negative serial covariance of price changes."""
    df = df.withColumn("_d", _c("close_adj") - prior(_c("close_adj"), 1, keys, order))
    df = df.withColumn("_d1", prior(_c("_d"), 1, keys, order))
    full = F.count("_d").over(last_rows(n, keys, order)) == n
    cov = F.when(full, F.covar_samp("_d", "_d1").over(last_rows(n - 1, keys, order)))
    return df.withColumn("_cov", cov).withColumn(
        "roll_spread", F.when(_c("_cov") < 0, 2 * F.sqrt(-_c("_cov")))
    ).drop("_d", "_d1", "_cov")


def stored_bar_indicators(df: DataFrame, keys=KEYS, order=ORDER) -> DataFrame:
    """Indicator columns the lake stores beside the bars."""
    change = _c("close") - prior(_c("close"), 1, keys, order)
    pct = F.try_divide(_c("close"), prior(_c("close"), 1, keys, order)) - 1
    typical = (_c("high") + _c("low") + _c("close")) / 3
    w = last_rows(20, keys, order)
    vwap = F.try_divide(when_full(typical, F.sum(typical * _c("volume")), w, 20), F.sum("volume").over(w))
    df = df.withColumns({"price_change_abs": change, "price_change": pct})
    vol_sma = roll_mean(_c("volume"), 10, keys, order)
    return df.withColumns(
        {
            "sma_5": roll_mean(_c("close"), 5, keys, order),
            "vwap": vwap,
            "volatility_10": roll_std(_c("price_change"), 10, keys, order),
            "volume_sma_10": vol_sma,
            "volume_ratio": F.try_divide(_c("volume"), vol_sma),
        }
    )


def base_features(df: DataFrame, keys=KEYS, order=ORDER) -> DataFrame:
    """All of the above; one shuffle on the keys serves every window."""
    df = add_row_number(df, keys, order)
    for step in (
        returns,
        rolling_returns,
        close_volatility,
        parkinson_volatility,
        garman_klass_volatility,
        moving_averages,
        exponential_averages,
        macd,
        rsi,
        stochastic,
        directional_index,
        average_true_range,
        bollinger,
        volume_features,
        amihud,
        roll_spread,
    ):
        df = step(df, keys=keys, order=order)
    return df


# rows before the current one that the widest chained frame of ``base_features`` reads
LOOKBACK = 5_000
