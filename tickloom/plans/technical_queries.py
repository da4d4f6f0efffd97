"""Queries for the per-instrument features."""

from __future__ import annotations

from tickloom.functions.blocks import in_blocks
from tickloom.operators import technical as t
from tickloom.plans import views as v
from tickloom.plans.registry import r, register, rounded, with_ctes
from pyspark.sql import functions as F

# one CTE with every bounded-frame feature; each query picks its columns
_W = "PARTITION BY instrument ORDER BY date"


def _full(agg: str, x: str, n: int) -> str:
    frame = f"({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) OVER {frame} = {n} THEN {agg} OVER {frame} END"


_STEP1 = f"""
s1 AS (
  SELECT *, close_adj / lag(close_adj) OVER ({_W}) - 1 AS simple_return,
         ln(close_adj / lag(close_adj) OVER ({_W})) AS log_return,
         pow(ln(high / low), 2) AS hl2,
         0.5 * pow(ln(high / low), 2) - (2 * ln(2) - 1) * pow(ln(close / open), 2) AS gk,
         close_adj - lag(close_adj) OVER ({_W}) AS d,
         lag(close_adj) OVER ({_W}) AS pc,
         volume * close_adj AS dollar_volume,
         (high + low + close) / 3 AS typical,
         row_number() OVER ({_W}) - 1 AS n
  FROM bars)"""
_STEP2 = f"""
s2 AS (
  SELECT *, abs(log_return) / (dollar_volume + 1e-10) AS illiq, lag(d) OVER ({_W}) AS d1,
         100 * (close_adj - {_full('min(low)', 'low', 14)})
           / ({_full('max(high)', 'high', 14)} - {_full('min(low)', 'low', 14)} + 1e-10) AS stoch_k
  FROM s1)"""


def _ctes(by: str = "type") -> list[str]:
    return [v.bars_sql(by), _STEP1, _STEP2]


def _feature(name, covers, build, exprs: dict[str, str], digits=6):
    cols = list(exprs)

    def run(spark, sf):
        return rounded(build(v.bars(spark, sf)).select("instrument", "date", *cols), digits)

    body = "SELECT instrument, date, " + ", ".join(r(e, c, digits) for c, e in exprs.items()) + " FROM s2"
    register(name, covers, run, with_ctes(_ctes(), body))


_feature("simple_return", "WIN-1 UDF-3", t.returns, {"simple_return": "simple_return"})
_feature("log_return", "WIN-2 FN-1", t.returns, {"log_return": "log_return"})
_feature(
    "rolling_return",
    "WIN-3",
    lambda b: t.rolling_returns(t.returns(b)),
    {f"return_{n}d": _full("sum(log_return)", "log_return", n) for n in t.RETURN_WINDOWS},
)
_feature(
    "close_volatility",
    "WIN-4",
    lambda b: t.close_volatility(t.returns(b)),
    {f"vol_cc_{n}d": f"{_full('stddev_samp(log_return)', 'log_return', n)} * sqrt(252)" for n in t.VOL_WINDOWS},
)
_feature(
    "parkinson_volatility",
    "WIN-5",
    t.parkinson_volatility,
    {
        f"vol_parkinson_{n}d": f"sqrt({_full('avg(hl2)', 'hl2', n)} / (4 * ln(2))) * sqrt(252)"
        for n in t.VOL_WINDOWS
    },
)
_feature(
    "garman_klass_volatility",
    "WIN-6",
    t.garman_klass_volatility,
    {
        f"vol_gk_{n}d": f"CASE WHEN {_full('avg(gk)', 'gk', n)} >= 0 "
        f"THEN sqrt(greatest({_full('avg(gk)', 'gk', n)}, 0)) * sqrt(252) END"
        for n in t.VOL_WINDOWS
    },
)
_feature(
    "moving_average",
    "WIN-7",
    t.moving_averages,
    {f"sma_{n}": _full("avg(close_adj)", "close_adj", n) for n in t.SMA_WINDOWS},
    4,
)
_feature(
    "stochastic_oscillator",
    "WIN-11",
    t.stochastic,
    {"stoch_k": "stoch_k", "stoch_d": _full("avg(stoch_k)", "stoch_k", 3)},
)
_feature(
    "true_range",
    "WIN-13",
    t.true_range,
    {"true_range": "greatest(high - low, abs(high - pc), abs(low - pc))"},
    8,
)
_mid = _full("avg(close_adj)", "close_adj", 20)
_sd = _full("stddev_samp(close_adj)", "close_adj", 20)
_feature(
    "bollinger_bands",
    "WIN-15",
    t.bollinger,
    {
        "bb_middle": _mid,
        "bb_upper": f"{_mid} + 2 * {_sd}",
        "bb_lower": f"{_mid} - 2 * {_sd}",
        "bb_width": f"4 * {_sd} / {_mid}",
        "bb_percent": f"(close_adj - ({_mid} - 2 * {_sd})) / (4 * {_sd})",
    },
    4,
)
_feature("dollar_volume", "WIN-16", t.dollar_volume, {"dollar_volume": "dollar_volume"}, 7)
_feature(
    "volume_averages",
    "WIN-17",
    t.volume_features,
    {
        k: e
        for n in t.VOLUME_WINDOWS
        for k, e in {
            f"volume_sma_{n}": _full("avg(volume)", "volume", n),
            f"volume_ratio_{n}": f"volume / {_full('avg(volume)', 'volume', n)}",
            f"dollar_vol_sma_{n}": _full("avg(dollar_volume)", "dollar_volume", n),
        }.items()
    },
    3,
)
_feature(
    "amihud_illiquidity",
    "WIN-18",
    lambda b: _scaled(t.amihud(t.returns(b)), [f"amihud_{n}d" for n in t.AMIHUD_WINDOWS]),
    {f"amihud_{n}d": f"{_full('avg(illiq)', 'illiq', n)} * 1000000" for n in t.AMIHUD_WINDOWS},
)
_feature(
    "roll_spread",
    "WIN-19",
    t.roll_spread,
    {
        "roll_spread": f"""CASE WHEN count(d) OVER ({_W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 20
        AND covar_samp(d, d1) OVER ({_W} ROWS BETWEEN 18 PRECEDING AND CURRENT ROW) < 0
        THEN 2 * sqrt(greatest(-covar_samp(d, d1) OVER ({_W} ROWS BETWEEN 18 PRECEDING AND CURRENT ROW), 0)) END"""
    },
    3,
)
_feature(
    "fallback_return",
    "WIN-69",
    t.fallback_return,
    {"log_ret": f"coalesce(close / lag(close) OVER ({_W}) - 1, 0)"},
)


def _scaled(df, cols):
    return df.withColumns({c: F.col(c) * 1_000_000 for c in cols})


# ---- exponential means: recursive SQL is the independent check -----------------------


def _recursive(columns: dict[str, tuple[str, float, int]], src: str, name: str) -> str:
    """CTE ``name`` with the recursion written out, per series and row number."""
    first = ", ".join(
        f"CASE WHEN n = {lead} THEN {x} END AS {c}" for c, (x, _, lead) in columns.items()
    )
    nxt = ", ".join(
        f"CASE WHEN s.n = {lead} THEN s.{x} ELSE {1 - a!r} * e.{c} + {a!r} * s.{x} END"
        for c, (x, a, lead) in columns.items()
    )
    cols = ", ".join(columns)
    return f"""
{name}(instrument, date, n, {cols}) AS (
  SELECT instrument, date, n, {first} FROM {src} WHERE n = 0
  UNION ALL
  SELECT s.instrument, s.date, s.n, {nxt} FROM {name} e JOIN {src} s ON s.instrument = e.instrument AND s.n = e.n + 1)"""


def _ema(name, covers, build, ctes, body, cols, digits=4):
    def run(spark, sf):
        return rounded(build(v.bars(spark, sf)).select("instrument", "date", *cols), digits)

    register(name, covers, run, with_ctes([*_ctes(), *ctes], body, recursive=True))


_ema(
    "exponential_average",
    "WIN-8",
    t.exponential_averages,
    [_recursive({f"ema_{s}": ("close_adj", 2 / (s + 1), 0) for s in t.EMA_SPANS}, "s2", "e")],
    "SELECT instrument, date, " + ", ".join(r(f"ema_{s}", f"ema_{s}", 4) for s in t.EMA_SPANS) + " FROM e",
    [f"ema_{s}" for s in t.EMA_SPANS],
)
_ema(
    "macd",
    "WIN-9",
    t.macd,
    [
        _recursive({"f": ("close_adj", 2 / 13, 0), "s": ("close_adj", 2 / 27, 0)}, "s2", "e1"),
        "m AS (SELECT instrument, date, n, f - s AS macd FROM e1)",
        _recursive({"sig": ("macd", 0.2, 0)}, "m", "e2"),
    ],
    f"SELECT instrument, date, {r('macd', 'macd', 4)}, {r('sig', 'macd_signal', 4)}, "
    f"{r('macd - sig', 'macd_histogram', 4)} FROM m JOIN e2 USING (instrument, date)",
    ["macd", "macd_signal", "macd_histogram"],
)
_ema(
    "relative_strength_index",
    "WIN-10",
    t.rsi,
    [
        "g AS (SELECT instrument, date, n, greatest(d, 0) AS gain, greatest(-d, 0) AS loss FROM s2)",
        _recursive({"ag": ("gain", 1 / 14, 1), "al": ("loss", 1 / 14, 1)}, "g", "e"),
    ],
    f"SELECT instrument, date, {r('100 - 100 / (1 + ag / (al + 1e-10))', 'rsi_14')} FROM e",
    ["rsi_14"],
    6,
)
_TR = "greatest(high - low, abs(high - pc), abs(low - pc))"
_DM = f"""
dm AS (
  SELECT instrument, date, n, {_TR} AS tr,
         CASE WHEN up > dn AND up > 0 THEN up ELSE 0 END AS pdm,
         CASE WHEN dn > up AND dn > 0 THEN dn ELSE 0 END AS mdm
  FROM (SELECT *, high - lag(high) OVER ({_W}) AS up, lag(low) OVER ({_W}) - low AS dn FROM s2))"""
_ema(
    "directional_index",
    "WIN-12",
    t.directional_index,
    [
        _DM,
        _recursive({"a": ("tr", 1 / 14, 0), "p": ("pdm", 1 / 14, 0), "m": ("mdm", 1 / 14, 0)}, "dm", "e1"),
        "di AS (SELECT instrument, date, n, 100 * p / (a + 1e-10) AS pdi, 100 * m / (a + 1e-10) AS mdi FROM e1)",
        "dx AS (SELECT *, 100 * abs(pdi - mdi) / (pdi + mdi + 1e-10) AS x FROM di)",
        _recursive({"adx": ("x", 1 / 14, 0)}, "dx", "e2"),
    ],
    f"SELECT instrument, date, {r('pdi', 'plus_di')}, {r('mdi', 'minus_di')}, {r('adx', 'adx')} "
    "FROM dx JOIN e2 USING (instrument, date)",
    ["plus_di", "minus_di", "adx"],
    6,
)
_ema(
    "average_true_range",
    "WIN-14",
    t.average_true_range,
    [
        f"x AS (SELECT instrument, date, n, {_TR} AS tr FROM s2)",
        _recursive({"atr": ("tr", 1 / 14, 0)}, "x", "e"),
    ],
    f"SELECT instrument, date, {r('atr', 'atr_14', 4)} FROM e",
    ["atr_14"],
)

# ---- stored indicators on long tick-like series, cut into blocks ----------------------

_TICK_W = "PARTITION BY instrument ORDER BY ts, event_id"


def _tick_frame(agg: str, x: str, n: int) -> str:
    f = f"({_TICK_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) OVER {f} = {n} THEN {agg} OVER {f} END"


def _stored(spark, sf):
    """Event ticks: five keys, no bound on a key's length, hence blocks."""
    ticks = v.table(spark, sf, "events").select(
        "event_id",
        F.col("event_type").alias("instrument"),
        "ts",
        F.col("value").alias("close"),
        (F.col("value") + 1).alias("high"),
        (F.col("value") / 2).alias("low"),
        (F.col("user_id") + 1).alias("volume"),
    )
    out = in_blocks(
        ticks,
        lambda df, keys, order: t.stored_bar_indicators(df, keys, order),
        keys=["instrument"],
        order=["ts", "event_id"],
        bucket=F.date_trunc("hour", F.col("ts").cast("timestamp")),
        lookback=24,
        block_rows=4_096,
    )
    return rounded(
        out.select(
            "instrument",
            "event_id",
            "price_change_abs",
            "price_change",
            "sma_5",
            "vwap",
            "volatility_10",
            "volume_sma_10",
            "volume_ratio",
        ),
        7,
    )


register(
    "stored_bar_indicators",
    "WIN-20",
    _stored,
    f"""
WITH k AS (
  SELECT event_id, event_type AS instrument, ts, value AS close, value + 1 AS high, value / 2 AS low, user_id + 1 AS volume
  FROM events),
p AS (
  SELECT *, close - lag(close) OVER ({_TICK_W}) AS ca, close / nullif(lag(close) OVER ({_TICK_W}), 0) - 1 AS cp,
         (high + low + close) / 3 AS tp FROM k)
SELECT instrument, event_id, {r('ca', 'price_change_abs', 7)}, {r('cp', 'price_change', 7)},
       {r(_tick_frame('avg(close)', 'close', 5), 'sma_5', 7)},
       {r(_tick_frame('sum(tp * volume)', 'tp', 20) + ' / ' + _tick_frame('sum(volume)', 'volume', 20), 'vwap', 7)},
       {r(_tick_frame('stddev_samp(cp)', 'cp', 10), 'volatility_10', 7)},
       {r(_tick_frame('avg(volume)', 'volume', 10), 'volume_sma_10', 7)},
       {r('volume / ' + _tick_frame('avg(volume)', 'volume', 10), 'volume_ratio', 7)}
FROM p""",
)
