"""Queries for regimes, calendar features and event proxies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import season as z
from tickloom.operators import technical as t
from tickloom.plans import views as v
from tickloom.plans.registry import query, r, register, rounded, with_ctes

_W = "PARTITION BY instrument ORDER BY date"


def _frame(n: int) -> str:
    return f"({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _full(agg: str, c: str, n: int) -> str:
    return f"CASE WHEN count({c}) OVER {_frame(n)} = {n} THEN {agg} OVER {_frame(n)} END"


_RET = f"ret AS (SELECT *, ln(close_adj / lag(close_adj) OVER ({_W})) AS log_return FROM bars)"
_VOL = f"""
vol AS (
  SELECT *, {_full('stddev_samp(log_return)', 'log_return', 20)} * sqrt(252) AS vol_cc_20d,
         {_full('sum(log_return)', 'log_return', 21)} AS return_21d, volume * close_adj AS dollar_volume,
         row_number() OVER ({_W}) - 1 AS n
  FROM ret)"""
_BASE = [v.bars_sql(), _RET, _VOL]


def _vol(spark, sf):
    b = t.returns(v.bars(spark, sf))
    return t.dollar_volume(t.rolling_returns(t.close_volatility(b, (20,)), (21,)))


_REG = """
raw AS (
  SELECT v.instrument, date, n, vol_cc_20d, CASE WHEN vol_cc_20d IS NOT NULL
         THEN greatest(len(list_filter(q, lambda e: e <= vol_cc_20d)) - 1, 0) END AS regime_raw
  FROM vol v JOIN (SELECT instrument, quantile_cont(vol_cc_20d, [0.25, 0.5, 0.75]) AS q FROM vol GROUP BY 1) USING (instrument))"""
_MAJ = f"""
maj AS (
  SELECT *, CAST((SELECT e FROM (SELECT unnest(w) AS e) WHERE e IS NOT NULL GROUP BY e ORDER BY count(*) DESC, e LIMIT 1) AS INTEGER) AS regime_id
  FROM (SELECT *, list(regime_raw) OVER ({_W} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS w FROM raw))"""


def _regimes(spark, sf):
    return z.majority_filter(z.quantile_regimes(_vol(spark, sf), "vol_cc_20d"))


register(
    "quantile_regime",
    "WIN-36",
    lambda s, sf: z.quantile_regimes(_vol(s, sf), "vol_cc_20d").select("instrument", "date", "regime_raw"),
    with_ctes([*_BASE, _REG], "SELECT instrument, date, CAST(regime_raw AS INTEGER) AS regime_raw FROM raw"),
)
register(
    "regime_majority_filter",
    "WIN-33",
    lambda s, sf: _regimes(s, sf).select("instrument", "date", "regime_id"),
    with_ctes([*_BASE, _REG, _MAJ], "SELECT instrument, date, regime_id FROM maj"),
)
register(
    "regime_flags",
    "WIN-34",
    lambda s, sf: z.regime_flags(_regimes(s, sf)).select("instrument", "date", *[f"regime_{k}" for k in range(4)]),
    with_ctes(
        [*_BASE, _REG, _MAJ],
        "SELECT instrument, date, "
        + ", ".join(f"CAST(coalesce(regime_id = {k}, false) AS INTEGER) AS regime_{k}" for k in range(4))
        + " FROM maj",
    ),
)
register(
    "regime_persistence",
    "WIN-35",
    lambda s, sf: z.regime_persistence(_regimes(s, sf).where("regime_id IS NOT NULL")).select(
        "instrument", "date", "regime_persistence", "regime_occurrences"
    ),
    with_ctes(
        [
            *_BASE,
            _REG,
            _MAJ,
            "live AS (SELECT * FROM maj WHERE regime_id IS NOT NULL)",
            f"runs AS (SELECT *, row_number() OVER ({_W}) - row_number() OVER (PARTITION BY instrument, regime_id ORDER BY date) AS g FROM live)",
        ],
        """SELECT instrument, date, row_number() OVER (PARTITION BY instrument, regime_id, g ORDER BY date) AS regime_persistence,
        row_number() OVER (PARTITION BY instrument, regime_id ORDER BY date) AS regime_occurrences FROM runs""",
    ),
)
register(
    "regime_transitions",
    "ML-5",
    lambda s, sf: rounded(_transitions(_regimes(s, sf))),
    with_ctes(
        [
            *_BASE,
            _REG,
            _MAJ,
            f"""st AS (SELECT instrument, regime_id AS to_regime, lag(regime_id) OVER ({_W}) AS from_regime FROM maj WHERE regime_id IS NOT NULL),
            c AS (SELECT instrument, from_regime, to_regime, count(*) AS n FROM st WHERE from_regime IS NOT NULL GROUP BY 1, 2, 3)""",
        ],
        f"SELECT instrument, from_regime, to_regime, n, {r('n / sum(n) OVER (PARTITION BY instrument, from_regime)', 'probability')} FROM c",
    ),
)


def _transitions(df):
    from tickloom.operators.models import transition_matrix

    return transition_matrix(df.where("regime_id IS NOT NULL"))


# ---- calendar -------------------------------------------------------------------------

_DOW = "(isodow(date) - 1)"


def _cyc(expr, period, name):
    return (
        f"{r(f'sin(2 * pi() * {expr} / {period})', name + '_sin')}, {r(f'cos(2 * pi() * {expr} / {period})', name + '_cos')}"
    )


register(
    "calendar_encodings",
    "WIN-37 FN-2",
    lambda s, sf: rounded(
        z.calendar_encodings(v.bars(s, sf).select("instrument", "date"))
    ),
    with_ctes(
        [v.bars_sql()],
        f"""SELECT instrument, date, CAST({_DOW} AS INTEGER) AS day_of_week, {_cyc(_DOW, 7, 'dow')},
        CAST({_DOW} = 0 AS INTEGER) AS is_monday, CAST({_DOW} = 4 AS INTEGER) AS is_friday,
        CAST(month(date) AS INTEGER) AS month_of_year, {_cyc('month(date)', 12, 'month')},
        CAST(month(date) = 1 AS INTEGER) AS is_january, CAST(quarter(date) AS INTEGER) AS quarter, {_cyc('quarter(date)', 4, 'quarter')}
        FROM bars""",
    ),
)


def _turn_sql(unit, n, name):
    return f"""
d AS (SELECT DISTINCT date, date_trunc('{unit}', date) AS p FROM bars),
f AS (SELECT date, CAST((row_number() OVER (PARTITION BY p ORDER BY date) <= {n}
      OR row_number() OVER (PARTITION BY p ORDER BY date DESC) <= {n}) AND count(*) OVER (PARTITION BY p) >= {2 * n} AS INTEGER) AS {name} FROM d)"""


register(
    "turn_of_month",
    "WIN-38",
    lambda s, sf: z.turn_of_month(v.bars(s, sf)).select("instrument", "date", "turn_of_month"),
    with_ctes(
        [v.bars_sql(), _turn_sql("month", 3, "turn_of_month")],
        "SELECT instrument, date, turn_of_month FROM bars JOIN f USING (date)",
    ),
)
register(
    "turn_of_quarter",
    "WIN-39",
    lambda s, sf: z.turn_of_quarter(v.bars(s, sf)).select("instrument", "date", "turn_of_quarter"),
    with_ctes(
        [v.bars_sql(), _turn_sql("quarter", 5, "turn_of_quarter")],
        "SELECT instrument, date, turn_of_quarter FROM bars JOIN f USING (date)",
    ),
)
register(
    "holiday_effects",
    "WIN-40",
    lambda s, sf: z.holiday_effects(v.bars(s, sf).select("instrument", "date")),
    with_ctes(
        [v.bars_sql()],
        """SELECT instrument, date, CAST(month(date) = 1 AND day(date) <= 10 AS INTEGER) AS new_year_effect,
        CAST(month(date) = 12 AND day(date) >= 20 AS INTEGER) AS year_end_effect,
        CAST(date = last_day(date) AND month(date) IN (3, 6, 9, 12) AS INTEGER) AS quarter_end,
        CAST(date = last_day(date) AS INTEGER) AS month_end FROM bars""",
    ),
)
register(
    "earnings_season",
    "WIN-41",
    lambda s, sf: z.earnings_season(v.bars(s, sf).select("instrument", "date")),
    with_ctes(
        [v.bars_sql()],
        """SELECT instrument, date, CAST(month(date) IN (1, 4, 7, 10) AND day(date) BETWEEN 15 AND 29 AS INTEGER)
        AS potential_earnings_period FROM bars""",
    ),
)

# ---- event proxies --------------------------------------------------------------------

_HV = "hv AS (SELECT *, CAST(coalesce(vol_cc_20d > (SELECT quantile_cont(vol_cc_20d, 0.9) FROM vol), false) AS INTEGER) AS high_vol_event FROM vol)"
_SINCE = "CAST(coalesce(n - max(CASE WHEN {f} = 1 THEN n END) OVER (" + _W + " ROWS BETWEEN 90 PRECEDING AND CURRENT ROW), 90) AS INTEGER)"
register(
    "high_volatility_event",
    "WIN-42",
    lambda s, sf: z.high_volatility_event(_vol(s, sf)).select("instrument", "date", "high_vol_event"),
    with_ctes([*_BASE, _HV], "SELECT instrument, date, high_vol_event FROM hv"),
)
register(
    "high_volume_event",
    "WIN-43",
    lambda s, sf: z.high_volume_event(_vol(s, sf)).select("instrument", "date", "high_volume_event"),
    with_ctes(
        _BASE,
        f"""SELECT instrument, date, CAST(coalesce(dollar_volume > {_full('quantile_cont(dollar_volume, 0.9)', 'dollar_volume', 20)}, false)
        AS INTEGER) AS high_volume_event FROM vol""",
    ),
)
register(
    "rows_since_event",
    "WIN-44",
    lambda s, sf: z.rows_since_event(
        z.high_volatility_event(_vol(s, sf)), "high_vol_event", "days_since_high_vol"
    ).select("instrument", "date", "days_since_high_vol"),
    with_ctes([*_BASE, _HV], f"SELECT instrument, date, {_SINCE.format(f='high_vol_event')} AS days_since_high_vol FROM hv"),
)


def _pr_sql(n):
    return f"""CASE WHEN count(vol_cc_20d) OVER {_frame(n)} = {n} THEN
      (len(list_filter(list(vol_cc_20d) OVER {_frame(n)}, lambda e: e < vol_cc_20d))
       + (len(list_filter(list(vol_cc_20d) OVER {_frame(n)}, lambda e: e = vol_cc_20d)) + 1) / 2.0) / {n} END"""


_PR = "pr AS (SELECT instrument, date, " + ", ".join(f"{_pr_sql(n)} AS vol_regime_{n}d" for n in (60, 126, 252)) + " FROM vol)"
register(
    "rolling_percent_rank",
    "WIN-45",
    lambda s, sf: rounded(
        z.rolling_percent_rank(_vol(s, sf), "vol_cc_20d").select(
            "instrument", "date", *[f"vol_regime_{n}d" for n in (60, 126, 252)]
        ),
        9,
    ),
    with_ctes(
        [*_BASE, _PR],
        "SELECT instrument, date, " + ", ".join(r(f"vol_regime_{n}d", f"vol_regime_{n}d", 9) for n in (60, 126, 252)) + " FROM pr",
    ),
)
_PR60 = f"pr AS (SELECT instrument, date, {_pr_sql(60)} AS p FROM vol)"
_CLS = """cls AS (SELECT *, CASE WHEN p <= 0.33 THEN 'low_vol' WHEN p <= 0.66 THEN 'med_vol' WHEN p <= 1 THEN 'high_vol' END AS c FROM pr)"""


def _class(s, sf):
    return z.volatility_class(z.rolling_percent_rank(_vol(s, sf), "vol_cc_20d", (60,)), "vol_regime_60d")


register(
    "volatility_class",
    "WIN-46",
    lambda s, sf: _class(s, sf).select("instrument", "date", "vol_regime_60d_class"),
    with_ctes([*_BASE, _PR60, _CLS], "SELECT instrument, date, c AS vol_regime_60d_class FROM cls"),
)
register(
    "volatility_class_changed",
    "WIN-47",
    lambda s, sf: z.changed_flag(_class(s, sf), "vol_regime_60d_class", "vol_regime_changed").select(
        "instrument", "date", "vol_regime_changed"
    ),
    with_ctes(
        [*_BASE, _PR60, _CLS],
        f"""SELECT instrument, date, CAST(CASE WHEN row_number() OVER ({_W}) = 1 THEN true
        ELSE c IS DISTINCT FROM lag(c) OVER ({_W}) END AS INTEGER) AS vol_regime_changed FROM cls""",
    ),
)
register(
    "trend_class",
    "WIN-48 FN-5",
    lambda s, sf: z.trend_class(_vol(s, sf)).select("instrument", "date", "trend_regime"),
    with_ctes(
        _BASE,
        """SELECT instrument, date, CASE WHEN return_21d <= -0.02 THEN 'downtrend' WHEN return_21d <= 0.02 THEN 'sideways'
        WHEN return_21d > 0.02 THEN 'uptrend' END AS trend_regime FROM vol""",
    ),
)
register(
    "fill_both_ways",
    "WIN-49 FN-4",
    lambda s, sf: rounded(
        z.fill_both_ways(v.dirty_bars(s, sf), ["close", "volume"]).select("instrument", "date", "close", "volume"), 8
    ),
    with_ctes(
        v.dirty_bars_sql(),
        f"""SELECT instrument, date, {r(f"coalesce(last_value(close IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(close IGNORE NULLS) OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))", 'close', 8)},
        coalesce(last_value(volume IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(volume IGNORE NULLS) OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS volume FROM bars""",
    ),
)
