"""Queries across instruments, and the flagship ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import cross_section as x
from tickloom.operators import technical as t
from tickloom.plans import views as v
from tickloom.plans.registry import query, r, register, rounded, with_ctes
from tickloom.session import materialise

_W = "PARTITION BY instrument ORDER BY date"


def _frame(n: int) -> str:
    return f"({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _full(agg: str, c: str, n: int) -> str:
    return f"CASE WHEN count({c}) OVER {_frame(n)} = {n} THEN {agg} OVER {_frame(n)} END"


_RET = f"""
ret AS (
  SELECT *, ln(close_adj / lag(close_adj) OVER ({_W})) AS log_return FROM bars)"""
_BENCH = "bench AS (SELECT date, coalesce(avg(log_return), 0) AS benchmark_return FROM ret GROUP BY date)"


def _panel(spark, sf, by="type"):
    b = t.returns(v.bars(spark, sf, by))
    return x.join_benchmark(b, x.market_return(b))


register(
    "equal_weight_market_return",
    "AGG-1",
    lambda s, sf: rounded(x.market_return(t.returns(v.bars(s, sf))), 8),
    with_ctes([v.bars_sql(), _RET, _BENCH], f"SELECT date, {r('benchmark_return', 'benchmark_return', 8)} FROM bench"),
)


def _single(s, sf):
    b = t.returns(v.bars(s, sf))
    return rounded(x.single_benchmark(b).select("instrument", "date", "benchmark_return"), 8)


register(
    "single_series_benchmark",
    "AGG-1",
    _single,
    with_ctes(
        [v.bars_sql(), _RET],
        f"""SELECT instrument, date, {r("coalesce(" + _full('avg(log_return)', 'log_return', 5) + ", 0) * 0.8", 'benchmark_return', 8)}
        FROM ret""""",
    ),
)
register(
    "benchmark_join",
    "JOIN-1",
    lambda s, sf: rounded(_panel(s, sf).select("instrument", "date", "log_return", "benchmark_return"), 8),
    with_ctes(
        [v.bars_sql(), _RET, _BENCH],
        f"SELECT instrument, date, {r('log_return', 'log_return', 8)}, {r('benchmark_return', 'benchmark_return', 8)} "
        "FROM ret LEFT JOIN bench USING (date)",
    ),
)

_PAIR = """
pair AS (
  SELECT r.*, benchmark_return, CASE WHEN log_return IS NOT NULL AND benchmark_return IS NOT NULL THEN log_return END AS y,
         CASE WHEN log_return IS NOT NULL AND benchmark_return IS NOT NULL THEN benchmark_return END AS x
  FROM ret r LEFT JOIN bench USING (date))"""


def _obs(n):
    return max(20, n // 3)


def _beta_sql(n):
    return (
        f"CASE WHEN count(x) OVER {_frame(n)} >= {_obs(n)} AND var_samp(x) OVER {_frame(n)} > 1e-10 "
        f"THEN covar_samp(x, y) OVER {_frame(n)} / var_samp(x) OVER {_frame(n)} END"
    )


_BETA = (
    "beta AS (SELECT *, "
    + ", ".join(f"{_beta_sql(n)} AS beta_{n}d" for n in x.BETA_WINDOWS)
    + " FROM pair)"
)
_ALPHA = (
    "alpha AS (SELECT *, "
    + ", ".join(f"log_return - beta_{n}d * benchmark_return AS alpha_{n}d" for n in x.BETA_WINDOWS)
    + " FROM beta)"
)
_BCTES = [v.bars_sql(), _RET, _BENCH, _PAIR, _BETA, _ALPHA]


def _beta_query(name, covers, build, exprs):
    register(
        name,
        covers,
        lambda s, sf: rounded(build(_panel(s, sf)).select("instrument", "date", *exprs), 5),
        with_ctes(
            _BCTES, "SELECT instrument, date, " + ", ".join(r(e, c, 5) for c, e in exprs.items()) + " FROM alpha"
        ),
    )


_beta_query("rolling_beta", "WIN-21", x.beta_alpha, {f"beta_{n}d": f"beta_{n}d" for n in x.BETA_WINDOWS})
_beta_query("rolling_alpha", "WIN-22", x.beta_alpha, {f"alpha_{n}d": f"alpha_{n}d" for n in x.BETA_WINDOWS})
_beta_query(
    "idiosyncratic_volatility",
    "WIN-23",
    lambda p: x.idiosyncratic_volatility(x.beta_alpha(p)),
    {
        f"idio_vol_{n}d": f"{_full(f'stddev_samp(alpha_{n}d)', f'alpha_{n}d', n)} * sqrt(252)"
        for n in x.BETA_WINDOWS
    },
)
_beta_query(
    "rolling_r_squared",
    "WIN-24",
    x.r_squared,
    {
        f"r_squared_{n}d": f"CASE WHEN count(x) OVER {_frame(n)} >= {_obs(n)} "
        f"THEN pow(corr(x, y) OVER {_frame(n)}, 2) END"
        for n in x.BETA_WINDOWS
    },
)

# ---- ranks ----------------------------------------------------------------------------

_FEATS = x.RANK_FEATURES


def _rank_panel(spark, sf):
    """Ranking reads its input three times, so the feature panel is written once."""
    b = t.returns(v.bars(spark, sf, "supplier", "week"))
    b = t.rolling_returns(b, (21, 63, 126))
    return materialise(t.close_volatility(b, (20, 60)).select("instrument", "date", *_FEATS), "rank-panel")


_RANK_CTES = [
    v.bars_sql("supplier", "week"),
    _RET,
    "feat AS (SELECT instrument, date, "
    + ", ".join(f"{_full('sum(log_return)', 'log_return', n)} AS return_{n}d" for n in (21, 63, 126))
    + ", "
    + ", ".join(f"{_full('stddev_samp(log_return)', 'log_return', n)} * sqrt(252) AS vol_cc_{n}d" for n in (20, 60))
    + " FROM ret)",
    "lng AS ("
    + " UNION ALL ".join(
        f"SELECT instrument, date, '{f}' AS feature, {f} AS value FROM feat WHERE {f} IS NOT NULL" for f in _FEATS
    )
    + ")",
    """
rnk AS (
  SELECT *, rank() OVER (PARTITION BY feature, date ORDER BY value)
            + (count(*) OVER (PARTITION BY feature, date, value) - 1) / 2.0 AS rank,
         count(*) OVER (PARTITION BY feature, date) AS n FROM lng)""",
    "pct AS (SELECT *, rank / n AS pct_rank FROM rnk)",
]


def _rank_query(name, covers, cols, body, digits=6, extra=()):
    register(
        name,
        covers,
        lambda s, sf: rounded(
            x.cross_ranks(_rank_panel(s, sf), measures=cols).select("instrument", "date", "feature", *cols), digits
        ),
        with_ctes([*_RANK_CTES, *extra], body),
    )


_rank_query(
    "cross_percent_rank",
    "WIN-25",
    ["pct_rank"],
    f"SELECT instrument, date, feature, {r('pct_rank', 'pct_rank', 9)} FROM pct",
    9,
)
_rank_query(
    "cross_rank", "WIN-26", ["rank"], f"SELECT instrument, date, feature, {r('rank', 'rank')} FROM pct"
)
_rank_query(
    "cross_zscore",
    "WIN-27",
    ["zscore"],
    f"""SELECT instrument, date, feature, {r('''(value - avg(value) OVER (PARTITION BY feature, date))
        / (stddev_samp(value) OVER (PARTITION BY feature, date) + 1e-10)''', 'zscore', 5)} FROM lng""",
    5,
)
_rank_query(
    "cross_decile",
    "WIN-28",
    ["decile"],
    """SELECT l.instrument, l.date, l.feature,
        CAST(1 + len(list_filter(q, lambda e: e < l.value)) AS INTEGER) AS decile
        FROM lng l JOIN edges USING (feature, date)""",
    extra=[
        "edges AS (SELECT feature, date, quantile_cont(value, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS q "
        "FROM lng GROUP BY 1, 2)"
    ],
)


@query(
    "composite_ranks",
    "WIN-29",
    with_ctes(
        [
            *_RANK_CTES,
            "wide AS (SELECT instrument, date, "
            + ", ".join(f"max(CASE WHEN feature = '{f}' THEN pct_rank END) AS {f}" for f in _FEATS)
            + " FROM pct GROUP BY 1, 2)",
        ],
        f"""SELECT instrument, date, {r('list_avg(list_filter([return_21d, return_63d, return_126d], lambda e: e IS NOT NULL))', 'momentum_composite_rank', 9)},
        {r('(1 - vol_cc_20d + 1 - vol_cc_60d) / 2', 'quality_composite_rank', 9)} FROM wide""",
    ),
)
def _composite(s, sf):
    long = x.cross_ranks(_rank_panel(s, sf), measures=["pct_rank"])
    wide = x.widen(long, _FEATS, {"pct_rank": "rank"})
    return rounded(
        x.composite_ranks(wide).select(
            "instrument", "date", "momentum_composite_rank", "quality_composite_rank"
        ),
        9,
    )


_UNI = f"""
uni AS (
  SELECT instrument, date, close_adj >= 2000 AS universe_price_filter, volume * close_adj >= 100000 AS universe_volume_filter,
         count(close_adj) OVER {_frame(21)} AS trading_days_21d,
         count(close_adj) OVER {_frame(21)} >= 15 AS universe_activity_filter FROM bars),
inu AS (SELECT *, universe_price_filter AND universe_volume_filter AND universe_activity_filter AS in_universe FROM uni)"""


@query("universe_flags", "SEL-10", with_ctes([v.bars_sql("supplier", "week"), _UNI], "SELECT * FROM inu"))
def _universe(s, sf):
    b = x.universe_flags(v.bars(s, sf, "supplier", "week"), min_price=2000.0)
    return b.select(
        "instrument",
        "date",
        "universe_price_filter",
        "universe_volume_filter",
        "trading_days_21d",
        "universe_activity_filter",
        "in_universe",
    )


@query(
    "universe_size",
    "AGG-2",
    with_ctes(
        [v.bars_sql("supplier", "week"), _UNI],
        """SELECT instrument, date, in_universe,
        CAST(sum(CAST(in_universe AS INTEGER)) OVER (PARTITION BY date) AS BIGINT) AS universe_size FROM inu""",
    ),
)
def _usize(s, sf):
    b = x.universe_flags(v.bars(s, sf, "supplier", "week"), min_price=2000.0)
    return x.universe_size(b).select("instrument", "date", "in_universe", "universe_size")


# ---- flagship -------------------------------------------------------------------------


@query(
    "latest_volatility_leaders",
    "WIN-2 WIN-4 WIN-25 TOP-1 TOP-7",
    with_ctes(
        [
            v.bars_sql("brand"),
            _RET,
            f"vol AS (SELECT instrument, date, {_full('stddev_samp(log_return)', 'log_return', 20)} * sqrt(252) AS vol_cc_20d FROM ret)",
            """rk AS (SELECT *, (rank() OVER (PARTITION BY date ORDER BY vol_cc_20d)
               + (count(*) OVER (PARTITION BY date, vol_cc_20d) - 1) / 2.0) / count(*) OVER (PARTITION BY date) AS pct_rank,
               row_number() OVER (PARTITION BY instrument ORDER BY date DESC) AS rn FROM vol WHERE vol_cc_20d IS NOT NULL)""",
        ],
        f"""SELECT instrument, date, {r('vol_cc_20d', 'vol_cc_20d')}, {r('pct_rank', 'pct_rank')}
        FROM rk WHERE rn = 1 ORDER BY rk.vol_cc_20d DESC, instrument LIMIT 10""",
    ),
)
def _leaders(s, sf):
    """Latest bar per brand with its volatility rank of that date; the ten most volatile."""
    b = t.close_volatility(t.returns(v.bars(s, sf, "brand")), (20,))
    ranked = x.cross_ranks(b, ["vol_cc_20d"], ["pct_rank"])
    latest = ranked.groupBy("instrument").agg(
        F.max_by(F.struct("date", "value", "pct_rank"), "date").alias("b")
    )
    return rounded(
        latest.select(
            "instrument",
            F.col("b.date").alias("date"),
            F.col("b.value").alias("vol_cc_20d"),
            F.col("b.pct_rank").alias("pct_rank"),
        )
        .orderBy(F.desc("vol_cc_20d"), "instrument")
        .limit(10)
    )
