"""Chained stages as one plan."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.operators import technical as t
from tickloom.operators.peers import MOMENTUM_WINDOWS
from tickloom.plans import stages as st
from tickloom.plans import views as v
from tickloom.plans.registry import r, register, rounded, with_ctes

_W = "PARTITION BY instrument ORDER BY date"


def _chain(s, sf):
    """A user stage between built-in ones: returns -> spread of the day -> targets."""

    def day_range(df):
        return df.withColumn("day_range", F.log(F.col("high") / F.col("low")))

    st.stage("day_range", ("high", "low"))(day_range)
    st.stage("returns", ("instrument", "date", "close_adj"))(t.returns)
    out = st.run_stages(v.bars(s, sf), ["returns", "day_range", "season", "targets"], {"targets": {"horizons": (5,)}}, tables=False)
    return rounded(out.select("instrument", "date", "log_return", "day_range", "turn_of_month", "month_end", "target_return_5d", "target_class_5d"))


register(
    "stage_chain",
    "UDF-1",
    _chain,
    with_ctes(
        [
            v.bars_sql(),
            f"fr AS (SELECT *, ln(close_adj / lag(close_adj) OVER ({_W})) AS log_return, ln(high / low) AS day_range, lead(close_adj, 5) OVER ({_W}) / close_adj - 1 AS y FROM bars)",
            "q AS (SELECT instrument, quantile_cont(y, [0.3, 0.7]) AS e FROM fr GROUP BY 1)",
            "d AS (SELECT DISTINCT date, date_trunc('month', date) AS p FROM bars)",
            """tm AS (SELECT date, CAST((row_number() OVER (PARTITION BY p ORDER BY date) <= 3 OR row_number() OVER (PARTITION BY p ORDER BY date DESC) <= 3)
              AND count(*) OVER (PARTITION BY p) >= 6 AS INTEGER) AS turn_of_month FROM d)""",
        ],
        f"""SELECT instrument, date, {r('log_return', 'log_return')}, {r('day_range', 'day_range')}, turn_of_month, CAST(date = last_day(date) AS INTEGER) AS month_end,
        {r('y', 'target_return_5d')}, CASE WHEN y <= e[1] THEN -1 WHEN y >= e[2] THEN 1 ELSE 0 END AS target_class_5d FROM fr JOIN q USING (instrument) JOIN tm USING (date)""",
    ),
)


def _full_chain(s, sf):
    """Hygiene through targets on every type's daily bars."""
    out = st.run_stages(
        v.bars(s, sf), ["hygiene", "base_features", "cross_section", "season", "regimes", "targets"], {"hygiene": {"min_volume": 1}}
    )
    return rounded(
        out.select(
            "instrument", "date", "data_quality_score", "log_return", "vol_cc_20d", "ema_12", "rsi_14", "beta_60d", "return_21d_rank", "regime_id", "target_return_5d"
        ),
        5,
    )


register("full_stage_chain", "UDF-1", _full_chain)


def _peer_chain(s, sf):
    """Returns, peers, their features, news and an out-of-fold prediction on weekly bars of every brand."""
    from tickloom.plans import news_queries as nq

    news = nq._scored(s, sf)
    bars = t.returns(v.bars(s, sf, "brand", "week")).withColumn("next_return", F.lead("log_return").over(Window.partitionBy("instrument").orderBy("date")))
    out = st.run_stages(
        bars,
        ["relationships", "target_features", "news_sentiment", "training"],
        {
            "relationships": {"min_abs": 0.1},
            "target_features": {"min_abs": 0.1},
            "news_sentiment": {"news": news},
            "training": {"features": ["log_return", "volume"], "label": "next_return"},
        },
    )
    gaps = [f"{c}_{n}d" for n in MOMENTUM_WINDOWS for c in ("avg_peer_momentum", "momentum_vs_peers")]
    return rounded(out.select("instrument", "date", "n_peers", "peer_correlation", *gaps, "sentiment_mean", "prediction"), 5)


register("peer_stage_chain", "UDF-1", _peer_chain)
