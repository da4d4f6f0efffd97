"""Queries for the documented methodology."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import corporate_events as ce
from tickloom.operators import cross_section as x
from tickloom.operators import news as nw
from tickloom.operators import peers as p
from tickloom.operators import relationships as rel
from tickloom.operators import research as rs
from tickloom.operators import season as z
from tickloom.operators import technical as t
from tickloom.plans import hygiene_queries as hq
from tickloom.plans import model_queries as mq
from tickloom.plans import news_queries as nq
from tickloom.plans import relationship_queries as rq
from tickloom.plans import target_queries as tq
from tickloom.plans import views as v
from tickloom.plans.registry import query, r, register, rounded, with_ctes

_W = "PARTITION BY instrument ORDER BY date"
_F = mq._ALL
_BASE = mq._BASE
_LNG = "lng AS (" + " UNION ALL ".join(f"SELECT instrument, date, '{f}' AS feature, {f} AS value, y FROM mf" for f in _F) + ")"
_G = "PARTITION BY instrument, feature ORDER BY date"

register(
    "information_coefficient",
    "DOC-1",
    lambda s, sf: rounded(rs.information_coefficient(mq._data(s, sf), _F, "y"), 5),
    with_ctes(
        [
            *_BASE,
            _LNG,
            """rk AS (SELECT feature, rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS rx,
              rank() OVER (PARTITION BY feature ORDER BY y) + (count(*) OVER (PARTITION BY feature, y) - 1) / 2.0 AS ry FROM lng WHERE value IS NOT NULL AND y IS NOT NULL)""",
            "ed AS (SELECT feature, count(*) AS n, corr(rx, ry) AS rho FROM rk GROUP BY 1)",
            rq.P_VALUES,
        ],
        f"SELECT feature, n, {r('abs(rho)', 'ic', 5)}, {r('greatest(p, 0)', 'p_value', 5)} FROM pv",
    ),
)
register(
    "feature_stability",
    "DOC-2",
    lambda s, sf: rounded(rs.feature_stability(mq._data(s, sf), _F), 5),
    with_ctes(
        [
            *_BASE,
            _LNG,
            f"lb AS (SELECT *, row_number() OVER ({_G}) - 1 AS i, count(*) OVER (PARTITION BY instrument, feature) AS len, lag(value, 252) OVER ({_G}) AS b FROM lng )",
            f"cc AS (SELECT *, CASE WHEN count(value) OVER f > 50 AND count(b) OVER f > 50 THEN corr(b, value) OVER f END AS c FROM lb WINDOW f AS ({_G} ROWS BETWEEN 251 PRECEDING AND CURRENT ROW))",
        ],
        f"SELECT instrument, feature, count(*) AS windows, {r('avg(c)', 'stability', 5)} FROM cc WHERE c IS NOT NULL AND i >= 503 AND (i - 503) % 21 = 0 AND i - 503 < len - 504 GROUP BY 1, 2",
    ),
)


_NAMES = ("momentum_a", "momentum_b", "rank_a", "log_spread", "basket_x", "rsi_14", "macd", "atr_9", "vol_regime", "month_sin", "other")
_IMP = f"imp AS (SELECT {list(_NAMES)!r}[CAST(k % 11 + 1 AS INTEGER)] || '_' || k AS feature, avg(value) AS importance FROM ev GROUP BY k)"


def _synthetic_importance(s, sf):
    """Scores per property key of the events, under feature-like names."""
    e = v.event_days(s, sf).groupBy("k").agg(F.avg("value").alias("importance"))
    name = F.element_at(F.array(*[F.lit(n) for n in _NAMES]), F.col("k") % 11 + 1)
    return e.select(F.concat_ws("_", name, F.col("k").cast("string")).alias("feature"), "importance")


register(
    "balanced_selection",
    "DOC-3",
    lambda s, sf: rounded(rs.balanced_selection(_synthetic_importance(s, sf), 28)),
    with_ctes(
        [
            v.EVENT_DAYS_SQL,
            _IMP,
            """ct AS (SELECT *, CASE WHEN feature LIKE '%momentum%' THEN 'momentum' WHEN feature LIKE '%reversion%' OR feature LIKE '%rank%' THEN 'mean_reversion'
              WHEN feature LIKE '%spread%' THEN 'spread' WHEN feature LIKE '%basket%' THEN 'basket' WHEN regexp_matches(feature, 'rsi|macd|bollinger|atr') THEN 'technical'
              WHEN feature LIKE '%regime%' THEN 'regime' WHEN regexp_matches(feature, 'dow|month|seasonal') THEN 'seasonal' END AS category FROM imp)""",
        ],
        f"""SELECT feature, {r('importance', 'importance')}, category, row_number() OVER (PARTITION BY category ORDER BY ct.importance DESC, feature) AS place FROM ct WHERE category IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY category ORDER BY ct.importance DESC, feature) <= 4""",
    ),
)
_CF = ("sma_10", "sma_20", "ret", "range_hl")


def _corr_data(s, sf):
    b = t.returns(t.moving_averages(v.bars(s, sf), (10, 20)))
    return b.select("instrument", "date", "sma_10", "sma_20", F.col("log_return").alias("ret"), F.log(F.col("high") / F.col("low")).alias("range_hl"))


_CD = f"""cd AS (SELECT * FROM (SELECT instrument, date, {mq._full('avg(close_adj)', 'close_adj', 10)} AS sma_10, {mq._full('avg(close_adj)', 'close_adj', 20)} AS sma_20, log_return AS ret, ln(high / low) AS range_hl FROM ret)
  WHERE sma_10 IS NOT NULL AND sma_20 IS NOT NULL AND ret IS NOT NULL)"""
register(
    "correlated_features",
    "DOC-4",
    lambda s, sf: rounded(rs.correlated_features(_corr_data(s, sf), _CF, 0.6)),
    with_ctes(
        [v.bars_sql(), mq._RET, _CD],
        " UNION ALL ".join(
            f"SELECT '{f}' AS feature, {r(w, 'max_correlation')}, {w} > 0.6 AS dropped FROM cd"
            for j, f in enumerate(_CF)
            for w in ["greatest(max(0.0), " + ", ".join([f"abs(corr({_CF[i]}, {f}))" for i in range(j)] or ["0.0"]) + ")"]
        ),
    ),
)
_SF = """
nb AS (SELECT *, row_number() OVER (PARTITION BY instrument, feature ORDER BY date) - 1 AS i, count(*) OVER (PARTITION BY instrument, feature) AS cnt FROM lng WHERE value IS NOT NULL AND y IS NOT NULL),
fd AS (SELECT *, CAST(greatest(0, floor((i - (cnt - 5 * (cnt // 6))) / (cnt // 6)) + 1) AS INTEGER) AS fold FROM nb),
kk AS (SELECT unnest(range(1, 6)) AS fold),
tr AS (SELECT f.instrument, f.feature, k.fold, regr_sxy(y, value) / (regr_sxx(y, value) + 1) AS b, avg(value) AS mx, avg(y) AS my FROM fd f JOIN kk k ON f.fold < k.fold GROUP BY 1, 2, 3),
ms AS (SELECT f.instrument, f.feature, f.fold, avg(pow(y - (my + b * (value - mx)), 2)) AS e FROM fd f JOIN tr USING (instrument, feature, fold) GROUP BY 1, 2, 3)"""
register(
    "single_feature_scores",
    "DOC-5",
    lambda s, sf: rounded(rs.single_feature_scores(mq._data(s, sf), _F, "y"), 4),
    with_ctes([*_BASE, _LNG, _SF], f"SELECT instrument, feature, {r('avg(e)', 'mse', 4)} FROM ms GROUP BY 1, 2"),
)


@query(
    "combined_importance",
    "DOC-6",
    with_ctes(
        [
            *_BASE,
            "im AS (" + " UNION ALL ".join(f"SELECT '{f}' AS feature, abs(corr({f}, y)) + abs(regr_r2(y, {f})) AS s FROM mf" for f in _F) + ")",
        ],
        f"SELECT feature, {r('s / (SELECT max(s) FROM im)', 'importance')} FROM im",
    ),
)
def _combined(s, sf):
    d = mq._data(s, sf)
    a = d.agg(*[F.abs(F.corr(f, "y")).alias(f) for f in _F]).unpivot([], list(_F), "feature", "score").withColumn("method", F.lit("correlation"))
    b = d.agg(*[F.abs(F.regr_r2("y", f)).alias(f) for f in _F]).unpivot([], list(_F), "feature", "score").withColumn("method", F.lit("fit"))
    return rounded(rs.combined_importance(a.unionByName(b)))


_PH = f"""
ph AS (SELECT instrument, date, feature, CAST((i - 251) / 21 + 1 AS INTEGER) AS period, c AS correlation FROM (
  SELECT *, row_number() OVER ({_G}) - 1 AS i, count(*) OVER (PARTITION BY instrument, feature) AS len, CASE WHEN count(value + y) OVER f > 2 THEN corr(value, y) OVER f END AS c FROM lng
  WINDOW f AS ({_G} ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)) WHERE i >= 251 AND (i - 251) % 21 = 0 AND i < len - 1)"""
register(
    "performance_history",
    "DOC-7",
    lambda s, sf: rounded(rs.performance_history(mq._data(s, sf), _F, "y"), 5),
    with_ctes([*_BASE, _LNG, _PH], f"SELECT instrument, date, feature, period, {r('correlation', 'correlation', 5)} FROM ph "),
)
register(
    "feature_decay",
    "DOC-7",
    lambda s, sf: rounded(rs.feature_decay(rs.performance_history(mq._data(s, sf), _F, "y")), 4),
    with_ctes(
        [
            *_BASE,
            _LNG,
            _PH,
            f"""dc AS (SELECT instrument, feature, avg(correlation) FILTER (period > l - 4) AS rec, avg(correlation) FILTER (period <= l - 4) AS his FROM
              (SELECT *, max(period) OVER (PARTITION BY instrument, feature) AS l FROM ph ) GROUP BY 1, 2 HAVING count(*) >= 4)""",
        ],
        f"SELECT instrument, feature, {r('rec', 'recent', 4)}, {r('his', 'historical', 4)}, {r('(his - rec) / his', 'decay_rate', 4)}, coalesce((his - rec) / his > 0.1, false) AS decaying FROM dc",
    ),
)
register(
    "reversion_pressure",
    "DOC-9",
    lambda s, sf: rounded(rs.reversion_pressure(rel.cointegration(rq._smooth(s, sf))).select("instrument_i", "instrument_j", "reversion_pressure"), 5),
    with_ctes(rq._CB, f"SELECT instrument_i, instrument_j, {r('-current_z_score / half_life', 'reversion_pressure', 5)} FROM cp"),
)


@query(
    "rows_since_wide_spread",
    "DOC-9",
    with_ctes(
        [
            *tq._CT,
            f"""sz AS (SELECT target, peer, date, t, coalesce(abs((spread - {tq._Z[20][0]}) / ({tq._Z[20][1]} + 1e-8)) > 2, false) AS hit, row_number() OVER (PARTITION BY target, peer ORDER BY date) - 1 AS n FROM rows_)""",
        ],
        """SELECT target, peer, date, CAST(coalesce(n - max(CASE WHEN hit THEN n END) OVER (PARTITION BY target, peer ORDER BY date ROWS BETWEEN 90 PRECEDING AND CURRENT ROW), 90) AS INTEGER) AS rows_since_wide FROM sz""",
    ),
)
def _since(s, sf):
    sp = p.spreads(tq._cal(s, sf), tq._peers(s, sf), (20,))
    sp = sp.withColumn("wide", F.coalesce(F.abs("spread_zscore_20d") > 2, F.lit(False)).cast("int"))
    return z.rows_since_event(sp, "wide", "rows_since_wide", keys=("target", "peer")).select("target", "peer", "date", "rows_since_wide")


# ---- news, macro, fundamentals -------------------------------------------------------------------

_N = [nq._SC, nq._DAY]
_CZ = f"CASE WHEN count(c) OVER f = 10 THEN (c - avg(c) OVER f) / nullif(stddev_samp(c) OVER f, 0) END"
_CZW = f"WINDOW f AS ({_W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"


def _day(s, sf):
    return nw.daily_sentiment(nq._scored(s, sf)).select("instrument", "date", "article_count", "sentiment_mean")


register(
    "news_count_shock",
    "DOC-10 DOC-25",
    lambda s, sf: rounded(rs.news_shock(_day(s, sf), 10).select("instrument", "date", "count_zscore", "news_volume_shock")),
    with_ctes(
        [*_N, f"cz AS (SELECT instrument, date, {_CZ} AS z FROM dy {_CZW})"],
        f"SELECT instrument, date, {r('z', 'count_zscore')}, coalesce(z > 2, false) AS news_volume_shock FROM cz",
    ),
)
register(
    "sentiment_delta",
    "DOC-10",
    lambda s, sf: rounded(rs.sentiment_delta(_day(s, sf)).select("instrument", "date", "sentiment_delta")),
    with_ctes(
        [
            *_N,
            f"dn AS (SELECT *, row_number() OVER ({_W}) - 1 AS n FROM dy)",
            f"em(instrument, date, n, e, m) AS (SELECT instrument, date, n, m, m FROM dn WHERE n = 0 UNION ALL SELECT d.instrument, d.date, d.n, {1 - 2 / 11!r} * em.e + {2 / 11!r} * d.m, d.m FROM em JOIN dn d ON d.instrument = em.instrument AND d.n = em.n + 1)",
        ],
        f"SELECT instrument, date, {r('m - e', 'sentiment_delta')} FROM em",
        recursive=True,
    ),
)
_PANEL = """
pw AS (SELECT date, max(value) FILTER (symbol = '1-URGENT') AS a, max(value) FILTER (symbol = '2-HIGH') AS b FROM econ WHERE symbol IN ('1-URGENT', '2-HIGH') GROUP BY 1),
pf AS (SELECT date, last_value(a IGNORE NULLS) OVER w AS v0, last_value(b IGNORE NULLS) OVER w AS v1 FROM pw WINDOW w AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
pn AS (SELECT *, v0 - v1 AS slope, v0 - lag(v0) OVER (ORDER BY date) AS d0, v1 - lag(v1) OVER (ORDER BY date) AS d1, v0 - v1 - lag(v0 - v1) OVER (ORDER BY date) AS ds FROM pf)"""
register(
    "macro_factor_panel",
    "DOC-11",
    lambda s, sf: rounded(rs.macro_panel(v.econ(s, sf), "1-URGENT", "2-HIGH"), 2),
    with_ctes(
        [v.ECON_SQL, _PANEL],
        f"SELECT date, {', '.join(r(c, n, 2) for c, n in (('v0', 'v0'), ('v1', 'v1'), ('slope', 'slope'), ('d0', 'delta_v0'), ('d1', 'delta_v1'), ('ds', 'delta_slope')))} FROM pn",
    ),
)
register(
    "macro_as_of_join",
    "DOC-11",
    lambda s, sf: rounded(
        rs.as_of_panel(v.bars(s, sf).select("instrument", "date", "volume"), rs.macro_panel(v.econ(s, sf), "1-URGENT", "2-HIGH"), ["slope"]), 2
    ),
    with_ctes(
        [v.bars_sql(), v.ECON_SQL, _PANEL],
        f"SELECT instrument, b.date, volume, {r('slope', 'slope', 2)} FROM bars b ASOF LEFT JOIN pn ON b.date >= pn.date",
    ),
)
register(
    "economic_surprise",
    "DOC-11",
    lambda s, sf: rounded(
        rs.surprise(
            v.econ(s, sf).withColumn("consensus", F.lag("value").over(p.Window.partitionBy("symbol").orderBy("date"))), "value", "consensus", ["symbol"]
        ).select("symbol", "date", "surprise"),
        5,
    ),
    with_ctes(
        [v.ECON_SQL, "ec AS (SELECT symbol, date, value - lag(value) OVER (PARTITION BY symbol ORDER BY date) AS d FROM econ)"],
        f"SELECT symbol, date, {r('d / stddev_samp(d) OVER (PARTITION BY symbol)', 'surprise', 5)} FROM ec",
    ),
)
_FUND = ("pe_ratio", "revenue_growth", "earnings_surprise")


def _fundamentals(s, sf):
    b = v.event_bars(s, sf)
    return b.select(
        "instrument", "date", F.col("close").alias("pe_ratio"), F.try_divide("high", "open").alias("revenue_growth"), F.col("volume").cast("double").alias("earnings_surprise")
    )


def _pr(c):
    """Percent rank among the values of the date; a NULL has no rank and is not counted."""
    return f"""CASE WHEN {c} IS NOT NULL THEN (rank() OVER (PARTITION BY date ORDER BY {c} NULLS LAST)
      + (count(*) OVER (PARTITION BY date, {c}) - 1) / 2.0) / count({c}) OVER (PARTITION BY date) END"""


@query(
    "fundamental_ranks",
    "DOC-16",
    with_ctes(
        [
            v.EVENT_BARS_SQL,
            "fu AS (SELECT instrument, date, close AS pe_ratio, high / nullif(open, 0) AS revenue_growth, CAST(volume AS DOUBLE) AS earnings_surprise FROM ebars)",
            "fr AS (SELECT instrument, date, " + ", ".join(f"{_pr(c)} AS {c}_rank" for c in _FUND) + " FROM fu)",
            "fs AS (SELECT *, (pe_ratio_rank + revenue_growth_rank + earnings_surprise_rank) / 3 AS fundamental_score FROM fr)",
        ],
        "SELECT instrument, date, " + ", ".join(r(f"{c}_rank", f"{c}_rank", 8) for c in _FUND) + f", {r('fundamental_score', 'fundamental_score', 8)} FROM fs",
    ),
)
def _fund_ranks(s, sf):
    wide = x.widen(x.cross_ranks(_fundamentals(s, sf), _FUND, ["pct_rank"]), _FUND, {"pct_rank": "rank"})
    total = (F.col("pe_ratio_rank") + F.col("revenue_growth_rank") + F.col("earnings_surprise_rank")) / 3
    return rounded(wide.withColumn("fundamental_score", total), 8)


@query(
    "earnings_windows",
    "DOC-17",
    with_ctes(
        [
            v.EVENT_BARS_SQL,
            v.EVENT_DAYS_SQL,
            hq._EARN,
            """nx AS (SELECT b.instrument, b.date, min(e.date - b.date) AS d FROM ebars b LEFT JOIN earn e ON e.instrument = b.instrument AND e.date >= b.date GROUP BY 1, 2),
            pv AS (SELECT b.instrument, b.date, min(b.date - e.date) AS d FROM ebars b LEFT JOIN earn e ON e.instrument = b.instrument AND e.date <= b.date GROUP BY 1, 2)""",
        ],
        """SELECT nx.instrument, nx.date, CAST(nx.d AS INTEGER) AS days_to_earnings, CAST(pv.d AS INTEGER) AS days_since_earnings, coalesce(nx.d <= 3, false) AS earnings_week,
        coalesce(nx.d BETWEEN 1 AND 5, false) AS pre_earnings, coalesce(pv.d BETWEEN 1 AND 5, false) AS post_earnings,
        nx.instrument IN (SELECT instrument FROM earn) AS has_earnings_data FROM nx JOIN pv USING (instrument, date)""",
    ),
)
def _windows(s, sf):
    return rs.earnings_windows(v.event_bars(s, sf).select("instrument", "date"), hq.earnings(s, sf))


@query(
    "event_conditioned_sentiment",
    "DOC-17",
    with_ctes(
        [
            v.EVENT_BARS_SQL,
            v.EVENT_DAYS_SQL,
            hq._EARN,
            hq._TRD,
            nq._SC,
            nq._DAY,
            """ec AS (SELECT b.instrument, b.date, m, (SELECT min(e.date - b.date) FROM earn e WHERE e.instrument = b.instrument AND e.date >= b.date) AS d,
              coalesce((SELECT sum(CASE WHEN lower(tt) IN ('purchase', 'buy') THEN t.value ELSE -t.value END) / 1000000 FROM trd t WHERE t.instrument = b.instrument AND abs(t.date - b.date) <= 7), 0) AS score
              FROM ebars b LEFT JOIN dy USING (instrument, date))""",
        ],
        f"""SELECT instrument, date, {r('m * CAST(coalesce(d <= 3, false) AS INTEGER)', 'sentiment_earnings_period')}, {r('m * CAST(coalesce(d BETWEEN 1 AND 5, false) AS INTEGER)', 'sentiment_pre_earnings')},
        {r('m - score', 'sentiment_insider_divergence')} FROM ec""",
    ),
)
def _event_sentiment(s, sf):
    b = ce.insider_flags(_windows(s, sf), hq.trades(s, sf)).join(_day(s, sf), ["instrument", "date"], "left")
    return rounded(
        rs.event_sentiment(b).select("instrument", "date", "sentiment_earnings_period", "sentiment_pre_earnings", "sentiment_insider_divergence")
    )


# ---- preparation, drift, screening ---------------------------------------------------------------

_CUTS = ["1998-01-01", "2000-01-01"]


@query(
    "train_only_preparation",
    "DOC-14",
    with_ctes(
        [
            v.bars_sql(),
            mq._RET,
            mq._MODEL,
            """ex AS (SELECT instrument, date, return_5d, vol_cc_20d, 1 AS fold, CASE WHEN date < DATE '1998-01-01' THEN 'train' WHEN date < DATE '2000-01-01' THEN 'test' END AS part FROM mf
              UNION ALL SELECT instrument, date, return_5d, vol_cc_20d, 2, CASE WHEN date < DATE '2000-01-01' THEN 'train' ELSE 'test' END FROM mf),
            me AS (SELECT fold, quantile_cont(return_5d, 0.5) AS a, quantile_cont(vol_cc_20d, 0.5) AS b FROM ex WHERE part = 'train' GROUP BY 1),
            fi AS (SELECT instrument, date, fold, part, coalesce(return_5d, a) AS return_5d, coalesce(vol_cc_20d, b) AS vol_cc_20d FROM ex JOIN me USING (fold) WHERE part IS NOT NULL),
            sc AS (SELECT fold, avg(return_5d) AS ma, stddev_pop(return_5d) AS sa, avg(vol_cc_20d) AS mb, stddev_pop(vol_cc_20d) AS sb FROM fi WHERE part = 'train' GROUP BY 1)""",
        ],
        f"SELECT instrument, date, fold, part, {r('(return_5d - ma) / sa', 'return_5d', 5)}, {r('(vol_cc_20d - mb) / sb', 'vol_cc_20d', 5)} FROM fi JOIN sc USING (fold)",
    ),
)
def _prepared(s, sf):
    d = mq._data(s, sf).select("instrument", "date", *mq._X)
    return rounded(rs.train_only_preparation(rs.expanding_splits(d, _CUTS), mq._X), 5)


register(
    "leakage_audit",
    "DOC-14",
    lambda s, sf: rs.leakage_audit(
        v.bars(s, sf).withColumns({"feature_time": F.col("date"), "label_time": F.lead("date").over(p.Window.partitionBy("instrument").orderBy("date"))}), ["feature_time", "label_time"]
    ),
    with_ctes(
        [v.bars_sql()],
        f"""SELECT 'feature_time' AS column_name, CAST(0 AS BIGINT) AS leaks, false AS leaking UNION ALL
        SELECT 'label_time', count(*) FILTER (l > date), count(*) FILTER (l > date) > 0 FROM (SELECT date, lead(date) OVER ({_W}) AS l FROM bars)""",
    ),
)
register(
    "decile_means",
    "DOC-15",
    lambda s, sf: rounded(rs.decile_means(mq._data(s, sf), "vol_cc_20d", "y"), 5),
    with_ctes(
        [*_BASE, "dq AS (SELECT quantile_cont(vol_cc_20d, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS q FROM mf WHERE vol_cc_20d IS NOT NULL AND y IS NOT NULL)"],
        f"""SELECT CAST(1 + len(list_filter(q, lambda e: e < vol_cc_20d)) AS INTEGER) AS decile, count(*) AS n, {r('avg(y)', 'mean_target', 5)} FROM mf, dq
        WHERE vol_cc_20d IS NOT NULL AND y IS NOT NULL GROUP BY 1""",
    ),
)
_DT = "1998-12-31"
register(
    "feature_drift",
    "DOC-23",
    lambda s, sf: rounded(rs.feature_drift(mq._data(s, sf), _F, _DT), 5),
    with_ctes(
        [
            *_BASE,
            _LNG,
            f"""l2 AS (SELECT * FROM lng ),
            s1 AS (SELECT instrument, feature, avg(value) AS m, stddev_samp(value) AS s, quantile_cont(value, 0.5) AS med FROM l2 WHERE date <= DATE '{_DT}' GROUP BY 1, 2),
            s2 AS (SELECT instrument, feature, quantile_cont(abs(value - med), 0.5) AS mad FROM l2 JOIN s1 USING (instrument, feature) WHERE date <= DATE '{_DT}' AND value IS NOT NULL GROUP BY 1, 2),
            rm AS (SELECT instrument, feature, date, CASE WHEN count(value) OVER f = 60 THEN avg(value) OVER f END AS rm FROM l2 WINDOW f AS ({_G} ROWS BETWEEN 59 PRECEDING AND CURRENT ROW))""",
        ],
        f"""SELECT instrument, feature, date, {r('(rm - m) / s', 'drift_z', 5)}, {r('(rm - med) / (1.4826 * mad)', 'robust_z', 5)}, coalesce(abs((rm - m) / s) > 2, false) AS drifted
        FROM rm JOIN s1 USING (instrument, feature) JOIN s2 USING (instrument, feature)""",
    ),
)
_VF = ("sma_10", "sma_20", "ret")
register(
    "variance_inflation",
    "DOC-24",
    lambda s, sf: rounded(rs.variance_inflation(_corr_data(s, sf), _VF, 1.5), 4),
    with_ctes(
        [
            v.bars_sql(),
            mq._RET,
            _CD,
            "cm AS (SELECT corr(sma_10, sma_20) AS a, corr(sma_10, ret) AS b, corr(sma_20, ret) AS c FROM cd)",
            "dt AS (SELECT *, 1 + 2 * a * b * c - a * a - b * b - c * c AS d FROM cm)",
        ],
        " UNION ALL ".join(
            f"SELECT '{f}' AS feature, {r(f'(1 - {e} * {e}) / d', 'vif', 4)}, (1 - {e} * {e}) / d > 1.5 AS too_high FROM dt" for f, e in zip(_VF, ("c", "b", "a"))
        ),
    ),
)

# ---- rules, turnover, buzz ------------------------------------------------------------------------


@query(
    "economic_staleness_rules",
    "DOC-18",
    with_ctes(
        [v.ECON_SQL, "fq AS (SELECT *, CASE symbol WHEN '1-URGENT' THEN 'Daily' WHEN '2-HIGH' THEN 'Weekly' WHEN '3-MEDIUM' THEN 'Monthly' ELSE 'Annual' END AS frequency FROM econ)"],
        """SELECT *, age_days > limit_days AS is_stale FROM (SELECT symbol, frequency, CAST(DATE '2001-08-20' - max(date) AS INTEGER) AS age_days,
        CASE frequency WHEN 'Daily' THEN 7 WHEN 'Weekly' THEN 14 WHEN 'Monthly' THEN 45 ELSE 400 END AS limit_days FROM fq GROUP BY 1, 2)""",
    ),
)
def _stale(s, sf):
    e = v.econ(s, sf)
    f = F.when(F.col("symbol") == "1-URGENT", "Daily").when(F.col("symbol") == "2-HIGH", "Weekly").when(F.col("symbol") == "3-MEDIUM", "Monthly").otherwise("Annual")
    return rs.stale_by_frequency(e.withColumn("frequency", f), "2001-08-20")


register(
    "news_field_rules",
    "DOC-18",
    lambda s, sf: rs.news_rule_violations(nq._symbol_news(s, sf).withColumn("sentiment_score", F.length("headline") / 100.0)),
    with_ctes(
        [v.ARTICLES_SQL, nq._SN],
        """SELECT 'headline shorter than 10' AS rule, count(*) FILTER (length(headline) < 10) AS n FROM sn UNION ALL SELECT 'headline longer than 200', count(*) FILTER (length(headline) > 200) FROM sn
        UNION ALL SELECT 'missing date', count(*) FILTER (date IS NULL) FROM sn UNION ALL SELECT 'missing source', count(*) FILTER (source IS NULL) FROM sn
        UNION ALL SELECT 'unknown label', count(*) FILTER (sentiment_label NOT IN ('positive', 'negative', 'neutral')) FROM sn
        UNION ALL SELECT 'score outside -1 to 1', count(*) FILTER (length(headline) / 100.0 NOT BETWEEN -1 AND 1) FROM sn""",
    ),
)
register(
    "eps_change_rules",
    "DOC-18",
    lambda s, sf: rounded(rs.eps_changes(v.event_bars(s, sf).select(F.col("instrument").alias("symbol"), "date", F.col("close").alias("eps")))),
    with_ctes(
        [v.EVENT_BARS_SQL, f"ep AS (SELECT instrument AS symbol, date, close AS eps, abs(close - lag(close) OVER ({_W})) / nullif(abs(lag(close) OVER ({_W})), 0) * 100 AS ch FROM ebars)"],
        f"SELECT symbol, date, {r('eps', 'eps')}, {r('ch', 'eps_change')}, coalesce(ch > 500, false) AS excessive FROM ep",
    ),
)


@query(
    "corporate_action_quality",
    "DOC-20",
    with_ctes(
        [
            v.EVENT_BARS_SQL,
            v.EVENT_DAYS_SQL,
            hq._ACT,
            f"mv AS (SELECT instrument, date, coalesce(abs(close / nullif(lag(close) OVER ({_W}), 0) - 1) > 0.5, false) AS big FROM ebars)",
            """af AS (SELECT m.instrument, m.date, any_value(big) AS big, coalesce(bool_or(d AND a.date = m.date), false) AS ex, coalesce(bool_or(d), false) AS dv,
              coalesce(bool_or(s AND abs(a.date - m.date) <= 1), false) AS sp FROM mv m LEFT JOIN aday a ON a.instrument = m.instrument AND abs(a.date - m.date) <= 3 GROUP BY 1, 2)""",
        ],
        f"""SELECT instrument, date, {r('0.4 * CAST(NOT (sp AND big) AS INTEGER) + 0.4 * CAST(NOT (ex AND big) AS INTEGER) + 0.2 * (1 - CAST((sp OR dv) AND big AS INTEGER))', 'corporate_action_quality_score')} FROM af""",
    ),
)
def _action_quality(s, sf):
    b = ce.action_flags(v.event_bars(s, sf).select("instrument", "date", "close"), hq.actions(s, sf))
    return rounded(rs.action_quality_score(b).select("instrument", "date", "corporate_action_quality_score"))


register(
    "turnover",
    "DOC-21",
    lambda s, sf: rounded(
        rs.turnover(
            v.bars(s, sf, "supplier").select("instrument", "date", "volume"),
            v.catalog(s, sf).select(F.col("symbol").alias("instrument"), (F.col("balance") + 2000).alias("free_float")),
        ).select("instrument", "date", "turnover")
    ),
    with_ctes(
        [v.bars_sql("supplier"), v.CATALOG_SQL],
        f"SELECT instrument, date, {r('volume / nullif(balance + 2000, 0)', 'turnover')} FROM bars LEFT JOIN catalog ON symbol = instrument",
    ),
)
register(
    "social_buzz",
    "DOC-26",
    lambda s, sf: rounded(
        rs.social_buzz(
            v.table(s, sf, "events").select(
                F.col("event_type").alias("instrument"), F.col("ts").cast("date").alias("date"), F.col("user_id").alias("author"), F.col("value").alias("engagement")
            )
        ),
        9,
    ),
    with_ctes(
        ["dy AS (SELECT event_type AS instrument, CAST(ts AS DATE) AS date, count(*) AS c, count(DISTINCT user_id) AS u, avg(value) AS e FROM events GROUP BY 1, 2)"],
        f"SELECT instrument, date, c AS mentions, u AS unique_authors, {r('e', 'engagement_per_post', 9)}, {r(_CZ, 'buzz_zscore', 9)} FROM dy {_CZW}",
    ),
)
