"""Queries for peer features and forward targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import peers as p
from tickloom.operators import select as sel
from tickloom.operators import targets as tg
from tickloom.operators import technical as t
from tickloom.plans import views as v
from tickloom.plans.registry import query, r, register, rounded, with_ctes

_W = "PARTITION BY instrument ORDER BY date"
_RET = f"ret AS (SELECT *, ln(close_adj / lag(close_adj) OVER ({_W})) AS log_return FROM bars)"
_BASE = [v.bars_sql(), _RET]
_CAL = """
cal AS (SELECT *, dense_rank() OVER (ORDER BY date) - 1 AS t FROM ret WHERE log_return IS NOT NULL
  AND date IN (SELECT date FROM ret WHERE log_return IS NOT NULL GROUP BY 1 HAVING count(*) >= 2)),
tgt AS (SELECT instrument AS target FROM bars GROUP BY 1 ORDER BY avg(volume) DESC, instrument LIMIT 1),
prs AS (SELECT DISTINCT target, instrument AS peer FROM bars, tgt WHERE instrument <> target),
rows_ AS (SELECT c.instrument AS target, p.peer, c.date, c.t, c.log_return AS rt, q.log_return AS rp, ln(c.close_adj) - ln(q.close_adj) AS spread
  FROM cal c JOIN prs p ON c.instrument = p.target LEFT JOIN cal q ON q.instrument = p.peer AND q.t = c.t)"""
_CT = [*_BASE, _CAL]


def _cal(s, sf):
    return p.calendar(t.returns(v.bars(s, sf)))


def _peers(s, sf):
    """Most liquid type against every other type."""
    b = v.bars(s, sf)
    target = sel.most_liquid(b).select(F.col("instrument").alias("target"))
    names = b.select(F.col("instrument").alias("peer")).distinct()
    return names.crossJoin(F.broadcast(target)).where("peer <> target")


def _span(n, keys):
    return f"(PARTITION BY {keys} ORDER BY t RANGE BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _full(agg, x, n, keys):
    return f"CASE WHEN count({x}) OVER {_span(n, keys)} = {n} THEN {agg} OVER {_span(n, keys)} END"


_MOM = "mom AS (SELECT instrument, date, t, " + ", ".join(f"{_full('sum(log_return)', 'log_return', n, 'instrument')} AS m{n}" for n in p.MOMENTUM_WINDOWS) + " FROM cal)"
_GAP = "gap AS (" + " UNION ALL ".join(
    f"SELECT c.target, c.peer, c.date, {n} AS \"window\", q.m{n} AS pm, x.m{n} AS tm FROM rows_ c JOIN mom x ON x.instrument = c.target AND x.t = c.t LEFT JOIN mom q ON q.instrument = c.peer AND q.t = c.t"
    for n in p.MOMENTUM_WINDOWS
) + ")"
register(
    "peer_momentum_gap",
    "WIN-51 JOIN-13",
    lambda s, sf: rounded(p.momentum_gaps(_cal(s, sf), _peers(s, sf)).select("target", "peer", "date", "window", "relative_momentum")),
    with_ctes([*_CT, _MOM, _GAP], f'SELECT target, peer, date, "window", {r("pm - tm", "relative_momentum")} FROM gap'),
)
register(
    "average_peer_momentum",
    "WIN-52",
    lambda s, sf: rounded(p.average_peer_momentum(p.momentum_gaps(_cal(s, sf), _peers(s, sf)))),
    with_ctes(
        [*_CT, _MOM, _GAP],
        f"""SELECT target, date, "window", {r('CASE WHEN count(pm) = count(*) THEN avg(pm) END', 'avg_peer_momentum')},
        {r('any_value(tm) - CASE WHEN count(pm) = count(*) THEN avg(pm) END', 'momentum_vs_peers')} FROM gap GROUP BY 1, 2, 3""",
    ),
)
_K = "target, peer"
_Z = {n: (_full("avg(spread)", "spread", n, _K), _full("stddev_samp(spread)", "spread", n, _K)) for n in p.SPREAD_WINDOWS}


def _spread_query(name, covers, cols, exprs):
    register(
        name,
        covers,
        lambda s, sf: rounded(p.spreads(_cal(s, sf), _peers(s, sf)).select("target", "peer", "date", *cols)),
        with_ctes(_CT, "SELECT target, peer, date, " + ", ".join(r(e, c) for c, e in zip(cols, exprs)) + " FROM rows_"),
    )


_spread_query("peer_spread", "WIN-53", ["spread"], ["spread"])
_spread_query(
    "peer_spread_zscore",
    "WIN-54",
    [f"spread_zscore_{n}d" for n in p.SPREAD_WINDOWS],
    [f"(spread - {m}) / ({sd} + 1e-8)" for m, sd in _Z.values()],
)
_spread_query(
    "peer_spread_momentum",
    "WIN-55",
    [f"spread_momentum_{n}d" for n in p.SPREAD_WINDOWS],
    [f"{_full('avg(spread)', 'spread', 5, _K)} - {m}" for m, _ in _Z.values()],
)
_AG = """
ag AS (SELECT target, date, t, any_value(rt) AS ret, (count(*) FILTER (rp < rt) + (count(*) FILTER (rp = rt) + 2) / 2.0) / (count(rp) + 1) AS pct,
  quantile_cont(rp, 0.5) AS med, avg(rp) AS bas FROM rows_ GROUP BY 1, 2, 3),
ad AS (SELECT *, ret - med AS dev FROM ag)"""


def _rev(name, covers, build, cols):
    register(
        name,
        covers,
        lambda s, sf: rounded(build(_cal(s, sf), _peers(s, sf)).select("target", "date", *cols)),
        with_ctes([*_CT, _AG], "SELECT target, date, " + ", ".join(r(e, c) for c, e in cols.items()) + " FROM ad"),
    )


_rev("peer_return_rank", "WIN-56", p.mean_reversion, {f"return_rank_{n}d": _full("avg(pct)", "pct", n, "target") for n in p.REVERSION_WINDOWS})
_rev(
    "deviation_from_peers",
    "WIN-57",
    p.mean_reversion,
    {f"deviation_from_peers_{n}d": _full("avg(dev)", "dev", n, "target") for n in p.REVERSION_WINDOWS},
)
_rev(
    "mean_reversion_signal",
    "WIN-58",
    p.mean_reversion,
    {f"mean_reversion_{n}d": f"{_full('sum(med)', 'med', n, 'target')} - {_full('sum(ret)', 'ret', n, 'target')}" for n in p.REVERSION_WINDOWS},
)
_rev(
    "basket_features",
    "WIN-59",
    p.basket_features,
    {
        k: e
        for n in p.BASKET_WINDOWS
        for k, e in {
            f"vs_basket_momentum_{n}d": f"{_full('sum(ret)', 'ret', n, 'target')} - {_full('sum(bas)', 'bas', n, 'target')}",
            f"vol_vs_basket_{n}d": f"{_full('stddev_samp(ret)', 'ret', n, 'target')} / ({_full('stddev_samp(bas)', 'bas', n, 'target')} + 1e-8)",
            f"beta_to_basket_{n}d": f"{_full('covar_samp(ret, bas)', 'dev', n, 'target')} / ({_full('var_samp(bas)', 'bas', n, 'target')} + 1e-8)",
        }.items()
    },
)
_REVF = [f"deviation_from_peers_{n}d" for n in (5, 10)]
_RV = "rv AS (SELECT target, date, " + ", ".join(f"{_full('avg(dev)', 'dev', n, 'target')} AS deviation_from_peers_{n}d" for n in (5, 10)) + " FROM ad)"
register(
    "cleaned_features",
    "WIN-60",
    lambda s, sf: rounded(p.clean_features(p.mean_reversion(_cal(s, sf), _peers(s, sf), (5, 10)).select("target", "date", *_REVF), _REVF)),
    with_ctes(
        [
            *_CT,
            _AG,
            _RV,
            "lf AS (" + " UNION ALL ".join(f"SELECT target, date, '{f}' AS feature, {f} AS value FROM rv" for f in _REVF) + ")",
            "qf AS (SELECT feature, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM lf GROUP BY 1)",
            "cf AS (SELECT target, date, feature, CASE WHEN value IS NOT NULL THEN least(greatest(value, lo), hi) END AS value FROM lf JOIN qf USING (feature))",
        ],
        f"""SELECT target, date, feature, {r('last_value(value IGNORE NULLS) OVER (PARTITION BY target, feature ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 'value')} FROM cf""",
    ),
)
register(
    "relevant_instruments",
    "JOIN-14",
    lambda s, sf: v.bars(s, sf).join(_peers(s, sf).select(F.col("peer").alias("instrument")), "instrument", "left_semi").select("instrument", "date", "volume"),
    with_ctes(_CT, "SELECT instrument, date, volume FROM bars WHERE instrument IN (SELECT peer FROM prs)"),
)


def _links(s, sf):
    return _peers(s, sf).withColumn("lag", (F.length("peer") % 5 + 1).cast("int"))


_SIG = """
lk AS (SELECT target, peer, CAST(length(peer) % 5 + 1 AS INTEGER) AS lag FROM prs),
sg AS (SELECT c.instrument AS target, k.peer, k.lag, c.date, c.t, q.log_return AS signal FROM cal c JOIN lk k ON c.instrument = k.target LEFT JOIN cal q ON q.instrument = k.peer AND q.t = c.t - k.lag)"""
register(
    "lagged_peer_signals",
    "JOIN-16",
    lambda s, sf: rounded(p.lagged_peer_signals(_cal(s, sf), _links(s, sf)).drop("t")),
    with_ctes([*_CT, _SIG], f"SELECT target, peer, lag, date, {r('signal', 'signal')} FROM sg"),
)
register(
    "positive_lead_signals",
    "DOC-22",
    lambda s, sf: p.positive_signal_count(p.lagged_peer_signals(_cal(s, sf), _links(s, sf)), 0.1).select("target", "peer", "date", "positive_signals"),
    with_ctes(
        [*_CT, _SIG],
        f"SELECT target, peer, date, CAST(sum(CASE WHEN signal > 0.1 THEN 1 ELSE 0 END) OVER {_span(20, _K)} AS INTEGER) AS positive_signals FROM sg",
    ),
)
register(
    "target_feature_merge",
    "JOIN-3",
    lambda s, sf: rounded(
        p.merge_target_features(v.bars(s, sf).select("instrument", "date", "volume"), p.mean_reversion(_cal(s, sf), _peers(s, sf), (5, 10)).select("target", "date", *_REVF))
    ),
    with_ctes(
        [*_CT, _AG, _RV],
        f"SELECT b.instrument, b.date, b.volume, {', '.join(r(f, f) for f in _REVF)} FROM bars b LEFT JOIN rv ON rv.target = b.instrument AND rv.date = b.date",
    ),
)

# ---- forward targets --------------------------------------------------------------------------


def _next(n):
    return f"({_W} ROWS BETWEEN 1 FOLLOWING AND {n} FOLLOWING)"


_FR = "fr AS (SELECT *, " + ", ".join(f"lead(close_adj, {h}) OVER ({_W}) / close_adj - 1 AS target_return_{h}d" for h in tg.HORIZONS) + " FROM bars)"
register(
    "forward_return",
    "WIN-64",
    lambda s, sf: rounded(tg.forward_returns(v.bars(s, sf)).select("instrument", "date", *[f"target_return_{h}d" for h in tg.HORIZONS])),
    with_ctes([v.bars_sql(), _FR], "SELECT instrument, date, " + ", ".join(r(f"target_return_{h}d", f"target_return_{h}d") for h in tg.HORIZONS) + " FROM fr"),
)
_FV = {h: f"CASE WHEN count(log_return) OVER {_next(h)} = {h} THEN stddev_samp(log_return) OVER {_next(h)} * sqrt(252) END" for h in tg.VOL_HORIZONS}
register(
    "forward_volatility",
    "WIN-65",
    lambda s, sf: rounded(tg.forward_volatility(t.returns(v.bars(s, sf))).select("instrument", "date", *[f"target_volatility_{h}d" for h in tg.VOL_HORIZONS])),
    with_ctes(_BASE, "SELECT instrument, date, " + ", ".join(r(e, f"target_volatility_{h}d") for h, e in _FV.items()) + " FROM ret"),
)
register(
    "direction_label",
    "WIN-66",
    lambda s, sf: rounded(tg.direction_labels(tg.forward_returns(v.bars(s, sf))).select("instrument", "date", *[f"target_direction_{h}d" for h in tg.HORIZONS])),
    with_ctes([v.bars_sql(), _FR], "SELECT instrument, date, " + ", ".join(f"CAST(sign(target_return_{h}d) AS DOUBLE) AS target_direction_{h}d" for h in tg.HORIZONS) + " FROM fr"),
)
register(
    "quantile_label",
    "WIN-67",
    lambda s, sf: tg.quantile_labels(tg.forward_returns(v.bars(s, sf))).select("instrument", "date", *[f"target_class_{h}d" for h in tg.HORIZONS]),
    with_ctes(
        [
            v.bars_sql(),
            _FR,
            "qq AS (SELECT instrument, " + ", ".join(f"quantile_cont(target_return_{h}d, [0.3, 0.7]) AS q{h}" for h in tg.HORIZONS) + " FROM fr GROUP BY 1)",
        ],
        "SELECT instrument, date, "
        + ", ".join(f"CASE WHEN target_return_{h}d <= q{h}[1] THEN -1 WHEN target_return_{h}d >= q{h}[2] THEN 1 ELSE 0 END AS target_class_{h}d" for h in tg.HORIZONS)
        + " FROM fr JOIN qq USING (instrument)",
    ),
)
register(
    "next_level_target",
    "WIN-68",
    lambda s, sf: rounded(tg.next_level(v.bars(s, sf)).select("instrument", "date", "target"), 8),
    with_ctes([v.bars_sql(), f"nx AS (SELECT *, lead(close) OVER ({_W}) AS target FROM bars)"], f"SELECT instrument, date, {r('target', 'target', 8)} FROM nx WHERE target IS NOT NULL"),
)
_SYM = ("PROMO", "SMALL")
register(
    "market_context_join",
    "JOIN-2",
    lambda s, sf: rounded(tg.market_context(v.bars(s, sf), _SYM).select("instrument", "date", *[f"{x}_{k}" for x in _SYM for k in ("return", "vol")])),
    with_ctes(
        [
            *_BASE,
            f"bv AS (SELECT instrument, date, log_return, CASE WHEN count(log_return) OVER ({_W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 20 THEN stddev_samp(log_return) OVER ({_W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) END AS vol FROM ret)",
        ],
        "SELECT b.instrument, b.date, "
        + ", ".join(f"{r(f'{x}.log_return', f'{x}_return')}, {r(f'{x}.vol', f'{x}_vol')}" for x in _SYM)
        + " FROM bars b "
        + " ".join(f"LEFT JOIN bv {x} ON {x}.instrument = '{x}' AND {x}.date = b.date" for x in _SYM),
    ),
)
_PH = f"({_W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"
register(
    "excursions",
    "DOC-12",
    lambda s, sf: rounded(tg.excursions(v.bars(s, sf)).select("instrument", "date", "max_adverse_excursion", "max_favorable_excursion", "breakout_continuation")),
    with_ctes(
        [v.bars_sql()],
        f"""SELECT instrument, date, {r(f'CASE WHEN count(close_adj) OVER {_next(10)} = 10 THEN min(low) OVER {_next(10)} / close_adj - 1 END', 'max_adverse_excursion')},
        {r(f'CASE WHEN count(close_adj) OVER {_next(10)} = 10 THEN max(high) OVER {_next(10)} / close_adj - 1 END', 'max_favorable_excursion')},
        CASE WHEN lead(close_adj, 10) OVER ({_W}) IS NOT NULL AND count(close_adj) OVER {_PH} = 20 THEN CAST(close_adj > max(close_adj) OVER {_PH} AND lead(close_adj, 10) OVER ({_W}) > close_adj AS INTEGER) END AS breakout_continuation FROM bars""",
    ),
)
register(
    "forward_volatility_class",
    "DOC-13",
    lambda s, sf: tg.volatility_classes(tg.forward_volatility(t.returns(v.bars(s, sf)), (21,))).select("instrument", "date", "forward_vol_class"),
    with_ctes(
        [*_BASE, f"fv AS (SELECT instrument, date, {_FV[21]} AS x FROM ret)", "fq AS (SELECT instrument, quantile_cont(x, 1/3) AS lo, quantile_cont(x, 2/3) AS hi FROM fv GROUP BY 1)"],
        "SELECT instrument, date, CASE WHEN x <= lo THEN 'low' WHEN x <= hi THEN 'med' WHEN x > hi THEN 'high' END AS forward_vol_class FROM fv JOIN fq USING (instrument)",
    ),
)


def _weighted(s, sf):
    b = t.exponential_averages(t.close_volatility(t.returns(v.bars(s, sf)), (20,)), (12,))
    peers = _peers(s, sf).withColumn("weight", F.length("peer").cast("double"))
    return rounded(p.weighted_peer_aggregates(p.calendar(b), peers), 4)


_WCT = [
    v.bars_sql(),
    f"""ret AS (SELECT *, ln(close_adj / lag(close_adj) OVER ({_W})) AS log_return, row_number() OVER ({_W}) - 1 AS n FROM bars),
    em(instrument, date, n, ema) AS (SELECT instrument, date, n, close_adj FROM ret WHERE n = 0
      UNION ALL SELECT s.instrument, s.date, s.n, {1 - 2 / 13!r} * e.ema + {2 / 13!r} * s.close_adj FROM em e JOIN ret s ON s.instrument = e.instrument AND s.n = e.n + 1),
    fx AS (SELECT ret.*, ema, CASE WHEN count(log_return) OVER ({_W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 20 THEN stddev_samp(log_return) OVER ({_W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) * sqrt(252) END AS vol
      FROM ret JOIN em USING (instrument, date))""",
    _CAL.split("rows_ AS")[0].rstrip().rstrip(",").replace("FROM ret WHERE log_return IS NOT NULL\n", "FROM fx WHERE log_return IS NOT NULL\n"),
    """pw AS (SELECT c.instrument AS target, c.date, length(p.peer) AS w, c.log_return AS rt, c.vol AS vt, c.ema AS et, q.log_return AS rp, q.vol AS vp, q.ema AS ep
      FROM cal c JOIN prs p ON c.instrument = p.target LEFT JOIN cal q ON q.instrument = p.peer AND q.t = c.t),
    wa AS (SELECT target, date, any_value(rt) AS rt, any_value(vt) AS vt, any_value(et) AS et, sum(w * rp) / sum(w) FILTER (rp IS NOT NULL) AS pr,
      sum(w * vp) / sum(w) FILTER (vp IS NOT NULL) AS pv, sum(w * ep) / sum(w) FILTER (ep IS NOT NULL) AS pe FROM pw GROUP BY 1, 2)""",
]
register(
    "weighted_peer_aggregates",
    "DOC-8",
    _weighted,
    with_ctes(
        _WCT,
        f"SELECT target, date, {r('pr', 'peer_return', 4)}, {r('rt - pr', 'relative_strength', 4)}, {r('vt / pv', 'peer_vol_ratio', 4)}, {r('et - pe', 'momentum_gap', 4)} FROM wa",
        recursive=True,
    ),
)
