"""Queries for pairwise statistics, clusters and peers, over weekly brand bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import relationships as rel
from tickloom.operators import technical as t
from tickloom.plans import views as v
from tickloom.plans.registry import query, r, register, rounded, with_ctes

_W = "PARTITION BY instrument ORDER BY date"


def _returns(s, sf):
    return t.returns(v.bars(s, sf, "brand", "week"))


_RET = f"ret AS (SELECT *, ln(close_adj / lag(close_adj) OVER ({_W})) AS log_return FROM bars)"
_BASE = [v.bars_sql("brand", "week"), _RET]


def _last(n, name="lst"):
    return f"{name} AS (SELECT instrument, date, log_return AS v FROM ret WHERE log_return IS NOT NULL AND date IN (SELECT DISTINCT date FROM ret WHERE log_return IS NOT NULL ORDER BY date DESC LIMIT {n}))"


def _pairs(src="lst", name="pairs"):
    return f"{name} AS (SELECT a.instrument AS instrument_i, b.instrument AS instrument_j, a.date, a.v AS x, b.v AS y FROM {src} a JOIN {src} b ON a.date = b.date AND a.instrument < b.instrument)"


_P = "PARTITION BY instrument_i, instrument_j"
_RANKED = f"""
rnk AS (SELECT instrument_i, instrument_j, date,
  rank() OVER ({_P} ORDER BY x) + (count(*) OVER ({_P}, x) - 1) / 2.0 AS x, rank() OVER ({_P} ORDER BY y) + (count(*) OVER ({_P}, y) - 1) / 2.0 AS y,
  count(*) OVER ({_P}) AS n FROM pairs)"""


def _edge_cols(df, digits=6):
    return rounded(df.select("instrument_i", "instrument_j", "window", "n", "rho"), digits)


register(
    "pearson_pairs",
    "STAT-1 JOIN-12",
    lambda s, sf: _union([rel.correlations(_returns(s, sf), window=n, method="pearson") for n in rel.CORRELATION_WINDOWS]),
    with_ctes(
        _BASE + [x for n in rel.CORRELATION_WINDOWS for x in (_last(n, f"l{n}"), _pairs(f"l{n}", f"p{n}"))],
        " UNION ALL ".join(
            f"SELECT instrument_i, instrument_j, {n} AS window, count(*) AS n, {r('corr(x, y)', 'rho')} FROM p{n} GROUP BY 1, 2"
            for n in rel.CORRELATION_WINDOWS
        ),
    ),
)


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _edge_cols(out)


register(
    "spearman_pairs",
    "STAT-2",
    lambda s, sf: _edge_cols(rel.correlations(_returns(s, sf), window=126)),
    with_ctes(
        [*_BASE, _last(126), _pairs(), _RANKED],
        f"SELECT instrument_i, instrument_j, 126 AS window, count(*) AS n, {r('corr(x, y)', 'rho')} FROM rnk GROUP BY 1, 2",
    ),
)
register(
    "kendall_pairs",
    "STAT-3",
    lambda s, sf: _edge_cols(rel.correlations(_returns(s, sf), window=60, method="kendall")),
    with_ctes(
        [*_BASE, _last(60), _pairs()],
        f"""SELECT a.instrument_i, a.instrument_j, 60 AS window, any_value(c.n) AS n,
        {r('sum(sign(b.x - a.x) * sign(b.y - a.y)) / sqrt(CAST(count(*) FILTER (a.x <> b.x) AS DOUBLE) * count(*) FILTER (a.y <> b.y))', 'rho')}
        FROM pairs a JOIN pairs b ON a.instrument_i = b.instrument_i AND a.instrument_j = b.instrument_j AND a.date < b.date
        JOIN (SELECT instrument_i, instrument_j, count(*) AS n FROM pairs GROUP BY 1, 2) c ON c.instrument_i = a.instrument_i AND c.instrument_j = a.instrument_j GROUP BY 1, 2""",
    ),
)
_EDGE = "ed AS (SELECT instrument_i, instrument_j, count(*) AS n, corr(x, y) AS rho FROM pairs GROUP BY 1, 2)"
#: From ``ed`` (n, rho) to two-sided p, by the finite series for whole degrees of freedom.
P_VALUES = """
ts AS (SELECT *, n - 2 AS dof, rho * sqrt((n - 2) / (1 - rho * rho)) AS t FROM ed),
th AS (SELECT *, atan(abs(t) / sqrt(dof)) AS a FROM ts),
pv AS (SELECT *, CASE WHEN dof % 2 = 0 THEN 1 - sin(a) * (SELECT sum(exp(lgamma(k + 0.5) - lgamma(k + 1.0)) / sqrt(pi()) * pow(cos(a), 2 * k)) FROM (SELECT unnest(generate_series(0, dof // 2 - 1)) AS k))
  ELSE 1 - 2 / pi() * (a + sin(a) * (SELECT sum(sqrt(pi()) / 2 * exp(lgamma(k + 1.0) - lgamma(k + 1.5)) * pow(cos(a), 2 * k + 1)) FROM (SELECT unnest(generate_series(0, (dof - 3) // 2)) AS k))) END AS p FROM th)"""
register(
    "correlation_significance",
    "STAT-4",
    lambda s, sf: rounded(
        rel.significance(rel.correlations(_returns(s, sf), window=60, method="pearson")).select(
            "instrument_i", "instrument_j", "n", "t_stat", "p_value"
        ),
        5,
    ),
    with_ctes(
        [*_BASE, _last(60), _pairs(), _EDGE, P_VALUES],
        f"SELECT instrument_i, instrument_j, n, {r('t', 't_stat', 5)}, {r('greatest(p, 0)', 'p_value', 5)} FROM pv",
    ),
)
register(
    "cross_set_correlation",
    "STAT-5",
    lambda s, sf: rounded(
        rel.cross_correlations(
            v.bars(s, sf).select("instrument", "date", F.col("close").alias("v")),
            v.econ(s, sf).select(F.col("symbol").alias("instrument"), "date", F.col("value").alias("v")),
        )
    ),
    with_ctes(
        [v.bars_sql(), v.ECON_SQL],
        f"SELECT instrument AS instrument_i, symbol AS instrument_j, count(*) AS n, {r('corr(close, value)', 'rho')} FROM bars JOIN econ USING (date) GROUP BY 1, 2",
    ),
)
_E126 = "ed AS (SELECT instrument_i, instrument_j, count(*) AS n, corr(x, y) AS rho FROM rnk GROUP BY 1, 2)"
_SP = [*_BASE, _last(126), _pairs(), _RANKED, _E126]


def _spearman(s, sf):
    return rel.correlations(_returns(s, sf), window=126)


register(
    "correlation_summary",
    "STAT-6",
    lambda s, sf: rounded(rel.correlation_summary(_spearman(s, sf), 0.15, 0.05)),
    with_ctes(
        _SP,
        f"""SELECT 126 AS window, 'spearman' AS method, count(*) AS pairs, {r('avg(rho)', 'mean_correlation')}, {r('stddev_pop(rho)', 'std_correlation')},
        {r('min(rho)', 'min_correlation')}, {r('max(rho)', 'max_correlation')}, count(*) FILTER (abs(rho) > 0.15) AS strong,
        count(*) FILTER (abs(rho) > 0.05 AND abs(rho) <= 0.15) AS moderate, count(*) FILTER (abs(rho) <= 0.05) AS weak FROM ed""",
    ),
)
register(
    "strong_pairs",
    "STAT-7",
    lambda s, sf: rounded(rel.strong_pairs(_spearman(s, sf), 0.15).select("instrument_i", "instrument_j", "rho", "direction")),
    with_ctes(
        _SP,
        f"SELECT instrument_i, instrument_j, {r('rho', 'rho')}, CASE WHEN rho > 0 THEN 'positive' ELSE 'negative' END AS direction FROM ed WHERE abs(rho) > 0.15",
    ),
)
_UV = f"uv AS (SELECT instrument_i, instrument_j, x / (n + 1) AS u, y / (n + 1) AS v FROM rnk)"


def _tail_side(a, b, u):
    hi, lo = f"count(*) FILTER ({u} > 0.9)", f"count(*) FILTER ({u} < 1 - 0.9)"
    return f"""SELECT {a} AS instrument_1, {b} AS instrument_2, {r(f'coalesce(count(*) FILTER (u > 0.9 AND v > 0.9) / nullif({hi}, 0), 0)', 'upper_tail')},
    {r(f'coalesce(count(*) FILTER (u < 1 - 0.9 AND v < 1 - 0.9) / nullif({lo}, 0), 0)', 'lower_tail')},
    {r(f'coalesce(2 - count(*) FILTER (u > 0.9 AND v > 0.9) / nullif({hi}, 0), 0)', 'upper_tail_compat')} FROM uv GROUP BY 1, 2"""


register(
    "tail_dependence",
    "STAT-8",
    lambda s, sf: rounded(rel.tail_dependence(_returns(s, sf), q=0.9)),
    with_ctes(
        [*_BASE, _last(126), _pairs(), _RANKED, _UV],
        _tail_side("instrument_i", "instrument_j", "u") + " UNION ALL " + _tail_side("instrument_j", "instrument_i", "v"),
    ),
)
_MI = """
bn AS (SELECT instrument_i, instrument_j, n, least(3, floor((x - 1) * 4 / n)) AS bx, least(3, floor((y - 1) * 4 / n)) AS by_ FROM rnk),
jn AS (SELECT instrument_i, instrument_j, bx, by_, count(*) / any_value(n) AS p, any_value(n) AS n FROM bn GROUP BY 1, 2, 3, 4),
mi AS (SELECT instrument_i, instrument_j, any_value(n) AS n, sum(p * ln(p / (px * py))) AS mi FROM (
  SELECT *, sum(p) OVER (PARTITION BY instrument_i, instrument_j, bx) AS px, sum(p) OVER (PARTITION BY instrument_i, instrument_j, by_) AS py FROM jn) GROUP BY 1, 2)"""
register(
    "mutual_information",
    "STAT-9",
    lambda s, sf: rounded(rel.mutual_information(_returns(s, sf))),
    with_ctes([*_BASE, _last(126), _pairs(), _RANKED, _MI], f"SELECT instrument_i, instrument_j, n, {r('mi', 'mi')} FROM mi"),
)
# The constant of the digamma function cancels, so harmonic sums stand for it.
_NEAR = """
sd AS (SELECT instrument_i, instrument_j, count(*) AS n, stddev_pop(x) AS sx, stddev_pop(y) AS sy FROM pairs GROUP BY 1, 2),
zs AS (SELECT instrument_i, instrument_j, date, n, x / sx AS x, y / sy AS y FROM pairs JOIN sd USING (instrument_i, instrument_j) WHERE n > 3),
dd AS (SELECT a.instrument_i, a.instrument_j, a.date, a.n, abs(a.x - b.x) AS dx, abs(a.y - b.y) AS dy
  FROM zs a JOIN zs b ON a.instrument_i = b.instrument_i AND a.instrument_j = b.instrument_j AND a.date <> b.date),
rc AS (SELECT instrument_i, instrument_j, date, min(greatest(dx, dy), 3)[3] AS reach FROM dd GROUP BY 1, 2, 3),
nr AS (SELECT instrument_i, instrument_j, date, any_value(n) AS n, count(*) FILTER (dx < reach) + 1 AS nx, count(*) FILTER (dy < reach) + 1 AS ny
  FROM dd JOIN rc USING (instrument_i, instrument_j, date) GROUP BY 1, 2, 3),
hs AS (SELECT m, coalesce(sum(1.0::DOUBLE / (m - 1)) FILTER (m > 1) OVER (ORDER BY m), 0) AS h FROM range(1, 200) t(m)),
km AS (SELECT nr.instrument_i, nr.instrument_j, any_value(nr.n) AS n, greatest(0, any_value(k.h) + any_value(w.h) - avg(hx.h + hy.h)) AS mi
  FROM nr JOIN hs hx ON hx.m = nx JOIN hs hy ON hy.m = ny JOIN hs w ON w.m = nr.n JOIN hs k ON k.m = 3 GROUP BY 1, 2)"""
register(
    "neighbour_information",
    "STAT-9",
    lambda s, sf: rounded(rel.neighbour_information(_returns(s, sf))),
    with_ctes(
        [*_BASE, _last(126), _pairs(), _NEAR],
        f"SELECT sd.instrument_i, sd.instrument_j, sd.n, {r('mi', 'mi')} FROM sd LEFT JOIN km USING (instrument_i, instrument_j)",
    ),
)
register(
    "mutual_information_top",
    "STAT-9",
    lambda s, sf: rounded(rel.mutual_information_top(rel.mutual_information(_returns(s, sf)))),
    with_ctes(
        [*_BASE, _last(126), _pairs(), _RANKED, _MI],
        f"SELECT instrument_i, instrument_j, n, {r('mi', 'mi')} FROM mi WHERE mi > (SELECT quantile_cont(mi, 0.75) FROM mi)",
    ),
)
_LW = """
np AS (SELECT count(DISTINCT instrument) AS p FROM lst),
fd AS (SELECT date FROM lst GROUP BY 1 HAVING count(*) = (SELECT p FROM np)),
cx AS (SELECT instrument, date, v - avg(v) OVER (PARTITION BY instrument) AS v FROM lst WHERE date IN (SELECT date FROM fd)),
nn AS (SELECT count(*) AS n FROM fd),
sm AS (SELECT a.instrument AS i, b.instrument AS j, sum(a.v * b.v) / (SELECT n FROM nn) AS s FROM cx a JOIN cx b ON a.date = b.date GROUP BY 1, 2),
sc AS (SELECT (SELECT sum(s) FROM sm WHERE i = j) / p AS mu, (SELECT sum(s * s) FROM sm) AS d2, (SELECT sum(q * q) FROM (SELECT sum(v * v) AS q FROM cx GROUP BY date)) AS b2,
  p, n FROM np, nn),
sh AS (SELECT mu, CASE WHEN delta > 0 THEN least(beta, delta) / delta ELSE 0 END AS w FROM (SELECT mu, (b2 / n - d2) / (p * n) AS beta, (d2 - 2 * mu * mu * p + p * mu * mu) / p AS delta FROM sc))"""
register(
    "shrunk_correlation",
    "STAT-10",
    lambda s, sf: rounded(rel.ledoit_wolf(_returns(s, sf))),
    with_ctes(
        [*_BASE, _last(126), _LW],
        f"""SELECT e.i AS instrument_i, e.j AS instrument_j, {r('(1 - w) * e.s / sqrt(((1 - w) * a.s + w * mu) * ((1 - w) * b.s + w * mu))', 'rho')}, {r('w', 'shrinkage')}
        FROM sm e JOIN sm a ON a.i = e.i AND a.j = e.i JOIN sm b ON b.i = e.j AND b.j = e.j, sh WHERE e.i < e.j""",
    ),
)
register(
    "correlation_distance",
    "STAT-11",
    lambda s, sf: rounded(rel.distances(_spearman(s, sf)).select("instrument_i", "instrument_j", "distance")),
    with_ctes(_SP, f"SELECT instrument_i, instrument_j, {r('sqrt(greatest(0, 2 * (1 - rho)))', 'distance')} FROM ed"),
)
_LIMIT = 1.28
_CC = f"""
near AS (SELECT instrument_i AS a, instrument_j AS b FROM ed WHERE sqrt(greatest(0, 2 * (1 - rho))) <= {_LIMIT} UNION SELECT instrument_j, instrument_i FROM ed WHERE sqrt(greatest(0, 2 * (1 - rho))) <= {_LIMIT}),
reach(a, b) AS (SELECT DISTINCT instrument, instrument FROM bars UNION SELECT r.a, n.b FROM reach r JOIN near n ON r.b = n.a),
cl AS (SELECT a AS instrument, min(b) AS cluster FROM reach GROUP BY 1)"""


def _clusters(s, sf, edges):
    return rel.distance_clusters(v.bars(s, sf, "brand", "week"), rel.distances(edges), _LIMIT)


register(
    "distance_clusters",
    "STAT-12",
    lambda s, sf: _clusters(s, sf, _spearman(s, sf)),
    with_ctes([*_SP, _CC], "SELECT instrument, cluster FROM cl", recursive=True),
)


def _tree_edges(s, sf):
    """Distances rounded as in the SQL, so that both sides order equal distances alike."""
    return rounded(rel.distances(_spearman(s, sf)).select("instrument_i", "instrument_j", "distance"))


# An edge is in the tree if no way between its ends has only lesser edges.
_TREE = f"""
de AS (SELECT instrument_i, instrument_j, {r('sqrt(greatest(0, 2 * (1 - rho)))', 'distance')} FROM ed WHERE rho IS NOT NULL),
od AS (SELECT *, row_number() OVER (ORDER BY distance, instrument_i, instrument_j) AS place FROM de WHERE distance IS NOT NULL),
dir2 AS (SELECT instrument_i AS a, instrument_j AS b, place FROM od UNION ALL SELECT instrument_j, instrument_i, place FROM od),
ways(a, b, worst) AS (SELECT a, b, place FROM dir2 UNION SELECT w.a, d.b, greatest(w.worst, d.place) FROM ways w JOIN dir2 d ON w.b = d.a WHERE w.a <> d.b),
tree AS (SELECT od.* FROM od JOIN (SELECT a, b, min(worst) AS worst FROM ways GROUP BY 1, 2) m ON m.a = instrument_i AND m.b = instrument_j AND m.worst = place)"""
_FIXED = """
nd AS (SELECT DISTINCT instrument FROM bars),
heavy AS (SELECT *, row_number() OVER (ORDER BY place DESC) AS h FROM tree),
kept AS (SELECT instrument_i AS a, instrument_j AS b FROM heavy WHERE h > 8 - ((SELECT count(*) FROM nd) - (SELECT count(*) FROM tree))),
kd AS (SELECT a, b FROM kept UNION ALL SELECT b, a FROM kept),
inside(a, b) AS (SELECT instrument, instrument FROM nd UNION SELECT r.a, n.b FROM inside r JOIN kd n ON r.b = n.a)"""
register(
    "spanning_tree",
    "STAT-12",
    lambda s, sf: rel.spanning_tree(_tree_edges(s, sf)),
    with_ctes([*_SP, _TREE], "SELECT instrument_i, instrument_j, distance FROM tree", recursive=True),
)
register(
    "fixed_clusters",
    "STAT-12",
    lambda s, sf: rel.fixed_clusters(v.bars(s, sf, "brand", "week"), _tree_edges(s, sf), 8),
    with_ctes([*_SP, _TREE, _FIXED], "SELECT a AS instrument, min(b) AS cluster FROM inside GROUP BY 1", recursive=True),
)
_PEER = """
dir AS (SELECT instrument_i AS a, instrument_j AS b, rho FROM ed WHERE abs(rho) >= 0.1 UNION ALL SELECT instrument_j, instrument_i, rho FROM ed WHERE abs(rho) >= 0.1),
top AS (SELECT a AS instrument, b AS peer, row_number() OVER (PARTITION BY a ORDER BY abs(rho) DESC, b) AS rank, rho FROM dir QUALIFY row_number() OVER (PARTITION BY a ORDER BY abs(rho) DESC, b) <= 10)"""
register(
    "top_peers",
    "TOP-4",
    lambda s, sf: rounded(rel.peer_map(_spearman(s, sf), min_abs=0.1).select("instrument", "peer", "rank", "weight")),
    with_ctes([*_SP, _PEER], f"SELECT instrument, peer, rank, {r('abs(rho)', 'weight')} FROM top"),
)


@query(
    "peer_map",
    "STAT-13",
    with_ctes(
        [*_SP, _CC, _PEER],
        f"""SELECT t.instrument, peer, rank, {r('rho', 'correlation')}, {r('abs(rho)', 'weight')}, x.cluster = y.cluster AS is_cluster_peer
        FROM top t JOIN cl x ON x.instrument = t.instrument JOIN cl y ON y.instrument = t.peer""",
        recursive=True,
    ),
)
def _peer_map(s, sf):
    edges = _spearman(s, sf)
    return rounded(rel.peer_map(edges, _clusters(s, sf, edges), min_abs=0.1))


# ---- alignment, lead-lag, cointegration --------------------------------------------------------

_ALL = "al AS (SELECT instrument, date, log_return AS v, dense_rank() OVER (ORDER BY date) - 1 AS t FROM ret WHERE log_return IS NOT NULL)"
_APAIR = "ap AS (SELECT a.instrument AS instrument_i, b.instrument AS instrument_j, a.t, a.v AS x, b.v AS y FROM al a JOIN al b ON a.t = b.t AND a.instrument < b.instrument)"
register(
    "pair_alignment",
    "JOIN-12 TOP-7",
    lambda s, sf: rel.pair_alignment(_returns(s, sf), "log_return", 60, 50),
    with_ctes(
        [*_BASE, _ALL, _APAIR],
        f"""SELECT instrument_i, instrument_j, count(*) AS n, CAST(min(t) AS INTEGER) AS first_t, CAST(max(t) AS INTEGER) AS last_t
        FROM (SELECT * FROM ap QUALIFY row_number() OVER ({_P} ORDER BY t DESC) <= 60) GROUP BY 1, 2 HAVING count(*) >= 50""",
    ),
)
_MIN = 0.2
_CCF = f"""
l60 AS (SELECT *, row_number() OVER ({_P} ORDER BY t) AS k, count(*) OVER ({_P}) AS n FROM (SELECT *, count(*) OVER ({_P}) AS total FROM ap QUALIFY row_number() OVER ({_P} ORDER BY t DESC) <= 60)),
lg AS (SELECT a.instrument_i, a.instrument_j, b.k - a.k AS lag, corr(a.x, b.y) AS c, any_value(a.total) AS n FROM l60 a JOIN l60 b ON a.instrument_i = b.instrument_i AND a.instrument_j = b.instrument_j AND b.k - a.k BETWEEN 1 AND 5 GROUP BY 1, 2, 3
  UNION ALL SELECT a.instrument_i, a.instrument_j, -(b.k - a.k), corr(a.y, b.x), any_value(a.total) FROM l60 a JOIN l60 b ON a.instrument_i = b.instrument_i AND a.instrument_j = b.instrument_j AND b.k - a.k BETWEEN 1 AND 5 GROUP BY 1, 2, 3),
ll AS (SELECT instrument_i, instrument_j, any_value(n) AS n, CAST(arg_max(lag, abs(c)) AS INTEGER) AS best_lag, arg_max(c, abs(c)) AS max_ccf FROM lg GROUP BY 1, 2 HAVING max(abs(c)) >= {_MIN} AND any_value(n) >= 50)"""
register(
    "lead_lag_pairs",
    "STAT-14",
    lambda s, sf: rounded(rel.lead_lag(_returns(s, sf), min_ccf=_MIN)),
    with_ctes([*_BASE, _ALL, _APAIR, _CCF], f"SELECT instrument_i, instrument_j, n, best_lag, {r('max_ccf', 'max_ccf')} FROM ll"),
)
register(
    "lead_lag_map",
    "STAT-15",
    lambda s, sf: rounded(rel.lead_lag_map(rel.lead_lag(_returns(s, sf), min_ccf=_MIN))),
    with_ctes(
        [*_BASE, _ALL, _APAIR, _CCF],
        f"""SELECT CASE WHEN best_lag > 0 THEN instrument_j ELSE instrument_i END AS follower, CASE WHEN best_lag > 0 THEN instrument_i ELSE instrument_j END AS leader,
        abs(best_lag) AS lag, {r('max_ccf', 'ccf')} FROM ll""",
    ),
)


def _smooth(s, sf):
    """Eight-week mean prices: a slow series, so residuals revert over several rows."""
    b = t.moving_averages(v.bars(s, sf, "brand", "week"), (8,))
    return b.where("sma_8 IS NOT NULL").select("instrument", "date", F.col("sma_8").alias("close_adj"))


_COI = f"""
sm AS (SELECT instrument, date, ln(CASE WHEN count(close_adj) OVER w = 8 THEN avg(close_adj) OVER w END) AS v FROM bars WINDOW w AS ({_W} ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)),
al AS (SELECT instrument, date, v, dense_rank() OVER (ORDER BY date) - 1 AS t FROM sm WHERE v IS NOT NULL),
{_APAIR},
ck AS (SELECT * FROM ap QUALIFY row_number() OVER ({_P} ORDER BY t DESC) <= 126),
rg AS (SELECT instrument_i, instrument_j, count(*) AS n, regr_slope(x, y) AS beta, regr_intercept(x, y) AS intercept FROM ck GROUP BY 1, 2),
rs AS (SELECT ck.*, x - (intercept + beta * y) AS e FROM ck JOIN rg USING (instrument_i, instrument_j)),
rl AS (SELECT *, lag(e) OVER ({_P} ORDER BY t) AS e1 FROM rs),
ar AS (SELECT instrument_i, instrument_j, regr_slope(e - e1, e1) AS rho, stddev_pop(e1) AS sl, count(e1) AS k, regr_sxx(e - e1, e1) AS sxx,
   regr_syy(e - e1, e1) AS syy, regr_sxy(e - e1, e1) AS sxy, avg(e) AS spread_mean, stddev_pop(e) AS spread_std, arg_max(e, t) AS last_e FROM rl GROUP BY 1, 2),
co AS (SELECT *, -ln(2) / ln(1 + rho) AS half_life, (last_e - spread_mean) / (spread_std + 1e-10) AS current_z_score, rho / (sl + 1e-10) AS t_stat_compat,
   rho / sqrt((syy - sxy * sxy / sxx) / (k - 2) / sxx) AS t_stat FROM ar JOIN rg USING (instrument_i, instrument_j) WHERE n >= 50 AND rho < -0.1 AND rho > -1),
cp AS (SELECT * FROM co WHERE half_life BETWEEN 1 AND 30)"""
_CB = [v.bars_sql("brand", "week"), _COI]
register(
    "cointegrated_pairs",
    "STAT-16",
    lambda s, sf: rounded(
        rel.cointegration(_smooth(s, sf)).select("instrument_i", "instrument_j", "n", "beta", "intercept", "rho", "half_life", "t_stat"), 5
    ),
    with_ctes(
        _CB,
        f"SELECT instrument_i, instrument_j, n, {', '.join(r(c, c, 5) for c in ('beta', 'intercept', 'rho', 'half_life', 't_stat'))} FROM cp",
    ),
)
register(
    "spread_state",
    "STAT-17",
    lambda s, sf: rounded(
        rel.cointegration(_smooth(s, sf)).select("instrument_i", "instrument_j", "spread_mean", "spread_std", "current_z_score", "t_stat_compat"), 5
    ),
    with_ctes(
        _CB,
        f"SELECT instrument_i, instrument_j, {', '.join(r(c, c, 5) for c in ('spread_mean', 'spread_std', 'current_z_score', 't_stat_compat'))} FROM cp",
    ),
)
register(
    "cointegration_map",
    "STAT-17",
    lambda s, sf: rounded(rel.cointegration_map(rel.cointegration(_smooth(s, sf))), 4),
    with_ctes(
        _CB,
        f"""SELECT instrument_i AS instrument, instrument_j AS partner, {r('beta', 'beta', 4)}, {r('current_z_score', 'current_z_score', 4)}, {r('half_life', 'half_life', 4)} FROM cp
        UNION ALL SELECT instrument_j, instrument_i, {r('1 / beta', 'beta', 4)}, {r('-current_z_score', 'current_z_score', 4)}, {r('half_life', 'half_life', 4)} FROM cp""",
    ),
)


@query(
    "merged_peers",
    "TOP-5",
    with_ctes(
        [
            v.bars_sql("brand", "week"),
            _RET,
            _COI,
            _last(126),
            _pairs(),
            _RANKED,
            _E126,
            _ALL.replace("al AS", "al2 AS"),
            _APAIR.replace("ap AS", "ap2 AS").replace("FROM al a JOIN al b", "FROM al2 a JOIN al2 b"),
            _CCF.replace("FROM ap ", "FROM ap2 "),
            """un AS (SELECT instrument_i AS a, instrument_j AS b, abs(rho) AS s FROM ed WHERE abs(rho) >= 0.1
              UNION ALL SELECT instrument_i, instrument_j, abs(t_stat_compat) FROM cp UNION ALL SELECT instrument_i, instrument_j, abs(max_ccf) FROM ll),
            bo AS (SELECT a, b, s FROM un UNION ALL SELECT b, a, s FROM un),
            me AS (SELECT a AS target, b AS peer, avg(s) AS score, count(*) AS sources FROM bo GROUP BY 1, 2)""",
        ],
        f"""SELECT target, peer, {r('score', 'score', 4)}, sources, row_number() OVER (PARTITION BY target ORDER BY me.score DESC, peer) AS place FROM me
        QUALIFY row_number() OVER (PARTITION BY target ORDER BY me.score DESC, peer) <= 5""",
    ),
)
def _merged(s, sf):
    ret = _returns(s, sf)
    cand = rel.peer_candidates(
        rel.correlations(ret, window=126, min_abs=0.1), rel.cointegration(_smooth(s, sf)), rel.lead_lag(ret, min_ccf=_MIN)
    )
    return rounded(rel.merged_peers(cand), 4)
