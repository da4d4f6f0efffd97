"""Pairwise statistics, clusters and peers.

Series are vectors over calendar dates, so an instrument weighs one bounded row in the
shuffle. See ``functions.pairs`` for how pairs meet.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import pairs as pr
from tickloom.operators.select import top_per_key
from tickloom.session import materialise, round_tables

CORRELATION_WINDOWS = (30, 60, 90, 126)
MIN_CORRELATION, MAX_PEERS = 0.4, 10
MIN_OBSERVATIONS, MAX_LAG, MIN_CCF, LEAD_LAG_ROWS = 50, 5, 0.3, 60
#: Distances that one step of ``neighbour_information`` holds at once; a longer series is one pair at a time.
NEIGHBOUR_CELLS = 2_000_000
COINTEGRATION_ROWS, MIN_HALF_LIFE, MAX_HALF_LIFE = 126, 1.0, 30.0


def indexed(df: DataFrame, value: str, last: int | None = None) -> DataFrame:
    """(instrument, t, v): dates numbered from 0, optionally the last ``last`` dates only.

    The date list is bounded by the calendar, so numbering it in one task is safe.
    """
    held = df.where(F.col(value).isNotNull()).select("instrument", "date", F.col(value).alias("v"))
    dates = held.select("date").distinct()
    if last is not None:
        dates = dates.orderBy(F.desc("date")).limit(last)
    numbered = dates.withColumn("t", F.row_number().over(Window.orderBy("date")) - 1)
    return held.join(numbered, "date").select("instrument", "t", "v")


# ---- correlations -------------------------------------------------------------------------


def _correlation(rank: bool):
    def kernel(a, b):
        if rank:
            both = np.isnan(a) | np.isnan(b)
            a, b = pr.masked_ranks(np.where(both, np.nan, a)), pr.masked_ranks(np.where(both, np.nan, b))
        rho, n = pr.masked_pearson(a, b)
        return {"n": n.astype("int64"), "rho": rho}

    return kernel


def _tau(a, b):
    """Kendall tau-b over common values, by summing signs at each row distance."""
    both = ~np.isnan(a) & ~np.isnan(b)
    n = both.sum(1)
    s, ta, tb = (np.zeros(len(a)) for _ in range(3))
    for d in range(1, a.shape[1]):
        ok = both[:, d:] & both[:, :-d]
        sa = np.where(ok, np.sign(a[:, d:] - a[:, :-d]), 0.0)
        sb = np.where(ok, np.sign(b[:, d:] - b[:, :-d]), 0.0)
        s += (sa * sb).sum(1)
        ta += (sa != 0).sum(1)
        tb += (sb != 0).sum(1)
    return {"n": n.astype("int64"), "rho": s / np.sqrt(ta * tb)}


_KERNELS = {"pearson": _correlation(False), "spearman": _correlation(True), "kendall": _tau}


def correlations(
    df: DataFrame, value: str = "log_return", window: int = 126, method: str = "spearman", min_abs: float = 0.0
) -> DataFrame:
    """Edges i < j over the latest ``window`` dates; weaker ones are dropped in the task."""
    keep = (lambda out: np.abs(out["rho"]) >= min_abs) if min_abs > 0 else (lambda out: ~np.isnan(out["rho"]))
    edges = pr.pair_statistics(
        indexed(df, value, window), _KERNELS[method], "n long, rho double", keep
    )
    return edges.withColumns({"window": F.lit(window), "method": F.lit(method)})


def cross_correlations(
    left: DataFrame, right: DataFrame, value: str = "v", method: str = "pearson"
) -> DataFrame:
    """Correlation of every left series with every right series over all common dates."""
    both = left.select("instrument", "date", value, F.lit("a").alias("side")).unionByName(
        right.select("instrument", "date", value, F.lit("b").alias("side"))
    )
    dates = both.select("date").distinct().withColumn("t", F.row_number().over(Window.orderBy("date")) - 1)
    series = both.join(dates, "date").select("side", "instrument", "t", F.col(value).alias("v"))
    return pr.pair_statistics(series, _KERNELS[method], "n long, rho double")


#: Terms of the beta series, and the square of t from which only the far tail's series is used.
_TERMS, _FAR = 200, 80.0
#: Steps by which the gamma ratio is raised before its asymptotic series applies.
_RAISED = 10


def _log_gamma_ratio(a: Column) -> Column:
    """ln(gamma(a + 1/2) / gamma(a)) for a >= 1/2."""
    z = a + _RAISED
    # published asymptotic series of the ratio: fixed values
    series = F.log(z) / 2 - 1 / (8 * z) + 1 / (192 * F.pow(z, 3)) - 1 / (640 * F.pow(z, 5)) + 17 / (14336 * F.pow(z, 7))
    for k in range(_RAISED):
        series = series + F.log((a + k) / (a + k + 0.5))
    return series


def student_p_value(t: Column, dof: Column) -> Column:
    """Two-sided p of Student's t: the incomplete beta function I_x(dof / 2, 1 / 2), x = dof / (dof + t^2).

    One formula for every number of degrees: the hypergeometric series of the function or of its complement with
    a fixed number of terms, whichever side converges. The absolute error is below 1e-9.
    """
    a, t2 = dof.cast("double") / 2, t * t
    x, y = dof / (dof + t2), t2 / (dof + t2)
    near = t2 <= F.least(dof.cast("double"), F.lit(_FAR))
    # complement: c = 1/2 and z = y; else c = a and z = x. Term n + 1 is term n times z (a + 1/2 + n) / (c + 1 + n).
    c, z = F.when(near, 0.5).otherwise(a), F.when(near, y).otherwise(x)
    given = F.struct((a + 0.5).alias("s"), (c + 1).alias("c"), z.alias("z"))
    series = F.aggregate(
        F.sequence(F.lit(0), F.lit(_TERMS - 1)),
        F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term"), given.alias("g")),
        lambda acc, n: F.struct(
            (acc["sum"] + acc["term"]).alias("sum"),
            (acc["term"] * acc["g"]["z"] * (acc["g"]["s"] + n) / (acc["g"]["c"] + n)).alias("term"),
            acc["g"].alias("g"),
        ),
        lambda acc: acc["sum"],
    )
    front = F.exp(a * F.log(x) + F.log(y) / 2 + _log_gamma_ratio(a)) / (math.sqrt(math.pi) * c)
    area = F.when(t2 == 0, 0.0).otherwise(front * series)
    return F.greatest(F.lit(0.0), F.when(near, 1 - area).otherwise(area))


def significance(edges: DataFrame) -> DataFrame:
    """t statistic and two-sided p of each correlation."""
    dof = F.col("n") - 2
    t = F.col("rho") * F.sqrt(F.try_divide(dof, 1 - F.col("rho") * F.col("rho")))
    return edges.withColumn("t_stat", t).withColumn("p_value", student_p_value(F.col("t_stat"), dof))


def correlation_summary(edges: DataFrame, strong: float = 0.7, moderate: float = 0.3) -> DataFrame:
    a = F.abs("rho")
    return edges.groupBy("window", "method").agg(
        F.count(F.lit(1)).alias("pairs"),
        F.avg("rho").alias("mean_correlation"),
        F.stddev_pop("rho").alias("std_correlation"),
        F.min("rho").alias("min_correlation"),
        F.max("rho").alias("max_correlation"),
        F.count_if(a > strong).alias("strong"),
        F.count_if((a > moderate) & (a <= strong)).alias("moderate"),
        F.count_if(a <= moderate).alias("weak"),
    )


def strong_pairs(edges: DataFrame, limit: float = 0.7) -> DataFrame:
    return edges.where(F.abs("rho") > limit).withColumn(
        "direction", F.when(F.col("rho") > 0, "positive").otherwise("negative")
    )


def tail_dependence(df: DataFrame, value: str = "log_return", window: int = 126, q: float = 0.95) -> DataFrame:
    """Lower and upper tail shares of the first series' extremes, both directions.

    ``upper_tail_compat`` is the 2 - share form.
    """

    def kernel(a, b):
        both = np.isnan(a) | np.isnan(b)
        n = (~both).sum(1)
        u = pr.masked_ranks(np.where(both, np.nan, a)) / (n + 1)[:, None]
        v = pr.masked_ranks(np.where(both, np.nan, b)) / (n + 1)[:, None]
        hi, lo = ((u > q) & (v > q)).sum(1), ((u < 1 - q) & (v < 1 - q)).sum(1)
        out = {"n": n.astype("int64")}
        for name, x in (("i", u), ("j", v)):
            nh, nl = (x > q).sum(1), (x < 1 - q).sum(1)
            out[f"up_{name}"] = np.where(nh > 0, hi / np.maximum(nh, 1), 0.0)
            out[f"low_{name}"] = np.where(nl > 0, lo / np.maximum(nl, 1), 0.0)
            out[f"any_{name}"] = nh > 0
        return out

    edges = pr.pair_statistics(
        indexed(df, value, window),
        kernel,
        "n long, up_i double, low_i double, any_i boolean, up_j double, low_j double, any_j boolean",
    )

    def side(first, second, s):
        up = F.col(f"up_{s}")
        return F.struct(
            F.col(f"instrument_{first}").alias("instrument_1"),
            F.col(f"instrument_{second}").alias("instrument_2"),
            up.alias("upper_tail"),
            F.col(f"low_{s}").alias("lower_tail"),
            F.when(F.col(f"any_{s}"), 2 - up).otherwise(0.0).alias("upper_tail_compat"),
        )

    return edges.select(F.inline(F.array(side("i", "j", "i"), side("j", "i", "j"))))


def mutual_information(df: DataFrame, value: str = "log_return", window: int = 126, bins: int = 4) -> DataFrame:
    """Binned mutual information of each pair (nats), bins of equal rank width."""

    def binned(x):
        r = pr.masked_ranks(x)
        n = (~np.isnan(r)).sum(1)[:, None]
        return np.where(np.isnan(r), -1, np.minimum(bins - 1, np.floor((r - 1) * bins / n)))

    def kernel(a, b):
        both = np.isnan(a) | np.isnan(b)
        n = (~both).sum(1)
        ba, bb = binned(np.where(both, np.nan, a)), binned(np.where(both, np.nan, b))
        pa = [(ba == k).sum(1) / n for k in range(bins)]
        pb = [(bb == k).sum(1) / n for k in range(bins)]
        mi = np.zeros(len(a))
        for i in range(bins):
            for j in range(bins):
                p = ((ba == i) & (bb == j)).sum(1) / n
                mi += np.where(p > 0, p * np.log(p / (pa[i] * pb[j])), 0.0)
        return {"n": n.astype("int64"), "mi": mi}

    return pr.pair_statistics(indexed(df, value, window), kernel, "n long, mi double")


def neighbour_information(df: DataFrame, value: str = "log_return", window: int = 126, k: int = 3) -> DataFrame:
    """Mutual information of each pair (nats) from distances to the ``k``-th nearest neighbour; no bins.

    The first estimator of Kraskov, Stögbauer and Grassberger (2004): values are divided by their deviation over the common dates, a
    point's reach is the larger of its two distances to the k-th nearest other point, and points that are strictly nearer along one side alone
    are counted. Below 0 it is 0; null with ``k`` common dates or fewer. Equal values count as they are, without noise, so the result is the
    same on every run; a series without spread has no information.
    """

    def kernel(a, b):
        both = ~np.isnan(a) & ~np.isnan(b)
        n = both.sum(1)
        psi = np.concatenate([[np.nan], np.cumsum(np.concatenate([[-np.euler_gamma], 1.0 / np.arange(1, a.shape[1] + 1)]))])
        mi = np.full(len(a), np.nan)
        step = max(1, NEIGHBOUR_CELLS // a.shape[1] ** 2)
        for s in range(0, len(a), step):
            part, ok = slice(s, s + step), both[s : s + step]
            apart = []
            for x in (a[part], b[part]):
                x = np.where(ok, x, np.nan)
                spread = np.nanstd(x, axis=1, keepdims=True)
                x = x / np.where(spread > 0, spread, 1.0)
                d = np.abs(x[:, :, None] - x[:, None, :])
                d[np.isnan(d)] = np.inf
                d[:, np.arange(d.shape[1]), np.arange(d.shape[1])] = np.inf
                apart.append(d)
            if a.shape[1] <= k:
                continue
            reach = np.partition(np.maximum(*apart), k - 1, axis=2)[:, :, k - 1 : k]
            near = sum(psi[(d < reach).sum(2) + 1] for d in apart)
            m = n[part]
            mean = np.where(ok, near, 0.0).sum(1) / m
            mi[part] = np.where(m > k, np.maximum(0.0, psi[k] + psi[m] - mean), np.nan)
        return {"n": n.astype("int64"), "mi": mi}

    return pr.pair_statistics(indexed(df, value, window), kernel, "n long, mi double")


def mutual_information_top(edges: DataFrame, share: float = 0.75) -> DataFrame:
    """Pairs above the quantile of all scores, with their rank."""
    from tickloom.functions.ranks import quantiles

    edge = quantiles(edges, [], "mi", [share], ["_edge"])
    return edges.crossJoin(F.broadcast(edge)).where(F.col("mi") > F.col("_edge")).drop("_edge")


def ledoit_wolf(df: DataFrame, value: str = "log_return", window: int = 126) -> DataFrame:
    """Shrunk correlation over the dates on which every instrument has a value.

    The shrinkage needs only sums: squares per date, and squares of the covariance edges.
    """
    held = indexed(df, value, window)
    count = held.select("instrument").distinct().agg(F.count(F.lit(1)).alias("_p"))
    full = (
        held.groupBy("t").agg(F.count(F.lit(1)).alias("_k")).crossJoin(F.broadcast(count)).where("_k = _p").select("t")
    )
    rows = held.join(full, "t", "left_semi")
    means = rows.groupBy("instrument").agg(F.avg("v").alias("_m"))
    x = rows.join(means, "instrument").select("instrument", "t", (F.col("v") - F.col("_m")).alias("v"))

    def kernel(a, b):
        ok = ~np.isnan(a) & ~np.isnan(b)
        return {"s_ij": np.where(ok, a * b, 0.0).sum(1) / ok.sum(1)}

    edges = pr.pair_statistics(x, kernel, "s_ij double")
    var = x.groupBy("instrument").agg(F.avg(F.col("v") * F.col("v")).alias("s"), F.count(F.lit(1)).alias("_n"))
    per_date = x.groupBy("t").agg(F.sum(F.col("v") * F.col("v")).alias("_q"))
    b = per_date.agg(F.sum(F.col("_q") * F.col("_q")).alias("_b"))
    diag = var.agg(
        F.sum("s").alias("_tr"),
        F.sum(F.col("s") * F.col("s")).alias("_d"),
        F.count(F.lit(1)).alias("_p"),
        F.max("_n").alias("_n"),
    )
    off = edges.agg((2 * F.sum(F.col("s_ij") * F.col("s_ij"))).alias("_o"))
    p, n, tr = F.col("_p"), F.col("_n"), F.col("_tr")
    dsum = F.col("_d") + F.col("_o")
    mu = tr / p
    beta = (F.col("_b") / n - dsum) / (p * n)
    delta = (dsum - 2 * mu * tr + p * mu * mu) / p
    scalar = (
        b.crossJoin(diag)
        .crossJoin(off)
        .select(
            mu.alias("_mu"),
            F.when(delta > 0, F.least(beta, delta) / delta).otherwise(0.0).alias("shrinkage"),
        )
    )
    vi = var.select(F.col("instrument").alias("instrument_i"), F.col("s").alias("_si"))
    vj = var.select(F.col("instrument").alias("instrument_j"), F.col("s").alias("_sj"))
    w = F.col("shrinkage")

    def total(s):
        return (1 - w) * F.col(s) + w * F.col("_mu")

    return (
        edges.join(vi, "instrument_i")
        .join(vj, "instrument_j")
        .crossJoin(F.broadcast(scalar))
        .select(
            "instrument_i",
            "instrument_j",
            ((1 - w) * F.col("s_ij") / F.sqrt(total("_si") * total("_sj"))).alias("rho"),
            "shrinkage",
        )
    )


def distances(edges: DataFrame) -> DataFrame:
    return edges.withColumn("distance", F.sqrt(F.greatest(F.lit(0.0), 2 * (1 - F.col("rho")))))


# ---- clusters and peers ----------------------------------------------------------------------


def both_ways(edges: DataFrame, *cols: str) -> DataFrame:
    """Directed copies (src, dst, *cols) of undirected edges."""
    ways = F.array(
        F.struct(F.col("instrument_i").alias("src"), F.col("instrument_j").alias("dst")),
        F.struct(F.col("instrument_j").alias("src"), F.col("instrument_i").alias("dst")),
    )
    return edges.select(F.inline(ways), *cols)


def distance_clusters(nodes: DataFrame, edges: DataFrame, limit: float = 0.7, max_rounds: int = 50) -> DataFrame:
    """Connected components of edges with distance <= limit (a single-linkage cut).

    Each round takes the smallest label among the neighbours, then follows the label's own
    label; the label table of every round is stored, so lost executors do not restart the loop.
    """
    with round_tables(nodes.sparkSession) as keep:
        near = keep(both_ways(edges.where(F.col("distance") <= limit)))
        labels = keep(nodes.select(F.col("instrument").alias("node"), F.col("instrument").alias("label")).distinct())
        for _ in range(max_rounds):
            seen = near.join(labels.withColumnRenamed("node", "dst"), "dst").groupBy("src").agg(F.min("label").alias("_l"))
            step = labels.join(seen.withColumnRenamed("src", "node"), "node", "left").select(
                "node", F.col("label").alias("_old"), F.least("label", "_l").alias("label")
            )
            hop = step.select(F.col("node").alias("label"), F.col("label").alias("_far"))
            nxt = keep(step.join(hop, "label").select("node", "_old", F.least("label", "_far").alias("label")))
            labels = nxt.select("node", "label")
            if nxt.where(F.col("_old") != F.col("label")).isEmpty():
                break
        else:
            raise RuntimeError("components did not settle; raise max_rounds")
        return materialise(labels.select(F.col("node").alias("instrument"), F.col("label").alias("cluster")), "clusters")


def spanning_tree(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(instrument_i, instrument_j, distance): the minimum spanning forest of the edges, by Borůvka's rounds.

    Edges are ordered by (distance, instrument_i, instrument_j) with the ends in order, so the forest is one and the same at ties and for
    any layout; distances that are null or NaN and loops are left out, of repeated edges the shortest counts. Each round every component
    takes its least edge to another one, chains of choices are followed by doubling, and edges between the same two components shrink to
    the least one. Components at least halve, so the rounds grow with the logarithm of the instruments; every table of a round is stored.
    """
    ends = edges.where(F.col("distance").isNotNull() & ~F.isnan("distance")).select(
        F.least("instrument_i", "instrument_j").alias("a"), F.greatest("instrument_i", "instrument_j").alias("b"), "distance"
    )
    edge = F.struct(F.col("distance"), F.col("a").alias("i"), F.col("b").alias("j"))
    ways = F.array(
        F.struct(F.col("a").alias("c"), F.col("b").alias("other")), F.struct(F.col("b").alias("c"), F.col("a").alias("other"))
    )
    with round_tables(edges.sparkSession) as keep:
        alive = keep(ends.where("a < b").groupBy("a", "b").agg(F.min(edge).alias("edge")))
        tree = alive.select("edge").limit(0)
        for _ in range(max_rounds):
            least = F.min(F.struct("edge", "other")).alias("least")
            best = keep(alive.select("edge", F.inline(ways)).groupBy("c").agg(least).select("c", "least.*"))
            if best.isEmpty():
                break
            tree = tree.unionByName(best.select("edge").distinct())
            # where two components choose the same edge, the smaller one is the root of their tree
            back = best.select(F.col("c").alias("other"), F.col("edge").alias("_back"))
            root = (F.col("edge") == F.col("_back")) & (F.col("c") < F.col("other"))
            parents = keep(best.join(back, "other").select("c", F.when(root, F.col("c")).otherwise(F.col("other")).alias("p")))
            while True:
                far = parents.toDF("p", "_far")
                step = keep(parents.join(far, "p").select("c", F.col("p").alias("_old"), F.col("_far").alias("p")))
                parents = step.select("c", "p")
                if step.where(F.col("_old") != F.col("p")).isEmpty():
                    break
            left, right = parents.toDF("a", "_a"), parents.toDF("b", "_b")
            moved = alive.join(left, "a").join(right, "b").where(F.col("_a") != F.col("_b"))
            merged = moved.groupBy(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
            alive = keep(merged.agg(F.min("edge").alias("edge")))
        else:
            raise RuntimeError("components did not settle; raise max_rounds")
        named = tree.select(F.col("edge.i").alias("instrument_i"), F.col("edge.j").alias("instrument_j"), "edge.distance")
        return materialise(named, "tree")


def cut_tree(nodes: DataFrame, tree: DataFrame, k: int) -> DataFrame:
    """(instrument, cluster): the single-linkage hierarchy of a spanning tree, cut into ``k`` clusters named by their smallest instrument.

    The edges of the tree in ascending order are the merges, so the cut undoes the heaviest ones. Instruments without an edge are clusters
    of their own. With more than ``k`` parts to begin with there are that many clusters, and with fewer instruments than ``k`` one for each.
    """
    parts = nodes.agg(F.count_distinct("instrument")).first()[0] - tree.count()
    if k > parts:
        ends = ["instrument_i", "instrument_j"]
        heaviest = tree.orderBy(F.desc("distance"), *[F.desc(c) for c in ends]).limit(k - parts)  # fewer than k rows
        tree = tree.join(heaviest.select(*ends), ends, "left_anti")
    return distance_clusters(nodes, tree, math.inf)


def fixed_clusters(nodes: DataFrame, edges: DataFrame, k: int = 8) -> DataFrame:
    """``k`` single-linkage clusters of all edges, see ``cut_tree``; every distance counts, no instrument stands for others."""
    return cut_tree(nodes, spanning_tree(edges), k)


def peer_map(
    edges: DataFrame,
    clusters: DataFrame | None = None,
    min_abs: float = MIN_CORRELATION,
    k: int = MAX_PEERS,
) -> DataFrame:
    """Top ``k`` peers of each instrument by absolute correlation, with cluster flag."""
    cand = both_ways(edges.where(F.abs("rho") >= min_abs), "rho")
    top = top_per_key(cand, k, ["src"], [F.desc(F.abs("rho")), F.col("dst")])
    out = top.select(
        F.col("src").alias("instrument"),
        F.col("dst").alias("peer"),
        F.col("place").alias("rank"),
        F.col("rho").alias("correlation"),
        F.abs("rho").alias("weight"),
    )
    if clusters is None:
        return out
    mine = clusters.select("instrument", F.col("cluster").alias("_c1"))
    theirs = clusters.select(F.col("instrument").alias("peer"), F.col("cluster").alias("_c2"))
    return (
        out.join(mine, "instrument", "left")
        .join(theirs, "peer", "left")
        .withColumn("is_cluster_peer", F.coalesce(F.col("_c1") == F.col("_c2"), F.lit(False)))
        .drop("_c1", "_c2")
    )


def merged_peers(candidates: DataFrame, n: int = 5) -> DataFrame:
    """Top ``n`` peers per target by mean score over the sources (target, peer, source, score)."""
    scores = candidates.groupBy("target", "peer").agg(
        F.avg("score").alias("score"), F.count(F.lit(1)).alias("sources")
    )
    return top_per_key(scores, n, ["target"], [F.desc("score"), F.col("peer")])


def peer_candidates(correlated: DataFrame, cointegrated: DataFrame, lead_lag: DataFrame) -> DataFrame:
    """Candidates of all sources in one schema (target, peer, source, score)."""
    parts = (
        (both_ways(correlated, "rho"), F.abs("rho"), "correlation"),
        (both_ways(cointegrated, "t_stat_compat"), F.abs("t_stat_compat"), "cointegration"),
        (both_ways(lead_lag, "max_ccf"), F.abs("max_ccf"), "lead_lag"),
    )
    out = None
    for df, score, name in parts:
        one = df.select(
            F.col("src").alias("target"), F.col("dst").alias("peer"), F.lit(name).alias("source"), score.alias("score")
        )
        out = one if out is None else out.unionByName(one)
    return out


# ---- alignment, lead-lag, cointegration --------------------------------------------------------


def pair_alignment(df: DataFrame, value: str, last: int | None = None, min_rows: int = 1) -> DataFrame:
    """Common dates of each pair: number, first and last date index of the last ``last``."""

    def kernel(a, b):
        both = ~np.isnan(a) & ~np.isnan(b)
        if last is not None:
            both &= np.cumsum(both[:, ::-1], 1)[:, ::-1] <= last
        t = np.arange(a.shape[1])
        return {
            "n": both.sum(1).astype("int64"),
            "first_t": np.where(both, t, a.shape[1]).min(1).astype("int32"),
            "last_t": np.where(both, t, -1).max(1).astype("int32"),
        }

    return pr.pair_statistics(
        indexed(df, value), kernel, "n long, first_t int, last_t int", lambda o: o["n"] >= min_rows
    )


def lead_lag(
    df: DataFrame,
    value: str = "log_return",
    rows: int = LEAD_LAG_ROWS,
    max_lag: int = MAX_LAG,
    min_ccf: float = MIN_CCF,
    min_rows: int = MIN_OBSERVATIONS,
    date_aligned: bool = False,
) -> DataFrame:
    """Best lagged correlation of each pair over its last common rows.

    Lag k > 0: i leads j by k rows. ``date_aligned`` correlates same-date values of the two
    trimmed ranges instead, as a label-aligned series correlation does.
    """

    def kernel(a, b):
        a, b, n = pr.last_common(a, b, rows)
        best, lag = np.zeros(len(a)), np.zeros(len(a), dtype="int32")
        for k in range(1, max_lag + 1):
            for sign, x, y in ((1, a, b), (-1, b, a)):
                if date_aligned:
                    first = (a.shape[1] - np.minimum(n, rows))[:, None]
                    pos = np.arange(a.shape[1])[None, :] - first
                    keep = (pos >= k) & (pos < np.minimum(n, rows)[:, None] - k)
                    r, _ = pr.masked_pearson(np.where(keep, x, np.nan), y)
                else:
                    r, _ = pr.masked_pearson(x[:, :-k], y[:, k:])
                better = np.abs(r) > np.abs(best)
                best, lag = np.where(better, r, best), np.where(better, sign * k, lag)
        return {"n": n.astype("int64"), "best_lag": lag.astype("int32"), "max_ccf": best}

    return pr.pair_statistics(
        indexed(df, value),
        kernel,
        "n long, best_lag int, max_ccf double",
        lambda o: (o["n"] >= min_rows) & (np.abs(o["max_ccf"]) >= min_ccf),
    )


def lead_lag_map(edges: DataFrame) -> DataFrame:
    """Follower, leader, lag, ccf."""
    i_leads = F.col("best_lag") > 0
    return edges.select(
        F.when(i_leads, F.col("instrument_j")).otherwise(F.col("instrument_i")).alias("follower"),
        F.when(i_leads, F.col("instrument_i")).otherwise(F.col("instrument_j")).alias("leader"),
        F.abs("best_lag").alias("lag"),
        F.col("max_ccf").alias("ccf"),
    )


def cointegration(
    df: DataFrame,
    price: str = "close_adj",
    rows: int = COINTEGRATION_ROWS,
    min_rows: int = MIN_OBSERVATIONS,
    max_rho: float = -0.1,
    half_life: tuple[float, float] = (MIN_HALF_LIFE, MAX_HALF_LIFE),
) -> DataFrame:
    """Regress log prices, then an AR(1) on the residual's change; keep mean-reverting pairs."""

    def kernel(a, b):
        a, b, n = pr.last_common(a, b, rows)
        beta, intercept, m = pr.ols(a, b)
        resid = a - (intercept[:, None] + beta[:, None] * b)
        lagged, change = resid[:, :-1], np.diff(resid, axis=1)
        rho, const, k = pr.ols(change, lagged)
        err = change - const[:, None] - rho[:, None] * lagged
        ok = ~np.isnan(err)
        mean_lag = np.where(ok, lagged, 0).sum(1) / k
        sxx = np.where(ok, (lagged - mean_lag[:, None]) ** 2, 0).sum(1)
        see = np.sqrt(np.where(ok, err * err, 0).sum(1) / (k - 2) / sxx)
        life = np.where((rho < 0) & (rho > -1), -math.log(2) / np.log1p(np.where(rho > -1, rho, 0.0)), np.inf)
        mean = np.nansum(resid, 1) / m
        std = np.sqrt(np.nansum((resid - mean[:, None]) ** 2, 1) / m)
        return {
            "n": m.astype("int64"),
            "beta": beta,
            "intercept": intercept,
            "rho": rho,
            "half_life": life,
            "spread_mean": mean,
            "spread_std": std,
            "current_z_score": (resid[:, -1] - mean) / (std + 1e-10),
            "t_stat": rho / see,
            "t_stat_compat": rho / (np.sqrt(sxx / k) + 1e-10),
            "_common": n,
        }

    def keep(o):
        inside = (o["half_life"] >= half_life[0]) & (o["half_life"] <= half_life[1])
        return (o["_common"] >= min_rows) & (o["rho"] < max_rho) & (o["rho"] > -1) & inside

    logs = df.where(F.col(price) > 0).withColumn("_lp", F.log(price))
    return pr.pair_statistics(
        indexed(logs, "_lp"),
        kernel,
        "n long, beta double, intercept double, rho double, half_life double, spread_mean double, "
        "spread_std double, current_z_score double, t_stat double, t_stat_compat double",
        keep,
    )


def cointegration_map(edges: DataFrame) -> DataFrame:
    """Both directions: the partner's view has 1/beta and the opposite z-score."""
    ways = F.array(
        F.struct(
            F.col("instrument_i").alias("instrument"),
            F.col("instrument_j").alias("partner"),
            F.col("beta").alias("beta"),
            F.col("current_z_score").alias("current_z_score"),
        ),
        F.struct(
            F.col("instrument_j").alias("instrument"),
            F.col("instrument_i").alias("partner"),
            F.try_divide(F.lit(1.0), "beta").alias("beta"),
            (-F.col("current_z_score")).alias("current_z_score"),
        ),
    )
    return edges.select(F.inline(ways), "half_life")
