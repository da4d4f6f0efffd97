"""Feature research: importance, stability, drift, leakage-safe preparation, macro and buzz."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.ewm import span_alpha, with_ewm
from tickloom.functions.frames import KEYS, ORDER, add_row_number, last_rows, prior, roll_mean, roll_std, series
from tickloom.functions.ranks import quantiles, with_average_rank
from tickloom.operators import corporate_events as ce
from tickloom.operators.models import grouped_ridge_cv
from tickloom.operators.relationships import student_p_value

# ---- feature quality --------------------------------------------------------------------------


def _long(df: DataFrame, features: Sequence[str], *keep: str) -> DataFrame:
    return df.select(*keep, *[F.col(f).cast("double") for f in features]).unpivot(
        list(keep), list(features), "feature", "value"
    ).where(F.col("value").isNotNull())


def information_coefficient(df: DataFrame, features: Sequence[str], target: str, min_rows: int = 30) -> DataFrame:
    """Absolute Spearman correlation of each feature with the target, over all rows.

    Ranks come from the two-level rank tables, so the whole-table sort is split.
    """
    long = _long(df.where(F.col(target).isNotNull()), features, target)
    ranked = with_average_rank(long, ["feature"], "value", "_rx", "_n1")
    ranked = with_average_rank(ranked, ["feature"], target, "_ry", "_n2")
    out = ranked.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.corr("_rx", "_ry").alias("_r"))
    dof = F.col("n") - 2
    t = F.col("_r") * F.sqrt(F.try_divide(dof, 1 - F.col("_r") * F.col("_r")))
    return out.where(F.col("n") > min_rows).select(
        "feature", "n", F.abs("_r").alias("ic"), student_p_value(t, dof).alias("p_value")
    )


def _stepped(df: DataFrame, features: Sequence[str], keys, order, extra: Sequence[str] = ()) -> DataFrame:
    return df.select(*keys, order, *extra, *[F.col(f).cast("double") for f in features]).unpivot(
        [*keys, order, *extra], list(features), "feature", "value"
    )


def feature_stability(
    df: DataFrame, features: Sequence[str], window: int = 252, step: int = 21, min_rows: int = 50, keys=KEYS, order=ORDER
) -> DataFrame:
    """Mean correlation of consecutive windows, a new pair of windows every ``step`` rows."""
    long = _stepped(df, features, keys, order)
    group = [*keys, "feature"]
    w = series(group, order)
    n = F.count(F.lit(1)).over(Window.partitionBy(*group))
    rows = long.withColumns(
        {"_i": F.row_number().over(w) - 1, "_len": n, "_before": F.lag("value", window).over(w)}
    )
    f = last_rows(window, group, order)
    held = (F.count("value").over(f) > min_rows) & (F.count("_before").over(f) > min_rows)
    rows = rows.withColumn("_c", F.when(held, F.corr("_before", "value").over(f)))
    start = F.col("_i") - (2 * window - 1)
    at = (start >= 0) & (start % step == 0) & (start < F.col("_len") - 2 * window)
    return (
        rows.where(at & F.col("_c").isNotNull())
        .groupBy(*group)
        .agg(F.count(F.lit(1)).alias("windows"), F.avg("_c").alias("stability"))
    )


# categories of selection, first match wins: fixed values
SELECTION_KINDS = (
    ("momentum", ("momentum",)),
    ("mean_reversion", ("reversion", "rank")),
    ("spread", ("spread",)),
    ("basket", ("basket",)),
    ("technical", ("rsi", "macd", "bollinger", "atr")),
    ("regime", ("regime",)),
    ("seasonal", ("dow", "month", "seasonal")),
)


def balanced_selection(importance: DataFrame, max_features: int = 50) -> DataFrame:
    """Best features of each category, the same number for every category."""
    kind = None
    for name, parts in SELECTION_KINDS:
        hit = F.col("feature").rlike("|".join(parts))
        kind = F.when(hit, name) if kind is None else kind.when(hit, name)
    share = max_features // len(SELECTION_KINDS)
    w = Window.partitionBy("category").orderBy(F.desc("importance"), "feature")
    return (
        importance.withColumn("category", kind)
        .where("category IS NOT NULL")
        .withColumn("place", F.row_number().over(w))
        .where(F.col("place") <= share)
    )


def correlated_features(df: DataFrame, features: Sequence[str], limit: float = 0.8) -> DataFrame:
    """(feature, max_correlation, dropped): a feature goes if an earlier one is too close.

    All pairs of the fixed feature list are one aggregation over complete rows.
    """
    pairs = [(i, j) for j in range(len(features)) for i in range(j)]
    one = df.dropna("any", subset=list(features)).agg(
        *[F.abs(F.corr(features[i], features[j])).alias(f"c_{i}_{j}") for i, j in pairs]
    )
    rows = []
    for j, f in enumerate(features):
        mine = [F.col(f"c_{i}_{j}") for i in range(j)]
        worst = F.greatest(*mine, F.lit(0.0)) if mine else F.lit(0.0)
        rows.append(F.struct(F.lit(f).alias("feature"), worst.alias("max_correlation")))
    return one.select(F.inline(F.array(*rows))).withColumn("dropped", F.col("max_correlation") > limit)


def single_feature_scores(df: DataFrame, features: Sequence[str], target: str, k: int = 5, keys=KEYS, order=ORDER) -> DataFrame:
    """Mean over folds of the out-of-fold squared error of a one-feature ridge."""
    long = _stepped(df, features, keys, order, [target])
    oof = grouped_ridge_cv(long, ["value"], target, [*keys, "feature"], order, k, 1.0, scale=False)
    per = oof.where("fold > 0").groupBy(*keys, "feature", "fold").agg(
        F.avg(F.pow(F.col("y") - F.col("y_hat"), 2)).alias("_mse")
    )
    return per.groupBy(*keys, "feature").agg(F.avg("_mse").alias("mse"))


def combined_importance(scores: DataFrame) -> DataFrame:
    """Sum over methods, divided by the largest sum (feature, method, score)."""
    total = scores.groupBy("feature").agg(F.sum("score").alias("_s"))
    top = total.agg(F.max("_s").alias("_top"))
    return total.crossJoin(F.broadcast(top)).select("feature", F.try_divide("_s", "_top").alias("importance"))


def performance_history(
    df: DataFrame, features: Sequence[str], target: str, window: int = 252, step: int = 21, keys=KEYS, order=ORDER
) -> DataFrame:
    """Rolling correlation with the target every ``step`` rows, numbered from 1."""
    long = _stepped(df, features, keys, order, [target])
    group = [*keys, "feature"]
    w = series(group, order)
    f = last_rows(window, group, order)
    both = F.when(F.col("value").isNotNull() & F.col(target).isNotNull(), 1)
    corr = F.when(F.count(both).over(f) > 2, F.corr("value", target).over(f))
    rows = long.withColumns(
        {"_i": F.row_number().over(w) - 1, "_len": F.count(F.lit(1)).over(Window.partitionBy(*group)), "correlation": corr}
    )
    start = F.col("_i") - (window - 1)
    at = (start >= 0) & (start % step == 0) & (F.col("_i") < F.col("_len") - 1)
    return rows.where(at).select(*group, order, (start / step + 1).cast("int").alias("period"), "correlation")


def feature_decay(history: DataFrame, limit: float = 0.1, recent: int = 4, keys=KEYS) -> DataFrame:
    """Relative drop of the mean of the last periods; NULL when there are too few."""
    group = [*keys, "feature"]
    last = history.groupBy(*group).agg(F.max("period").alias("_last"))
    new = F.col("period") > F.col("_last") - recent
    return (
        history.join(last, group)
        .groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.avg(F.when(new, F.col("correlation"))).alias("recent"),
            F.avg(F.when(~new, F.col("correlation"))).alias("historical"),
        )
        .where(F.col("_n") >= recent)
        .withColumn("decay_rate", F.try_divide(F.col("historical") - F.col("recent"), F.col("historical")))
        .withColumn("decaying", F.coalesce(F.col("decay_rate") > limit, F.lit(False)))
        .drop("_n")
    )


def feature_drift(df: DataFrame, features: Sequence[str], train_until: str, n: int = 60, limit: float = 2.0, keys=KEYS, order=ORDER) -> DataFrame:
    """Rolling mean against the train period: z and robust z (median, 1.4826 MAD)."""
    long = _stepped(df, features, keys, order)
    group = [*keys, "feature"]
    train = long.where(F.col(order) <= F.lit(train_until).cast("date"))
    stats = train.groupBy(*group).agg(F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s"))
    med = quantiles(train, group, "value", [0.5], ["_med"])
    dev = train.join(med, group).withColumn("_d", F.abs(F.col("value") - F.col("_med")))
    mad = quantiles(dev, group, "_d", [0.5], ["_mad"])
    rolled = long.withColumn("rolling_mean", roll_mean(F.col("value"), n, group, order))
    z = F.try_divide(F.col("rolling_mean") - F.col("_m"), F.col("_s"))
    rz = F.try_divide(F.col("rolling_mean") - F.col("_med"), 1.4826 * F.col("_mad"))
    return (
        rolled.join(stats, group)
        .join(med, group)
        .join(mad, group)
        .select(*group, order, z.alias("drift_z"), rz.alias("robust_z"))
        .withColumn("drifted", F.coalesce(F.abs("drift_z") > limit, F.lit(False)))
    )


def variance_inflation(df: DataFrame, features: Sequence[str], limit: float = 10.0) -> DataFrame:
    """Variance inflation of each feature: diagonal of the inverse k x k correlation matrix.

    The rows are one aggregation; a single row of k (k - 1) / 2 numbers reaches numpy.
    """
    k = len(features)
    pairs = [(i, j) for i in range(k) for j in range(i + 1, k)]
    one = df.dropna("any", subset=list(features)).agg(
        *[F.corr(features[i], features[j]).alias(f"c_{i}_{j}") for i, j in pairs]
    )

    def invert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                c = np.eye(k)
                for (i, j), x in zip(pairs, row):
                    c[i, j] = c[j, i] = x
                yield pd.DataFrame({"feature": list(features), "vif": np.diag(np.linalg.pinv(c))})

    return one.mapInPandas(invert, "feature string, vif double").withColumn("too_high", F.col("vif") > limit)


def decile_means(df: DataFrame, feature: str, target: str) -> DataFrame:
    """Mean target by decile of the feature over all rows."""
    names = [f"_e{i}" for i in range(1, 10)]
    rows = df.where(F.col(feature).isNotNull() & F.col(target).isNotNull())
    edges = quantiles(rows, [], feature, [i / 10 for i in range(1, 10)], names)
    bin_no = F.lit(1)
    for e in names:
        bin_no = bin_no + F.when(F.col(feature) > F.col(e), 1).otherwise(0)
    return (
        rows.crossJoin(F.broadcast(edges))
        .groupBy(bin_no.alias("decile"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("mean_target"))
    )


def expanding_splits(df: DataFrame, cuts: Sequence[str], order: str = ORDER) -> DataFrame:
    """Each row once per fold: train before the cut, test until the next cut."""
    d = F.col(order)
    entries = []
    for i, cut in enumerate(cuts):
        start = F.lit(cut).cast("date")
        end = F.lit(cuts[i + 1]).cast("date") if i + 1 < len(cuts) else None
        part = F.when(d < start, "train")
        part = part.when(d < end, "test") if end is not None else part.otherwise("test")
        entries.append(F.struct(F.lit(i + 1).alias("fold"), part.alias("part")))
    return df.select("*", F.inline(F.array(*entries))).where("part IS NOT NULL")


def train_only_preparation(df: DataFrame, features: Sequence[str], keys: Sequence[str] = ("fold",)) -> DataFrame:
    """Fill gaps with train medians and scale by train mean and deviation, per fold."""
    train = df.where("part = 'train'")
    long = train.select(*keys, *features).unpivot(list(keys), list(features), "_f", "_x")
    med = quantiles(long, [*keys, "_f"], "_x", [0.5], ["_med"])
    stats = med.groupBy(*keys).agg(*[F.max(F.when(F.col("_f") == f, F.col("_med"))).alias(f"_med_{f}") for f in features])
    filled = df.join(stats, list(keys)).withColumns({f: F.coalesce(F.col(f), F.col(f"_med_{f}")) for f in features})
    scale = filled.where("part = 'train'").groupBy(*keys).agg(
        *[F.avg(f).alias(f"_m_{f}") for f in features], *[F.stddev_pop(f).alias(f"_s_{f}") for f in features]
    )
    out = filled.join(scale, list(keys)).withColumns(
        {f: (F.col(f) - F.col(f"_m_{f}")) / F.when(F.col(f"_s_{f}") > 0, F.col(f"_s_{f}")).otherwise(1.0) for f in features}
    )
    return out.drop(*[f"{p}_{f}" for f in features for p in ("_med", "_m", "_s")])


def leakage_audit(df: DataFrame, stamps: Sequence[str], origin: str = ORDER) -> DataFrame:
    """Rows per timestamp column that lie after the label's origin."""
    one = df.agg(*[F.count_if(F.col(c) > F.col(origin)).alias(c) for c in stamps])
    return one.unpivot([], list(stamps), "column_name", "leaks").withColumn("leaking", F.col("leaks") > 0)


# ---- signals -------------------------------------------------------------------------------------


def reversion_pressure(edges: DataFrame) -> DataFrame:
    return edges.withColumn("reversion_pressure", -F.col("current_z_score") / F.col("half_life"))


def news_shock(df: DataFrame, n: int = 60, limit: float = 2.0, keys=KEYS, order=ORDER) -> DataFrame:
    """Article count against its last n rows: z-score and shock flag."""
    c = F.col("article_count")
    z = F.try_divide(c - roll_mean(c, n, keys, order), roll_std(c, n, keys, order))
    return df.withColumn("count_zscore", z).withColumn(
        "news_volume_shock", F.coalesce(F.col("count_zscore") > limit, F.lit(False))
    )


def sentiment_delta(df: DataFrame, span: int = 10, keys=KEYS, order=ORDER) -> DataFrame:
    """Sentiment less its exponential mean."""
    df = with_ewm(df, {"_ema": ("sentiment_mean", span_alpha(span), 0)}, keys, order)
    return df.withColumn("sentiment_delta", F.col("sentiment_mean") - F.col("_ema")).drop("_ema")


def macro_panel(econ: DataFrame, long_rate: str, short_rate: str, others: Sequence[str] = ()) -> DataFrame:
    """One row per date: series levels, curve slope and one-step changes, values carried forward.

    The panel is bounded by the calendar: one row per date.
    """
    names = [long_rate, short_rate, *others]
    wide = econ.where(F.col("symbol").isin(names)).groupBy("date").agg(
        *[F.max(F.when(F.col("symbol") == s, F.col("value"))).alias(f"v{i}") for i, s in enumerate(names)]
    )
    w = Window.orderBy("date")
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    filled = wide.withColumns({f"v{i}": F.last(f"v{i}", ignorenulls=True).over(back) for i in range(len(names))})
    return filled.withColumn("slope", F.col("v0") - F.col("v1")).withColumns(
        {
            **{f"delta_v{i}": F.col(f"v{i}") - F.lag(f"v{i}").over(w) for i in range(len(names))},
            "delta_slope": F.col("slope") - F.lag("slope").over(w),
        }
    )


def as_of_panel(df: DataFrame, panel: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Backward as-of join of a per-date panel: the last panel row on or before each date.

    Only the dates (bounded by the calendar) are aligned; rows then join on equality.
    """
    dates = df.select("date").distinct().withColumn("_d", F.lit(True))
    merged = dates.join(panel.select("date", F.struct(*columns).alias("_row")), "date", "full_outer")
    back = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    found = merged.withColumn("_row", F.last("_row", ignorenulls=True).over(back)).where("_d").select("date", "_row.*")
    return df.join(found, "date", "left")


def surprise(df: DataFrame, actual: str, consensus: str, group: Sequence[str]) -> DataFrame:
    """(actual - consensus) / deviation of that difference within the group."""
    d = F.col(actual) - F.col(consensus)
    std = df.withColumn("_d", d).groupBy(*group).agg(F.stddev_samp("_d").alias("_s"))
    return df.join(std, list(group)).withColumn("surprise", F.try_divide(d, F.col("_s"))).drop("_s")


def earnings_windows(bars: DataFrame, events: DataFrame, days: int = 5) -> DataFrame:
    """Days to the next and since the last event, with pre and post flags."""
    out = ce.prior_event(ce.next_event(bars, events), events, "days_since_earnings")
    return out.withColumns(
        {
            "pre_earnings": F.coalesce(F.col("days_to_earnings").between(1, days), F.lit(False)),
            "post_earnings": F.coalesce(F.col("days_since_earnings").between(1, days), F.lit(False)),
        }
    )


def event_sentiment(df: DataFrame) -> DataFrame:
    s = F.col("sentiment_mean")
    return df.withColumns(
        {
            "sentiment_earnings_period": s * F.col("earnings_week").cast("int"),
            "sentiment_pre_earnings": s * F.col("pre_earnings").cast("int"),
            "sentiment_insider_divergence": s - F.col("insider_activity_score"),
        }
    )


def action_quality_score(df: DataFrame, big_move: float = 0.5, keys=KEYS, order=ORDER) -> DataFrame:
    """0.4 split ok + 0.4 dividend ok + 0.2 no unusual move, per row with event flags.

    A split (dividend) day is ok when the move is not large after the factor is applied.
    """
    move = F.abs(F.try_divide(F.col("close"), prior(F.col("close"), 1, keys, order)) - 1)
    df = df.withColumn("_m", F.coalesce(move, F.lit(0.0)))
    large = F.col("_m") > big_move
    near = F.col("recent_split") | F.col("recent_dividend")
    ok_split = ~(F.col("recent_split") & large)
    ok_div = ~(F.col("ex_dividend_date") & large)
    return df.withColumn(
        "corporate_action_quality_score",
        0.4 * ok_split.cast("int") + 0.4 * ok_div.cast("int") + 0.2 * (1 - (near & large).cast("int")),
    ).drop("_m")


def turnover(df: DataFrame, floats: DataFrame) -> DataFrame:
    """Volume by free float (instrument, free_float)."""
    return df.join(floats, "instrument", "left").withColumn("turnover", F.try_divide("volume", "free_float"))


def social_buzz(posts: DataFrame, n: int = 10, keys=KEYS, order=ORDER) -> DataFrame:
    """Mentions, authors, engagement per post and the mention z-score, per instrument and date."""
    daily = posts.groupBy("instrument", "date").agg(
        F.count(F.lit(1)).alias("mentions"),
        F.countDistinct("author").alias("unique_authors"),
        F.avg("engagement").alias("engagement_per_post"),
    )
    c = F.col("mentions")
    return daily.withColumn(
        "buzz_zscore", F.try_divide(c - roll_mean(c, n, keys, order), roll_std(c, n, keys, order))
    )


# ---- configured rules ------------------------------------------------------------------------------

# days until an indicator counts as stale, by frequency: fixed values
STALE_DAYS = {"Daily": 7, "Weekly": 14, "Monthly": 45, "Quarterly": 120, "Annual": 400}
MAX_EPS_CHANGE = 500.0


def stale_by_frequency(df: DataFrame, as_of: str) -> DataFrame:
    """Per indicator: age against the limit of its frequency."""
    limit = F.lit(None).cast("int")
    for name, days in STALE_DAYS.items():
        limit = F.when(F.col("frequency") == name, days).otherwise(limit)
    return (
        df.groupBy("symbol", "frequency")
        .agg(F.datediff(F.lit(as_of).cast("date"), F.max("date")).alias("age_days"))
        .withColumn("limit_days", limit)
        .withColumn("is_stale", F.col("age_days") > F.col("limit_days"))
    )


def news_rule_violations(df: DataFrame) -> DataFrame:
    """Articles breaking each field rule, as (rule, n)."""
    rules = {
        "headline shorter than 10": F.length("headline") < 10,
        "headline longer than 200": F.length("headline") > 200,
        "missing date": F.col("date").isNull(),
        "missing source": F.col("source").isNull(),
        "unknown label": ~F.col("sentiment_label").isin("positive", "negative", "neutral"),
        "score outside -1 to 1": ~F.col("sentiment_score").between(-1.0, 1.0),
    }
    one = df.agg(*[F.count_if(e).alias(n) for n, e in rules.items()])
    return one.unpivot([], [F.col(f"`{n}`") for n in rules], "rule", "n")


def eps_changes(df: DataFrame, limit: float = MAX_EPS_CHANGE) -> DataFrame:
    """Percent EPS change between reports of a symbol and whether it breaks the limit."""
    before = F.lag("eps").over(Window.partitionBy("symbol").orderBy("date"))
    change = F.try_divide(F.abs(F.col("eps") - before), F.abs(before)) * 100
    return df.withColumn("eps_change", change).withColumn(
        "excessive", F.coalesce(F.col("eps_change") > limit, F.lit(False))
    )
