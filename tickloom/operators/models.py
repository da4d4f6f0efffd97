"""Model preparation, fits on Spark ML or from sums, and model bookkeeping.

Per-instrument linear fits never gather an instrument's rows: cross products combine
map-side, cumulative sums over folds give every training set at once, and only the small
systems of equations (features squared) reach numpy inside tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.frames import KEYS, ORDER, last_rows, series
from tickloom.functions.ranks import quantiles
from tickloom.session import ensure_checkpoints, materialise

#: Sums of the same rows differ by less, whatever their order.
SETTLED = 1e-9
ACCURACY_METRICS = ("accuracy", "precision", "recall", "f1")


# ---- preparation ---------------------------------------------------------------------------


def standardise(df: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """(x - mean) / population deviation, 0 spread left centred."""
    stats = df.groupBy(*group).agg(
        *[F.avg(c).alias(f"_m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns]
    )
    joined = df.join(stats, list(group)) if group else df.crossJoin(F.broadcast(stats))
    out = {
        c: (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(1.0)
        for c in columns
    }
    return joined.withColumns(out).drop(*[f"_{k}_{c}" for c in columns for k in ("m", "s")])


def robust_scale(df: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """(x - median) / interquartile range."""
    keys = [*group, "_f"]
    long = df.select(*group, *columns).unpivot(list(group), list(columns), "_f", "_x")
    edges = quantiles(long, keys, "_x", [0.25, 0.5, 0.75], ["_q1", "_q2", "_q3"])
    wide = edges.groupBy(*group).agg(
        *[F.max(F.when(F.col("_f") == c, F.col(q))).alias(f"{q}_{c}") for c in columns for q in ("_q1", "_q2", "_q3")]
    )
    joined = df.join(wide, list(group)) if group else df.crossJoin(F.broadcast(wide))
    out = {}
    for c in columns:
        iqr = F.col(f"_q3_{c}") - F.col(f"_q1_{c}")
        out[c] = (F.col(c) - F.col(f"_q2_{c}")) / F.when(iqr > 0, iqr).otherwise(1.0)
    return joined.withColumns(out).drop(*[f"{q}_{c}" for c in columns for q in ("_q1", "_q2", "_q3")])


def hash_bucket(*keys: str) -> Column:
    """Stable 0-99 bucket of the key columns."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long") % 100


def train_test_split(df: DataFrame, keys: Sequence[str], train_share: int = 80) -> DataFrame:
    """Mark rows train or test by key hash: the same on every run and every retry."""
    return df.withColumn("split", F.when(hash_bucket(*keys) < train_share, "train").otherwise("test"))


def with_folds(df: DataFrame, k: int = 5, keys=KEYS, order=ORDER) -> DataFrame:
    """Fold 0 is training only; folds 1..k are consecutive blocks of n // (k + 1) rows."""
    w = series(keys, order)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    size = F.floor(n / (k + 1))
    fold = F.floor(F.try_divide(F.row_number().over(w) - 1 - (n - k * size), size)) + 1
    return df.withColumn("fold", F.greatest(F.lit(0), F.coalesce(fold, F.lit(0))).cast("int"))


# ---- linear fits from sums --------------------------------------------------------------------


def _sums(features: Sequence[str], target: str) -> list[Column]:
    cols = [*features, target]
    out = [F.count(F.lit(1)).cast("double").alias("s_n")]
    out += [F.sum(c).alias(f"s_{i}") for i, c in enumerate(cols)]
    out += [
        F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"s_{i}_{j}")
        for i in range(len(cols))
        for j in range(i, len(cols))
    ]
    return out


def _sum_names(k: int) -> list[str]:
    return ["s_n", *[f"s_{i}" for i in range(k + 1)], *[f"s_{i}_{j}" for i in range(k + 1) for j in range(i, k + 1)]]


def _solver(k: int, alpha: float, scale: bool, keep: Sequence[str]):
    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = pdf["s_n"].to_numpy(float)
            sums = np.stack([pdf[f"s_{i}"].to_numpy(float) for i in range(k + 1)], 1)
            cross = np.empty((len(pdf), k + 1, k + 1))
            for i in range(k + 1):
                for j in range(i, k + 1):
                    cross[:, i, j] = cross[:, j, i] = pdf[f"s_{i}_{j}"].to_numpy(float)
            mean = sums / n[:, None]
            centred = cross - n[:, None, None] * mean[:, :, None] * mean[:, None, :]
            sxx, sxy = centred[:, :k, :k].copy(), centred[:, :k, k].copy()
            sd = np.ones((len(pdf), k))
            if scale:
                sd = np.sqrt(np.diagonal(sxx, axis1=1, axis2=2) / n[:, None])
                sd = np.where(sd > 0, sd, 1.0)
                sxx /= sd[:, :, None] * sd[:, None, :]
                sxy /= sd
            beta = np.linalg.solve(sxx + alpha * np.eye(k), sxy[:, :, None])[:, :, 0] / sd
            icpt = mean[:, k] - (beta * mean[:, :k]).sum(1)
            sse = centred[:, k, k] - 2 * (beta * centred[:, :k, k]).sum(1)
            sse += np.einsum("ri,rij,rj->r", beta, centred[:, :k, :k], beta)
            out = pdf[list(keep)].copy()
            out["coefficients"] = list(beta)
            out["intercept"] = icpt
            out["train_rows"] = n.astype("int64")
            out["train_rmse"] = np.sqrt(np.maximum(sse, 0.0) / n)
            out["train_r2"] = 1 - sse / centred[:, k, k]
            yield out

    return solve


_FIT = "coefficients array<double>, intercept double, train_rows long, train_rmse double, train_r2 double"


def grouped_ridge(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    keys: Sequence[str] = KEYS,
    alpha: float = 1.0,
    scale: bool = False,
    min_rows: int = 3,
) -> DataFrame:
    """Ridge (alpha 0: least squares) per key from map-side combined sums."""
    rows = df.dropna("any", subset=[*features, target])
    sums = rows.groupBy(*keys).agg(*_sums(features, target)).where(F.col("s_n") >= min_rows)
    schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    return sums.mapInPandas(_solver(len(features), alpha, scale, keys), f"{schema}, {_FIT}")


def grouped_ridge_cv(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    keys: Sequence[str] = KEYS,
    order: str = ORDER,
    k: int = 5,
    alpha: float = 1.0,
    scale: bool = True,
) -> DataFrame:
    """Out-of-fold predictions of time-ordered folds, fold 0 NULL; scaling from the train part.

    One pass gives the sums of each (key, fold); a running sum over at most k + 1 folds gives
    every training set, so there is no loop of fits.
    """
    rows = with_folds(df.dropna("any", subset=[*features, target]), k, keys, order)
    per = rows.groupBy(*keys, "fold").agg(*_sums(features, target))
    before = Window.partitionBy(*keys).orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    names = _sum_names(len(features))
    train = per.select(*keys, "fold", *[F.sum(c).over(before).alias(c) for c in names]).where("fold > 0")
    schema = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in keys)
    fits = train.mapInPandas(
        _solver(len(features), alpha, scale, [*keys, "fold"]), f"{schema}, fold int, {_FIT}"
    )
    pred = F.col("intercept")
    for i, f in enumerate(features):
        pred = pred + F.col("coefficients")[i] * F.col(f)
    return rows.join(fits, [*keys, "fold"], "left").select(
        *keys, order, "fold", F.col(target).alias("y"), pred.alias("y_hat")
    )


# ---- Spark ML --------------------------------------------------------------------------------


def assemble(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    need = [*features, *([label] if label else [])]
    out = VectorAssembler(inputCols=list(features), outputCol="features").transform(df.dropna("any", subset=need))
    return out.withColumn("label", F.col(label).cast("double")) if label else out


def estimator(kind: str, classify: bool = False, **params):
    """Estimator by model name: the factory the registry of model types maps to."""
    from pyspark.ml import classification as c
    from pyspark.ml import regression as g

    kinds = {
        ("linear", False): lambda: g.LinearRegression(solver="normal", **params),
        ("ridge", False): lambda: g.LinearRegression(solver="normal", standardization=False, **params),
        ("random_forest", False): lambda: g.RandomForestRegressor(**{"numTrees": 100, "seed": 42, **params}),
        ("boosted_trees", False): lambda: g.GBTRegressor(**{"maxIter": 100, "seed": 42, **params}),
        ("random_forest", True): lambda: c.RandomForestClassifier(**{"numTrees": 100, "seed": 42, **params}),
        ("logistic", True): lambda: c.LogisticRegression(**params),
    }
    if (kind, classify) not in kinds:
        raise ValueError(f"no {'classifier' if classify else 'regressor'} named {kind}")
    return kinds[kind, classify]()


def ridge_reg_param(rows: DataFrame, label: str, alpha: float) -> float:
    """Spark's regParam for a penalty alpha on the raw sum of squares: two scalars are read."""
    one = rows.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return alpha * (one["s"] or 1.0) / max(one["n"], 1)


def fit_and_predict(df: DataFrame, features: Sequence[str], label: str, kind: str, keys: Sequence[str], classify=False, **params):
    """Fit on the train split; returns (model, predictions of all rows with split)."""
    rows = assemble(train_test_split(df, keys), features, label)
    if kind == "ridge" and "regParam" not in params:
        params["regParam"] = ridge_reg_param(rows.where("split = 'train'"), "label", 1.0)
    model = estimator(kind, classify, **params).fit(rows.where("split = 'train'"))
    return model, model.transform(rows)


def split_metrics(pred: DataFrame) -> DataFrame:
    return pred.select("split", F.col("label").alias("y"), F.col("prediction").alias("y_hat")).transform(
        lambda d: regression_metrics(d, ["split"])
    )


def importances(model, features: Sequence[str], spark) -> DataFrame:
    values = model.featureImportances.toArray()
    return spark.createDataFrame(
        [(f, float(x)) for f, x in zip(features, values)], "feature string, importance double"
    )


def kmeans(df: DataFrame, features: Sequence[str], k: int, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(assignments, one row per cluster: size, centre, inertia and silhouette of the fit)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator

    rows = assemble(df, features)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(rows)
    out = model.transform(rows)
    score = ClusteringEvaluator(featuresCol="features", predictionCol="cluster").evaluate(out)
    centres = df.sparkSession.createDataFrame(
        [(i, [float(x) for x in c], float(model.summary.trainingCost), float(score)) for i, c in enumerate(model.clusterCenters())],
        "cluster int, centre array<double>, inertia double, silhouette double",
    )
    sizes = out.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    return out.drop("features"), centres.join(sizes, "cluster", "left")


def gaussian_mixture(df: DataFrame, features: Sequence[str], k: int, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(assignments with probability, one row per component: weight, mean, AIC and BIC)."""
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.functions import vector_to_array

    rows = assemble(df, features)
    model = GaussianMixture(k=k, seed=seed, featuresCol="features", predictionCol="component").fit(rows)
    d = len(features)
    free = k - 1 + k * d + k * d * (d + 1) / 2
    ll, n = model.summary.logLikelihood, rows.count()
    aic, bic = 2 * free - 2 * ll, free * float(np.log(n)) - 2 * ll
    table = [
        (i, float(w), [float(x) for x in g.mean.toArray()], float(aic), float(bic))
        for i, (w, g) in enumerate(zip(model.weights, model.gaussians))
    ]
    out = model.transform(rows).withColumn("probability", vector_to_array("probability")).drop("features")
    return out, df.sparkSession.createDataFrame(table, "component int, weight double, mean array<double>, aic double, bic double")


def sweep(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """Test RMSE of each model kind; the best is marked."""
    out = None
    for kind in kinds:
        _, pred = fit_and_predict(df, features, label, kind, keys)
        row = split_metrics(pred).where("split = 'test'").select(F.lit(kind).alias("model"), "rmse", "mae", "r2")
        out = row if out is None else out.unionByName(row)
    best = out.agg(F.min_by("model", "rmse").alias("_best"))
    return out.crossJoin(F.broadcast(best)).withColumn("is_best", F.col("model") == F.col("_best")).drop("_best")


def text_classifier(train: DataFrame, text: str, label: str, cells: int = 1 << 16):
    """TF-IDF over one- and two-word terms with a logistic model; labels 0, 1, ...

    Every term counts: terms are hashed to ``cells`` places, so no vocabulary is gathered on the driver.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, NGram, RegexTokenizer, StopWordsRemover, VectorAssembler

    stages = [
        RegexTokenizer(inputCol=text, outputCol="_raw", pattern="[^\\p{L}]+"),
        StopWordsRemover(inputCol="_raw", outputCol="_words"),
        NGram(n=2, inputCol="_words", outputCol="_pairs"),
        HashingTF(inputCol="_words", outputCol="_c1", numFeatures=cells),
        HashingTF(inputCol="_pairs", outputCol="_c2", numFeatures=cells),
        VectorAssembler(inputCols=["_c1", "_c2"], outputCol="_c"),
        IDF(inputCol="_c", outputCol="features"),
        LogisticRegression(labelCol=label, featuresCol="features", regParam=0.01, maxIter=30),
    ]
    return Pipeline(stages=stages).fit(train)


def text_scores(model, df: DataFrame, keys: Sequence[str], values: Sequence[float] = (-1.0, 1.0)) -> DataFrame:
    """Expected value of the classes: the sum of probability times ``values`` (2p - 1 for two labels)."""
    from pyspark.ml.functions import vector_to_array

    p = vector_to_array("probability")
    score = sum((p[i] * v for i, v in enumerate(values)), F.lit(0.0))
    return model.transform(df).select(*keys, score.alias("score"))


def importance_selection(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], k: int = 5, sample_rows: int | None = None) -> DataFrame:
    """Top ``k`` features of a 50-tree forest fitted on all rows, or on the ``sample_rows`` of least hash if a number is given."""
    sample = df.dropna("any", subset=[*features, label])
    if sample_rows is not None:
        text = F.concat_ws("|", *[F.col(c).cast("string") for c in keys])
        sample = sample.orderBy(F.md5(text)).limit(sample_rows)
    model = estimator("random_forest", numTrees=50).fit(assemble(sample, features, label))
    return importances(model, features, df.sparkSession).orderBy(F.desc("importance"), "feature").limit(k)


# ---- regimes per instrument ---------------------------------------------------------------------


def grouped_regimes(
    df: DataFrame,
    features: Sequence[str],
    n_regimes: int = 4,
    max_rounds: int = 200,
    min_rows: int = 50,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Lloyd clustering inside each instrument, all instruments at once.

    Start: quantile groups of the first feature. A round joins the few centres of a key to
    its rows and averages again map-side; centres are checkpointed, rows are never gathered.
    Labels are ordered by the first feature's centre. Rounds go on until no centre moves; an error is raised if that
    does not happen within ``max_rounds``.
    """
    ensure_checkpoints(df.sparkSession)
    keys = list(keys)
    rows = df.dropna("any", subset=list(features))
    enough = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_rows)
    z = standardise(rows.join(enough.select(*keys), keys, "left_semi"), features, keys)
    z = materialise(z, "regime-rows")  # every round reads it
    first = features[0]
    names = [f"_q{i}" for i in range(1, n_regimes)]
    edges = quantiles(z, keys, first, [i / n_regimes for i in range(1, n_regimes)], names)
    start = F.lit(0)
    for q in names:
        start = start + F.when(F.col(first) > F.col(q), 1).otherwise(0)
    labelled = z.join(edges, keys).withColumn("regime", start).drop(*names)

    def centres(d: DataFrame) -> DataFrame:
        per = d.groupBy(*keys, "regime").agg(*[F.avg(c).alias(c) for c in features])
        return per.groupBy(*keys).agg(
            F.array_sort(F.collect_list(F.struct(*features, F.col("regime").alias("_r")))).alias("_centres")
        ).checkpoint()

    def distance(c):
        total = F.lit(0.0)
        for f in features:
            total = total + F.pow(c[f] - F.col(f), 2)
        return total

    table = centres(labelled)
    for _ in range(max_rounds):
        near = F.array_min(
            F.transform("_centres", lambda c, i: F.struct(distance(c).alias("d"), i.alias("i")))
        )["i"]
        labelled = z.join(table, keys).withColumn("regime", near).drop("_centres")
        nxt = centres(labelled)
        apart = F.zip_with("_new", "_old", lambda a, b: reduce(or_, [F.abs(a[f] - b[f]) > SETTLED for f in features]))
        pairs = nxt.withColumnRenamed("_centres", "_new").join(table.withColumnRenamed("_centres", "_old"), keys)
        moved = pairs.where((F.size("_new") != F.size("_old")) | F.exists(apart, lambda x: x))
        if moved.isEmpty():
            return labelled.withColumn("regime", F.col("regime").cast("int"))
        table = nxt
    raise RuntimeError("regimes did not settle; raise max_rounds")


def transition_matrix(df: DataFrame, state: str = "regime_id") -> DataFrame:
    """Counts and row probabilities of state changes per instrument."""
    moves = df.withColumn("from_regime", F.lag(state).over(series())).where("from_regime IS NOT NULL")
    counts = moves.groupBy("instrument", "from_regime", F.col(state).alias("to_regime")).agg(
        F.count(F.lit(1)).alias("n")
    )
    totals = counts.groupBy("instrument", "from_regime").agg(F.sum("n").alias("_t"))
    return counts.join(totals, ["instrument", "from_regime"]).select(
        "instrument", "from_regime", "to_regime", "n", (F.col("n") / F.col("_t")).alias("probability")
    )


# ---- evaluation -----------------------------------------------------------------------------------


def regression_metrics(pred: DataFrame, group: Sequence[str]) -> DataFrame:
    """RMSE, MAE, R2, MAPE and mean relative error of (y, y_hat), one aggregation.

    R2 uses sums around the group mean from the same pass: sst = n * population variance.
    """
    e = F.col("y") - F.col("y_hat")
    held = pred.where("y IS NOT NULL AND y_hat IS NOT NULL")
    return held.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(F.avg(e * e), F.var_pop("y"))).alias("r2"),
        F.avg(F.when(F.col("y") != 0, F.abs(e) / F.abs("y") * 100).otherwise(0.0)).alias("mape"),
        F.avg(F.when(F.col("y") != 0, -e / F.col("y") * 100).otherwise(0.0)).alias("relative_error"),
    )


def directional_accuracy(pred: DataFrame, group: Sequence[str]) -> DataFrame:
    """Share of rows whose actual and predicted level lie on the same side of ``last_level``."""
    actual, guess = F.col("y") > F.col("last_level"), F.col("y_hat") > F.col("last_level")
    return pred.where("y IS NOT NULL AND y_hat IS NOT NULL AND last_level IS NOT NULL").groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.avg((actual == guess).cast("double")).alias("directional_accuracy")
    )


def classification_accuracy(pred: DataFrame, group: Sequence[str]) -> DataFrame:
    return pred.where("y IS NOT NULL AND y_hat IS NOT NULL").groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("y") == F.col("y_hat")).cast("double")).alias("accuracy")
    )


def merge_predictions(df: DataFrame, pred: DataFrame) -> DataFrame:
    return df.join(pred.select("instrument", "date", F.col("y_hat").alias("prediction")), ["instrument", "date"], "left")


def ensemble_predictions(pred: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted mean of the model predictions of each row, for each training window where there are several."""
    w = F.col("weight")
    keys = ["instrument", "date", *[c for c in ("training_window",) if c in pred.columns]]
    return (
        pred.join(weights, "model")
        .where("y_hat IS NOT NULL")
        .groupBy(*keys)
        .agg(F.first("y").alias("y"), F.try_divide(F.sum(w * F.col("y_hat")), F.sum(w)).alias("y_hat"))
    )


def ensemble_weights(scores: DataFrame, metric: str) -> DataFrame:
    """Softmax of accuracy-like scores, normalised inverse of losses (target, model, score)."""
    top = scores.groupBy("target").agg(F.max("score").alias("_top"))
    raw = (
        F.exp(F.col("score") - F.col("_top"))
        if metric in ACCURACY_METRICS
        else 1.0 / (F.col("score") + 1e-8)
    )
    rows = scores.join(top, "target").withColumn("_w", raw)
    total = rows.groupBy("target").agg(F.sum("_w").alias("_t"))
    return rows.join(total, "target").select("target", "model", (F.col("_w") / F.col("_t")).alias("weight"))


def best_model(scores: DataFrame, keys: Sequence[str], metric: str) -> DataFrame:
    """Best model per key: highest accuracy or lowest loss, ties by name."""
    score = -F.col("score") if metric in ACCURACY_METRICS else F.col("score")
    return scores.groupBy(*keys).agg(
        F.min_by("model", F.struct(score, "model")).alias("best_model"),
        F.min_by("score", F.struct(score, "model")).alias("score"),
    )


def recent_performance(history: DataFrame, as_of: str, days: int) -> DataFrame:
    """Mean of each metric over the last ``days`` days (model, metric, ts, value)."""
    start = F.date_sub(F.lit(as_of).cast("date"), days)
    return history.where(F.col("date") >= start).groupBy("model", "metric").agg(F.avg("value").alias("value"))


def switch_signal(
    history: DataFrame, as_of: str, metric: str, limit: float = 0.05, any_fall: bool = False
) -> DataFrame:
    """True where the 30-day mean is worse than the 60-day mean by more than ``limit``: lower for accuracies, higher for losses.

    ``any_fall`` takes a fall as worse for every metric.
    """
    sign = 1 if any_fall or metric in ACCURACY_METRICS else -1
    recent = recent_performance(history, as_of, 30).where(F.col("metric") == metric)
    longer = recent_performance(history, as_of, 60).where(F.col("metric") == metric)
    a, b = F.coalesce("recent", F.lit(0.0)), F.col("historical")
    return (
        longer.select("model", F.col("value").alias("historical"))
        .join(recent.select("model", F.col("value").alias("recent")), "model", "left")
        .withColumn("should_switch", F.coalesce((b > 0) & (sign * (b - a) / b > limit), F.lit(False)))
    )


def backtest_summary(metrics: DataFrame) -> DataFrame:
    """Mean, population deviation and median of each metric by model and training window."""
    keys = ["model", "training_window", "metric"]
    med = quantiles(metrics, keys, "value", [0.5], ["median"])
    return (
        metrics.groupBy(*keys)
        .agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
        .join(med, keys)
    )


def rolling_backtest(df: DataFrame, x: str, y: str, windows: Sequence[int], keys=KEYS, order=ORDER) -> DataFrame:
    """Next-row predictions from the previous n rows, for a line, the mean and the last value.

    ``y`` of a row must be known by the next row; row t is predicted from rows t-n .. t-1.
    """
    rows = df.dropna("any", subset=[x, y])
    parts = []
    for n in windows:
        w = series(keys, order).rowsBetween(-n, -1)
        full = F.count(y).over(w) == n
        line = F.regr_intercept(y, x).over(w) + F.regr_slope(y, x).over(w) * F.col(x)
        for name, p in (("line", line), ("mean", F.avg(y).over(w)), ("last", F.lag(y).over(series(keys, order)))):
            parts.append((n, name, F.when(full, p)))
    cols = {f"_p{i}": p for i, (_, _, p) in enumerate(parts)}
    last = F.lag(y).over(series(keys, order))
    wide = rows.withColumns({**cols, "last_level": last})
    entries = F.array(
        *[
            F.struct(F.lit(n).alias("training_window"), F.lit(name).alias("model"), F.col(f"_p{i}").alias("y_hat"))
            for i, (n, name, _) in enumerate(parts)
        ]
    )
    return wide.select(*keys, order, F.col(y).alias("y"), "last_level", F.inline(entries)).where("y_hat IS NOT NULL")


def window_sums(v: np.ndarray, n: int) -> np.ndarray:
    """Sums of every ``n`` consecutive rows of ``v``.

    Rows are cut into blocks of ``n``: a window is the end of one block and the start of the next. Only sums, no differences, so nothing
    cancels, and the work does not depend on ``n``.
    """
    rows, tail = len(v), v.shape[1:]
    if rows < n:
        return np.empty((0, *tail))
    blocks = np.zeros((-(-rows // n) * n, *tail))
    blocks[:rows] = v
    blocks = blocks.reshape(-1, n, *tail)
    ahead = np.cumsum(blocks, axis=1).reshape(-1, *tail)
    behind = np.cumsum(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1, *tail)
    first = np.arange(rows - n + 1)
    inner = (first % n != 0).astype(float).reshape(-1, *[1] * len(tail))
    return behind[first] + inner * ahead[first + n - 1]


def _rolling_fits(x: np.ndarray, y: np.ndarray, n: int, alpha: float, scale: bool) -> np.ndarray:
    """Prediction of rows n, n + 1, ... from the n rows before each, by ridge with an unpenalised intercept."""
    k = x.shape[1]
    centre = np.append(x.mean(0), y.mean())
    z = np.column_stack([x, y]) - centre  # near zero, so that products of means do not cancel
    total = window_sums(z, n)[:-1]
    cross = window_sums(z[:, :, None] * z[:, None, :], n)[:-1]
    mean = total / n
    size = np.sqrt(np.diagonal(cross, axis1=1, axis2=2)[:, :k] / n)
    cross = cross - n * mean[:, :, None] * mean[:, None, :]
    sd = np.sqrt(np.maximum(np.diagonal(cross, axis1=1, axis2=2)[:, :k], 0.0) / n)
    # a spread below 1e-6 of the values is rounding: the feature is constant in this window
    live = sd > 1e-6 * size
    sd = np.where(live, sd, 1.0)
    left = np.where(live[:, :, None] & live[:, None, :], cross[:, :k, :k] / (sd[:, :, None] * sd[:, None, :]), 0.0)
    right = np.where(live, cross[:, :k, k] / sd, 0.0)[:, :, None]
    if alpha > 0:
        left[:, np.arange(k), np.arange(k)] += alpha if scale else alpha / (sd * sd)
        beta = np.linalg.solve(left, right)[:, :, 0] / sd
    else:  # the pseudo-inverse leaves out what is constant or repeats other features
        beta = (np.linalg.pinv(left, rcond=1e-10, hermitian=True) @ right)[:, :, 0] / sd
    return centre[k] + mean[:, k] + (beta * (z[n:, :k] - mean[:, :k])).sum(1)


def rolling_ridge_backtest(
    df: DataFrame,
    features: Sequence[str],
    y: str,
    windows: Sequence[int],
    keys=KEYS,
    order=ORDER,
    alpha: float = 0.0,
    scale: bool = True,
    fill: float | None = None,
    model: str = "ridge",
) -> DataFrame:
    """Next-row predictions from the previous n rows with any number of features, for all window sizes in one pass over a series.

    Columns as ``rolling_backtest``: row t is predicted by a ridge (``alpha`` 0: least squares) on rows t-n .. t-1, so ``y`` of a row must be known by
    the next one. Rows without ``y`` are left out, and rows without a feature too unless ``fill`` replaces it. A series of n rows or fewer gives no
    prediction for that window. A task holds one series, which the calendar bounds; pass (key, block) of ``functions.blocks`` for longer ones.
    Rows of one key with equal ``order`` are taken by ascending ``y``, then by the features.
    """
    inner = [f"x{i}" for i in range(len(features))]
    values = [F.col(c).cast("double") for c in features]
    if fill is not None:
        values = [F.coalesce(v, F.lit(float(fill))) for v in values]
    rows = df.select(
        *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)],
        F.col(order).alias("at"),
        F.col(y).cast("double").alias("y"),
        *[v.alias(c) for v, c in zip(values, inner)],
    ).dropna("any", subset=["y", *inner])
    group = [f"k{i}" for i in range(len(keys))]
    types = rows.schema
    schema = ", ".join(f"{c} {types[c].dataType.simpleString()}" for c in [*group, "at"])
    sizes = [int(n) for n in windows]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["at", "y", *inner], ignore_index=True)
        x, target = pdf[inner].to_numpy(float), pdf["y"].to_numpy(float)
        parts = [pd.DataFrame({**{c: pdf[c][:0] for c in [*group, "at"]}, "y": [], "last_level": [], "training_window": [], "y_hat": []})]
        for n in sizes:
            if len(pdf) > n:
                part = pdf.loc[n:, [*group, "at", "y"]].copy()
                part["last_level"] = target[n - 1 : -1]
                part["training_window"] = n
                part["y_hat"] = _rolling_fits(x, target, n, alpha, scale)
                parts.append(part)
        return pd.concat(parts[1:] or parts, ignore_index=True)

    out = rows.groupBy(*group).applyInPandas(run, f"{schema}, y double, last_level double, training_window int, y_hat double")
    return out.select(
        *[F.col(g).alias(k) for g, k in zip(group, keys)],
        F.col("at").alias(order),
        "y",
        "last_level",
        "training_window",
        F.lit(model).alias("model"),
        "y_hat",
    )


def row_metrics(pred: DataFrame) -> DataFrame:
    """Per prediction: squared and absolute error, percent errors, direction, as long rows."""
    e = F.col("y") - F.col("y_hat")
    sign = (F.col("y") > F.col("last_level")) == (F.col("y_hat") > F.col("last_level"))
    values = {
        "mse": e * e,
        "mae": F.abs(e),
        "rmse": F.abs(e),
        "mape": F.when(F.col("y") != 0, F.abs(e) / F.abs("y") * 100).otherwise(0.0),
        "relative_error": F.when(F.col("y") != 0, -e / F.col("y") * 100).otherwise(0.0),
        "directional_accuracy": sign.cast("double"),
    }
    entries = F.array(*[F.struct(F.lit(k).alias("metric"), x.alias("value")) for k, x in values.items()])
    return pred.select("instrument", "date", "model", "training_window", F.inline(entries))


def mean_importance(table: DataFrame, k: int = 10) -> DataFrame:
    return (
        table.groupBy("feature")
        .agg(F.avg("importance").alias("importance"))
        .orderBy(F.desc("importance"), "feature")
        .limit(k)
    )


def top_correlated_features(df: DataFrame, features: Sequence[str], target: str, k: int) -> DataFrame:
    """Top ``k`` features by absolute correlation with the target: one aggregation."""
    one = df.agg(*[F.coalesce(F.abs(F.corr(f, target)), F.lit(0.0)).alias(f) for f in features])
    return (
        one.unpivot([], list(features), "feature", "abs_correlation")
        .orderBy(F.desc("abs_correlation"), "feature")
        .limit(k)
    )
