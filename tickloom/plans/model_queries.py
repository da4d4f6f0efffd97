"""Queries for model preparation, fits and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import model_store as store
from tickloom.operators import models as m
from tickloom.operators import season as z
from tickloom.operators import targets as tg
from tickloom.operators import technical as t
from tickloom.plans import views as v
from tickloom.plans.registry import query, r, register, rounded, with_ctes
from tickloom.session import scratch

_W = "PARTITION BY instrument ORDER BY date"
_RET = f"ret AS (SELECT *, ln(close_adj / lag(close_adj) OVER ({_W})) AS log_return FROM bars)"


def _fr(n):
    return f"({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _full(agg, c, n):
    return f"CASE WHEN count({c}) OVER {_fr(n)} = {n} THEN {agg} OVER {_fr(n)} END"


_X = ("return_5d", "vol_cc_20d")
_MODEL = f"""
mf AS (SELECT instrument, date, {_full('sum(log_return)', 'log_return', 5)} AS return_5d, {_full('stddev_samp(log_return)', 'log_return', 20)} * sqrt(252) AS vol_cc_20d,
  ln(high / low) AS range_hl, ln(volume) AS log_volume, lead(close_adj, 5) OVER ({_W}) / close_adj - 1 AS y, log_return FROM ret),
md AS (SELECT * FROM mf WHERE return_5d IS NOT NULL AND vol_cc_20d IS NOT NULL AND y IS NOT NULL)"""
_BASE = [v.bars_sql(), _RET, _MODEL]
_ALL = ("return_5d", "vol_cc_20d", "range_hl", "log_volume")


def _data(s, sf):
    b = t.close_volatility(t.rolling_returns(t.returns(v.bars(s, sf)), (5,)), (20,))
    b = tg.forward_returns(b, (5,)).withColumns(
        {"range_hl": F.log(F.col("high") / F.col("low")), "log_volume": F.log("volume")}
    )
    return b.select("instrument", "date", *_ALL, F.col("target_return_5d").alias("y"), "log_return")


# ---- preparation ---------------------------------------------------------------------------------

register(
    "standard_scaling",
    "ML-1",
    lambda s, sf: rounded(m.standardise(_data(s, sf).select("instrument", "date", *_X), _X, ["instrument"])),
    with_ctes(
        _BASE,
        "SELECT instrument, date, " + ", ".join(r(f"({c} - avg({c}) OVER p) / stddev_pop({c}) OVER p", c) for c in _X) + " FROM mf WINDOW p AS (PARTITION BY instrument)",
    ),
)
register(
    "robust_scaling",
    "ML-1",
    lambda s, sf: rounded(m.robust_scale(_data(s, sf).select("instrument", "date", *_X), _X)),
    with_ctes(
        [*_BASE, "q AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS i_{c}" for c in _X) + " FROM mf)"],
        "SELECT instrument, date, " + ", ".join(r(f"({c} - m_{c}) / i_{c}", c) for c in _X) + " FROM mf, q",
    ),
)
register(
    "hash_split",
    "ML-12",
    lambda s, sf: m.train_test_split(v.bars(s, sf).select("instrument", "date"), ["instrument", "date"]),
    with_ctes(
        [v.bars_sql()],
        "SELECT instrument, date, CASE WHEN CAST('0x' || md5(instrument || '|' || date)[1:7] AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM bars",
    ),
)

# ---- linear fits ---------------------------------------------------------------------------------

_SUMS = """
sm AS (SELECT instrument, count(*) AS n, regr_sxx(y, return_5d) AS a, regr_sxx(y, vol_cc_20d) AS b, covar_pop(return_5d, vol_cc_20d) * count(*) AS c,
  covar_pop(return_5d, y) * count(*) AS p, covar_pop(vol_cc_20d, y) * count(*) AS q, var_pop(y) * count(*) AS sy,
  avg(return_5d) AS m1, avg(vol_cc_20d) AS m2, avg(y) AS my FROM md GROUP BY 1)"""


def _ridge_sql(alpha):
    return f"""
bt AS (SELECT *, ((b + {alpha}) * p - c * q) / ((a + {alpha}) * (b + {alpha}) - c * c) AS b1, ((a + {alpha}) * q - c * p) / ((a + {alpha}) * (b + {alpha}) - c * c) AS b2 FROM sm),
sse AS (SELECT *, sy - 2 * (b1 * p + b2 * q) + b1 * b1 * a + 2 * b1 * b2 * c + b2 * b2 * b AS e FROM bt)"""


_FIT_SQL = f"SELECT instrument, {r('b1', 'b1', 5)}, {r('b2', 'b2', 5)}, {r('my - b1 * m1 - b2 * m2', 'intercept', 5)}, n AS train_rows, {r('sqrt(e / n)', 'train_rmse', 5)}, {r('1 - e / sy', 'train_r2', 5)} FROM sse"


def _fit(alpha):
    def run(s, sf):
        fit = m.grouped_ridge(_data(s, sf), _X, "y", alpha=alpha)
        c = F.col("coefficients")
        return rounded(fit.select("instrument", c[0].alias("b1"), c[1].alias("b2"), "intercept", "train_rows", "train_rmse", "train_r2"), 5)

    return run


register("linear_fit", "ML-6", _fit(0.0), with_ctes([*_BASE, _SUMS, _ridge_sql(0.0)], _FIT_SQL))
register("ridge_fit", "ML-7", _fit(1.0), with_ctes([*_BASE, _SUMS, _ridge_sql(1.0)], _FIT_SQL))


def _saved(s, sf):
    """Fitted, saved, loaded by name and applied; the prediction comes from the files."""
    data, folder = _data(s, sf), scratch(s, "models")
    fitted = store.create("grouped_ridge", features=_X, target="y", alpha=1.0).fit(data)
    store.save_model(fitted, folder, "grouped_ridge", "next_week")
    out = store.load_model(s, folder, "grouped_ridge", "next_week").transform(data)
    return rounded(out.where("prediction IS NOT NULL").select("instrument", "date", "prediction"), 5)


register(
    "saved_model_predictions",
    "UDF-2",
    _saved,
    with_ctes(
        [*_BASE, _SUMS, _ridge_sql(1.0)],
        f"""SELECT instrument, date, {r('my + b1 * (return_5d - m1) + b2 * (vol_cc_20d - m2)', 'prediction', 5)}
        FROM mf JOIN bt USING (instrument) WHERE n >= 3 AND return_5d IS NOT NULL AND vol_cc_20d IS NOT NULL""",
    ),
)

_FOLD = """
nb AS (SELECT *, row_number() OVER (PARTITION BY instrument ORDER BY date) - 1 AS i, count(*) OVER (PARTITION BY instrument) AS cnt FROM md),
fd AS (SELECT *, CAST(greatest(0, floor((i - (cnt - 5 * (cnt // 6))) / (cnt // 6)) + 1) AS INTEGER) AS fold FROM nb),
kk AS (SELECT unnest(range(1, 6)) AS fold),
tr AS (SELECT f.instrument, k.fold, count(*) AS n, var_pop(return_5d) AS va, var_pop(vol_cc_20d) AS vb, covar_pop(return_5d, vol_cc_20d) AS vc, covar_pop(return_5d, y) AS vp,
  covar_pop(vol_cc_20d, y) AS vq, avg(return_5d) AS m1, avg(vol_cc_20d) AS m2, avg(y) AS my FROM fd f JOIN kk k ON f.fold < k.fold GROUP BY 1, 2),
zs AS (SELECT *, n + 1.0 AS d, n * vc / sqrt(va * vb) AS c, n * vp / sqrt(va) AS p, n * vq / sqrt(vb) AS q FROM tr),
bz AS (SELECT *, (d * p - c * q) / (d * d - c * c) / sqrt(va) AS b1, (d * q - c * p) / (d * d - c * c) / sqrt(vb) AS b2 FROM zs),
oof AS (SELECT f.instrument, f.date, f.fold, f.y, my + b1 * (return_5d - m1) + b2 * (vol_cc_20d - m2) AS y_hat FROM fd f LEFT JOIN bz USING (instrument, fold))"""


def _oof(s, sf):
    return m.grouped_ridge_cv(_data(s, sf), _X, "y")


register(
    "time_ordered_cv",
    "ML-11",
    lambda s, sf: rounded(_oof(s, sf), 5),
    with_ctes([*_BASE, _FOLD], f"SELECT instrument, date, fold, {r('y', 'y', 5)}, {r('y_hat', 'y_hat', 5)} FROM oof"),
)
register(
    "prediction_merge",
    "JOIN-5",
    lambda s, sf: rounded(m.merge_predictions(v.bars(s, sf).select("instrument", "date", "volume"), _oof(s, sf)), 5),
    with_ctes([*_BASE, _FOLD], f"SELECT instrument, date, volume, {r('y_hat', 'prediction', 5)} FROM bars LEFT JOIN oof USING (instrument, date)"),
)
_MET = f"""count(*) AS n, {r('sqrt(avg((y - y_hat) * (y - y_hat)))', 'rmse', 4)}, {r('avg(abs(y - y_hat))', 'mae', 4)}, {r('1 - avg((y - y_hat) * (y - y_hat)) / var_pop(y)', 'r2', 4)},
  {r('avg(CASE WHEN y <> 0 THEN abs(y - y_hat) / abs(y) * 100 ELSE 0 END)', 'mape', 2)}, {r('avg(CASE WHEN y <> 0 THEN (y_hat - y) / y * 100 ELSE 0 END)', 'relative_error', 2)}"""


def _met(df):
    return df.withColumns(
        {c: F.round(c, 4) for c in ("rmse", "mae", "r2")} | {c: F.round(c, 2) for c in ("mape", "relative_error")}
    )


# ---- rolling backtest and evaluation ---------------------------------------------------------------

_WIN = (20, 60)


def _backtest(s, sf):
    b = t.returns(v.bars(s, sf)).withColumns({"x": F.log("volume"), "level": F.log("close")})
    return m.rolling_backtest(b, "x", "level", _WIN)


def _prev(n):
    return f"({_W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


_BT = (
    "bx AS (SELECT instrument, date, ln(close) AS y, ln(volume) AS x FROM bars),\nbt AS ("
    + " UNION ALL ".join(
        f"""SELECT instrument, date, y, last_level, {n} AS training_window, '{k}' AS model, y_hat FROM (SELECT *, lag(y) OVER ({_W}) AS last_level,
        CASE WHEN count(y) OVER {_prev(n)} = {n} THEN {e} END AS y_hat FROM bx) WHERE y_hat IS NOT NULL"""
        for n in _WIN
        for k, e in (
            ("line", f"regr_intercept(y, x) OVER {_prev(n)} + regr_slope(y, x) OVER {_prev(n)} * x"),
            ("mean", f"avg(y) OVER {_prev(n)}"),
            ("last", f"lag(y) OVER ({_W})"),
        )
    )
    + ")"
)
_B = [v.bars_sql(), _BT]
register(
    "rolling_backtest",
    "ML-19",
    lambda s, sf: rounded(_backtest(s, sf).select("instrument", "date", "training_window", "model", "y_hat"), 6),
    with_ctes(_B, f"SELECT instrument, date, training_window, model, {r('y_hat', 'y_hat', 6)} FROM bt"),
)

def _backtest_two(s, sf):
    b = t.returns(v.bars(s, sf)).withColumns({"x": F.log("volume"), "z": F.log(F.col("high") / F.col("low")), "level": F.log("close")})
    return m.rolling_ridge_backtest(b, ["x", "z"], "level", _WIN)


def _two_sql():
    """Least squares on two features by the normal equations; windows where these are close to singular are left to the pseudo-inverse."""
    one = """SELECT instrument, date, {n} AS training_window, count(*) OVER w AS c, x, z, avg(x) OVER w AS mx, avg(z) OVER w AS mz, avg(y) OVER w AS my,
      var_pop(x) OVER w AS sxx, var_pop(z) OVER w AS szz, covar_pop(x, z) OVER w AS sxz, covar_pop(x, y) OVER w AS sxy, covar_pop(z, y) OVER w AS szy
      FROM bz WINDOW w AS (PARTITION BY instrument ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"""
    parts = " UNION ALL ".join(one.format(n=n) for n in _WIN)
    return [
        v.bars_sql(),
        "bz AS (SELECT instrument, date, ln(close) AS y, ln(volume) AS x, ln(high / low) AS z FROM bars)",
        f"tw AS (SELECT * FROM ({parts}) WHERE c = training_window)",
    ]


register(
    "rolling_backtest_features",
    "ML-19",
    lambda s, sf: rounded(_backtest_two(s, sf).select("instrument", "date", "training_window", "model", "y_hat"), 5),
    with_ctes(
        _two_sql(),
        f"""SELECT instrument, date, training_window, 'ridge' AS model,
        {r('my + (szz * sxy - sxz * szy) / (sxx * szz - sxz * sxz) * (x - mx) + (sxx * szy - sxz * sxy) / (sxx * szz - sxz * sxz) * (z - mz)', 'y_hat', 5)} FROM tw""",
    ),
)
register(
    "regression_metrics",
    "ML-13",
    lambda s, sf: _met(m.regression_metrics(_backtest(s, sf), ["model", "training_window"])),
    with_ctes(_B, f"SELECT model, training_window, {_MET} FROM bt GROUP BY 1, 2"),
)
register(
    "directional_accuracy",
    "ML-13",
    lambda s, sf: rounded(m.directional_accuracy(_backtest(s, sf), ["model", "training_window"])),
    with_ctes(
        _B,
        f"SELECT model, training_window, count(*) AS n, {r('avg(CAST((y > last_level) = (y_hat > last_level) AS INTEGER))', 'directional_accuracy')} FROM bt WHERE last_level IS NOT NULL GROUP BY 1, 2",
    ),
)
register(
    "model_comparison",
    "ML-14",
    lambda s, sf: _met(m.regression_metrics(_backtest(s, sf), ["model"])),
    with_ctes(_B, f"SELECT model, {_MET} FROM bt GROUP BY 1"),
)
_SCORES = "sco AS (SELECT instrument AS target, model || '_' || training_window AS model, sqrt(avg((y - y_hat) * (y - y_hat))) AS rmse, avg(CAST((y > last_level) = (y_hat > last_level) AS INTEGER)) AS acc FROM bt GROUP BY 1, 2)"


def _scores(s, sf, metric):
    p = _backtest(s, sf).withColumn("model", F.concat_ws("_", "model", "training_window"))
    g = ["instrument", "model"]
    out = m.regression_metrics(p, g) if metric == "rmse" else m.directional_accuracy(p, g).withColumnRenamed("directional_accuracy", "accuracy")
    return out.select(F.col("instrument").alias("target"), "model", F.col(metric).alias("score"))


register(
    "best_model",
    "TOP-8",
    lambda s, sf: rounded(m.best_model(_scores(s, sf, "rmse"), ["target"], "rmse"), 5),
    with_ctes([*_B, _SCORES], f"SELECT target, arg_min(model, rmse) AS best_model, {r('min(rmse)', 'score', 5)} FROM sco GROUP BY 1"),
)
register(
    "loss_weights",
    "ML-16",
    lambda s, sf: rounded(m.ensemble_weights(_scores(s, sf, "rmse"), "rmse")),
    with_ctes([*_B, _SCORES], f"SELECT target, model, {r('1 / (rmse + 1e-8) / sum(1 / (rmse + 1e-8)) OVER (PARTITION BY target)', 'weight')} FROM sco"),
)
register(
    "accuracy_weights",
    "ML-16",
    lambda s, sf: rounded(m.ensemble_weights(_scores(s, sf, "accuracy"), "accuracy")),
    with_ctes([*_B, _SCORES], f"SELECT target, model, {r('exp(acc) / sum(exp(acc)) OVER (PARTITION BY target)', 'weight')} FROM sco"),
)


@query(
    "ensemble_predictions",
    "ML-15",
    with_ctes(
        _B,
        f"""SELECT instrument, date, {r('any_value(y)', 'y', 6)}, {r("sum(w * y_hat) / sum(w)", 'y_hat', 6)}, training_window
        FROM (SELECT *, CASE model WHEN 'line' THEN 1.0 WHEN 'mean' THEN 2.0 ELSE 0.5 END AS w FROM bt) GROUP BY instrument, date, training_window""",
    ),
)
def _ensemble(s, sf):
    weights = s.createDataFrame([("line", 1.0), ("mean", 2.0), ("last", 0.5)], "model string, weight double")
    return rounded(m.ensemble_predictions(_backtest(s, sf), weights), 6)


_AS_OF = "2001-11-01"
_HIST = "hs AS (SELECT instrument, date, model || '_' || training_window AS model, 'mae' AS metric, abs(y - y_hat) AS value FROM bt)"


def _history(s, sf):
    p = m.row_metrics(_backtest(s, sf)).where("metric = 'mae'")
    return p.withColumn("model", F.concat_ws("_", "model", "training_window"))


register(
    "recent_performance",
    "AGG-39",
    lambda s, sf: rounded(m.recent_performance(_history(s, sf), _AS_OF, 30), 5),
    with_ctes([*_B, _HIST], f"SELECT model, metric, {r('avg(value)', 'value', 5)} FROM hs WHERE date >= DATE '{_AS_OF}' - 30 GROUP BY 1, 2"),
)
register(
    "model_switch_signal",
    "ML-17",
    lambda s, sf: rounded(m.switch_signal(_history(s, sf), _AS_OF, "mae"), 5),
    with_ctes(
        [*_B, _HIST, f"sw AS (SELECT model, avg(value) AS b, avg(value) FILTER (date >= DATE '{_AS_OF}' - 30) AS a FROM hs WHERE date >= DATE '{_AS_OF}' - 60 GROUP BY 1)"],
        f"SELECT model, {r('b', 'historical', 5)}, {r('a', 'recent', 5)}, b > 0 AND (a - b) / b > 0.05 AS should_switch FROM sw",
    ),
)
_METRICS = {
    "mse": "(y - y_hat) * (y - y_hat)",
    "mae": "abs(y - y_hat)",
    "rmse": "abs(y - y_hat)",
    "mape": "CASE WHEN y <> 0 THEN abs(y - y_hat) / abs(y) * 100 ELSE 0 END",
    "relative_error": "CASE WHEN y <> 0 THEN (y_hat - y) / y * 100 ELSE 0 END",
    "directional_accuracy": "CAST((y > last_level) = (y_hat > last_level) AS DOUBLE)",
}
register(
    "backtest_summary",
    "AGG-40",
    lambda s, sf: rounded(m.backtest_summary(m.row_metrics(_backtest(s, sf))), 4),
    with_ctes(
        [*_B, "lm AS (" + " UNION ALL ".join(f"SELECT model, training_window, '{k}' AS metric, {e} AS value FROM bt" for k, e in _METRICS.items()) + ")"],
        f"SELECT model, training_window, metric, count(value) AS n, {r('avg(value)', 'mean', 4)}, {r('stddev_pop(value)', 'std', 4)}, {r('quantile_cont(value, 0.5)', 'median', 4)} FROM lm GROUP BY 1, 2, 3",
    ),
)
register(
    "top_correlated_features",
    "TOP-6",
    lambda s, sf: rounded(m.top_correlated_features(_data(s, sf), _ALL, "y", 3)),
    with_ctes(
        _BASE,
        "SELECT * FROM ("
        + " UNION ALL ".join(f"SELECT '{f}' AS feature, {r(f'coalesce(abs(corr({f}, y)), 0)', 'abs_correlation')} FROM mf" for f in _ALL)
        + ") ORDER BY abs_correlation DESC, feature LIMIT 3",
    ),
)


@query(
    "mean_feature_importance",
    "ML-24",
    with_ctes(
        [*_BASE, "im AS (" + " UNION ALL ".join(f"SELECT instrument, '{f}' AS feature, abs(corr({f}, y)) AS importance FROM mf GROUP BY 1" for f in _ALL) + ")"],
        f"SELECT feature, {r('avg(importance)', 'importance')} FROM im GROUP BY 1",
    ),
)
def _importance(s, sf):
    """Importance per instrument (absolute correlation), averaged."""
    per = _data(s, sf).groupBy("instrument").agg(*[F.abs(F.corr(f, "y")).alias(f) for f in _ALL])
    return rounded(m.mean_importance(per.unpivot(["instrument"], list(_ALL), "feature", "importance")))


# ---- regimes by clustering: the rounds are unrolled in SQL -------------------------------------------

_RF = ("vol_cc_20d", "return_5d", "log_volume")
#: Rounds unrolled in SQL: more than it takes until no centre moves; further rounds change nothing.
_ROUNDS = 150
_Z = f"""
rz AS (SELECT instrument, date, {', '.join(f'({c} - avg({c}) OVER p) / stddev_pop({c}) OVER p AS {c}' for c in _RF)} FROM mf
  WHERE vol_cc_20d IS NOT NULL AND return_5d IS NOT NULL WINDOW p AS (PARTITION BY instrument)),
g0 AS (SELECT z.*, CAST(vol_cc_20d > q[1] AS INTEGER) + CAST(vol_cc_20d > q[2] AS INTEGER) + CAST(vol_cc_20d > q[3] AS INTEGER) AS g
  FROM rz z JOIN (SELECT instrument, quantile_cont(vol_cc_20d, [0.25, 0.5, 0.75]) AS q FROM rz GROUP BY 1) USING (instrument))"""


def _round(i):
    dist = " + ".join(f"pow(z.{c} - c.{c}, 2)" for c in _RF)
    return f"""
c{i} AS (SELECT instrument, row_number() OVER (PARTITION BY instrument ORDER BY vol_cc_20d) - 1 AS g, {', '.join(_RF)} FROM (SELECT instrument, g, {', '.join(f'avg({c}) AS {c}' for c in _RF)} FROM g{i - 1} GROUP BY 1, 2)),
g{i} AS (SELECT z.instrument, z.date, {', '.join(f'z.{c}' for c in _RF)}, arg_min(c.g, {dist}) AS g FROM rz z JOIN c{i} c ON c.instrument = z.instrument GROUP BY ALL)"""


register(
    "clustered_regimes",
    "ML-4",
    lambda s, sf: m.grouped_regimes(_data(s, sf), _RF).select("instrument", "date", "regime"),
    with_ctes([*_BASE, _Z, *[_round(i) for i in range(1, _ROUNDS + 1)]], f"SELECT instrument, date, CAST(g AS INTEGER) AS regime FROM g{_ROUNDS}"),
)

# ---- Spark ML: seeded algorithms, no SQL twin ---------------------------------------------------------

_KEY = ["instrument", "date"]
register("kmeans_clusters", "ML-2", lambda s, sf: rounded(m.kmeans(_data(s, sf), _ALL, 4)[1]))
register("gaussian_mixture", "ML-3", lambda s, sf: rounded(m.gaussian_mixture(_data(s, sf), _ALL, 3)[1]))
register("random_forest", "ML-8", lambda s, sf: rounded(m.split_metrics(m.fit_and_predict(_data(s, sf), _ALL, "y", "random_forest", _KEY)[1])))
register("boosted_trees", "ML-9", lambda s, sf: rounded(m.split_metrics(m.fit_and_predict(_data(s, sf), _ALL, "y", "boosted_trees", _KEY)[1])))


def _logistic(s, sf):
    d = _data(s, sf).withColumn("up", (F.col("y") > 0).cast("double"))
    _, pred = m.fit_and_predict(d, _ALL, "up", "logistic", _KEY, classify=True)
    return rounded(m.classification_accuracy(pred.select("split", F.col("label").alias("y"), F.col("prediction").alias("y_hat")), ["split"]))


register("logistic_direction", "ML-10", _logistic)
register("model_sweep", "ML-18 UDF-2", lambda s, sf: rounded(m.sweep(_data(s, sf), _ALL, "y", _KEY, ["linear", "ridge", "boosted_trees"])))


def _text(s, sf):
    a = v.articles(s, sf)
    train = a.where("sentiment IS NOT NULL").withColumn("label", (F.col("sentiment") > 0).cast("double"))
    return rounded(m.text_scores(m.text_classifier(train, "text", "label"), a, ["article_id"]))


register("text_classifier", "ML-20", _text)
register("importance_selection", "ML-25", lambda s, sf: rounded(m.importance_selection(_data(s, sf), _ALL, "y", _KEY, 3)))
