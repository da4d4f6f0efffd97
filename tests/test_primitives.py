"""Skew-safe building blocks against pandas."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tickloom.functions import pairs as pr
from tickloom.functions.blocks import in_blocks
from tickloom.functions.ewm import with_ewm
from tickloom.functions.ranks import quantiles, with_average_rank
from tickloom.operators import technical as t


def panel(n: int, names=("A", "B", "C"), seed: int = 1) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    days = pd.date_range("2020-01-01", periods=n, freq="D").date
    parts = []
    for k in names:
        c = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, n)))
        parts.append(
            pd.DataFrame(
                {
                    "instrument": k,
                    "date": days,
                    "open": c * 0.99,
                    "high": c * 1.02,
                    "low": c * 0.97,
                    "close": c,
                    "close_adj": c,
                    "volume": rng.integers(1_000, 9_000, n),
                }
            )
        )
    return pd.concat(parts, ignore_index=True)


def test_ewm_matches_pandas_over_many_sub_blocks(spark):
    pdf = panel(900)
    df = with_ewm(spark.createDataFrame(pdf), {"f": ("close", 0.9, 0), "s": ("close", 2 / 201, 0), "m": ("close", 0.2, 0)})
    got = df.toPandas().sort_values(["instrument", "date"], ignore_index=True)
    for col, a in (("f", 0.9), ("s", 2 / 201), ("m", 0.2)):
        want = pdf.groupby("instrument")["close"].transform(lambda x: x.ewm(alpha=a, adjust=False).mean())
        assert np.abs(got[col] - want).max() < 1e-9


def test_blocks_give_the_values_of_whole_series(spark):
    """One key owns most rows; blocks of 64 rows must not change a single value."""
    pdf = pd.concat([panel(700, ["HOT"]), panel(40, ["COLD"], 2)])
    df = spark.createDataFrame(pdf)

    def features(d, keys=("instrument",), order="date"):
        d = t.close_volatility(t.returns(d, keys, order), (5, 20), keys, order)
        return t.roll_spread(t.average_true_range(d, 3, keys, order), 20, keys, order)

    plain = features(df).drop("_n").orderBy("instrument", "date").toPandas()
    blocked = in_blocks(
        df,
        features,
        keys=["instrument"],
        order=["date"],
        bucket=F.date_trunc("month", "date"),
        lookback=128,
        block_rows=128,
    )
    got = blocked.select(plain.columns.tolist()).orderBy("instrument", "date").toPandas()
    pd.testing.assert_frame_equal(plain, got, rtol=1e-9)


def test_ranks_and_quantiles_with_tiny_ranges(spark):
    """Ranges of about 5 values: the cut path must equal pandas, with ties and NULLs."""
    rng = np.random.default_rng(3)
    v = np.round(rng.normal(0, 1, 600), 1)
    v[::17] = np.nan
    pdf = pd.DataFrame({"id": range(600), "g": np.where(np.arange(600) < 500, "hot", "cold"), "v": v})
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    got = with_average_rank(df, ["g"], "v", rows_per_bucket=5).orderBy("id").toPandas()
    want = pdf.groupby("g")["v"].rank()
    assert np.allclose(got["rank"].astype(float), want, equal_nan=True)
    q = quantiles(df, ["g"], "v", [0.01, 0.3, 0.5, 0.99], list("abcd"), rows_per_bucket=5).toPandas().set_index("g")
    for name, p in zip("abcd", [0.01, 0.3, 0.5, 0.99]):
        assert np.allclose(q[name], pdf.groupby("g")["v"].quantile(p).reindex(q.index))


def test_pairs_across_blocks_meet_exactly_once(spark):
    pdf = pd.DataFrame({"k": [f"s{i}" for i in range(37)], "x": np.arange(37.0)})
    rows = pr.pair_join(spark.createDataFrame(pdf), "k", ["x"], per_block=4).toPandas()
    want = {(a, b) for a in pdf.k for b in pdf.k if a < b}
    assert len(rows) == len(want) and set(zip(rows.k_i, rows.k_j)) == want


def test_pair_statistics_match_pandas_with_gaps(spark):
    from tickloom.operators.relationships import correlations

    rng = np.random.default_rng(5)
    wide = pd.DataFrame(rng.normal(size=(60, 7)), columns=list("abcdefg"), index=pd.date_range("2021-01-01", periods=60).date)
    wide.iloc[5:15, 2] = np.nan
    long = wide.stack().rename("log_return").rename_axis(["date", "instrument"]).reset_index()
    df = spark.createDataFrame(long)
    for method in ("pearson", "spearman", "kendall"):
        got = correlations(df, window=40, method=method).toPandas()
        if method == "kendall":
            x, y = wide["a"].iloc[-40:].to_numpy(), wide["b"].iloc[-40:].to_numpy()
            s = sum(np.sign(x[i] - x[j]) * np.sign(y[i] - y[j]) for i in range(40) for j in range(i))
            row = got[(got.instrument_i == "a") & (got.instrument_j == "b")].iloc[0]
            assert abs(row.rho - s / (40 * 39 / 2)) < 1e-12
            continue
        want = wide.iloc[-40:].corr(method=method)
        for r in got.itertuples():
            assert abs(r.rho - want.loc[r.instrument_i, r.instrument_j]) < 1e-12


def test_student_p_values(spark):
    from tickloom.operators.relationships import student_p_value

    rows = [(2.0, 10), (2.0, 11), (0.0, 7), (12.706, 1), (2.0, 5000)]
    df = spark.createDataFrame(rows, "t double, dof long")
    got = [r.p for r in df.select(student_p_value(F.col("t"), F.col("dof")).alias("p")).collect()]
    want = [0.0733880, 0.0708240, 1.0, 0.0500000, 0.0455537]
    assert np.allclose(got, want, atol=2e-5)


def test_date_columns_survive_blocks(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 1, d), float(d)) for d in range(1, 29)], "instrument string, date date, x double")
    out = in_blocks(df, lambda d, k, o: d, keys=["instrument"], order=["date"], bucket=F.date_trunc("week", "date"), lookback=3, block_rows=5)
    assert sorted(r.date for r in out.collect()) == [dt.date(2024, 1, d) for d in range(1, 29)]
