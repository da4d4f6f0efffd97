"""Hand-computed fixtures and known answers."""

from __future__ import annotations

import datetime as dt
import json
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from test_primitives import panel
from tickloom.operators import corporate_events as ce
from tickloom.operators import cross_section as x
from tickloom.operators import hygiene as h
from tickloom.operators import models as m
from tickloom.operators import news as nw
from tickloom.operators import peers as p
from tickloom.operators import quality as q
from tickloom.operators import relationships as rel
from tickloom.operators import season as z
from tickloom.operators import technical as t
from tickloom.plans import stages as st
from tickloom.sources import filters as fl
from tickloom.sources import sinks
from tickloom.sources.lake import Lake

D = dt.date
BARS = "instrument string, date date, open double, high double, low double, close double, volume long"


def bad_bars(spark, volumes=(1000, 1100, 1200)):
    rows = zip((100.0, 101.0, 102.0), (105.0, 104.0, 103.0), (95.0, 96.0, 97.0), (103.0, 102.0, 104.0), volumes)
    return spark.createDataFrame([("TEST", D(2023, 1, i + 1), *r) for i, r in enumerate(rows)], BARS)


def test_one_broken_bar_is_found(spark):
    df = h.resolve_adjusted_close(bad_bars(spark))
    got = {r["rule"]: r["n"] for r in h.ohlc_violations(df).collect()}
    assert got["high < close"] == 1 and sum(got.values()) == 1


def test_few_rows_are_not_winsorised(spark):
    df = bad_bars(spark, (1000, 1100, 100000))
    assert [r.volume for r in h.winsorise(df).orderBy("date").collect()] == [1000, 1100, 100000]


def test_volume_is_carried_forward(spark):
    out = h.align_calendar(bad_bars(spark, (1000, None, 1200))).orderBy("date").collect()
    assert [r.volume for r in out] == [1000, 1000, 1200]


def test_business_days(spark):
    rows = [(D(2024, 1, 1), D(2024, 1, 31)), (D(2024, 1, 6), D(2024, 1, 7)), (D(1960, 1, 1), D(2024, 12, 31)), (D(2024, 3, 1), D(2024, 3, 1))]
    df = spark.createDataFrame(rows, "a date, b date")
    got = [r.n for r in df.select(q.weekdays_between(F.col("a"), F.col("b")).alias("n")).collect()]
    assert got == [len(pd.bdate_range(a, b)) for a, b in rows]


def test_scored_news(spark):
    rows = [
        (D(2023, 11, 1), "AAPL", 0.8, "Reuters"),
        (D(2023, 11, 1), "AAPL", -0.3, "Bloomberg"),
        (D(2023, 11, 1), "AAPL", 0.1, "WSJ"),
        (D(2023, 11, 2), "AAPL", 0.5, "CNBC"),
        (D(2023, 11, 2), "AAPL", -0.7, "MarketWatch"),
    ]
    df = spark.createDataFrame(rows, "date date, instrument string, sentiment double, source string")
    a, b = nw.daily_sentiment(df, timestamp=None, importance=None).orderBy("date").collect()
    assert (a.article_count, a.unique_sources) == (3, 3)
    assert np.allclose([a.sentiment_mean, a.sentiment_median, a.positive_pct, a.negative_pct], [0.2, 0.1, 1 / 3, 1 / 3])
    assert abs(a.sentiment_skew - pd.Series([0.8, -0.3, 0.1]).skew()) < 1e-9
    assert np.allclose([b.sentiment_mean, b.positive_pct, b.negative_pct], [-0.1, 0.5, 0.5]) and b.sentiment_skew is None


def test_known_beta(spark):
    rng = np.random.default_rng(42)
    days = pd.date_range("2023-01-01", periods=150).date
    market = rng.normal(0, 0.01, 150)
    rows = []
    for k, beta in {"A": 0.5, "B": 1.0, "C": 1.7}.items():
        r = beta * market + rng.normal(0, 0.001, 150)
        rows += [(k, d, float(a), float(b)) for d, a, b in zip(days, r, market)]
    df = spark.createDataFrame(rows, "instrument string, date date, log_return double, benchmark_return double")
    got = x.r_squared(x.beta_alpha(df, (60,)), (60,)).where(F.col("date") == F.lit(days[-1])).collect()
    for r in got:
        assert abs(r.beta_60d - {"A": 0.5, "B": 1.0, "C": 1.7}[r.instrument]) < 0.1 and r.r_squared_60d > 0.9
    first = x.beta_alpha(df, (60,)).where("beta_60d IS NOT NULL").agg(F.min("date")).first()[0]
    assert first == days[19]


def test_feature_bounds_and_row_count(spark):
    pdf = panel(120)
    out = t.base_features(spark.createDataFrame(pdf)).toPandas()
    assert len(out) == len(pdf)
    assert out["rsi_14"].dropna().between(0, 100).all() and out["stoch_k"].dropna().between(-1e-6, 100 + 1e-6).all()
    assert (out["vol_cc_20d"].dropna() > 0).all()
    wilder = pdf.groupby("instrument")["close"].transform(
        lambda c: 100 - 100 / (1 + c.diff().clip(lower=0).ewm(alpha=1 / 14, adjust=False).mean() / ((-c.diff()).clip(lower=0).ewm(alpha=1 / 14, adjust=False).mean() + 1e-10))
    )
    got = out.sort_values(["instrument", "date"])["rsi_14"].to_numpy()
    assert np.allclose(got, wilder.to_numpy(), equal_nan=True)


def test_cross_ranks_match_pandas_when_a_date_is_split(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"instrument": [f"i{k}" for k in range(80)] * 2, "date": [D(2024, 1, 1)] * 80 + [D(2024, 1, 2)] * 80, "f": np.round(rng.normal(size=160), 1)})
    got = x.cross_ranks(spark.createDataFrame(pdf), ["f"], rows_per_bucket=6).toPandas()
    want = pdf.assign(
        pct=pdf.groupby("date")["f"].rank(pct=True),
        zs=pdf.groupby("date")["f"].transform(lambda v: (v - v.mean()) / (v.std() + 1e-10)),
    )
    both = got.merge(want, on=["instrument", "date"])
    assert len(both) == 160 and np.allclose(both.pct_rank, both.pct) and np.allclose(both.zscore, both.zs)


def test_cross_ranks_sort_rows_once_and_split_large_dates(spark):
    """Ties, a value of most rows, NaN, zeros of both signs and null keys, in whole and in split groups."""
    rng = np.random.default_rng(4)
    days = [D(2024, 1, 1)] * 300 + [D(2024, 1, 2)] * 60 + [D(2024, 1, 3)] * 3
    f = np.where(rng.random(363) < 0.6, 0.5, np.round(rng.normal(size=363), 1))
    f[:4], f[300:303] = [np.nan, np.nan, 0.0, -0.0], [np.nan, 0.0, -0.0]
    rows = [(f"i{k}", d, float(v)) for k, (d, v) in enumerate(zip(days, f))]
    odd = [(None, D(2024, 1, 2), 0.5), ("n", None, 1.0), ("m", D(2024, 1, 2), None)]
    df = spark.createDataFrame(rows + odd, "instrument string, date date, f double")
    whole = [(d, np.inf if np.isnan(v) else v) for _, d, v in [*rows, odd[0]]]
    want = {}
    for d, v in whole:
        same = [w for e, w in whole if e == d]
        less, upto = sum(w < v for w in same), sum(w <= v for w in same)
        want[d, v] = ((less + upto + 1) / 2, len(same))
    for most in (20, 100, 1_000):
        got = x.cross_ranks(df, ["f"], ["rank", "pct_rank"], rows_per_bucket=most).collect()
        assert sorted(str(r.instrument) for r in got) == sorted(str(i) for i, *_ in [*rows, odd[0]])
        for r in got:
            rank, n = want[r.date, np.inf if np.isnan(r.value) else r.value]
            assert r["rank"] == rank and r.pct_rank == rank / n
        deciles = {(r.instrument, r.date): r.decile for r in x.cross_ranks(df, ["f"], ["decile"], rows_per_bucket=most).collect()}
        assert len(deciles) == 364 and (most == 20 or deciles == kept)
        kept = deciles
    plan = x.cross_ranks(df, ["f"], ["pct_rank"])._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"value#\d+ = value#\d+", plan)  # nothing is joined back by value


def test_next_and_prior_event_beyond_the_bars(spark):
    bars = spark.createDataFrame([("A", D(2024, 1, d)) for d in (2, 5, 9)] + [("B", D(2024, 1, 2))], "instrument string, date date")
    ev = spark.createDataFrame([("A", D(2024, 1, 4)), ("A", D(2024, 1, 4)), ("A", D(2024, 1, 20))], "instrument string, date date")
    out = {(r.instrument, r.date.day): r for r in ce.prior_event(ce.next_event(bars, ev), ev, "ago").collect()}
    assert [out["A", d].days_to_earnings for d in (2, 5, 9)] == [2, 15, 11]
    assert [out["A", d].ago for d in (2, 5, 9)] == [None, 1, 5]
    assert out["A", 2].earnings_week and not out["A", 5].earnings_week
    assert out["B", 2].days_to_earnings is None and not out["B", 2].has_earnings_data


def test_ratio_parsing(spark):
    df = spark.createDataFrame([("2:1",), ("1:2",), ("x",), ("3:0",), (None,), ("1:2:3",)], "r string")
    assert [r.f for r in df.select(ce.parse_ratio(F.col("r")).alias("f")).collect()] == [2.0, 0.5, 1.0, 1.0, 1.0, 1.0]


def test_lead_lag_finds_the_planted_leader(spark):
    rng = np.random.default_rng(2)
    lead = rng.normal(size=80)
    follow = np.r_[rng.normal(size=2), lead[:-2]] + rng.normal(0, 0.1, 80)
    days = pd.date_range("2024-01-01", periods=80).date
    rows = [("L", d, float(v)) for d, v in zip(days, lead)] + [("F", d, float(v)) for d, v in zip(days, follow)]
    df = spark.createDataFrame(rows, "instrument string, date date, log_return double")
    r = rel.lead_lag_map(rel.lead_lag(df)).first()
    assert (r.leader, r.follower, r.lag) == ("L", "F", 2) and r.ccf > 0.9


def test_calendar_gaps_leave_peer_frames_short(spark):
    days = [D(2024, 1, d) for d in range(1, 11)]
    rows = [(k, d, 0.01 * (i + 1)) for k in "TPQ" for i, d in enumerate(days) if not (k == "P" and i == 4)]
    df = p.calendar(spark.createDataFrame(rows, "instrument string, date date, log_return double"))
    peers = spark.createDataFrame([("T", "P"), ("T", "Q")], "target string, peer string")
    got = {r.date.day: r.avg_peer_momentum for r in p.average_peer_momentum(p.momentum_gaps(df, peers, (3,))).collect()}
    assert got[4] is not None and got[5] is None and got[7] is None and abs(got[8] - 0.21) < 1e-12


def test_ridge_from_sums_matches_numpy(spark):
    rng = np.random.default_rng(42)
    f = rng.normal(size=(300, 3))
    y = f @ [0.5, 0.3, -0.2] + rng.normal(0, 0.1, 300)
    pdf = pd.DataFrame(f, columns=["a", "b", "c"]).assign(y=y, instrument="A")
    row = m.grouped_ridge(spark.createDataFrame(pdf), ["a", "b", "c"], "y").first()
    xc, yc = f - f.mean(0), y - y.mean()
    assert np.allclose(row.coefficients, np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ yc))
    model, pred = m.fit_and_predict(spark.createDataFrame(pdf.assign(k=range(300))), ["a", "b", "c"], "y", "ridge", ["k"])
    assert {r.split for r in m.split_metrics(pred).collect()} == {"train", "test"}


def test_regimes_follow_two_obvious_groups(spark):
    pdf = pd.DataFrame({"instrument": "A", "date": pd.date_range("2024-01-01", periods=100).date, "v": [0.1] * 50 + [5.0] * 50})
    pdf["v"] += np.linspace(0, 0.05, 100)
    got = m.grouped_regimes(spark.createDataFrame(pdf), ["v"], 2, max_rounds=50).toPandas().sort_values("date")
    assert got["regime"].tolist() == [0] * 50 + [1] * 50


def test_persistence_and_flags(spark):
    df = spark.createDataFrame([("A", D(2024, 1, i + 1), r) for i, r in enumerate([0, 0, 1, 0, 0])], "instrument string, date date, regime_id int")
    got = z.regime_persistence(df).orderBy("date").collect()
    assert [r.regime_persistence for r in got] == [1, 2, 1, 1, 2] and [r.regime_occurrences for r in got] == [1, 2, 1, 3, 4]


def test_lake_with_one_file_per_symbol(spark, tmp_path):
    daily = tmp_path / "market_data" / "daily"
    daily.mkdir(parents=True)
    for s in ("AAPL", "MSFT"):
        pd.DataFrame({"date": pd.to_datetime(["2024-01-02", "2024-01-03"]).astype("datetime64[us]"), "open": [1.0, 2.0], "high": [1.0, 2.0], "low": [1.0, np.nan], "close": [1.0, 2.0], "volume": [50, 500000]}).to_parquet(daily / f"{s}.parquet")
    news = tmp_path / "news_data"
    news.mkdir()
    (news / "news_20240102.json").write_text(json.dumps([{"article_id": "1", "source": "x", "published_at": "2024-01-02T10:00:00Z", "symbols": ["AAPL"], "sentiment_label": "positive"}]))
    (news / "news_20240103.json").write_text("[{broken")
    lake = Lake(spark, str(tmp_path), layout="files", json_lines=False)
    assert lake.get_market_data(["NOPE"]).count() == 0
    assert lake.get_market_data(["AAPL"]).count() == 2
    assert lake.get_market_data().where("low IS NULL").count() == 2
    f = fl.QueryFilter(
        date_range=fl.DateRange("2024-01-01"),
        data_types=(fl.DataTypeFilter("market_data", "daily", min_volume=100000),),
        sort_by="date",
        sort_order="desc",
        limit=100,
    )
    assert {r.symbol for r in lake.query(f).collect()} == {"AAPL", "MSFT"}
    assert [r.article_id for r in lake.get_news_data(["AAPL"]).collect()] == ["1"]
    assert {r.symbol for r in lake.list_available_symbols().collect()} == {"AAPL", "MSFT"}


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    df = spark.createDataFrame([("daily", s, dt.datetime(2024, 1, d), 1.0, 10) for s in "AB" for d in (1, 2)], "interval string, symbol string, date timestamp, close double, volume long")
    sinks.write_bars(df, str(tmp_path / "market_data"))
    got = Lake(spark, str(tmp_path)).get_market_data(["A"], "daily", include_indicators=[]).select("symbol", "close")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "sma_20" not in plan and got.count() == 2


def test_stage_checks_columns(spark):
    with pytest.raises(ValueError, match="close_adj"):
        st.run_stage(bad_bars(spark), "base_features")


def test_news_filter_keeps_first_copy(spark):
    rows = [(3, "u1", "x" * 60), (1, "u1", "x" * 60), (2, "u2", "y" * 10), (4, "u3", "z" * 6000)]
    df = spark.createDataFrame(rows, "article_id long, url string, content string").withColumns({"date": F.lit("d"), "instrument": F.lit("A")})
    assert [r.article_id for r in nw.filter_news(df).collect()] == [1]


@pytest.mark.parametrize(("alpha", "scale"), [(0.0, True), (2.0, False), (2.0, True)])
def test_rolling_backtest_with_several_features_equals_a_fit_per_row(spark, alpha, scale):
    rng = np.random.default_rng(11)
    rows, names = [], ["a", "b", "c"]
    for key, size in (("long", 90), ("short", 20), ("one", 1)):
        x = rng.normal(size=(size, 3)) * [1, 100, 1e-3] + [5, 1_000, 0]
        x[: size // 2, 2] = 0.25  # constant in the first windows
        y = x @ [1.0, 0.02, 300.0] + rng.normal(size=size)
        rows += [(key, i, float(y[i]), *map(float, x[i])) for i in range(size)]
    rows += [("long", 45, None, 1.0, 1.0, 1.0), (None, 1, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "instrument string, date int, y double, a double, b double, c double").repartition(5)
    got = m.rolling_ridge_backtest(df, names, "y", (20, 30), alpha=alpha, scale=scale).collect()
    assert len(got) == 70 + 60
    series = np.array([r[2:] for r in rows if r[0] == "long" and r[2] is not None])
    for g in got:
        n, i = g["training_window"], g["date"]
        past, now = series[i - n : i], series[i]
        mean = past.mean(0)
        z = past - mean
        sd = z[:, 1:].std(0)
        live = sd > 1e-12
        unit = np.where(live, sd, 1.0) if scale else np.ones(3)
        x = z[:, 1:][:, live] / unit[live]
        beta = np.linalg.solve(x.T @ x + alpha * np.eye(live.sum()), x.T @ z[:, 0])
        want = mean[0] + ((now[1:] - mean[1:])[live] / unit[live]) @ beta
        assert g["instrument"] == "long" and g["last_level"] == series[i - 1, 0]
        assert g["y_hat"] == pytest.approx(want, rel=1e-7, abs=1e-7)


def test_rolling_backtest_fills_features_and_takes_an_empty_table(spark):
    schema = "instrument string, date int, y double, a double, k0 string"
    rows = [("A", i, float(i), None if i % 3 else float(i), "x") for i in range(12)]
    df = spark.createDataFrame(rows, schema)
    assert m.rolling_ridge_backtest(df, ["a"], "y", (5,), fill=0.0).count() == 7
    assert m.rolling_ridge_backtest(df, ["a"], "y", (5,)).count() == 0
    assert m.rolling_ridge_backtest(df.limit(0), ["a"], "y", (5,)).count() == 0


def test_window_sums():
    v = np.arange(23.0).reshape(23, 1) ** 2
    for n in (1, 4, 22, 23, 30):
        want = [v[i : i + n].sum(0) for i in range(23 - n + 1)] if n <= 23 else []
        assert np.allclose(m.window_sums(v, n), np.array(want).reshape(-1, 1))
