"""Mutual information by nearest neighbours against a plain loop."""

from __future__ import annotations

import math
from datetime import date, timedelta

import numpy as np
import pytest

from tickloom.operators import relationships as rel


def digamma(n: int) -> float:
    return sum(1 / i for i in range(1, n)) - np.euler_gamma


def plain(x, y, k=3):
    n = len(x)
    if n <= k:
        return None
    x, y = (v / (np.std(v) or 1.0) for v in (np.array(x), np.array(y)))
    total = 0.0
    for i in range(n):
        dx = [abs(x[i] - x[j]) for j in range(n) if j != i]
        dy = [abs(y[i] - y[j]) for j in range(n) if j != i]
        reach = sorted(map(max, dx, dy))[k - 1]
        total += digamma(1 + sum(d < reach for d in dx)) + digamma(1 + sum(d < reach for d in dy))
    return max(0.0, digamma(k) + digamma(n) - total / n)


def test_equals_plain_loop(spark, monkeypatch):
    monkeypatch.setattr(rel, "NEIGHBOUR_CELLS", 20_000)  # several steps
    rng = np.random.default_rng(5)
    base = rng.normal(size=90)
    series = {
        "a": base,
        "b": base + 0.3 * rng.normal(size=90),
        "c": rng.normal(size=90),
        "d": np.where(rng.random(90) < 0.3, np.nan, base**2),  # gaps
        "e": np.round(rng.normal(size=90)),  # ties
        "f": np.full(90, 2.0),  # no spread
        "g": np.where(np.arange(90) < 3, base, np.nan),  # too few
    }
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(90)]
    rows = [(name, day, float(x)) for name, xs in series.items() for day, x in zip(days, xs, strict=True) if not math.isnan(x)]
    df = spark.createDataFrame(rows, "instrument string, date date, log_return double")
    got = {(r.instrument_i, r.instrument_j): r for r in rel.neighbour_information(df).collect()}
    assert len(got) == 21
    for (i, j), r in got.items():
        both = ~np.isnan(series[i]) & ~np.isnan(series[j])
        want = plain(series[i][both], series[j][both])
        assert r.n == both.sum()
        assert r.mi is None if want is None else r.mi == pytest.approx(want, abs=1e-9)
    assert got["a", "b"].mi > 0.5 > got["a", "c"].mi and got["a", "f"].mi == 0


def test_short_panel_and_empty_table(spark):
    kind = "instrument string, date date, log_return double"
    few = spark.createDataFrame([(i, date(2024, 1, d), float(d)) for i in "ab" for d in (1, 2)], kind)
    assert [tuple(r) for r in rel.neighbour_information(few).collect()] == [("a", "b", 2, None)]
    assert rel.neighbour_information(spark.createDataFrame([], kind)).count() == 0
