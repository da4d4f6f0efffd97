"""Plans and formulas that hold at every size."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tickloom.operators import models as m
from tickloom.operators import relationships as rel
from tickloom.plans import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["close_volatility"])
def test_bars_are_hashed_not_sorted(spark, name):
    plan = REGISTRY[name].build(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def _series_p(t, dof):
    """The finite series for whole degrees of freedom."""
    theta = math.atan(abs(t) / math.sqrt(dof))
    c2, total, term = math.cos(theta) ** 2, 0.0, 1.0
    for k in range(1, (dof // 2 if dof % 2 == 0 else (dof - 1) // 2) + 1):
        total += term
        term *= c2 * (2 * k / (2 * k + 1) if dof % 2 else (2 * k - 1) / (2 * k))
    if dof % 2:
        return 1 - 2 / math.pi * (theta + math.sin(theta) * math.cos(theta) * total)
    return 1 - math.sin(theta) * total


def test_p_values_of_any_size(spark):
    cases = [(t, dof) for dof in (1, 2, 3, 4, 7, 20, 79, 80, 81, 100, 999, 1_000, 1_001, 50_000, 1_000_001) for t in (0.0, 1e-6, 0.3, -1.0, 2.5, 8.5, 9.1, 40.0)]
    rows = spark.createDataFrame(cases, "t double, dof bigint").select("t", "dof", rel.student_p_value(F.col("t"), F.col("dof")).alias("p")).collect()
    for r in rows:
        assert r.p == pytest.approx(max(0.0, _series_p(r.t, r.dof)), abs=1e-8), (r.t, r.dof)


def test_regimes_settle(spark):
    rows = [("a", i, float((i * 37 % 101) ** 2), float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "instrument string, date int, x double, z double")
    out = m.grouped_regimes(df, ["x", "z"], 3)
    again = out.groupBy("regime").agg(F.avg("x").alias("cx"), F.avg("z").alias("cz"))
    nearest = out.crossJoin(F.broadcast(again.withColumnRenamed("regime", "r"))).groupBy("date", "regime").agg(
        F.min_by("r", F.pow(F.col("x") - F.col("cx"), 2) + F.pow(F.col("z") - F.col("cz"), 2)).alias("r")
    )
    assert nearest.where("r <> regime").count() == 0
    with pytest.raises(RuntimeError):
        m.grouped_regimes(df, ["x", "z"], 3, max_rounds=1).count()


def test_switch_signal_takes_losses_and_accuracies(spark):
    rows = [("m", "mae", f"2024-01-{d:02d}", 1.0 if d < 3 else 2.0) for d in (1, 2, 30, 31)]
    history = spark.createDataFrame(rows, "model string, metric string, day string, value double").withColumn("date", F.to_date("day"))
    flag = lambda **o: m.switch_signal(history, "2024-02-10", "mae", **o).first().should_switch
    assert flag() is True and flag(any_fall=True) is False
