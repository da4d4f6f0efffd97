"""News store by day, files that a scan leaves out, and the order of raw lines at large keys."""

from __future__ import annotations

import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tickloom.plans import views
from tickloom.sources import schemas as sc
from tickloom.sources import sinks
from tickloom.sources.lake import Lake

NEWS = "article_id long, date date, text string"


def files(path) -> dict[str, int]:
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    }


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_store_touches_only_days_that_receive_articles(spark, tmp_path):
    path = f"{tmp_path}/news"
    first = [(1, date(2024, 1, 1), "a"), (2, date(2024, 1, 5), "b"), (3, date(2024, 1, 9), None)]
    sinks.upsert_news_store(spark.createDataFrame(first, NEWS), path, date(2024, 1, 10), 30)
    before = files(path)
    late = [
        (2, date(2024, 1, 6), "known under another day"),
        (4, date(2024, 1, 9), "later copy"),
        (4, date(2024, 1, 8), "early copy"),
        (4, date(2024, 1, 8), "early copy"),
        (5, date(2023, 11, 1), "too old"),
        (None, date(2024, 1, 9), "no id"),
        (6, None, "no day"),
    ]
    store = sinks.upsert_news_store(spark.createDataFrame(late, NEWS), path, date(2024, 2, 2), 30)
    assert store.columns == ["article_id", "date", "text"]
    assert rows(store) == [(2, date(2024, 1, 5), "b"), (3, date(2024, 1, 9), None), (4, date(2024, 1, 8), "early copy")]
    after = files(path)
    kept = {f: t for f, t in before.items() if "date=2024-01-01" not in f}
    assert {f: after.get(f) for f in kept} == kept
    assert {f.split("date=")[1][:10] for f in set(after) - set(before)} == {"2024-01-08"}
    # the same run again changes nothing
    again = sinks.upsert_news_store(spark.createDataFrame(late, NEWS), path, date(2024, 2, 2), 30)
    assert again.count() == 3 and set(files(path)) == set(after)


def test_store_takes_an_empty_table(spark, tmp_path):
    path = f"{tmp_path}/news"
    assert sinks.upsert_news_store(spark.createDataFrame([], NEWS), path, date(2024, 1, 10)).count() == 0
    assert sinks.upsert_news_store(spark.createDataFrame([(1, date(2024, 1, 9), "a")], NEWS), path, date(2024, 1, 10)).count() == 1


def test_files_left_out_are_listed_with_their_reason(spark, tmp_path):
    bars = spark.createDataFrame([("a b", "2024-01-02", 1.0)], "symbol string, date string, value double")
    bars.withColumn("date", F.col("date").cast("timestamp")).coalesce(1).write.partitionBy("symbol").parquet(f"{tmp_path}/economic_data")
    for name, content in (("x y", b"PAR1 no parquet"), ("z", b"")):
        os.makedirs(f"{tmp_path}/economic_data/symbol={name}")
        (tmp_path / "economic_data" / f"symbol={name}" / "f.parquet").write_bytes(content)
    os.makedirs(f"{tmp_path}/earnings_data")
    good, bad, bare = '{"symbol": "a", "date": "2024-01-02"}\n', '{"symbol": "a"\n', '{"date": "2024-01-02"}\n'
    for name, content in (("good", good * 2), ("some", good + bad), ("none", bad), ("bare", good + bare), ("empty", "")):
        (tmp_path / "earnings_data" / f"{name}.json").write_text(content)
    lake = Lake(spark, str(tmp_path))
    out = {os.path.basename(os.path.dirname(r.path)): r for r in lake.skipped_parquet("economic_data", sc.ECONOMIC).collect()}
    assert {k: r.reason for k, r in out.items()} == {"symbol=x y": "no rows"}
    got = {os.path.basename(r.path)[:-5]: tuple(r)[2:] for r in lake.skipped_json("earnings_data", sc.EARNINGS).collect()}
    assert got == {
        "some": (2, 1, 0, "broken records"),
        "none": (1, 1, 0, "no record parses"),
        "bare": (2, 0, 1, "records without key"),
    }


LINE = "l_orderkey long, l_linenumber int, l_partkey long, l_extendedprice double, l_quantity double"


def test_line_order_at_large_keys(spark):
    lines = [
        (600_000_000_000, 7, 20_000_000_000, 104_949.5, 50.0),
        (600_000_000_000, 7, 20_000_000_000, 104_949.5, 2.5),
        (600_000_000_000, 7, 20_000_000_000, 104_949.5, 3.0),
        (600_000_000_000, 7, 2_000_000_000, 90.5, 99.99),
        (1, 99, 20_000_000_001, 0.01, 0.01),
        (0, 0, 0, 0.0, 0.0),
    ]
    df = spark.createDataFrame(lines, LINE).withColumn("o", views.line_order())
    assert [tuple(r)[:5] for r in df.orderBy("o").collect()] == sorted(lines)
    assert df.agg(F.max("o")).first()[0] < Decimal(10**38)
    plan = df.groupBy().agg(F.min_by("l_quantity", "o"), F.max_by("l_quantity", "o"))._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan.split("== Physical Plan ==")[1]


def test_line_order_refuses_what_does_not_fit(spark):
    df = spark.createDataFrame([(1, 1, 1, 1.0, 1000.0)], LINE).select(views.line_order().alias("o"))
    with pytest.raises(PySparkException, match="l_quantity"):
        df.collect()
