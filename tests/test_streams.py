"""Streams that are drained in several runs, with late files and windows that stay open."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.functions.ewm import prefix_means
from tickloom.operators import news
from tickloom.streaming import jobs

START = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
SCHEMA = "event_id bigint, instrument string, ts timestamp, price double, size bigint, sentiment double"


def ticks(spark, first, minutes):
    rows = [(first + i, "AB"[i % 2], START + dt.timedelta(minutes=m), float(i % 7), 1, (i % 5 - 2) / 2) for i, m in enumerate(minutes)]
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


def table(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in x) for x in df.collect())


#: form: (builder, end of a result's window, longest window)
FORMS = {
    "bars": (lambda x: jobs.bars(x, "hourly"), "bar_start + INTERVAL 1 HOUR", "1 HOUR"),
    "sentiment": (lambda x: jobs.daily_sentiment(x, late="10 minutes"), "CAST(date AS TIMESTAMP) + INTERVAL 1 DAY", "1 DAY"),
    "shock": (lambda x: jobs.article_shock(x, late="10 minutes"), "window_end", "7 DAYS"),
    "sessions": (lambda x: jobs.gap_sessions(x, "2 hours", late="10 minutes"), "last_ts + INTERVAL 2 HOURS", None),
}


@pytest.mark.parametrize("form", FORMS)
def test_two_drains_return_every_window_once(spark, tmp_path, form):
    build, end, reach = FORMS[form]
    root, place = f"{tmp_path}/ticks", {"path": f"{tmp_path}/sink", "checkpoint": f"{tmp_path}/state"}

    def run():
        batch = spark.read.schema(SCHEMA).parquet(root)
        stream = jobs.read_files(spark, root, SCHEMA, files_per_trigger=1)
        return table(jobs.run_and_finish(build, stream, batch, F.expr(end), form, reach, **place))

    first = ticks(spark, 0, range(0, 4_000, 7))
    first.write.mode("append").parquet(root)
    assert run() == table(build(first))  # the newest windows are open, and there all the same
    second = ticks(spark, 10_000, [3_999, 3_998, *range(4_005, 9_000, 11)])  # two rows within the time for late ones
    second.write.mode("append").parquet(root)
    both = first.unionByName(second)
    assert run() == table(build(both))
    # a file far behind the watermark is dropped by the stream and by what finishes it
    ticks(spark, 20_000, [1, 2, 3]).write.mode("append").parquet(root)
    ticks(spark, 30_000, [9_000, 9_001]).write.mode("append").parquet(root)
    late = run()
    if form in ("bars", "sentiment"):
        assert late == table(build(both.unionByName(ticks(spark, 30_000, [9_000, 9_001]))))
    assert run() == late  # nothing new: the same windows again


def test_watermark_of_a_new_query_is_1970(spark, tmp_path):
    (tmp_path / "offsets").mkdir()
    (tmp_path / "offsets" / "0").write_text('v1\n{"batchWatermarkMs":0,"batchTimestampMs":1}\n{}')
    assert spark.range(1).select(F.unix_millis(jobs.watermark_of(spark, str(tmp_path)))).first()[0] == 0


def _ewm_files(spark, root, pieces):
    for rows in pieces:
        data = [(k, START + dt.timedelta(hours=h), x) for k, h, x in rows]
        spark.createDataFrame(data, "instrument string, bar_start timestamp, close double").coalesce(1).write.mode("append").parquet(root)


def _ewm_wanted(rows, span):
    alpha, out = 2 / (span + 1), []
    for k in sorted({r[0] for r in rows}):
        y = None
        for _, h, x in sorted(r for r in rows if r[0] == k):
            y = x if y is None else (1 - alpha) * y + alpha * x
            out.append((k, h, x, pytest.approx(y, rel=1e-9)))
    return out


def _ewm_rows(df):
    hours = (F.unix_timestamp("bar_start") - int(START.timestamp())) / 3600
    return table(df.select("instrument", hours.cast("int"), "close", "ewm"))


@pytest.mark.parametrize("seed", [None, 1, 2])
def test_mean_does_not_depend_on_the_order_of_files(spark, tmp_path, seed):
    rows = [("AB"[h % 2], h, float((h * 37) % 101)) for h in range(200)]
    rows += [("A", 50, 3.0), ("A", 50, 1.0)]  # one time, several values: by ascending value
    shuffled = rows[:]
    if seed is not None:
        random.Random(seed).shuffle(shuffled)
    root, place = f"{tmp_path}/bars", {"path": f"{tmp_path}/sink", "checkpoint": f"{tmp_path}/state"}

    def run():
        stream = jobs.read_files(spark, root, "instrument string, bar_start timestamp, close double", files_per_trigger=1)
        return _ewm_rows(jobs.run_ewm(stream, 5, late="250 hours", **place))

    _ewm_files(spark, root, [shuffled[i : i + 50] for i in range(0, len(rows), 50)])
    assert run() == _ewm_wanted(rows, 5)
    # a second drain goes on from the state; most of the first rows are passed by the watermark now
    more = [("AB"[h % 2], h, float(h % 13)) for h in range(200, 420)]
    _ewm_files(spark, root, [more[110:], more[:110]])
    assert run() == _ewm_wanted(rows + more, 5)
    assert spark.read.parquet(place["path"]).count() > 100
    assert run() == _ewm_wanted(rows + more, 5)


def test_mean_leaves_out_late_and_incomplete_rows(spark, tmp_path):
    root = f"{tmp_path}/bars"
    rows = [("A", h, float(h)) for h in range(0, 100, 2)]
    _ewm_files(spark, root, [rows])
    schema = "instrument string, bar_start timestamp, close double"
    place = {"path": f"{tmp_path}/sink", "checkpoint": f"{tmp_path}/state"}
    jobs.run_ewm(jobs.read_files(spark, root, schema), 3, late="10 hours", **place)
    _ewm_files(spark, root, [[("A", 1, 1e9), ("A", 97, 5.0), (None, 98, 1.0), ("A", 99, None)]])
    out = jobs.run_ewm(jobs.read_files(spark, root, schema), 3, late="10 hours", **place)
    assert _ewm_rows(out) == _ewm_wanted([*rows, ("A", 97, 5.0)], 3)


def test_prefix_means_equal_the_recursion():
    x = np.random.default_rng(5).normal(size=1_000)
    for alpha in (0.02, 0.3, 0.9):
        want, y = [], None
        for v in x:
            y = v if y is None else (1 - alpha) * y + alpha * v
            want.append(y)
        assert np.allclose(prefix_means(x, alpha), want, rtol=1e-9, atol=1e-12)
        assert np.allclose(prefix_means(x[400:], alpha, want[399]), want[400:], rtol=1e-9, atol=1e-12)
    assert len(prefix_means(x[:0], 0.3)) == 0


def test_daily_measures_of_a_stream_equal_the_batch_operator(spark, tmp_path):
    rnd = random.Random(3)
    rows = []
    for i in range(6_000):
        x = None if i % 11 == 0 else rnd.gauss(0.05, 0.4)
        weight = None if i % 7 == 0 else float(i % 3 + 1)
        source = None if i % 13 == 0 else f"s{rnd.randrange(700)}"
        rows.append(("AB"[i % 2], START + dt.timedelta(seconds=rnd.randrange(3 * 86_400)), x, source, weight))
    rows += [("C", START, None, "s", 1.0), ("D", START, 0.2, None, None)]  # no sentiment at all; one article
    schema = "instrument string, ts timestamp, sentiment double, source string, importance double"
    root = f"{tmp_path}/news"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(root)
    batch = spark.read.parquet(root)
    got = jobs.run_and_finish(
        lambda df: jobs.daily_sentiment(df, late="4 days", source="source", importance="importance"),
        jobs.read_files(spark, root, schema, files_per_trigger=1),
        batch,
        F.expr("CAST(date AS TIMESTAMP) + INTERVAL 1 DAY"),
        "measures",
        "1 DAY",
    ).toPandas()
    want = news.daily_sentiment(batch.withColumn("date", F.to_date("ts"))).toPandas()
    by = ["instrument", "date"]
    got, want = got.sort_values(by, ignore_index=True), want.sort_values(by, ignore_index=True)
    assert got[by].equals(want[by]) and len(got) == 7
    for c in set(want.columns) - {*by, "sentiment_median", "unique_sources"}:
        assert np.allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, equal_nan=True), c
    assert (abs(got["unique_sources"] / want["unique_sources"].clip(lower=1) - 1)[want["unique_sources"] > 0] < 0.04).all()
    for k, day, median in zip(got["instrument"], got["date"], got["sentiment_median"]):
        values = sorted(r[2] for r in rows if r[0] == k and r[1].date() == day and r[2] is not None)
        rank = sum(v <= median for v in values) / len(values)
        assert len(values) == 1 or abs(rank - 0.5) < 0.02
