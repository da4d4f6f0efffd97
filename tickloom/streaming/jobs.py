"""Structured Streaming forms of the incremental operators.

Each function maps a streaming DataFrame to a streaming DataFrame; ``run_available`` drains
a source into parquet files under the shared folder and returns them as a table, so nothing
passes through the driver. ``run_and_finish`` adds the windows that the watermark has not closed yet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from decimal import Decimal
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.functions.ewm import prefix_means, span_alpha, with_ewm
from tickloom.operators.news import DECAY, LABEL_EDGE, unbiased_skew
from tickloom.session import scratch

# window length of each bar interval: fixed values
INTERVALS = {
    "1min": "1 minute",
    "5min": "5 minutes",
    "15min": "15 minutes",
    "30min": "30 minutes",
    "hourly": "1 hour",
    "daily": "1 day",
}


def read_files(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def run_available(out: DataFrame, name: str, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process everything the source holds, then read the sink back.

    With a fixed ``path`` and ``checkpoint`` a later run continues where this one stopped.
    """
    spark = out.sparkSession
    base = scratch(spark, f"stream-{name}")
    path, checkpoint = path or f"{base}/data", checkpoint or f"{base}/state"
    query = (
        out.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(path)


def watermark_of(spark: SparkSession, checkpoint: str) -> Column:
    """Event time up to which a stopped query has closed its windows; 1970 before its first watermark."""
    log = spark.read.text(f"{checkpoint}/offsets").where(F.col("value").contains("batchWatermarkMs"))
    held = log.agg(F.max(F.get_json_object("value", "$.batchWatermarkMs").cast("bigint"))).first()[0]
    return F.timestamp_millis(F.lit(held or 0))


def run_and_finish(
    build: Callable[[DataFrame], DataFrame],
    stream: DataFrame,
    batch: DataFrame,
    end: Column,
    name: str,
    reach: str | None = None,
    time: str = "ts",
    path: str | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """Drain ``stream`` through ``build`` and add the windows that are still open, made from the same rows as a batch.

    ``batch`` reads the files of ``stream``. ``end`` is the end of a result's window, in columns of the result. A window is written to the sink when
    the watermark reaches its end; rows of windows that end later were never dropped as late, so the batch form of these windows is
    what the state holds. The sink and the state are left as they are: a later run with the same ``path`` and ``checkpoint`` goes on.
    ``reach`` bounds a window's length, so that only rows near the watermark are read again; sessions have no such bound.
    """
    spark = stream.sparkSession
    base = scratch(spark, f"stream-{name}")
    path, checkpoint = path or f"{base}/data", checkpoint or f"{base}/state"
    closed = run_available(build(stream), name, path, checkpoint)
    mark = watermark_of(spark, checkpoint)
    recent = batch if reach is None else batch.where(F.col(time) >= mark - F.expr(f"INTERVAL {reach}"))
    return closed.unionByName(build(recent).where(end > mark))


def news_ingest(stream: DataFrame, key: str = "article_id", time: str = "ts", keep: str = "90 days") -> DataFrame:
    """First copy of each article id; ids are remembered for ``keep`` of event time."""
    return stream.withWatermark(time, keep).dropDuplicatesWithinWatermark([key])


def bars(
    stream: DataFrame, interval: str = "5min", late: str = "10 minutes", time: str = "ts", tie: str = "event_id"
) -> DataFrame:
    """Tumbling bars of (instrument, price, size) ticks; partial aggregation splits hot keys."""
    # one number of fixed width, so that the partial aggregate is hashed, not sorted
    micros = F.unix_micros(F.col(time).cast("timestamp")).cast("decimal(19,0)")
    order = micros * F.lit(Decimal(10**18)) + F.col(tie).cast("decimal(18,0)")
    return (
        stream.withWatermark(time, late)
        .groupBy("instrument", F.window(time, INTERVALS[interval]).alias("w"))
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.sum("size").alias("volume"),
        )
        .select("instrument", F.col("w.start").alias("bar_start"), "open", "high", "low", "close", "volume")
    )


def daily_sentiment(
    stream: DataFrame,
    late: str = "1 day",
    time: str = "ts",
    source: str | None = None,
    importance: str | None = None,
    min_articles: int = 1,
    decay: float = DECAY,
    quantile_k: int = 400,
    distinct_lg_k: int = 14,
) -> DataFrame:
    """Daily measures per instrument in one pass; articles later than ``late`` are dropped, and days without any sentiment.

    All but two are sums, so a day's state has a fixed size and partial results merge. The recency weight exp(-decay * hours to the last article)
    is taken from the start of the day instead: the common factor cancels. Median and distinct sources come from sketches:
    the median is a value whose rank is within about 0.7 % of the middle (``quantile_k`` 400), the count is within about 2 % (``distinct_lg_k`` 14);
    up to ``quantile_k`` articles, the median is the exact lower one. Null importance counts as 1, null sources are not counted.
    """
    x = F.col("sentiment").cast("double")
    known = x.isNotNull()
    hours = F.pmod(F.unix_micros(F.col(time).cast("timestamp")), F.lit(86_400_000_000)) / 3.6e9
    recency = F.when(known, F.exp(decay * hours))
    positive, negative = (F.avg(F.when(known, side.cast("double"))) for side in (x > LABEL_EDGE, x < -LABEL_EDGE))
    measures = [
        F.count(F.lit(1)).alias("article_count"),
        F.avg(x).alias("sentiment_mean"),
        F.coalesce(F.stddev_samp(x), F.lit(0.0)).alias("sentiment_std"),
        F.min(x).alias("sentiment_min"),
        F.max(x).alias("sentiment_max"),
        positive.alias("positive_pct"),
        negative.alias("negative_pct"),
        (1 - positive - negative).alias("neutral_pct"),
        unbiased_skew(x).alias("sentiment_skew"),
        F.least(F.count(F.lit(1)) / 5.0, F.lit(2.0)).alias("news_shock"),
        F.try_divide(F.sum(recency * x), F.sum(recency)).alias("sentiment_recency_weighted"),
        F.when(F.count(x) > 0, F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(x, quantile_k), F.lit(0.5))).alias("sentiment_median"),
    ]
    if importance:
        weight = F.when(known, F.coalesce(F.col(importance).cast("double"), F.lit(1.0)))
        measures.append(F.try_divide(F.sum(weight * x), F.sum(weight)).alias("sentiment_volume_weighted"))
    if source:
        measures.append(F.hll_sketch_estimate(F.hll_sketch_agg(F.col(source), distinct_lg_k)).alias("unique_sources"))
    return (
        stream.withWatermark(time, late)
        .groupBy("instrument", F.window(time, "1 day").alias("w"))
        .agg(*measures)
        .where((F.col("article_count") >= min_articles) & F.col("sentiment_mean").isNotNull())
        .withColumn("w", F.col("w.start").cast("date"))
        .withColumnRenamed("w", "date")
    )


def _days(window: str) -> Column:
    """Length of a window column in days."""
    return (F.unix_timestamp(F.col(window)["end"]) - F.unix_timestamp(F.col(window)["start"])) / 86_400


def article_shock(
    stream: DataFrame, length: str = "7 days", step: str = "1 day", late: str = "1 day", time: str = "ts", per_day: float = 5.0
) -> DataFrame:
    """Article count of a sliding window and its shock measure."""
    return (
        stream.withWatermark(time, late)
        .groupBy("instrument", F.window(time, length, step).alias("w"))
        .agg(F.count(F.lit(1)).alias("article_count"))
        .select(
            "instrument",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "article_count",
            F.least(F.col("article_count") / (_days("w") * per_day), F.lit(2.0)).alias("news_shock"),
        )
    )


def gap_sessions(stream: DataFrame, gap: str = "3 hours", late: str = "1 hour", time: str = "ts") -> DataFrame:
    """Unbroken runs of data per instrument; a silence longer than ``gap`` ends a run."""
    return (
        stream.withWatermark(time, late)
        .groupBy("instrument", F.session_window(time, gap).alias("w"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min(time).alias("first_ts"), F.max(time).alias("last_ts"))
        .select("instrument", "first_ts", "last_ts", "rows")
    )


class OrderedMean(StatefulProcessor):
    """Holds the rows of a key until the watermark passes them, then adds them to the mean in time order."""

    def __init__(self, alpha: float):
        self.alpha = alpha

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.level = handle.getValueState("level", "y double")
        self.held = handle.getListState("held", "micros bigint, x double")

    def handleInputRows(self, key: tuple[Any, ...], rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        first = None
        for pdf in rows:
            micros = pdf["micros"].to_numpy("int64")
            self.held.appendList(list(zip(micros.tolist(), pdf["x"].to_numpy("float64").tolist())))
            first = int(micros.min()) if first is None else min(first, int(micros.min()))
        if first is not None:
            self._wake(-(-first // 1000))
        return iter(())

    def handleExpiredTimer(self, key: tuple[Any, ...], timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        limit = timerValues.getCurrentWatermarkInMs() * 1000
        held = pd.DataFrame(list(self.held.get()), columns=["micros", "x"])
        due = held[held["micros"] <= limit].sort_values(["micros", "x"], ignore_index=True)
        later = held[held["micros"] > limit]
        self.held.clear()
        if len(later):
            self.held.put(list(zip(later["micros"].tolist(), later["x"].tolist())))
            self.handle.registerTimer(-(-int(later["micros"].min()) // 1000))
        if len(due):
            x = due["x"].to_numpy("float64")
            y = prefix_means(x, self.alpha, self.level.get()[0] if self.level.exists() else None)
            self.level.update((float(y[-1]),))
            yield pd.DataFrame({"instrument": key[0], "micros": due["micros"], "x": x, "y": y})

    def _wake(self, millis: int) -> None:
        """One timer a key, at its oldest held row."""
        for old in list(self.handle.listTimers()):
            if old <= millis:
                return
            self.handle.deleteTimer(old)
        self.handle.registerTimer(millis)

    def close(self) -> None:
        pass


def ewm(bars_stream: DataFrame, span: int, value: str = "close", time: str = "bar_start", late: str = "1 day") -> DataFrame:
    """Exponential mean per instrument in event-time order, whatever order files and micro-batches come in.

    A row waits until the watermark (newest time less ``late``) passes it, so the state holds the rows of the time span ``late`` and one
    number per key. Rows of one time are taken by ascending value. Rows behind the watermark are dropped, as are rows without a time, a
    value or an instrument. ``run_ewm`` drains a source and adds the rows that still wait.
    """
    return (
        bars_stream.select("instrument", F.col(time).alias("at"), F.col(value).cast("double").alias("x"))
        .dropna()
        .withWatermark("at", late)
        .withColumn("micros", F.unix_micros("at"))
        .groupBy("instrument")
        .transformWithStateInPandas(
            OrderedMean(span_alpha(span)), "instrument string, micros bigint, x double, y double", "append", "eventTime"
        )
        .select("instrument", F.timestamp_micros("micros").alias(time), F.col("x").alias(value), F.col("y").alias("ewm"))
    )


@contextmanager
def rocks_state(spark: SparkSession) -> Iterator[None]:
    """Named state variables need the RocksDB state store; the session's own setting returns afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def waiting_ewm(spark: SparkSession, checkpoint: str, span: int, value: str = "close", time: str = "bar_start") -> DataFrame:
    """Means of the rows that a stopped ``ewm`` query still holds, from its state; the state is only read.

    The level of a key goes before its held rows as their first value, so the batch form carries it on.
    """

    def variable(name: str) -> DataFrame:
        return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)

    level = variable("level").select(
        F.col("key.instrument").alias("instrument"), F.lit(None).cast("bigint").alias("micros"), F.col("value.y").alias("x")
    )
    held = variable("held").select(F.col("key.instrument").alias("instrument"), "list_element.micros", "list_element.x")
    # nulls come first in a window; ties by value as in the stream
    rows = level.unionByName(held).withColumn("_at", F.struct("micros", "x"))
    return (
        with_ewm(rows, {"ewm": ("x", span_alpha(span), 0)}, ["instrument"], "_at")
        .where("micros IS NOT NULL")
        .select("instrument", F.timestamp_micros("micros").alias(time), F.col("x").alias(value), "ewm")
    )


def run_ewm(
    bars_stream: DataFrame,
    span: int,
    value: str = "close",
    time: str = "bar_start",
    late: str = "1 day",
    path: str | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """Drain ``bars_stream`` through ``ewm`` and add the rows that the watermark has not passed yet.

    A later run with the same ``path`` and ``checkpoint`` goes on: neither the sink nor the state is changed by what is added.
    """
    spark = bars_stream.sparkSession
    base = scratch(spark, "stream-ewm")
    path, checkpoint = path or f"{base}/data", checkpoint or f"{base}/state"
    with rocks_state(spark):
        done = run_available(ewm(bars_stream, span, value, time, late), "ewm", path, checkpoint)
    return done.unionByName(waiting_ewm(spark, checkpoint, span, value, time))
