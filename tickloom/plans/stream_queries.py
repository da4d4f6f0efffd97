"""Streaming queries: the event table is replayed as a file stream and drained."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.plans import views as v
from tickloom.plans.lake_queries import _stored
from tickloom.plans.registry import r, register, rounded, with_ctes
from tickloom.session import scratch
from tickloom.streaming import jobs


def _ticks(s, sf) -> DataFrame:
    return v.table(s, sf, "events").select(
        "event_id",
        F.col("event_id").alias("article_id"),
        F.col("event_type").alias("instrument"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
        F.col("user_id").alias("size"),
        F.sin("value").alias("sentiment"),
        F.concat(F.lit("s"), (F.col("user_id") % 17).cast("string")).alias("source"),
        F.when(F.col("event_id") % 5 != 0, F.col("event_id") % 3 + 1).alias("importance"),
    )


def _source(s, sf, copies: int = 1) -> DataFrame:
    """Ticks as a file stream; ``copies`` > 1 repeats every record."""
    return _sources(s, sf, copies)[0]


def _sources(s, sf, copies: int = 1) -> tuple[DataFrame, DataFrame]:
    """Ticks as a file stream, and the same files as a table."""

    def write(root):
        t = _ticks(s, sf)
        for _ in range(copies - 1):
            t = t.unionByName(_ticks(s, sf))
        t.write.parquet(root)

    path = _stored(s, sf, f"ticks{copies}", write)
    schema = _ticks(s, sf).schema
    return jobs.read_files(s, path, schema), s.read.schema(schema).parquet(path)


def _finished(s, sf, build, end, name, reach=None, prepare=lambda df: df) -> DataFrame:
    stream, batch = _sources(s, sf)
    return jobs.run_and_finish(build, prepare(stream), prepare(batch), end, name, reach)


def _bars(s, sf) -> DataFrame:
    return _finished(s, sf, lambda x: jobs.bars(x, "hourly"), F.col("bar_start") + F.expr("INTERVAL 1 HOUR"), "bars", "1 HOUR")


_TK = "tk AS (SELECT event_id, event_type AS instrument, ts, value AS price, user_id AS size, sin(value) AS sentiment, CASE WHEN event_id % 5 <> 0 THEN event_id % 3 + 1 END AS importance FROM events)"


register(
    "news_stream_dedup",
    "STR-1",
    lambda s, sf: rounded(
        jobs.run_available(jobs.news_ingest(_source(s, sf, 2)), "dedup").select("article_id", "instrument", "price")
    ),
    with_ctes([_TK], f"SELECT event_id AS article_id, instrument, {r('price', 'price')} FROM tk"),
)
register(
    "stream_bars",
    "STR-2",
    lambda s, sf: rounded(
        _bars(s, sf).select(
            "instrument", F.unix_timestamp("bar_start").alias("bar_epoch"), "open", "high", "low", "close", "volume"
        )
    ),
    with_ctes(
        [_TK],
        f"""SELECT instrument, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS bar_epoch, {r('first(price ORDER BY ts, event_id)', 'open')}, {r('max(price)', 'high')},
        {r('min(price)', 'low')}, {r('last(price ORDER BY ts, event_id)', 'close')}, CAST(sum(size) AS BIGINT) AS volume FROM tk GROUP BY 1, 2""",
    ),
)
# every measure that is exact; median and sources are sketches, see tests/test_streams.py
_MEASURES = {
    "sentiment_mean": "avg(sentiment)",
    "sentiment_std": "coalesce(stddev_samp(sentiment), 0)",
    "sentiment_min": "min(sentiment)",
    "sentiment_max": "max(sentiment)",
    "positive_pct": "count(*) FILTER (sentiment > 0.1) / count(sentiment)",
    "negative_pct": "count(*) FILTER (sentiment < -0.1) / count(sentiment)",
    "neutral_pct": "1 - count(*) FILTER (sentiment > 0.1) / count(sentiment) - count(*) FILTER (sentiment < -0.1) / count(sentiment)",
    "sentiment_skew": "skewness(sentiment)",
    "news_shock": "least(count(*) / 5.0, 2)",
    "sentiment_recency_weighted": "sum(w * sentiment) / sum(w) FILTER (sentiment IS NOT NULL)",
    "sentiment_volume_weighted": "sum(coalesce(importance, 1) * sentiment) / sum(coalesce(importance, 1)) FILTER (sentiment IS NOT NULL)",
}
register(
    "stream_daily_sentiment",
    "STR-3",
    lambda s, sf: rounded(
        _finished(
            s,
            sf,
            lambda x: jobs.daily_sentiment(x, source="source", importance="importance"),
            F.col("date").cast("timestamp") + F.expr("INTERVAL 1 DAY"),
            "sentiment",
            "1 DAY",
        ).select("instrument", "date", "article_count", *_MEASURES),
        6,
    ),
    with_ctes(
        [
            _TK,
            "wt AS (SELECT *, CAST(ts AS DATE) AS date, exp(-0.1 * (epoch_us(max(ts) OVER (PARTITION BY instrument, CAST(ts AS DATE))) - epoch_us(ts)) / 3.6e9) AS w FROM tk)",
        ],
        f"""SELECT instrument, date, count(*) AS article_count, {", ".join(r(e, c, 6) for c, e in _MEASURES.items())}
        FROM wt GROUP BY 1, 2 HAVING count(sentiment) > 0""",
    ),
)
register(
    "stream_article_shock",
    "STR-4",
    lambda s, sf: rounded(
        _finished(s, sf, jobs.article_shock, F.col("window_end"), "shock", "7 DAYS").select(
            "instrument", F.col("window_start").cast("date").alias("window_start"), F.col("window_end").cast("date").alias("window_end"), "article_count", "news_shock"
        )
    ),
    with_ctes(
        [_TK, "wd AS (SELECT instrument, ts, CAST(CAST(ts AS DATE) - CAST(k AS INTEGER) AS DATE) AS s FROM tk, (SELECT unnest(range(0, 7)) AS k))"],
        f"""SELECT instrument, s AS window_start, CAST(s + 7 AS DATE) AS window_end, count(*) AS article_count, {r('least(count(*) / 35.0, 2)', 'news_shock')} FROM wd GROUP BY 1, 2""",
    ),
)
register(
    "stream_gap_sessions",
    "STR-5",
    lambda s, sf: _finished(
        s,
        sf,
        lambda x: jobs.gap_sessions(x, "1 hour"),
        F.col("last_ts") + F.expr("INTERVAL 1 HOUR"),
        "sessions",
        prepare=lambda x: x.withColumn("instrument", F.col("size").cast("string")),
    ).select(
        "instrument", F.unix_timestamp("first_ts").alias("first_epoch"), F.unix_timestamp("last_ts").alias("last_epoch"), "rows"
    ),
    with_ctes(
        [
            _TK,
            "us AS (SELECT CAST(size AS VARCHAR) AS instrument, ts FROM tk)",
            "br AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS b FROM us WINDOW w AS (PARTITION BY instrument ORDER BY ts))",
            "sn AS (SELECT *, sum(b) OVER (PARTITION BY instrument ORDER BY ts) AS g FROM br)",
        ],
        f"""SELECT instrument, CAST(floor(epoch(min(ts))) AS BIGINT) AS first_epoch, CAST(floor(epoch(max(ts))) AS BIGINT) AS last_epoch, count(*) AS rows FROM sn GROUP BY instrument, g""",
    ),
)
_HB = f"""
hb AS (SELECT instrument, date_trunc('hour', ts) AS h, last(price ORDER BY ts, event_id) AS close FROM tk GROUP BY 1, 2),
hn AS (SELECT *, row_number() OVER (PARTITION BY instrument ORDER BY h) - 1 AS n FROM hb),
em(instrument, h, n, y) AS (SELECT instrument, h, n, close FROM hn WHERE n = 0 UNION ALL SELECT d.instrument, d.h, d.n, {1 - 2 / 13!r} * em.y + {2 / 13!r} * d.close FROM em JOIN hn d ON d.instrument = em.instrument AND d.n = em.n + 1)"""


def _ewm(s, sf):
    """Two queries joined by a table: finished bars are written to files, the mean reads those files."""
    path, bars = scratch(s, "bar-table"), _bars(s, sf)
    bars.write.parquet(path)
    out = jobs.run_ewm(jobs.read_files(s, path, bars.schema), 12)
    return rounded(out.select("instrument", F.unix_timestamp("bar_start").alias("bar_epoch"), "ewm"))


register(
    "stream_ewm",
    "STR-6",
    _ewm,
    with_ctes([_TK, _HB], f"SELECT instrument, CAST(epoch(h) AS BIGINT) AS bar_epoch, {r('y', 'ewm')} FROM em", recursive=True),
)
