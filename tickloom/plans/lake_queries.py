"""Queries over a lake that Spark writes from the given tables, then reads back."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import hygiene as h
from tickloom.plans import hygiene_queries as hq
from tickloom.plans import views as v
from tickloom.plans.registry import query, r, register, rounded, with_ctes
from tickloom.session import scratch
from tickloom.sources import filters as fl
from tickloom.sources import schemas as sc
from tickloom.sources import sinks
from tickloom.sources.lake import Lake

_LAKES: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf: str, part: str, write) -> str:
    """Write one part of the lake once per application, under the shared folder."""
    key = (spark.sparkContext.applicationId, sf, part)
    if key not in _LAKES:
        root = scratch(spark, f"lake-{part}")
        write(root)
        _LAKES[key] = root
    return _LAKES[key]


def _write_market(spark, sf, root):
    b = v.bars(spark, sf).select(
        F.lit("daily").alias("interval"),
        F.col("instrument").alias("symbol"),
        F.col("date").cast("timestamp").alias("date"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        (F.col("close") * 2).alias("sma_20"),
        (F.col("high") - F.col("low")).alias("vwap"),
    )
    e = v.table(spark, sf, "events")
    order = v.event_order()
    hourly = (
        e.groupBy(F.col("event_type").alias("symbol"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("date"))
        .agg(
            F.min_by("value", order).alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", order).alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
        .withColumns({"interval": F.lit("hourly"), "sma_20": F.lit(None).cast("double"), "vwap": F.lit(None).cast("double")})
    )
    sinks.write_bars(b.unionByName(hourly), f"{root}/market_data")


def _write_economic(spark, sf, root):
    e = v.econ(spark, sf).select(
        "symbol",
        F.col("date").cast("timestamp").alias("date"),
        "value",
        F.when(F.col("symbol") < "3", "rates").otherwise("growth").alias("category"),
        F.when(F.col("symbol") < "2", "high").otherwise("low").alias("importance"),
        F.lit("daily").alias("frequency"),
    )
    sinks.write_bars(e, f"{root}/economic_data")


def _market(spark, sf) -> Lake:
    return Lake(spark, _stored(spark, sf, "market", lambda root: _write_market(spark, sf, root)))


def _economic(spark, sf) -> Lake:
    return Lake(spark, _stored(spark, sf, "economic", lambda root: _write_economic(spark, sf, root)))


def _both(spark, sf) -> Lake:
    """Bars and economic series under one root."""

    def write(root):
        _write_market(spark, sf, root)
        _write_economic(spark, sf, root)

    return Lake(spark, _stored(spark, sf, "both", write))


def _news(spark, sf) -> Lake:
    def write(root):
        a = v.articles(spark, sf)
        score = F.coalesce("sentiment", F.lit(0.0))
        sinks.write_report(
            a.select(
                F.col("article_id").cast("string").alias("article_id"),
                F.substring_index("text", ".", 1).alias("title"),
                F.col("text").alias("content"),
                "source",
                F.date_format("date", "yyyy-MM-dd").alias("published_at"),
                F.array("instrument", F.concat(F.lit("x"), "instrument")).alias("symbols"),
                score.alias("sentiment_score"),
                F.when(score > 0.1, "positive").when(score < -0.1, "negative").otherwise("neutral").alias("sentiment_label"),
                F.when(F.col("article_id") % 3 == 0, "market").otherwise("company").alias("category"),
            ),
            f"{root}/news_data",
        )

    return Lake(spark, _stored(spark, sf, "news", write))


def _trends(spark, sf) -> Lake:
    def write(root):
        t = v.trends(spark, sf)
        docs = t.groupBy("keyword").agg(
            F.collect_list(
                F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"), "search_score")
            ).alias("search_interest")
        )
        sinks.write_report(
            docs.select(
                "keyword",
                F.lit("today 12-m").alias("timeframe"),
                F.when(F.col("keyword") != "view", F.when(F.col("keyword") < "f", "US").otherwise("DE")).alias("geo"),
                F.lit(7).alias("category"),
                "search_interest",
                F.when(F.col("keyword") > "e", F.struct(F.array("keyword").alias("top"), F.array().cast("array<string>").alias("rising"))).alias("related_queries"),
            ),
            f"{root}/trends_data",
        )

    return Lake(spark, _stored(spark, sf, "trends", write))


def _events(spark, sf) -> Lake:
    def write(root):
        e = v.event_days(spark, sf)
        day = F.date_format("date", "yyyy-MM-dd")
        sinks.write_report(
            e.where("event_type = 'signup'").select(
                F.col("instrument").alias("symbol"), day.alias("date"), (F.col("k") % 4 + 1).alias("quarter"),
                F.col("value").alias("eps_estimate"), F.when(F.col("k") < 50, "finnhub").otherwise("polygon").alias("source"),
            ),
            f"{root}/earnings_data",
        )
        form = F.when(F.col("event_type") == "view", "8-K").otherwise("10-K")
        even = F.col("k") % 2 == 0
        sinks.write_report(
            e.where("event_type IN ('view', 'click')").select(
                F.col("instrument").alias("symbol"),
                F.when(even, form).alias("form_type"),
                F.when(~even, form).alias("type"),
                F.when(even, day).alias("filing_date"),
                F.when(~even, day).alias("date"),
            ),
            f"{root}/sec_filings/year=2024",
        )
        sinks.write_report(
            e.where("event_type IN ('purchase', 'error')").select(
                F.col("instrument").alias("symbol"),
                F.when(F.col("event_type") == "purchase", "purchase").otherwise("sale").alias("transaction_type"),
                F.when(even, day).alias("transaction_date"),
                F.when(~even, day).alias("date"),
                "value",
            ),
            f"{root}/insider_trading",
        )
        sinks.write_report(
            e.where("event_type = 'signup'").select(
                F.col("instrument").alias("symbol"),
                F.when(even, "dividend").alias("action_type"),
                F.when(~even, "split").alias("type"),
                day.alias("effective_date"),
                F.concat(F.col("k").cast("string"), F.lit(":2")).alias("ratio"),
            ),
            f"{root}/corporate_actions",
        )

    return Lake(spark, _stored(spark, sf, "events", write))


_PX = ("open", "high", "low", "close")


def _px(digits=8):
    return ", ".join(r(c, c, digits) for c in _PX)


register(
    "market_data_scan",
    "SRC-1",
    lambda s, sf: rounded(
        _market(s, sf).get_market_data(["PROMO", "SMALL", "NOPE"], "daily", include_indicators=[]).withColumn("date", F.col("date").cast("date")),
        8,
    ),
    with_ctes([v.bars_sql()], f"SELECT instrument AS symbol, date, {_px()}, volume FROM bars WHERE instrument IN ('PROMO', 'SMALL', 'NOPE')"),
)
register(
    "economic_data_scan",
    "SRC-2 SEL-5",
    lambda s, sf: rounded(
        _economic(s, sf).get_economic_data(category="rates", importance="low", frequency="daily").select("symbol", F.col("date").cast("date").alias("date"), "value"), 4
    ),
    with_ctes([v.ECON_SQL], f"SELECT symbol, date, {r('value', 'value', 4)} FROM econ WHERE symbol < '3' AND NOT symbol < '2'"),
)
_NEWS = """
news AS (
  SELECT CAST(article_id AS VARCHAR) AS article_id, source, date, instrument, coalesce(sentiment, 0.0) AS sentiment_score,
         CASE WHEN coalesce(sentiment, 0) > 0.1 THEN 'positive' WHEN coalesce(sentiment, 0) < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
         CASE WHEN article_id % 3 = 0 THEN 'market' ELSE 'company' END AS category, length(text) AS n_content
  FROM articles)"""
register(
    "news_data_scan",
    "SRC-3",
    lambda s, sf: _news(s, sf)
    .get_news_data(["3", "x7"], fl.DateRange("2024-01-05", "2024-01-20"))
    .select("article_id", "source", F.col("published_at").cast("date").alias("date"), F.length("content").cast("long").alias("n_content")),
    with_ctes(
        [v.ARTICLES_SQL, _NEWS],
        "SELECT article_id, source, date, n_content FROM news WHERE instrument IN ('3', '7') AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
    ),
)
register(
    "trends_data_scan",
    "SRC-4 FN-6",
    lambda s, sf: _trends(s, sf).get_trends_data().select("keyword", "date", "search_score", "geo"),
    with_ctes(
        [v.TRENDS_SQL],
        """SELECT keyword, strftime(date, '%Y-%m-%d') AS date, search_score,
        CASE WHEN keyword <> 'view' THEN CASE WHEN keyword < 'f' THEN 'US' ELSE 'DE' END END AS geo FROM trends""",
    ),
)
register(
    "earnings_calendar_scan",
    "SRC-5",
    lambda s, sf: rounded(
        _events(s, sf)
        .get_earnings_data(date_range=fl.DateRange("2024-01-03T00:00:00Z", "2024-01-15"), source="finnhub")
        .select("symbol", "event_date", "quarter", "eps_estimate")
    ),
    with_ctes(
        [v.EVENT_DAYS_SQL],
        f"""SELECT instrument AS symbol, date AS event_date, k % 4 + 1 AS quarter, {r('value', 'eps_estimate')} FROM ev
        WHERE event_type = 'signup' AND k < 50 AND date BETWEEN DATE '2024-01-03' AND DATE '2024-01-15'""",
    ),
)
register(
    "filings_scan",
    "SRC-6",
    lambda s, sf: _events(s, sf)
    .get_sec_filings(filing_types=["8-K"], date_range=fl.DateRange("2024-01-10"))
    .select("symbol", "form_type", "event_date"),
    with_ctes(
        [v.EVENT_DAYS_SQL],
        "SELECT instrument AS symbol, '8-K' AS form_type, date AS event_date FROM ev WHERE event_type = 'view' AND date >= DATE '2024-01-10'",
    ),
)
register(
    "insider_trades_scan",
    "SRC-7",
    lambda s, sf: rounded(
        _events(s, sf).get_insider_trading(transaction_types=["sale"], date_range=fl.DateRange("2024-01-01", "2024-01-20"))
        .select("symbol", "event_date", "value")
    ),
    with_ctes(
        [v.EVENT_DAYS_SQL],
        f"SELECT instrument AS symbol, date AS event_date, {r('value', 'value')} FROM ev WHERE event_type = 'error' AND date <= DATE '2024-01-20'",
    ),
)
register(
    "corporate_actions_scan",
    "SRC-8",
    lambda s, sf: _events(s, sf).get_corporate_actions(action_types=["split"]).select("symbol", "action_type", "event_date", "ratio"),
    with_ctes(
        [v.EVENT_DAYS_SQL],
        "SELECT instrument AS symbol, 'split' AS action_type, date AS event_date, k || ':2' AS ratio FROM ev WHERE event_type = 'signup' AND k % 2 <> 0",
    ),
)


@query(
    "multi_source_query",
    "SRC-9 UDF-4 SET-1 TOP-1 TOP-2",
    with_ctes(
        [v.bars_sql(), v.ECON_SQL],
        f"""SELECT symbol, date, {r('close', 'close', 8)}, {r('value', 'value', 2)} FROM (
          SELECT instrument AS symbol, date, close, CAST(NULL AS DOUBLE) AS value FROM bars WHERE volume >= 100
          UNION ALL SELECT symbol, date, NULL, value FROM econ)
        WHERE date >= DATE '1998-01-01' AND date <= DATE '2000-06-30' AND symbol <> 'LARGE'
        ORDER BY date DESC, symbol LIMIT 200 OFFSET 10""",
    ),
)
def _multi(s, sf):
    """Two stored data types in one query: union, filter, sort, offset, limit."""
    market = fl.DataTypeFilter("market_data", "daily", min_volume=100, include_indicators=())
    q = fl.QueryFilter(
        date_range=fl.DateRange("1998-01-01", "2000-06-30"),
        instruments=fl.InstrumentFilter(exclude_symbols=["LARGE"]),
        data_types=(market, fl.DataTypeFilter("economic_data")),
        sort_by="date",
        sort_order="desc",
        limit=200,
        offset=10,
    )
    page = _both(s, sf).query(q)
    return rounded(page.select("symbol", F.col("date").cast("date").alias("date"), "close", F.round("value", 2).alias("value")), 8)


@query(
    "corrupt_records_skipped",
    "SRC-10 FN-8",
    with_ctes(
        [v.EVENT_DAYS_SQL],
        "SELECT instrument AS symbol, date AS event_date, count(*) AS n FROM ev WHERE event_type = 'signup' AND value >= 5 GROUP BY 1, 2",
    ),
)
def _corrupt(s, sf):
    """Records of small events are cut off in the middle; the reader keeps the rest."""

    def write(root):
        e = v.event_days(s, sf).where("event_type = 'signup'")
        rec = F.to_json(
            F.struct(F.col("instrument").alias("symbol"), F.date_format("date", "yyyy-MM-dd").alias("date"))
        )
        broken = F.when(F.col("value") < 5, F.substring(rec, 1, 15)).otherwise(rec)
        e.select(broken.alias("value")).write.text(f"{root}/earnings_data")

    lake = Lake(s, _stored(s, sf, "corrupt", write))
    return lake.get_earnings_data().groupBy("symbol", "event_date").agg(F.count(F.lit(1)).alias("n"))


@query(
    "skipped_files",
    "SRC-10",
    with_ctes(
        [v.EVENT_DAYS_SQL, v.ECON_SQL],
        """SELECT 'economic_data' AS folder, 'no rows' AS reason, 1::BIGINT AS n_files, 0::BIGINT AS n_records, 0::BIGINT AS n_broken
        UNION ALL SELECT 'earnings_data', 'no record parses', 1, count(*), count(*) FROM ev WHERE event_type = 'click'
        UNION ALL SELECT 'earnings_data', 'broken records', 1, count(*), count(*) FILTER (WHERE value < 5) FROM ev WHERE event_type = 'signup'""",
    ),
)
def _skipped(s, sf):
    """A parquet folder with one file that is no parquet; JSON files with some and with only broken records. Good files are not listed."""

    def write(root):
        _write_economic(s, sf, root)
        text = v.event_days(s, sf).select("event_type", "value", F.concat(F.lit('{"symbol": "'), "instrument").alias("cut"))
        one = text.where("event_type = 'click'").select(F.col("cut").alias("value")).coalesce(1)
        one.write.text(f"{root}/economic_data/symbol=broken")
        one.write.text(f"{root}/earnings_data/click")
        for kind, most in (("signup", 5), ("purchase", 0)):
            record = F.when(F.col("value") < most, F.col("cut")).otherwise(F.concat("cut", F.lit('"}')))
            text.where(F.col("event_type") == kind).select(record.alias("value")).coalesce(1).write.text(f"{root}/earnings_data/{kind}")

    lake = Lake(s, _stored(s, sf, "skipped", write))
    out = lake.skipped_parquet("economic_data", sc.ECONOMIC).withColumn("folder", F.lit("economic_data"))
    out = out.unionByName(lake.skipped_json("earnings_data", sc.EARNINGS).withColumn("folder", F.lit("earnings_data")))
    sums = [F.sum(c).alias(c) for c in ("n_records", "n_broken")]
    return out.groupBy("folder", "reason").agg(F.count(F.lit(1)).alias("n_files"), *sums)


register(
    "available_symbols",
    "SRC-11",
    lambda s, sf: _market(s, sf).list_available_symbols("market_data", "daily"),
    "SELECT DISTINCT p_type AS symbol FROM lineitem JOIN part ON l_partkey = p_partkey",
)
register(
    "lake_inventory",
    "SRC-12",
    lambda s, sf: _market(s, sf).inventory(),
    """SELECT 'daily' AS interval, count(DISTINCT p_type) AS symbols FROM lineitem JOIN part ON l_partkey = p_partkey
    UNION ALL SELECT 'hourly', count(DISTINCT event_type) FROM events""",
)
register("storage_usage", "AGG-29", lambda s, sf: _market(s, sf).storage_usage())


@query(
    "catalog_load",
    "SRC-13",
    with_ctes([v.CATALOG_SQL], "SELECT symbol, name, sector, market_cap_category, exchange, status FROM catalog"),
)
def _catalog(s, sf):
    root = _stored(s, sf, "catalog", lambda p: sinks.write_report(v.catalog(s, sf), f"{p}/catalog/base"))
    return Lake(s, root).catalog("base").select("symbol", "name", "sector", "market_cap_category", "exchange", "status")


@query(
    "parquet_sink",
    "SNK-1",
    with_ctes(
        [v.bars_sql()],
        "SELECT 'run-1' AS run_id, count(*) AS n_rows, 3 AS n_columns, 'date,instrument,log_ret' AS columns FROM bars",
    ),
)
def _sink(s, sf):
    from tickloom.operators.technical import fallback_return

    out = fallback_return(v.bars(s, sf)).select("instrument", "date", "log_ret")
    return sinks.write_result(out, scratch(s, "result"), "run-1")


@query(
    "json_report_sink",
    "SNK-2",
    with_ctes(
        v.dirty_bars_sql(),
        " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) AS n FROM bars WHERE {e}" for n, e in h.OHLC_RULES.items()),
    ),
)
def _report(s, sf):
    path = scratch(s, "report")
    sinks.write_report(h.ohlc_violations(v.dirty_bars(s, sf)), path)
    return s.read.schema("rule string, n long").json(path)


@query(
    "news_upsert",
    "SNK-3 JOIN-15",
    with_ctes(
        [v.ARTICLES_SQL],
        "SELECT article_id, date, source FROM articles WHERE date >= DATE '2024-01-30' - 20",
    ),
)
def _upsert(s, sf):
    """Stored: the labelled articles. Incoming: every article, twice."""
    a = v.articles(s, sf)
    cols = ["article_id", "date", "source"]
    stored, incoming = a.where("sentiment IS NOT NULL").select(*cols), a.select(*cols)
    return sinks.upsert_news(stored, incoming.unionByName(incoming), F.lit("2024-01-30").cast("date"), 20)


@query(
    "news_store_upsert",
    "SNK-3 JOIN-15",
    with_ctes(
        [v.ARTICLES_SQL],
        "SELECT article_id, date, source FROM articles WHERE date >= DATE '2024-01-30' - 20",
    ),
)
def _store_upsert(s, sf):
    """A store of the labelled articles takes every article, twice, ten days later; its first days go."""
    a = v.articles(s, sf)
    cols = ["article_id", "date", "source"]
    path = scratch(s, "news-store")
    sinks.upsert_news_store(a.where("sentiment IS NOT NULL").select(*cols), path, Date(2024, 1, 20), 20)
    every = a.select(*cols)
    return sinks.upsert_news_store(every.unionByName(every), path, Date(2024, 1, 30), 20)


# ---- predicates ------------------------------------------------------------------------------

register(
    "date_range_filter",
    "SEL-1",
    lambda s, sf: v.table(s, sf, "events")
    .where(fl.DateRange("2024-01-05T06:30:00Z", "2024-01-09").predicate(F.col("ts")))
    .select("event_id"),
    "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-05 06:30:00' AND ts < TIMESTAMP '2024-01-10 00:00:00'",
)
register(
    "instrument_filter",
    "SEL-2",
    lambda s, sf: v.bars(s, sf, "brand")
    .where(fl.InstrumentFilter(symbol_pattern="Brand#1", exclude_symbols=["Brand#13"]).predicate(F.col("instrument")))
    .groupBy("instrument")
    .agg(F.count(F.lit(1)).alias("n")),
    with_ctes(
        [v.bars_sql("brand")],
        "SELECT instrument, count(*) AS n FROM bars WHERE instrument LIKE 'Brand#1%' AND instrument <> 'Brand#13' GROUP BY 1",
    ),
)
register(
    "market_predicates",
    "SEL-3",
    lambda s, sf: fl.market_predicates(
        v.bars(s, sf), fl.DataTypeFilter("market_data", "daily", min_volume=150, price_range=(500.0, 2500.0))
    ).select("instrument", "date", "volume"),
    with_ctes([v.bars_sql()], "SELECT instrument, date, volume FROM bars WHERE volume >= 150 AND close BETWEEN 500 AND 2500"),
)
register(
    "indicator_projection",
    "SEL-4",
    lambda s, sf: rounded(
        _market(s, sf)
        .get_market_data(None, "daily", include_indicators=["sma_20", "vwap"], exclude_indicators=["vwap"])
        .drop(*_PX, "volume")
        .withColumn("date", F.col("date").cast("date")),
        8,
    ),
    with_ctes([v.bars_sql()], f"SELECT instrument AS symbol, date, {r('close * 2', 'sma_20', 8)} FROM bars"),
)
register(
    "news_predicates",
    "SEL-6",
    lambda s, sf: _news(s, sf)
    .get_news_data(
        sentiment_label="positive", sources=["src1", "src2", "src3"], sentiment_score_range=(0.5, 1.0), news_category="company"
    )
    .select("article_id", "source"),
    with_ctes(
        [v.ARTICLES_SQL, _NEWS],
        """SELECT article_id, source FROM news WHERE sentiment_label = 'positive' AND source IN ('src1', 'src2', 'src3')
        AND sentiment_score BETWEEN 0.5 AND 1 AND category = 'company'""",
    ),
)
register(
    "trends_predicates",
    "SEL-7",
    lambda s, sf: _trends(s, sf).get_trends_data(geo="DE", category=7, min_search_interest=80).select("keyword", "date", "search_score"),
    with_ctes(
        [v.TRENDS_SQL],
        """SELECT keyword, strftime(date, '%Y-%m-%d') AS date, search_score FROM trends
        WHERE keyword <> 'view' AND NOT keyword < 'f' AND search_score >= 80""",
    ),
)
