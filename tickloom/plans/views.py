"""Canonical market views over the given tables, for Spark and as SQL text."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- bars -------------------------------------------------------------------------

_SQL_INSTRUMENT = {
    "brand": ("p_brand", "lineitem JOIN part ON l_partkey = p_partkey"),
    "type": ("p_type", "lineitem JOIN part ON l_partkey = p_partkey"),
    "supplier": ("CAST(l_suppkey AS VARCHAR)", "lineitem"),
}
_FINE = "l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity"


def line_order() -> Column:
    """Order of raw lines (order, line, part, price in cents, quantity in hundredths) as one number of 38 digits.

    ``min_by`` over a struct has no fixed-width buffer and would sort every raw line; over a number it is hashed. The digits (12, 2, 11, 9
    and 4) hold every key, price and quantity up to scale factor 100,000; a value that does not fit stops the query instead of changing the order.
    """
    def held(name: str, digits: int, times: int = 1) -> Column:
        value = F.round(F.col(name) * times).cast("long") if times > 1 else F.col(name).cast("long")
        refuse = F.raise_error(F.concat(F.lit(f"{name} too large to order: "), F.col(name).cast("string")))
        return F.when(value.between(0, 10**digits - 1) | value.isNull(), value).otherwise(refuse)

    high = held("l_orderkey", 12) * 100 + held("l_linenumber", 2)
    low = held("l_extendedprice", 9, 100) * 10_000 + held("l_quantity", 4, 100)
    upper = high.cast("decimal(14,0)") * F.lit(Decimal(10**11)) + held("l_partkey", 11).cast("decimal(11,0)")
    return upper.cast("decimal(25,0)") * F.lit(Decimal(10**13)) + low.cast("decimal(13,0)")


def event_order(time: str = "ts", tie: str = "event_id") -> Column:
    """Order of events as one number: microseconds, then the id."""
    micros = F.unix_micros(F.col(time).cast("timestamp")).cast("decimal(19,0)")
    return micros * F.lit(Decimal(10**18)) + F.col(tie).cast("decimal(18,0)")


def bars(spark: SparkSession, sf: str, by: str = "type", freq: str = "day") -> DataFrame:
    """Daily or weekly bars; one map-side combined aggregation, no sort of raw lines."""
    lines = table(spark, sf, "lineitem")
    if by == "supplier":
        lines = lines.withColumn("instrument", F.col("l_suppkey").cast("string"))
    else:
        part = table(spark, sf, "part").select("p_partkey", F.col(f"p_{by}").alias("instrument"))
        lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    day = F.col("l_shipdate").cast("date")
    if freq == "week":
        day = F.date_trunc("week", day).cast("date")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return (
        lines.select("instrument", day.alias("date"), line_order().alias("o"), price.alias("p"), "l_quantity")
        .groupBy("instrument", "date")
        .agg(
            F.min_by("p", "o").alias("open"),
            F.max("p").alias("high"),
            F.min("p").alias("low"),
            F.max_by("p", "o").alias("close"),
            F.sum("l_quantity").cast("long").alias("volume"),
        )
        .withColumn("close_adj", F.col("close"))
    )


def bars_sql(by: str = "type", freq: str = "day", name: str = "bars") -> str:
    inst, src = _SQL_INSTRUMENT[by]
    day = "CAST(l_shipdate AS DATE)"
    if freq == "week":
        day = "CAST(date_trunc('week', l_shipdate) AS DATE)"
    return f"""
{name} AS (
  SELECT {inst} AS instrument, {day} AS date,
         first(l_extendedprice / l_quantity ORDER BY {_FINE}) AS open,
         max(l_extendedprice / l_quantity) AS high,
         min(l_extendedprice / l_quantity) AS low,
         last(l_extendedprice / l_quantity ORDER BY {_FINE}) AS close,
         CAST(sum(l_quantity) AS BIGINT) AS volume,
         last(l_extendedprice / l_quantity ORDER BY {_FINE}) AS close_adj
  FROM {src} GROUP BY 1, 2)"""


def dirty_bars(spark: SparkSession, sf: str, by: str = "type") -> DataFrame:
    """Bars with gaps and errors at fixed volumes, so that quality rules have work."""
    v = F.col("volume")
    b = bars(spark, sf, by)
    return b.select(
        "instrument",
        "date",
        F.when(v % 13 == 0, -F.col("open")).otherwise(F.col("open")).alias("open"),
        F.when(v % 11 == 0, F.col("low") - 1).otherwise(F.col("high")).alias("high"),
        F.when(v % 17 == 0, F.col("high") + 1).otherwise(F.col("low")).alias("low"),
        F.when(v % 19 != 0, F.col("close")).alias("close"),
        F.when(v % 23 == 0, -v).when(v % 7 != 0, v).alias("volume"),
        "close_adj",
    )


def dirty_bars_sql(by: str = "type") -> list[str]:
    return [
        bars_sql(by, name="clean"),
        """
bars AS (
  SELECT instrument, date,
         CASE WHEN volume % 13 = 0 THEN -open ELSE open END AS open,
         CASE WHEN volume % 11 = 0 THEN low - 1 ELSE high END AS high,
         CASE WHEN volume % 17 = 0 THEN high + 1 ELSE low END AS low,
         CASE WHEN volume % 19 <> 0 THEN close END AS close,
         CASE WHEN volume % 23 = 0 THEN -volume WHEN volume % 7 <> 0 THEN volume END AS volume,
         close_adj
  FROM clean)""",
    ]


# ---- events -----------------------------------------------------------------------


def event_days(spark: SparkSession, sf: str) -> DataFrame:
    """Corporate events: instrument, day, type and value."""
    return table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("instrument"),
        F.col("ts").cast("date").alias("date"),
        "event_type",
        "value",
        (F.get_json_object("props", "$.k").cast("int")).alias("k"),
    )


EVENT_DAYS_SQL = """
ev AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS instrument, CAST(ts AS DATE) AS date, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""


def event_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Daily bars of every user, priced by event value."""
    e = table(spark, sf, "events")
    order = event_order()
    return (
        e.groupBy(F.col("user_id").cast("string").alias("instrument"), F.col("ts").cast("date").alias("date"))
        .agg(
            F.min_by("value", order).alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", order).alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
    )


EVENT_BARS_SQL = """
ebars AS (
  SELECT CAST(user_id AS VARCHAR) AS instrument, CAST(ts AS DATE) AS date,
         first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
         last(value ORDER BY ts, event_id) AS close, count(*) AS volume
  FROM events GROUP BY 1, 2)"""


# ---- economic series, catalog, articles, trends -----------------------------------


def econ(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").cast("date").alias("date"))
        .agg(F.sum("o_totalprice").alias("value"))
    )


ECON_SQL = """
econ AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS value
  FROM orders GROUP BY 1, 2)"""


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    n = table(spark, sf, "nation")
    g = table(spark, sf, "region")
    bal = F.col("s_acctbal")
    return (
        s.join(n, s.s_nationkey == n.n_nationkey)
        .join(g, n.n_regionkey == g.r_regionkey)
        .select(
            F.col("s_suppkey").cast("string").alias("symbol"),
            F.col("s_name").alias("name"),
            F.col("n_name").alias("sector"),
            F.when(bal >= 8000, "mega_cap")
            .when(bal >= 5000, "large_cap")
            .when(bal >= 2000, "mid_cap")
            .when(bal >= 500, "etf")
            .otherwise("small_cap")
            .alias("market_cap_category"),
            F.col("r_name").alias("exchange"),
            F.when(bal < 0, "delisted").otherwise("active").alias("status"),
            bal.alias("balance"),
        )
    )


CATALOG_SQL = """
catalog AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS symbol, s_name AS name, n_name AS sector,
         CASE WHEN s_acctbal >= 8000 THEN 'mega_cap' WHEN s_acctbal >= 5000 THEN 'large_cap'
              WHEN s_acctbal >= 2000 THEN 'mid_cap' WHEN s_acctbal >= 500 THEN 'etf'
              ELSE 'small_cap' END AS market_cap_category,
         r_name AS exchange,
         CASE WHEN s_acctbal < 0 THEN 'delisted' ELSE 'active' END AS status,
         s_acctbal AS balance
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def articles(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    l = table(spark, sf, "labels")
    return d.join(l, "doc_id", "left").select(
        F.col("doc_id").alias("article_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("date"),
        (F.col("doc_id") % 20).cast("string").alias("instrument"),
        "source",
        "lang",
        "text",
        (F.col("quality") - F.col("toxic")).cast("double").alias("sentiment"),
        ((F.col("doc_id") % 24)).cast("int").alias("hour"),
    )


ARTICLES_SQL = """
articles AS (
  SELECT d.doc_id AS article_id, CAST(DATE '2024-01-01' + CAST(d.doc_id % 30 AS INTEGER) AS DATE) AS date,
         CAST(d.doc_id % 20 AS VARCHAR) AS instrument, source, lang, text,
         CAST(quality - toxic AS DOUBLE) AS sentiment, CAST(d.doc_id % 24 AS INTEGER) AS hour
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def trends(spark: SparkSession, sf: str) -> DataFrame:
    """Daily interest per keyword, scaled to 0-100 by the keyword's best day."""
    daily = (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("keyword"), F.col("ts").cast("date").alias("date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    top = daily.groupBy("keyword").agg(F.max("n").alias("top"))
    return daily.join(top, "keyword").select(
        "keyword", "date", F.floor(F.col("n") * 100 / F.col("top")).cast("int").alias("search_score")
    )


TRENDS_SQL = """
trends AS (
  SELECT keyword, date, CAST(floor(n * 100.0 / max(n) OVER (PARTITION BY keyword)) AS INTEGER) AS search_score
  FROM (SELECT event_type AS keyword, CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1, 2))"""
