"""Instrument catalog, earnings and search-trend reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.pairs import pair_join

# sectors that mark a fund: fixed values
FUND_SECTORS = ("ETF", "Commodity ETF", "Bond ETF")


def select_symbols(
    catalog: DataFrame,
    status: str | None = None,
    sector: str | None = None,
    market_cap_category: str | None = None,
    exchange: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    for name, want in (
        ("status", status),
        ("sector", sector),
        ("market_cap_category", market_cap_category),
        ("exchange", exchange),
    ):
        if want is not None:
            catalog = catalog.where(F.col(name) == want)
    out = catalog.select("symbol")
    return out.orderBy("symbol").limit(limit) if limit else out


def fund_symbols(catalog: DataFrame, limit: int | None = None) -> DataFrame:
    hit = (F.col("market_cap_category") == "etf") | F.col("sector").isin(*FUND_SECTORS)
    out = catalog.where(hit).select("symbol")
    return out.orderBy("symbol").limit(limit) if limit else out


def indicators_by_criteria(
    indicators: DataFrame, categories: Sequence[str] | None = None, importance: str | None = None
) -> DataFrame:
    if categories:
        indicators = indicators.where(F.col("category").isin(list(categories)))
    if importance:
        indicators = indicators.where(F.col("importance") == importance)
    return indicators.select("symbol").distinct()


def instrument_metadata(catalog: DataFrame, symbol: str) -> DataFrame:
    return catalog.where(F.col("symbol") == symbol)


def sector_list(catalog: DataFrame) -> DataFrame:
    return catalog.select("sector").distinct().orderBy("sector")


def catalog_statistics(catalog: DataFrame) -> DataFrame:
    """Counts by status, cap, sector, exchange and in total: one grouping-sets pass."""
    dims = ["status", "market_cap_category", "sector", "exchange"]
    grouped = catalog.groupingSets(
        [[F.col(d)] for d in dims] + [[]], *[F.col(d) for d in dims]
    ).agg(F.count(F.lit(1)).alias("n"), *[F.grouping(d).alias(f"_g_{d}") for d in dims])
    kind, value = F.lit("total"), F.lit("all")
    for d in dims:
        kind = F.when(F.col(f"_g_{d}") == 0, d).otherwise(kind)
        value = F.when(F.col(f"_g_{d}") == 0, F.col(d)).otherwise(value)
    return grouped.select(kind.alias("dimension"), value.alias("value"), "n")


def catalog_classes(catalog: DataFrame) -> DataFrame:
    """Class of each entry, first match wins, counted."""
    cls = (
        F.when(F.col("status") == "delisted", "delisted")
        .when(F.col("market_cap_category") == "etf", "etf")
        .when(F.col("country").isNotNull(), "adr")
        .when(F.col("market_cap_category") == "mega_cap", "mega_cap")
        .otherwise("large_cap")
    )
    return catalog.groupBy(cls.alias("class")).agg(F.count(F.lit(1)).alias("n"))


def missing_symbols(wanted: DataFrame, base: DataFrame) -> DataFrame:
    return wanted.select("symbol").distinct().join(base.select("symbol"), "symbol", "left_anti")


def list_coverage(lists: dict[str, DataFrame], base: DataFrame) -> DataFrame:
    """(list_name, total, covered, coverage_percentage) against the base list."""
    out = None
    marked = base.select("symbol").distinct().withColumn("_in", F.lit(1))
    for name, df in lists.items():
        row = (
            df.select("symbol")
            .distinct()
            .join(marked, "symbol", "left")
            .agg(F.count(F.lit(1)).alias("total"), F.count("_in").alias("covered"))
            .select(
                F.lit(name).alias("list_name"),
                "total",
                "covered",
                F.try_divide(F.col("covered") * 100.0, F.col("total")).alias("coverage_percentage"),
            )
        )
        out = row if out is None else out.unionByName(row)
    return out


# ---- earnings --------------------------------------------------------------------------


def upcoming_earnings(calendar: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Calendar rows of the next ``days`` days in snake case, hour "Unknown" when absent."""
    start = F.lit(as_of).cast("date")
    return calendar.where(F.col("date").between(start, F.date_add(start, days))).select(
        "symbol",
        "date",
        F.coalesce("hour", F.lit("Unknown")).alias("hour"),
        F.col("epsEstimate").alias("eps_estimate"),
        F.col("epsActual").alias("eps_actual"),
    )


def earnings_surprise(df: DataFrame) -> DataFrame:
    """Actual less estimate, and as percent of the absolute estimate (0 for estimate 0)."""
    diff = F.col("actual") - F.col("estimate")
    return df.withColumns(
        {
            "surprise": diff,
            "surprise_percent": F.when(
                F.col("estimate") != 0, F.try_divide(diff, F.abs("estimate")) * 100
            ).otherwise(0.0),
        }
    )


def beat_rates(surprises: DataFrame) -> DataFrame:
    return surprises.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("total_quarters"),
        F.count_if(F.col("surprise") > 0).alias("positive_surprises"),
        F.avg((F.coalesce(F.col("surprise") > 0, F.lit(False))).cast("double")).alias("surprise_rate"),
    )


def earnings_coverage(calendar: DataFrame, tracked: DataFrame) -> DataFrame:
    have = calendar.select("symbol").distinct().withColumn("_in", F.lit(1))
    sources = calendar.select("source").distinct().agg(F.count(F.lit(1)).alias("sources"))
    return (
        tracked.select("symbol")
        .distinct()
        .join(have, "symbol", "left")
        .agg(F.count("_in").alias("available"), F.count(F.lit(1)).alias("total"))
        .crossJoin(sources)
        .withColumn("coverage_percentage", F.try_divide(F.col("available") * 100.0, F.col("total")))
    )


def earnings_months(calendar: DataFrame) -> DataFrame:
    return calendar.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))


def earnings_documents(estimates: DataFrame, history: DataFrame, surprises: DataFrame) -> DataFrame:
    """One document per symbol from one-row-per-symbol parts; absent parts stay NULL."""
    parts = {"estimates": estimates, "history": history, "surprises": surprises}
    out = None
    for name, df in parts.items():
        part = df.select("symbol", F.struct(*[c for c in df.columns if c != "symbol"]).alias(name))
        out = part if out is None else out.join(part, "symbol", "full_outer")
    return out.where(" OR ".join(f"{p} IS NOT NULL" for p in parts))


def document_counters(docs: DataFrame) -> DataFrame:
    return docs.agg(
        F.count(F.lit(1)).alias("symbols_processed"),
        *[F.count(p).alias(f"with_{p}") for p in ("estimates", "history", "surprises")],
    )


# ---- search trends ---------------------------------------------------------------------


def trend_summary(points: DataFrame) -> DataFrame:
    """Per category: keywords, points, mean of the positive scores."""
    counts = points.groupBy("category", "keyword").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.when(F.col("search_score") > 0, F.col("search_score"))).alias("_s"),
        F.count_if(F.col("search_score") > 0).alias("_p"),
    )
    return counts.groupBy("category").agg(
        F.count(F.lit(1)).alias("keywords_count"),
        F.sum("_n").alias("total_data_points"),
        F.coalesce(F.try_divide(F.sum("_s"), F.sum("_p")), F.lit(0.0)).alias("avg_search_score"),
    )


def category_distance(points: DataFrame) -> DataFrame:
    """abs(avg1 - avg2) / max(avg1, avg2, 1) for every ordered pair of categories."""
    avgs = points.groupBy("category").agg(F.avg("search_score").alias("avg"))
    pairs = pair_join(avgs, "category", ["avg"])
    a, b = F.col("avg_i"), F.col("avg_j")
    dist = F.abs(a - b) / F.greatest(a, b, F.lit(1.0))
    both = F.array(
        F.struct(F.col("category_i").alias("category_1"), F.col("category_j").alias("category_2")),
        F.struct(F.col("category_j").alias("category_1"), F.col("category_i").alias("category_2")),
    )
    return pairs.select(F.inline(both), dist.alias("distance"))


def trends_coverage(docs: DataFrame) -> DataFrame:
    """One row over trend documents: keywords, valid score stats, missing fields, related share."""
    scores = F.expr("filter(search_interest, p -> p.search_score BETWEEN 0 AND 100).search_score")
    total = F.aggregate(F.col("_sc"), F.lit(0).cast("long"), lambda a, x: a + x)
    rows = docs.withColumn("_sc", scores)
    return rows.agg(
        F.countDistinct("keyword").alias("keywords"),
        F.sum(F.size("_sc")).cast("long").alias("valid_points"),
        F.try_divide(F.sum(total), F.sum(F.size("_sc"))).alias("avg_score"),
        F.max(F.array_max("_sc")).alias("max_score"),
        F.min(F.array_min("_sc")).alias("min_score"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in ("keyword", "geo", "timeframe")],
        F.count_if(F.coalesce(F.size("search_interest"), F.lit(0)) <= 0).alias("missing_interest"),
        (F.avg(F.col("related_queries").isNotNull().cast("double")) * 100).alias("related_queries_percentage"),
    )


def dynamic_value(points: Column, keyword: Column) -> Column:
    """Value stored under a key named like the keyword: JSON object text -> integer."""
    return F.element_at(F.from_json(points, "map<string,string>"), keyword).try_cast("int")
