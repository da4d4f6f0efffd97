"""Queries for the catalog, sets, top-k, earnings, trends and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import catalog as c
from tickloom.operators import select as sel
from tickloom.plans import lake_queries as lq
from tickloom.plans import views as v
from tickloom.plans.registry import query, r, register, rounded, with_ctes

_CAT = [v.CATALOG_SQL]
AS_OF = "2024-01-10"


def _base(s, sf):
    return v.catalog(s, sf).where("balance >= 1000")


def _favorites(s, sf):
    return v.catalog(s, sf).where("exchange IN ('ASIA', 'EUROPE')")


def _popular(s, sf):
    return v.catalog(s, sf).where("market_cap_category IN ('small_cap', 'mega_cap')")


_LISTS = [
    v.CATALOG_SQL,
    "base AS (SELECT symbol FROM catalog WHERE balance >= 1000)",
    "fav AS (SELECT symbol FROM catalog WHERE exchange IN ('ASIA', 'EUROPE'))",
    "pop AS (SELECT symbol FROM catalog WHERE market_cap_category IN ('small_cap', 'mega_cap'))",
]

register(
    "catalog_filter",
    "SEL-14",
    lambda s, sf: c.select_symbols(v.catalog(s, sf), "active", None, "large_cap", "ASIA", 5),
    with_ctes(
        _CAT,
        "SELECT symbol FROM catalog WHERE status = 'active' AND market_cap_category = 'large_cap' AND exchange = 'ASIA' ORDER BY symbol LIMIT 5",
    ),
)
register(
    "fund_symbols",
    "SEL-14",
    lambda s, sf: c.fund_symbols(v.catalog(s, sf)),
    with_ctes(_CAT, "SELECT symbol FROM catalog WHERE market_cap_category = 'etf'"),
)


def _indicator_catalog(s, sf):
    return lq._economic(s, sf).get_economic_data()


register(
    "indicator_selection",
    "SEL-15",
    lambda s, sf: c.indicators_by_criteria(_indicator_catalog(s, sf), ["rates"], "high"),
    "SELECT DISTINCT o_orderpriority AS symbol FROM orders WHERE o_orderpriority < '2'",
)
register(
    "instrument_metadata",
    "SEL-24",
    lambda s, sf: c.instrument_metadata(v.catalog(s, sf), "7").select("symbol", "name", "sector", "exchange", "status"),
    with_ctes(_CAT, "SELECT symbol, name, sector, exchange, status FROM catalog WHERE symbol = '7'"),
)
register(
    "sector_list",
    "SEL-24",
    lambda s, sf: c.sector_list(v.catalog(s, sf)),
    with_ctes(_CAT, "SELECT DISTINCT sector FROM catalog"),
)
register(
    "valid_symbols",
    "SEL-23",
    lambda s, sf: v.table(s, sf, "customer")
    .select(F.concat_ws("", "c_mktsegment", F.element_at(F.array(*[F.lit(x) for x in (".", "-", "#", " ", "")]), (F.col("c_custkey") % 5 + 1).cast("int")), F.col("c_custkey").cast("string")).alias("symbol"))
    .where(sel.valid_symbol(F.col("symbol"))),
    """SELECT symbol FROM (SELECT c_mktsegment || ['.', '-', '#', ' ', ''][CAST(c_custkey % 5 + 1 AS INTEGER)] || c_custkey AS symbol FROM customer)
    WHERE regexp_full_match(regexp_replace(symbol, '[.-]', '', 'g'), '[A-Za-z0-9]+')""",
)
register(
    "catalog_statistics",
    "AGG-37",
    lambda s, sf: c.catalog_statistics(v.catalog(s, sf)),
    with_ctes(
        _CAT,
        " UNION ALL ".join(
            f"SELECT '{d}' AS dimension, {d} AS value, count(*) AS n FROM catalog GROUP BY {d}"
            for d in ("status", "market_cap_category", "sector", "exchange")
        )
        + " UNION ALL SELECT 'total', 'all', count(*) FROM catalog",
    ),
)
register(
    "catalog_classes",
    "AGG-41",
    lambda s, sf: c.catalog_classes(
        v.catalog(s, sf).withColumn("country", F.when(F.col("exchange") == "EUROPE", F.col("sector")))
    ),
    with_ctes(
        _CAT,
        """SELECT CASE WHEN status = 'delisted' THEN 'delisted' WHEN market_cap_category = 'etf' THEN 'etf' WHEN exchange = 'EUROPE' THEN 'adr'
        WHEN market_cap_category = 'mega_cap' THEN 'mega_cap' ELSE 'large_cap' END AS class, count(*) AS n FROM catalog GROUP BY 1""",
    ),
)
register(
    "list_coverage",
    "AGG-38",
    lambda s, sf: rounded(c.list_coverage({"favorites": _favorites(s, sf), "popular": _popular(s, sf)}, _base(s, sf))),
    with_ctes(
        _LISTS,
        " UNION ALL ".join(
            f"""SELECT '{n}' AS list_name, count(*) AS total, count(*) FILTER (symbol IN (SELECT symbol FROM base)) AS covered,
            {r('count(*) FILTER (symbol IN (SELECT symbol FROM base)) * 100.0 / count(*)', 'coverage_percentage')} FROM {t}"""
            for n, t in (("favorites", "fav"), ("popular", "pop"))
        ),
    ),
)
register(
    "missing_symbols",
    "JOIN-15",
    lambda s, sf: c.missing_symbols(_favorites(s, sf), _base(s, sf)),
    with_ctes(_LISTS, "SELECT symbol FROM fav WHERE symbol NOT IN (SELECT symbol FROM base)"),
)
register(
    "union_distinct_symbols",
    "SET-2",
    lambda s, sf: _favorites(s, sf).select("symbol").union(_popular(s, sf).select("symbol")).distinct(),
    with_ctes(_LISTS, "SELECT symbol FROM fav UNION SELECT symbol FROM pop"),
)
register(
    "union_all_rows",
    "SET-1",
    lambda s, sf: v.bars(s, sf)
    .select(F.col("instrument").alias("symbol"), "date", "volume")
    .unionByName(v.econ(s, sf).select("symbol", "date"), allowMissingColumns=True),
    with_ctes([v.bars_sql(), v.ECON_SQL], "SELECT instrument AS symbol, date, volume FROM bars UNION ALL SELECT symbol, date, NULL FROM econ"),
)
register(
    "except_symbols",
    "SET-3",
    lambda s, sf: _base(s, sf).select("symbol").subtract(_favorites(s, sf).select("symbol")).subtract(_popular(s, sf).select("symbol")),
    with_ctes(_LISTS, "SELECT symbol FROM base EXCEPT SELECT symbol FROM fav EXCEPT SELECT symbol FROM pop"),
)
register(
    "missing_in_both",
    "SET-4",
    lambda s, sf: c.missing_symbols(_favorites(s, sf), _base(s, sf)).intersect(c.missing_symbols(_popular(s, sf), _base(s, sf))),
    with_ctes(_LISTS, "(SELECT symbol FROM fav EXCEPT SELECT symbol FROM base) INTERSECT (SELECT symbol FROM pop EXCEPT SELECT symbol FROM base)"),
)
register(
    "common_dates",
    "SET-5",
    lambda s, sf: v.bars(s, sf).select("date").distinct().join(v.econ(s, sf).select("date").distinct(), "date"),
    with_ctes([v.bars_sql(), v.ECON_SQL], "SELECT date FROM bars INTERSECT SELECT date FROM econ"),
)

# ---- sorts and top-k --------------------------------------------------------------------

register(
    "sorted_page",
    "TOP-1 TOP-2",
    lambda s, sf: lq.fl.sort_page(
        v.bars(s, sf).select(F.col("instrument").alias("symbol"), "date", "volume"),
        lq.fl.QueryFilter(sort_by="volume", sort_order="desc", limit=50, offset=5),
    ),
    with_ctes([v.bars_sql()], "SELECT instrument AS symbol, date, volume FROM bars ORDER BY volume DESC, instrument, date LIMIT 50 OFFSET 5"),
)


@query("panel_order", "TOP-3", with_ctes([v.bars_sql()], "SELECT instrument, date, volume FROM bars"))
def _panel(s, sf):
    """Panel order as written: hash by instrument and year, sorted inside a partition."""
    return (
        v.bars(s, sf)
        .select("instrument", "date", "volume")
        .repartition("instrument", F.year("date"))
        .sortWithinPartitions("instrument", "date")
    )


register(
    "latest_rows",
    "TOP-7",
    lambda s, sf: rounded(sel.latest_rows(v.bars(s, sf, "supplier"), 5).select("instrument", "date", "close"), 8),
    with_ctes(
        [v.bars_sql("supplier")],
        f"SELECT instrument, date, {r('close', 'close', 8)} FROM bars QUALIFY row_number() OVER (PARTITION BY instrument ORDER BY date DESC) <= 5",
    ),
)
register(
    "most_liquid_instrument",
    "AGG-3",
    lambda s, sf: rounded(sel.most_liquid(v.bars(s, sf, "brand"))),
    with_ctes(
        [v.bars_sql("brand")],
        f"SELECT instrument, {r('avg(volume)', 'mean_volume')} FROM bars GROUP BY 1 ORDER BY avg(volume) DESC, instrument LIMIT 1",
    ),
)
register(
    "first_article_wins",
    "TOP-9",
    lambda s, sf: sel.first_per_key(
        v.articles(s, sf).select(F.md5("text").alias("text_key"), "date", "article_id", "source"), ["text_key"], ["date", "article_id"]
    ),
    with_ctes(
        [v.ARTICLES_SQL],
        """SELECT md5(text) AS text_key, date, article_id, source FROM articles
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY date, article_id) = 1""",
    ),
)
register(
    "date_thinning",
    "SEL-17",
    lambda s, sf: sel.thin_dates(v.bars(s, sf, "brand"), "close", 0.7).select("instrument", "date"),
    with_ctes(
        [v.bars_sql("brand")],
        """SELECT instrument, date FROM bars WHERE date IN (SELECT date FROM bars GROUP BY 1
        HAVING count(close) >= 0.7 * (SELECT count(DISTINCT instrument) FROM bars))""",
    ),
)
register(
    "date_thinning_by_count",
    "SEL-17",
    lambda s, sf: sel.thin_dates_by_count(v.bars(s, sf, "brand"), "close", 12).select("instrument", "date"),
    with_ctes(
        [v.bars_sql("brand")],
        "SELECT instrument, date FROM bars WHERE date IN (SELECT date FROM bars GROUP BY 1 HAVING count(close) >= 12)",
    ),
)
register(
    "column_fill_shares",
    "SEL-18",
    lambda s, sf: rounded(sel.column_fill_shares(v.dirty_bars(s, sf, "supplier"), ["close", "volume", "open"])),
    with_ctes(
        v.dirty_bars_sql("supplier"),
        " UNION ALL ".join(f"SELECT '{x}' AS feature, {r(f'count({x}) / count(*)', 'non_null_share')} FROM bars" for x in ("close", "volume", "open")),
    ),
)
register(
    "sparse_column_thinning",
    "SEL-18",
    lambda s, sf: rounded(
        sel.thin_columns(
            v.bars(s, sf).withColumn("rare", F.when(F.col("volume") % 5 == 0, F.col("open"))).select("instrument", "date", "close", "rare"),
            ["close", "rare"],
        ),
        8,
    ),
    with_ctes([v.bars_sql()], f"SELECT instrument, date, {r('close', 'close', 8)} FROM bars"),
)


@query(
    "feature_columns",
    "SEL-16",
    with_ctes([v.bars_sql()], f"SELECT instrument, date, {r('ln(high / low)', 'spread_hl', 8)}, 1 AS pulse FROM bars"),
)
def _features(s, sf):
    b = v.bars(s, sf).withColumns(
        {
            "spread_hl": F.log(F.col("high") / F.col("low")),
            "pulse": F.lit(1),
            "target_x": F.lit(2.0),
            "pred_x": F.lit(2.0),
            "true_beta": F.lit(1.0),
        }
    )
    return rounded(b.select("instrument", "date", *sel.feature_columns(b)), 8)


# ---- earnings ------------------------------------------------------------------------------


def _calendar(s, sf):
    e = v.event_days(s, sf).where("event_type = 'signup'")
    return e.select(
        F.col("instrument").alias("symbol"),
        "date",
        F.when(F.col("k") % 3 == 0, "amc").when(F.col("k") % 3 == 1, "bmo").alias("hour"),
        F.col("value").alias("epsEstimate"),
        (F.col("value") * (F.col("k") + 50) / 100).alias("epsActual"),
        F.when(F.col("k") < 50, "finnhub").otherwise("polygon").alias("source"),
    )


_CAL = """
cal AS (SELECT instrument AS symbol, date, CASE k % 3 WHEN 0 THEN 'amc' WHEN 1 THEN 'bmo' END AS hour, value AS est,
  value * (k + 50) / 100 AS act, CASE WHEN k < 50 THEN 'finnhub' ELSE 'polygon' END AS source, k FROM ev WHERE event_type = 'signup')"""
_E = [v.EVENT_DAYS_SQL, _CAL]


def _surprises(s, sf):
    return c.earnings_surprise(
        _calendar(s, sf).select("symbol", "date", F.col("epsActual").alias("actual"), F.when(F.col("epsEstimate") > 5, F.col("epsEstimate")).otherwise(0.0).alias("estimate"))
    )


_SUR = """
sur AS (SELECT symbol, date, act - e AS surprise, CASE WHEN e <> 0 THEN (act - e) / abs(e) * 100 ELSE 0 END AS surprise_percent
  FROM (SELECT *, CASE WHEN est > 5 THEN est ELSE 0 END AS e FROM cal))"""
register(
    "upcoming_earnings",
    "SEL-22",
    lambda s, sf: rounded(c.upcoming_earnings(_calendar(s, sf), AS_OF, 14)),
    with_ctes(
        _E,
        f"""SELECT symbol, date, coalesce(hour, 'Unknown') AS hour, {r('est', 'eps_estimate')}, {r('act', 'eps_actual')} FROM cal
        WHERE date BETWEEN DATE '{AS_OF}' AND DATE '{AS_OF}' + 14""",
    ),
)
register(
    "earnings_surprise",
    "AGG-33",
    lambda s, sf: rounded(_surprises(s, sf).select("symbol", "date", "surprise", "surprise_percent"), 5),
    with_ctes([*_E, _SUR], f"SELECT symbol, date, {r('surprise', 'surprise', 5)}, {r('surprise_percent', 'surprise_percent', 5)} FROM sur"),
)
register(
    "earnings_beat_rate",
    "AGG-34",
    lambda s, sf: rounded(c.beat_rates(_surprises(s, sf))),
    with_ctes(
        [*_E, _SUR],
        f"""SELECT symbol, count(*) AS total_quarters, count(*) FILTER (surprise > 0) AS positive_surprises,
        {r('count(*) FILTER (surprise > 0) / count(*)', 'surprise_rate')} FROM sur GROUP BY 1""",
    ),
)
register(
    "earnings_coverage",
    "AGG-27",
    lambda s, sf: rounded(c.earnings_coverage(_calendar(s, sf), v.catalog(s, sf))),
    with_ctes(
        [*_E, v.CATALOG_SQL],
        f"""SELECT count(*) FILTER (symbol IN (SELECT symbol FROM cal)) AS available, count(*) AS total,
        (SELECT count(DISTINCT source) FROM cal) AS sources,
        {r('count(*) FILTER (symbol IN (SELECT symbol FROM cal)) * 100.0 / count(*)', 'coverage_percentage')} FROM catalog""",
    ),
)
register(
    "earnings_months",
    "AGG-27",
    lambda s, sf: c.earnings_months(_calendar(s, sf)),
    with_ctes(_E, "SELECT strftime(date, '%Y-%m') AS month, count(*) AS n FROM cal GROUP BY 1"),
)


def _documents(s, sf):
    cal = _calendar(s, sf)
    est = cal.where("hour = 'amc'").groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    his = cal.where("source = 'finnhub'").groupBy("symbol").agg(F.max("date").alias("last"))
    sur = _surprises(s, sf).where("surprise > 40").groupBy("symbol").agg(F.max("surprise").alias("best"))
    return c.earnings_documents(est, his, sur)


_DOC = [
    *_E,
    _SUR,
    """docs AS (SELECT symbol, e.n, h.last, s.best FROM (SELECT symbol, count(*) AS n FROM cal WHERE hour = 'amc' GROUP BY 1) e
      FULL JOIN (SELECT symbol, max(date) AS last FROM cal WHERE source = 'finnhub' GROUP BY 1) h USING (symbol)
      FULL JOIN (SELECT symbol, max(surprise) AS best FROM sur WHERE surprise > 40 GROUP BY 1) s USING (symbol))""",
]
register(
    "earnings_documents",
    "JOIN-18",
    lambda s, sf: rounded(
        _documents(s, sf).select(
            "symbol", F.col("estimates.n").alias("n"), F.col("history.last").alias("last"), F.col("surprises.best").alias("best")
        )
    ),
    with_ctes(_DOC, f"SELECT symbol, n, last, {r('best', 'best')} FROM docs"),
)
register(
    "document_counters",
    "AGG-43",
    lambda s, sf: c.document_counters(_documents(s, sf)),
    with_ctes(
        _DOC,
        "SELECT count(*) AS symbols_processed, count(n) AS with_estimates, count(last) AS with_history, count(best) AS with_surprises FROM docs",
    ),
)

# ---- trends --------------------------------------------------------------------------------


def _points(s, sf):
    e = v.event_days(s, sf)
    daily = e.groupBy(
        (F.col("k") % 7).cast("string").alias("category"), F.col("event_type").alias("keyword"), "date"
    ).agg((F.count(F.lit(1)) - 1).cast("int").alias("search_score"))
    return daily


_PTS = """
pts AS (SELECT CAST(k % 7 AS VARCHAR) AS category, event_type AS keyword, date, count(*) - 1 AS search_score FROM ev GROUP BY 1, 2, 3)"""
register(
    "trend_summary",
    "AGG-35",
    lambda s, sf: rounded(c.trend_summary(_points(s, sf))),
    with_ctes(
        [v.EVENT_DAYS_SQL, _PTS],
        f"""SELECT category, count(DISTINCT keyword) AS keywords_count, count(*) AS total_data_points,
        {r('coalesce(avg(search_score) FILTER (search_score > 0), 0)', 'avg_search_score')} FROM pts GROUP BY 1""",
    ),
)
register(
    "category_distance",
    "AGG-36",
    lambda s, sf: rounded(c.category_distance(_points(s, sf))),
    with_ctes(
        [v.EVENT_DAYS_SQL, _PTS, "av AS (SELECT category, avg(search_score) AS a FROM pts GROUP BY 1)"],
        f"""SELECT x.category AS category_1, y.category AS category_2, {r('abs(x.a - y.a) / greatest(x.a, y.a, 1.0)', 'distance')}
        FROM av x, av y WHERE x.category <> y.category""",
    ),
)


def _trend_docs(s, sf):
    from tickloom.sources import schemas as sc

    return lq._trends(s, sf)._json("trends_data", sc.TRENDS)


register(
    "trends_coverage",
    "AGG-26",
    lambda s, sf: rounded(c.trends_coverage(_trend_docs(s, sf))),
    with_ctes(
        [v.TRENDS_SQL],
        f"""SELECT count(DISTINCT keyword) AS keywords, count(*) AS valid_points, {r('avg(search_score)', 'avg_score')}, max(search_score) AS max_score,
        min(search_score) AS min_score, CAST(0 AS BIGINT) AS missing_keyword, CAST(1 AS BIGINT) AS missing_geo, CAST(0 AS BIGINT) AS missing_timeframe,
        CAST(0 AS BIGINT) AS missing_interest, {r("count(DISTINCT keyword) FILTER (keyword > 'e') * 100.0 / count(DISTINCT keyword)", 'related_queries_percentage')} FROM trends""",
    ),
)
register(
    "dynamic_key_value",
    "FN-7",
    lambda s, sf: v.trends(s, sf)
    .select(
        "keyword",
        "date",
        F.to_json(F.create_map(F.lit("date"), F.col("date").cast("string"), "keyword", F.col("search_score").cast("string"))).alias("point"),
    )
    .select("keyword", "date", c.dynamic_value(F.col("point"), F.col("keyword")).alias("search_score")),
    with_ctes([v.TRENDS_SQL], "SELECT keyword, date, search_score FROM trends"),
)

# ---- lookups -------------------------------------------------------------------------------

_CODES = ("UNRATE", "DGS10", "CPIAUCSL", "GDP", "VIXCLS", "DCOILWTICO", "INDPRO", "DGS2", "XYZ", "PCEPI")
_CODE_SQL = "[" + ", ".join(f"'{x}'" for x in _CODES) + "]"


@query(
    "indicator_lookup",
    "FN-11",
    f"""SELECT c_custkey, code, CASE WHEN code IN ('UNRATE', 'PAYEMS', 'CIVPART') THEN 'employment' WHEN code IN ('FEDFUNDS', 'DGS10', 'DGS2', 'DFF') THEN 'interest_rates'
    WHEN code IN ('CPIAUCSL', 'CPILFESL', 'PCEPI') THEN 'inflation' WHEN code IN ('GDP', 'GDPC1') THEN 'growth' WHEN code IN ('VIXCLS', 'DEXUSEU', 'DTWEXBGS') THEN 'markets'
    WHEN code IN ('DCOILWTICO', 'GOLDAMGBD228NLBM') THEN 'commodities' WHEN code = 'INDPRO' THEN 'industrial' ELSE 'other' END AS category,
    CASE WHEN code IN ('UNRATE', 'GDP', 'FEDFUNDS', 'CPIAUCSL', 'PAYEMS', 'DGS10', 'VIXCLS') THEN 'high'
    WHEN code IN ('DEXUSEU', 'DCOILWTICO', 'INDPRO', 'DGS2') THEN 'medium' ELSE 'low' END AS importance
    FROM (SELECT c_custkey, {_CODE_SQL}[CAST(c_custkey % 10 + 1 AS INTEGER)] AS code FROM customer)""",
)
def _lookup(s, sf):
    code = F.element_at(F.array(*[F.lit(x) for x in _CODES]), (F.col("c_custkey") % 10 + 1).cast("int"))
    return v.table(s, sf, "customer").select("c_custkey", code.alias("code")).withColumns(
        {
            "category": sel.lookup(F.col("code"), sel.INDICATOR_CATEGORIES, "other"),
            "importance": sel.lookup(F.col("code"), sel.INDICATOR_IMPORTANCE, "low"),
        }
    )


_NAMES = ("Gold Fund", "Treasury Bond ETF", "S&P 500 ETF", "Russell 2000 Fund", "Russell 1000 ETF", "REIT ETF", "Chip ETF", "Acme Corp")
_SECTORS = ("Health Care", "Financials", "Industrials", "Communications", "Energy")


@query(
    "fund_and_sector_lookup",
    "FN-11",
    f"""SELECT c_custkey, CASE WHEN n NOT LIKE '%ETF%' AND n NOT LIKE '%Fund%' THEN NULL WHEN n LIKE '%Bond%' OR n LIKE '%Treasury%' THEN 'Bond ETF'
    WHEN n LIKE '%Gold%' OR n LIKE '%Silver%' OR n LIKE '%Commodity%' THEN 'Commodity ETF' WHEN n LIKE '%Real Estate%' OR n LIKE '%REIT%' THEN 'Real Estate ETF'
    WHEN n LIKE '%S&P 500%' THEN 'Large Cap Blend' WHEN n LIKE '%Russell%2000%' THEN 'Small Cap Blend' WHEN n LIKE '%Russell%' THEN 'Large Cap Blend' ELSE 'Sector ETF' END AS fund,
    CASE s WHEN 'Health Care' THEN 'Healthcare' WHEN 'Financials' THEN 'Financial Services' WHEN 'Industrials' THEN 'Industrial' WHEN 'Communications' THEN 'Communication Services' ELSE s END AS sector
    FROM (SELECT c_custkey, {list(_NAMES)!r}[CAST(c_custkey % 8 + 1 AS INTEGER)] AS n, {list(_SECTORS)!r}[CAST(c_custkey % 5 + 1 AS INTEGER)] AS s FROM customer)""",
)
def _funds(s, sf):
    name = F.element_at(F.array(*[F.lit(x) for x in _NAMES]), (F.col("c_custkey") % 8 + 1).cast("int"))
    sector = F.element_at(F.array(*[F.lit(x) for x in _SECTORS]), (F.col("c_custkey") % 5 + 1).cast("int"))
    return v.table(s, sf, "customer").select(
        "c_custkey", sel.fund_category(name).alias("fund"), sel.normal_sector(sector).alias("sector")
    )


register(
    "article_ids",
    "FN-10",
    lambda s, sf: v.articles(s, sf).select(
        "article_id",
        F.sha2(F.concat_ws("|", "source", F.date_format("date", "yyyy-MM-dd"), F.col("article_id").cast("string")), 256).alias("stable_id"),
    ),
    with_ctes([v.ARTICLES_SQL], "SELECT article_id, sha256(source || '|' || strftime(date, '%Y-%m-%d') || '|' || article_id) AS stable_id FROM articles"),
)
_FN = ("return_momentum_5d", "log_spread_3", "mean_reversion_9", "cross_rank", "basket_vol", "lead_corr", "other")
register(
    "feature_categories",
    "FN-14",
    lambda s, sf: v.table(s, sf, "customer")
    .select("c_custkey", F.element_at(F.array(*[F.lit(x) for x in _FN]), (F.col("c_custkey") % 7 + 1).cast("int")).alias("feature"))
    .withColumn("category", sel.feature_category(F.col("feature"))),
    f"""SELECT c_custkey, f AS feature, CASE WHEN f LIKE '%momentum%' THEN 'momentum' WHEN f LIKE '%spread%' THEN 'spread'
    WHEN f LIKE '%reversion%' OR f LIKE '%rank%' OR f LIKE '%deviation%' THEN 'mean_reversion' WHEN f LIKE '%basket%' THEN 'basket'
    WHEN f LIKE '%lead%' OR f LIKE '%lag%' THEN 'relationship' END AS category
    FROM (SELECT c_custkey, {list(_FN)!r}[CAST(c_custkey % 7 + 1 AS INTEGER)] AS f FROM customer)""",
)
