"""Queries for profiles, coverage and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import corporate_events as ce
from tickloom.operators import hygiene as h
from tickloom.operators import quality as q
from tickloom.plans import hygiene_queries as hq
from tickloom.plans import views as v
from tickloom.plans.registry import query, r, register, rounded, with_ctes

_W = "PARTITION BY instrument ORDER BY date"
AS_OF = "2001-11-15"
_COLS = ("instrument", "date", "open", "high", "low", "close", "volume")


def _dirty(s, sf, by="supplier"):
    return v.dirty_bars(s, sf, by).select(*_COLS)


_TYPES = {
    "instrument": "string",
    "date": "date",
    "open": "double",
    "high": "double",
    "low": "double",
    "close": "double",
    "volume": "bigint",
    "flag": "int",
    "empty": "double",
}


def _profiled(s, sf):
    return _dirty(s, sf).withColumns({"flag": F.lit(1), "empty": F.when(F.col("volume") > 2000, F.col("open"))})


_PROF = "prof AS (SELECT instrument, date, open, high, low, close, volume, 1 AS flag, CASE WHEN volume > 2000 THEN open END AS empty FROM bars)"
_NUM = ("open", "high", "low", "close", "volume", "flag", "empty")

register(
    "column_profile",
    "AGG-10",
    lambda s, sf: rounded(q.column_profile(_profiled(s, sf))),
    with_ctes(
        [*v.dirty_bars_sql("supplier"), _PROF],
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, '{_TYPES[c]}' AS data_type, count(*) AS total_rows, count(*) - count({c}) AS null_count,
            {f'count(DISTINCT {c}) <= 1' if c in _NUM else 'false'} AS is_constant,
            {r(f'(count(*) - count({c})) * 100.0 / count(*)', 'null_percentage')},
            (count(*) - count({c})) * 2 > count(*) AS mostly_missing FROM prof"""
            for c in _TYPES
        ),
    ),
)


def _dups(s, sf):
    e = v.table(s, sf, "events").select("user_id", "event_type", F.col("ts").cast("date").alias("d"))
    return q.duplicate_rows(e)


register(
    "duplicate_rows",
    "AGG-10",
    _dups,
    """SELECT CAST(sum(c) AS BIGINT) AS total_rows, CAST(sum(c - 1) AS BIGINT) AS duplicate_rows
    FROM (SELECT count(*) AS c FROM events GROUP BY user_id, event_type, CAST(ts AS DATE))""",
)


def _over(c, tbl="bars"):
    return f"(SELECT count(*) FILTER (abs({c} - m) > 5 * s) FROM {tbl}, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM {tbl}) WHERE s > 0)"


register(
    "routing_quality_issues",
    "AGG-11",
    lambda s, sf: q.routing_issues(_profiled(s, sf)),
    with_ctes(
        [*v.dirty_bars_sql("supplier"), _PROF],
        " UNION ALL ".join(
            [f"SELECT '{c}' AS column_name, 'high missing data' AS issue FROM prof HAVING (count(*) - count({c})) * 2 > count(*)" for c in _TYPES]
            + [f"SELECT '{c}', 'constant column' FROM prof HAVING count(DISTINCT {c}) <= 1" for c in _NUM]
            + [f"SELECT '{c}', 'excessive outliers' FROM prof HAVING {_over(c, 'prof')} > count(*) * 0.01" for c in _NUM]
        ),
    ),
)
register(
    "outlier_shares",
    "AGG-11",
    lambda s, sf: rounded(q.outlier_shares(_dirty(s, sf))),
    with_ctes(
        v.dirty_bars_sql("supplier"),
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, {_over(c)} AS outliers, {r(f'{_over(c)} * 100.0 / count(*)', 'outlier_percentage')},
            {_over(c)} > count(*) * 0.01 AS excessive FROM bars"""
            for c in ("open", "high", "low", "close", "volume")
        ),
    ),
)


@query(
    "corporate_range_checks",
    "AGG-12",
    with_ctes(
        [
            v.EVENT_BARS_SQL,
            v.EVENT_DAYS_SQL,
            hq._EARN,
            hq._TRD,
            hq._ACT,
            """d AS (SELECT b.instrument, b.date, (SELECT CAST(min(e.date - b.date) AS INTEGER) FROM earn e WHERE e.instrument = b.instrument AND e.date >= b.date) * 30 AS dte,
            coalesce((SELECT sum(CASE WHEN lower(tt) IN ('purchase', 'buy') THEN t.value ELSE -t.value END) / 1000000 FROM trd t WHERE t.instrument = b.instrument AND abs(t.date - b.date) <= 7), 0) * 1000 AS score,
            coalesce((SELECT arg_max(factor, a.date) FROM aday a WHERE a.instrument = b.instrument AND s AND abs(a.date - b.date) <= 1), 1.0) AS f,
            CAST(b.volume * 20 AS DOUBLE) AS qs FROM ebars b)""",
        ],
        """SELECT 'earnings days beyond a year' AS check_name, count(*) FILTER (abs(dte) > 365) AS n, count(*) FILTER (abs(dte) > 365) > 0 AS failed FROM d
        UNION ALL SELECT 'insider score beyond 1000', count(*) FILTER (abs(score) > 1000), count(*) FILTER (abs(score) > 1000) > 0 FROM d
        UNION ALL SELECT 'split factor outside 0.1-10', count(*) FILTER (f < 0.1 OR f > 10), count(*) FILTER (f < 0.1 OR f > 10) > 0 FROM d
        UNION ALL SELECT 'low quality score', count(*) FILTER (qs < 50), count(*) FILTER (qs < 50) > count(*) * 0.1 FROM d
        UNION ALL SELECT 'missing earnings days', count(*) FILTER (dte IS NULL), count(*) FILTER (dte IS NULL) > count(*) * 0.8 FROM d""",
    ),
)
def _corporate(s, sf):
    b = v.event_bars(s, sf).select("instrument", "date", "volume")
    b = ce.action_flags(ce.insider_flags(ce.next_event(b, hq.earnings(s, sf)), hq.trades(s, sf)), hq.actions(s, sf))
    b = b.withColumns(
        {
            "days_to_earnings": F.col("days_to_earnings") * 30,
            "insider_activity_score": F.col("insider_activity_score") * 1000,
            "data_quality_score": (F.col("volume") * 20).cast("double"),
        }
    )
    return q.corporate_range_checks(b)


_CONS = "high >= low AND high >= open AND high >= close AND low <= open AND low <= close"
register(
    "stage_quality_report",
    "AGG-13",
    lambda s, sf: rounded(q.stage_report(_dirty(s, sf))),
    with_ctes(
        v.dirty_bars_sql("supplier"),
        f"""SELECT count(DISTINCT instrument) AS instruments, count(DISTINCT date) AS trading_days, min(date) AS start_date, max(date) AS end_date,
        bool_and(coalesce({_CONS}, false)) AS ohlc_consistent,
        bool_and(coalesce(open > 0 AND high > 0 AND low > 0 AND close > 0, false)) AS positive_prices,
        bool_and(coalesce(volume >= 0, false)) AS valid_volumes,
        {', '.join(r(f'count({c}) * 100.0 / count(*)', f'{c}_coverage') for c in ('open', 'high', 'low', 'close', 'volume'))} FROM bars""",
    ),
)

# ---- per-symbol metrics: one SQL CTE, several queries -----------------------------------

_MET = f"""
rr AS (SELECT *, close / nullif(lag(close) OVER ({_W}), 0) - 1 AS ret, date - lag(date) OVER ({_W}) AS gap FROM bars),
med AS (SELECT instrument, quantile_cont(CAST(volume AS DOUBLE), 0.5) AS m FROM bars GROUP BY 1),
agg AS (
  SELECT instrument, count(*) AS total_records, min(date) AS first_date, max(date) AS last_date,
    CAST(sum(CAST(open IS NULL AS INTEGER) + CAST(high IS NULL AS INTEGER) + CAST(low IS NULL AS INTEGER) + CAST(close IS NULL AS INTEGER) + CAST(volume IS NULL AS INTEGER)) AS BIGINT) AS null_values,
    count(*) FILTER (high < low) + count(*) FILTER (high < open) + count(*) FILTER (high < close) + count(*) FILTER (low > open) + count(*) FILTER (low > close) AS price_relationship_errors,
    count(*) FILTER (open <= 0) + count(*) FILTER (high <= 0) + count(*) FILTER (low <= 0) + count(*) FILTER (close <= 0) AS invalid_prices,
    count(*) FILTER (open = high AND high = low AND low = close) AS flat_price_days,
    count(*) FILTER (abs(ret) > 0.2) AS large_price_gaps, count(*) FILTER (abs(ret) > 0.5) AS extreme_return_days,
    stddev_samp(ret) AS return_volatility, max(abs(ret)) AS max_single_day_return, avg(ret) AS avg_daily_return,
    count(*) FILTER (volume = 0) AS zero_volume_days, count(*) FILTER (volume < 0) AS negative_volume_days, avg(volume) AS avg_volume,
    count(*) FILTER (volume < m * 0.01 OR volume > m * 100) AS abn,
    count(*) FILTER (gap > 3) AS data_gaps_count, CAST(coalesce(max(gap) FILTER (gap > 3), 0) AS INTEGER) AS longest_data_gap_days
  FROM rr JOIN med USING (instrument) GROUP BY 1),
met AS (
  SELECT *, CAST(last_date - first_date AS INTEGER) AS date_range_days, round(null_values / (total_records * 5) * 100, 2) AS null_percentage,
    CASE WHEN total_records > 10 THEN abn END AS abnormal_volume_days, 0 AS technical_indicators_present,
    (SELECT count(*) FROM (SELECT unnest(generate_series(first_date, last_date, INTERVAL 1 DAY)) AS d) WHERE isodow(d) < 6) AS expected,
    CAST(DATE '{AS_OF}' - last_date AS INTEGER) AS days_since_last_update FROM agg),
mets AS (
  SELECT *, CASE WHEN total_records > 1 THEN round(total_records / expected, 3) END AS completeness_ratio,
    CASE WHEN total_records > 1 THEN greatest(0, expected - total_records) END AS missing_trading_days,
    CASE WHEN days_since_last_update <= 7 THEN 'fresh' WHEN days_since_last_update <= 30 THEN 'recent' WHEN days_since_last_update <= 90 THEN 'aging' ELSE 'stale' END AS data_freshness_status
  FROM met)"""
_MCTES = [*v.dirty_bars_sql("supplier"), _MET]


def _metrics(s, sf):
    return q.symbol_metrics(_dirty(s, sf), AS_OF)


def _metric_query(name, covers, cols, digits=6):
    floats = {"return_volatility", "max_single_day_return", "avg_daily_return", "avg_volume", "null_percentage", "completeness_ratio"}
    body = ", ".join(r(c, c, digits) if c in floats else c for c in cols)
    register(
        name,
        covers,
        lambda s, sf: rounded(_metrics(s, sf).select("instrument", *cols), digits),
        with_ctes(_MCTES, f"SELECT instrument, {body} FROM mets"),
    )


_metric_query(
    "symbol_quality_metrics",
    "AGG-15",
    [
        "total_records",
        "date_range_days",
        "null_values",
        "null_percentage",
        "price_relationship_errors",
        "invalid_prices",
        "flat_price_days",
        "large_price_gaps",
        "extreme_return_days",
        "return_volatility",
        "max_single_day_return",
        "avg_daily_return",
        "zero_volume_days",
        "negative_volume_days",
        "avg_volume",
        "abnormal_volume_days",
        "technical_indicators_present",
    ],
    5,
)
_metric_query("completeness", "AGG-16", ["completeness_ratio", "missing_trading_days"])
_metric_query("date_gaps", "AGG-17", ["data_gaps_count", "longest_data_gap_days"])
_metric_query("freshness", "AGG-18", ["days_since_last_update", "data_freshness_status"])
_SCORE = """
sc AS (SELECT *, greatest(least(100 - least(null_percentage * 0.5, 15) - least(price_relationship_errors / total_records * 30, 25)
   - least(invalid_prices / total_records * 30, 25)
   - CASE WHEN completeness_ratio < 0.8 THEN least((0.8 - completeness_ratio) * 25, 8) ELSE 0 END
   - CASE WHEN days_since_last_update > 7 THEN least(least((days_since_last_update - 7) / 30, 1) * 20, 8) ELSE 0 END, 100), 0) AS quality_score FROM mets)"""
register(
    "quality_score",
    "AGG-19 AGG-21",
    lambda s, sf: rounded(q.quality_score(_metrics(s, sf)).select("instrument", "quality_score", "score_band")),
    with_ctes(
        [*_MCTES, _SCORE],
        f"""SELECT instrument, {r('quality_score', 'quality_score')}, CASE WHEN quality_score >= 95 THEN 'excellent' WHEN quality_score >= 80 THEN 'good'
        WHEN quality_score >= 60 THEN 'acceptable' WHEN quality_score >= 40 THEN 'poor' ELSE 'critical' END AS score_band FROM sc""",
    ),
)
_ISS = [
    ("null_percentage > 5", "High null value percentage", "CASE WHEN null_percentage > 15 THEN 'high' ELSE 'medium' END", "format('{:.2f}% null values', null_percentage)"),
    ("price_relationship_errors > 0", "Price relationship violations", "'critical'", "price_relationship_errors || ' impossible price relations'"),
    ("invalid_prices > 0", "Invalid price values", "'critical'", "invalid_prices || ' zero or negative prices'"),
    ("extreme_return_days > 0", "Extreme daily returns detected", "'medium'", "extreme_return_days || ' days beyond 50%'"),
    ("large_price_gaps > 5", "Frequent large price gaps", "'medium'", "large_price_gaps || ' days beyond 20%'"),
    ("completeness_ratio < 0.8", "Low data completeness", "CASE WHEN completeness_ratio < 0.5 THEN 'high' ELSE 'medium' END", "format('{:.1f}% of expected days', completeness_ratio * 100)"),
    ("days_since_last_update > 7", "Stale data", "CASE WHEN days_since_last_update > 30 THEN 'high' ELSE 'medium' END", "'Last updated ' || days_since_last_update || ' days ago'"),
    ("abnormal_volume_days > total_records * 0.05", "Volume anomalies detected", "'low'", "abnormal_volume_days || ' days with abnormal volume'"),
    ("longest_data_gap_days > 10", "Long data gap detected", "'medium'", "'Longest gap: ' || longest_data_gap_days || ' days'"),
]
register(
    "quality_issues",
    "AGG-20",
    lambda s, sf: q.quality_issues(_metrics(s, sf)),
    with_ctes(
        _MCTES,
        " UNION ALL ".join(
            f"SELECT instrument, '{t}' AS issue, {sev} AS severity, {d} AS details FROM mets WHERE {c}" for c, t, sev, d in _ISS
        ),
    ),
)

# ---- coverage ----------------------------------------------------------------------------


def _interval_bars(s, sf):
    """Bars of several intervals: daily for all suppliers, some hold the finer ones too."""
    b = v.bars(s, sf, "supplier").select(F.col("instrument").alias("symbol"), "date")
    key = F.col("symbol").cast("int")
    return b.withColumn(
        "interval",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(key % 10 != 0, F.lit("daily")),
                    F.when(key % 3 == 0, F.lit("hourly")),
                    F.when(key % 5 == 1, F.lit("5min")),
                    F.when(key % 7 == 2, F.lit("1min")),
                )
            )
        ),
    )


_IB = """
ib AS (
  SELECT instrument AS symbol, date, unnest(list_filter([CASE WHEN CAST(instrument AS INTEGER) % 10 <> 0 THEN 'daily' END,
   CASE WHEN CAST(instrument AS INTEGER) % 3 = 0 THEN 'hourly' END, CASE WHEN CAST(instrument AS INTEGER) % 5 = 1 THEN '5min' END,
   CASE WHEN CAST(instrument AS INTEGER) % 7 = 2 THEN '1min' END], lambda x: x IS NOT NULL)) AS interval FROM bars)"""
_MAT = """
mat AS (
  SELECT c.symbol, i.interval, count(ib.date) AS rows, min(ib.date) AS first_date, max(ib.date) AS last_date, count(ib.date) > 0 AS available
  FROM catalog c, (SELECT unnest(['daily', 'hourly', '30min', '15min', '5min', '1min']) AS interval) i
  LEFT JOIN ib ON ib.symbol = c.symbol AND ib.interval = i.interval GROUP BY 1, 2)"""
_COV = [v.bars_sql("supplier"), _IB, v.CATALOG_SQL, _MAT]


def _matrix(s, sf):
    return q.coverage_matrix(_interval_bars(s, sf), v.catalog(s, sf))


register("coverage_matrix", "AGG-22", _matrix, with_ctes(_COV, "SELECT * FROM mat"))
register(
    "interval_coverage",
    "AGG-22",
    lambda s, sf: rounded(q.interval_coverage(_matrix(s, sf))),
    with_ctes(
        _COV,
        f"""SELECT interval, count(*) FILTER (available) AS available, count(*) FILTER (NOT available) AS missing,
        {r('count(*) FILTER (available) * 100.0 / count(*)', 'coverage_percentage')} FROM mat GROUP BY 1""",
    ),
)
_PAT = """
pat AS (SELECT sector AS category, count(*) AS total_combinations, count(*) FILTER (NOT available) AS missing_combinations,
  round(count(*) FILTER (NOT available) * 100.0 / count(*), 2) AS missing_percentage FROM mat JOIN catalog USING (symbol) GROUP BY 1)"""


def _patterns(s, sf):
    cats = v.catalog(s, sf).select("symbol", F.col("sector").alias("category"))
    return q.missing_patterns(_matrix(s, sf), cats)


register("missing_patterns", "AGG-23", lambda s, sf: rounded(_patterns(s, sf)), with_ctes([*_COV, _PAT], "SELECT * FROM pat"))
register(
    "missing_recommendations",
    "AGG-42",
    lambda s, sf: q.missing_recommendations(_patterns(s, sf)),
    with_ctes(
        [*_COV, _PAT],
        """SELECT category, p AS priority, format('{}: {} has {:.1f}% missing combinations', p, upper(category[1]) || lower(category[2:]), missing_percentage) AS recommendation
        FROM (SELECT *, CASE WHEN missing_percentage > 50 THEN 'HIGH PRIORITY' WHEN missing_percentage > 25 THEN 'MEDIUM PRIORITY' END AS p FROM pat) WHERE p IS NOT NULL""",
    ),
)
_STAT = f"""
sts AS (SELECT symbol, CASE WHEN count(*) FILTER (available) = 0 THEN 'missing' WHEN bool_and(available) THEN 'complete' ELSE 'partial' END AS status,
  count(*) FILTER (available) AS intervals_available, coalesce(string_agg(CASE WHEN NOT available THEN interval END, ',' ORDER BY interval), '') AS missing_intervals,
  count(*) FILTER (DATE '{AS_OF}' - last_date > 2) AS outdated_intervals FROM mat GROUP BY 1)"""
register(
    "download_status",
    "AGG-30",
    lambda s, sf: q.download_status(_matrix(s, sf), AS_OF),
    with_ctes([*_COV, _STAT], "SELECT * FROM sts"),
)
register(
    "download_priorities",
    "AGG-42 AGG-30",
    lambda s, sf: q.download_priorities(q.download_status(_matrix(s, sf), AS_OF)),
    with_ctes(
        [*_COV, _STAT],
        """SELECT * FROM (SELECT 1 AS priority, 'Download data for symbols with no data' AS recommendation, count(*) FILTER (status = 'missing') AS n FROM sts
        UNION ALL SELECT 2, 'Complete data for symbols with partial data', count(*) FILTER (status = 'partial') FROM sts
        UNION ALL SELECT 3, 'Update outdated datasets', CAST(sum(outdated_intervals) AS BIGINT) FROM sts) WHERE n > 0""",
    ),
)
_EAGE = f"CAST(DATE '{AS_OF}' - max(date) AS INTEGER)"
register(
    "economic_coverage",
    "AGG-24",
    lambda s, sf: rounded(q.economic_coverage(v.econ(s, sf), AS_OF)),
    with_ctes(
        [v.ECON_SQL, "qq AS (SELECT symbol, quantile_cont(value, 0.99) AS q99, quantile_cont(value, 0.01) AS q01 FROM econ GROUP BY 1)"],
        f"""SELECT symbol, count(*) AS rows, min(date) AS first_date, max(date) AS last_date, count(*) - count(value) AS null_count,
        {r('(count(*) - count(value)) * 100.0 / count(*)', 'null_percentage')}, {_EAGE} AS days_since_last_update,
        CASE WHEN {_EAGE} <= 7 THEN 'fresh' WHEN {_EAGE} <= 30 THEN 'recent' WHEN {_EAGE} <= 90 THEN 'aging' ELSE 'stale' END AS data_freshness_status,
        {_EAGE} > 90 AS is_stale, count(*) FILTER (value > q99 * 10 OR value < q01 * 0.1) AS extreme_values
        FROM econ JOIN qq USING (symbol) GROUP BY 1""",
    ),
)


@query(
    "evaluation_summary",
    "AGG-28",
    with_ctes(
        [*_COV, v.ECON_SQL],
        f"""SELECT 'market' AS data_type, count(*) FILTER (available) AS available, count(*) AS total, {r('round(count(*) FILTER (available) * 100.0 / count(*), 2)', 'availability_percentage')} FROM mat
        UNION ALL SELECT 'economic', count(*) FILTER (n >= 500), count(*), {r('round(count(*) FILTER (n >= 500) * 100.0 / count(*), 2)', 'availability_percentage')} FROM (SELECT symbol, count(*) AS n FROM econ GROUP BY 1)
        UNION ALL SELECT 'news', count(*) FILTER (l.doc_id IS NOT NULL), count(*), {r('round(count(*) FILTER (l.doc_id IS NOT NULL) * 100.0 / count(*), 2)', 'availability_percentage')} FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    ),
)
def _summary(s, sf):
    market = _matrix(s, sf).agg(F.count_if("available").alias("available"), F.count(F.lit(1)).alias("total"))
    econ = (
        v.econ(s, sf).groupBy("symbol").count().agg(F.count_if(F.col("count") >= 500).alias("available"), F.count(F.lit(1)).alias("total"))
    )
    news = v.articles(s, sf).agg(F.count("sentiment").alias("available"), F.count(F.lit(1)).alias("total"))
    return rounded(q.evaluation_summary({"market": market, "economic": econ, "news": news}))


register(
    "zscore_outliers",
    "DOC-19",
    lambda s, sf: rounded(
        q.zscore_outliers(v.event_days(s, sf), "value", ["event_type"]).select("event_id", "zscore", "is_zscore_outlier")
    ),
    f"""SELECT event_id, {r('(value - avg(value) OVER w) / stddev_samp(value) OVER w', 'zscore')},
    abs((value - avg(value) OVER w) / stddev_samp(value) OVER w) > 3 AS is_zscore_outlier FROM events WINDOW w AS (PARTITION BY event_type)""",
)
register(
    "iqr_outliers",
    "DOC-19",
    lambda s, sf: q.iqr_outliers(v.event_days(s, sf), "value", ["event_type"]).select("event_id", "is_iqr_outlier"),
    """SELECT event_id, value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) AS is_iqr_outlier
    FROM events JOIN (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1) USING (event_type)""",
)
