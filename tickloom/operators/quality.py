"""Data-quality profiles, coverage and scores as DataFrames.

Dates are compared with an ``as_of`` argument, never with the clock. Percentiles of groups
without a size bound use ``ranks.quantiles``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.frames import series
from tickloom.functions.ranks import quantiles

PRICES = ("open", "high", "low", "close")
# indicator columns counted as present: fixed values
INDICATORS = (
    "sma_20",
    "sma_50",
    "ema_12",
    "ema_26",
    "rsi",
    "macd",
    "bollinger_upper",
    "bollinger_lower",
    "atr",
    "vwap",
)
INTERVALS = ("daily", "hourly", "30min", "15min", "5min", "1min")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    numeric = {"double", "float", "integer", "long", "short", "byte", "decimal"}
    return [
        f.name for f in df.schema.fields if f.dataType.typeName() in numeric and f.name not in exclude
    ]


# ---- generic profiles -----------------------------------------------------------------


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: rows, nulls, percent, type, mostly-missing and constant flags.

    Constant means at most one distinct value, which min = max decides without a distinct.
    """
    numeric = set(numeric_columns(df))
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in df.columns:
        aggs.append(F.count(c).alias(f"n_{c}"))
        if c in numeric:
            aggs.append((F.min(c).eqNullSafe(F.max(c))).alias(f"k_{c}"))
    one = df.agg(*aggs)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(kinds[c]).alias("data_type"),
                F.col("_rows").alias("total_rows"),
                (F.col("_rows") - F.col(f"n_{c}")).alias("null_count"),
                (F.col(f"k_{c}") if c in numeric else F.lit(False)).alias("is_constant"),
            )
            for c in df.columns
        ]
    )
    return (
        one.select(F.inline(rows))
        .withColumn("null_percentage", F.try_divide(F.col("null_count") * 100.0, F.col("total_rows")))
        .withColumn("mostly_missing", F.coalesce(F.col("null_percentage") > 50, F.lit(False)))
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row; equal rows combine map-side before the shuffle."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("_c"))
        .agg(F.sum("_c").alias("total_rows"), F.sum(F.col("_c") - 1).alias("duplicate_rows"))
    )


def outlier_shares(df: DataFrame, sigmas: float = 5.0, limit: float = 0.01) -> DataFrame:
    """Share of rows beyond ``sigmas`` deviations per numeric column, two narrow passes."""
    cols = numeric_columns(df)
    stats = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]
    )
    beyond = [
        F.count_if((F.col(f"s_{c}") > 0) & (F.abs(F.col(c) - F.col(f"m_{c}")) > sigmas * F.col(f"s_{c}"))).alias(f"o_{c}")
        for c in cols
    ]
    one = df.select(*cols).crossJoin(F.broadcast(stats)).agg(F.count(F.lit(1)).alias("_rows"), *beyond)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"o_{c}").alias("outliers"), "_rows") for c in cols])
    return one.select(F.inline(rows)).select(
        "column_name",
        "outliers",
        F.try_divide(F.col("outliers") * 100.0, F.col("_rows")).alias("outlier_percentage"),
        (F.col("outliers") > F.col("_rows") * limit).alias("excessive"),
    )


def routing_issues(df: DataFrame) -> DataFrame:
    """Issue rows (column_name, issue): mostly missing, constant, too many outliers."""
    profile = column_profile(df)
    outliers = outlier_shares(df).where("excessive")
    return (
        profile.where("mostly_missing")
        .select("column_name", F.lit("high missing data").alias("issue"))
        .unionByName(
            profile.where("is_constant").select("column_name", F.lit("constant column").alias("issue"))
        )
        .unionByName(outliers.select("column_name", F.lit("excessive outliers").alias("issue")))
    )


def corporate_range_checks(df: DataFrame) -> DataFrame:
    """Range checks on the corporate event columns as (check_name, n, failed)."""
    rules = {
        "earnings days beyond a year": F.abs("days_to_earnings") > 365,
        "insider score beyond 1000": F.abs("insider_activity_score") > 1000,
        "split factor outside 0.1-10": (F.col("split_adjustment_factor") < 0.1)
        | (F.col("split_adjustment_factor") > 10),
        "low quality score": F.col("data_quality_score") < 50,
        "missing earnings days": F.col("days_to_earnings").isNull(),
    }
    share = {"low quality score": 0.1, "missing earnings days": 0.8}
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(e).alias(f"c{i}") for i, e in enumerate(rules.values())]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                F.col(f"c{i}").alias("n"),
                (F.col(f"c{i}") > F.col("_rows") * share.get(name, 0.0)).alias("failed"),
            )
            for i, name in enumerate(rules)
        ]
    )
    return one.select(F.inline(rows))


def stage_report(df: DataFrame) -> DataFrame:
    """One row: instruments, dates, rule checks and coverage of the bar columns."""
    consistent = (
        (F.col("high") >= F.col("low"))
        & (F.col("high") >= F.col("open"))
        & (F.col("high") >= F.col("close"))
        & (F.col("low") <= F.col("open"))
        & (F.col("low") <= F.col("close"))
    )
    positive = F.lit(True)
    for c in PRICES:
        positive = positive & (F.col(c) > 0)
    days = df.select("date").distinct().agg(F.count(F.lit(1)).alias("trading_days"))
    insts = df.select("instrument").distinct().agg(F.count(F.lit(1)).alias("instruments"))
    one = df.agg(
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        F.bool_and(F.coalesce(consistent, F.lit(False))).alias("ohlc_consistent"),
        F.bool_and(F.coalesce(positive, F.lit(False))).alias("positive_prices"),
        F.bool_and(F.coalesce(F.col("volume") >= 0, F.lit(False))).alias("valid_volumes"),
        *[(F.avg(F.col(c).isNotNull().cast("double")) * 100).alias(f"{c}_coverage") for c in (*PRICES, "volume")],
    )
    return insts.crossJoin(days).crossJoin(one)


# ---- market data quality per symbol ----------------------------------------------------


def weekdays_between(first: Column, last: Column) -> Column:
    """Monday-Friday days from first to last, both included (closed form)."""

    def before(day: Column) -> Column:
        n = F.unix_date(day) + 3  # 1969-12-29, a Monday, is 0
        return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(5))

    return before(F.date_add(last, 1)) - before(first)


def freshness_status(days: Column) -> Column:
    return (
        F.when(days <= 7, "fresh").when(days <= 30, "recent").when(days <= 90, "aging").when(days > 90, "stale")
    )


def symbol_metrics(df: DataFrame, as_of: str) -> DataFrame:
    """Quality metrics per instrument of a daily panel (one row per instrument and day)."""
    w = series()
    change = F.try_divide(F.col("close"), F.lag("close").over(w)) - 1
    gap = F.datediff("date", F.lag("date").over(w))
    rows = df.withColumns({"_r": change, "_gap": gap})
    medians = quantiles(
        df.withColumn("_v", F.col("volume").cast("double")), ["instrument"], "_v", [0.5], ["_med"]
    )
    bad_order = sum(
        (F.coalesce(e, F.lit(False)).cast("int"))
        for e in (
            F.col("high") < F.col("low"),
            F.col("high") < F.col("open"),
            F.col("high") < F.col("close"),
            F.col("low") > F.col("open"),
            F.col("low") > F.col("close"),
        )
    )
    invalid = sum(F.coalesce(F.col(c) <= 0, F.lit(False)).cast("int") for c in PRICES)
    held = [c for c in df.columns if c not in ("instrument", "date")]
    nulls = sum(F.col(c).isNull().cast("int") for c in held)
    flat = (
        (F.col("open") == F.col("high")) & (F.col("high") == F.col("low")) & (F.col("low") == F.col("close"))
    )
    out = (
        rows.join(medians, "instrument", "left")
        .groupBy("instrument")
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
            F.sum(nulls).alias("null_values"),
            F.sum(bad_order).alias("price_relationship_errors"),
            F.sum(invalid).alias("invalid_prices"),
            F.count_if(flat).alias("flat_price_days"),
            F.count_if(F.abs("_r") > 0.2).alias("large_price_gaps"),
            F.count_if(F.abs("_r") > 0.5).alias("extreme_return_days"),
            F.stddev_samp("_r").alias("return_volatility"),
            F.max(F.abs("_r")).alias("max_single_day_return"),
            F.avg("_r").alias("avg_daily_return"),
            F.count_if(F.col("volume") == 0).alias("zero_volume_days"),
            F.count_if(F.col("volume") < 0).alias("negative_volume_days"),
            F.avg("volume").alias("avg_volume"),
            F.count_if(
                (F.col("volume") < F.col("_med") * 0.01) | (F.col("volume") > F.col("_med") * 100)
            ).alias("_abnormal"),
            F.count_if(F.col("_gap") > 3).alias("data_gaps_count"),
            F.coalesce(F.max(F.when(F.col("_gap") > 3, F.col("_gap"))), F.lit(0)).alias(
                "longest_data_gap_days"
            ),
        )
    )
    n = F.col("total_records")
    expected = weekdays_between(F.col("first_date"), F.col("last_date"))
    days_old = F.datediff(F.lit(as_of).cast("date"), F.col("last_date"))
    return out.withColumns(
        {
            "date_range_days": F.datediff("last_date", "first_date"),
            "null_percentage": F.round(F.col("null_values") / (n * len(held)) * 100, 2),
            "abnormal_volume_days": F.when(n > 10, F.col("_abnormal")),
            "technical_indicators_present": F.lit(sum(c in df.columns for c in INDICATORS)),
            "completeness_ratio": F.when(n > 1, F.round(F.try_divide(n, expected), 3)),
            "missing_trading_days": F.when(n > 1, F.greatest(F.lit(0).cast("long"), expected - n)),
            "days_since_last_update": days_old,
            "data_freshness_status": freshness_status(days_old),
        }
    ).drop("_abnormal")


# scoring weights and caps: fixed values
WEIGHTS = {"null": 0.25, "price": 0.30, "completeness": 0.25, "freshness": 0.20}
CAPS = {"critical": 25.0, "high": 15.0, "medium": 8.0}
MIN_COMPLETENESS, FRESH_DAYS, MAX_GAP_DAYS, NULL_LIMIT = 0.8, 7, 10, 5


def quality_score(metrics: DataFrame) -> DataFrame:
    """0-100 score from capped penalties, and its band."""
    n = F.col("total_records")
    completeness, age = F.col("completeness_ratio"), F.col("days_since_last_update")
    penalties = (
        F.least(F.col("null_percentage") * WEIGHTS["null"] * 2, F.lit(CAPS["high"])),
        F.least(F.col("price_relationship_errors") / n * 100 * WEIGHTS["price"], F.lit(CAPS["critical"])),
        F.least(F.col("invalid_prices") / n * 100 * WEIGHTS["price"], F.lit(CAPS["critical"])),
        F.when(
            completeness < MIN_COMPLETENESS,
            F.least((MIN_COMPLETENESS - completeness) * 100 * WEIGHTS["completeness"], F.lit(CAPS["medium"])),
        ).otherwise(0.0),
        F.when(
            age > FRESH_DAYS,
            F.least(
                F.least((age - FRESH_DAYS) / 30, F.lit(1.0)) * WEIGHTS["freshness"] * 100, F.lit(CAPS["medium"])
            ),
        ).otherwise(0.0),
    )
    total = F.lit(100.0)
    for p in penalties:
        total = total - F.coalesce(p, F.lit(0.0))
    return metrics.withColumn("quality_score", F.greatest(F.least(total, F.lit(100.0)), F.lit(0.0))).withColumn(
        "score_band", score_band(F.col("quality_score"))
    )


def score_band(score: Column) -> Column:
    return (
        F.when(score >= 95, "excellent")
        .when(score >= 80, "good")
        .when(score >= 60, "acceptable")
        .when(score >= 40, "poor")
        .otherwise("critical")
    )


def quality_issues(metrics: DataFrame) -> DataFrame:
    """One row per broken rule: instrument, issue, severity, details."""
    m = F.col

    def issue(when: Column, text: str, severity: Column | str, details: Column) -> Column:
        sev = F.lit(severity) if isinstance(severity, str) else severity
        return F.when(
            when, F.struct(F.lit(text).alias("issue"), sev.alias("severity"), details.alias("details"))
        )

    def worse(cond: Column) -> Column:
        return F.when(cond, "high").otherwise("medium")

    rules = [
        issue(
            m("null_percentage") > NULL_LIMIT,
            "High null value percentage",
            worse(m("null_percentage") > 15),
            F.format_string("%.2f%% null values", m("null_percentage")),
        ),
        issue(
            m("price_relationship_errors") > 0,
            "Price relationship violations",
            "critical",
            F.format_string("%d impossible price relations", m("price_relationship_errors")),
        ),
        issue(
            m("invalid_prices") > 0,
            "Invalid price values",
            "critical",
            F.format_string("%d zero or negative prices", m("invalid_prices")),
        ),
        issue(
            m("extreme_return_days") > 0,
            "Extreme daily returns detected",
            "medium",
            F.format_string("%d days beyond 50%%", m("extreme_return_days")),
        ),
        issue(
            m("large_price_gaps") > 5,
            "Frequent large price gaps",
            "medium",
            F.format_string("%d days beyond 20%%", m("large_price_gaps")),
        ),
        issue(
            m("completeness_ratio") < MIN_COMPLETENESS,
            "Low data completeness",
            worse(m("completeness_ratio") < 0.5),
            F.format_string("%.1f%% of expected days", m("completeness_ratio") * 100),
        ),
        issue(
            m("days_since_last_update") > FRESH_DAYS,
            "Stale data",
            worse(m("days_since_last_update") > 30),
            F.format_string("Last updated %d days ago", m("days_since_last_update")),
        ),
        issue(
            m("abnormal_volume_days") > m("total_records") * 0.05,
            "Volume anomalies detected",
            "low",
            F.format_string("%d days with abnormal volume", m("abnormal_volume_days")),
        ),
        issue(
            m("longest_data_gap_days") > MAX_GAP_DAYS,
            "Long data gap detected",
            "medium",
            F.format_string("Longest gap: %d days", m("longest_data_gap_days")),
        ),
    ]
    return metrics.select("instrument", F.inline(F.array_compact(F.array(*rules))))


# ---- coverage --------------------------------------------------------------------------


def coverage_matrix(bars: DataFrame, symbols: DataFrame, intervals: Sequence[str] = INTERVALS) -> DataFrame:
    """Every symbol x interval with rows and range; missing pairs have 0 rows.

    The grid is an ``explode`` of the fixed interval list, not a cross join.
    """
    have = bars.groupBy("symbol", "interval").agg(
        F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )
    grid = symbols.select("symbol").distinct().withColumn(
        "interval", F.explode(F.array(*[F.lit(i) for i in intervals]))
    )
    return grid.join(have, ["symbol", "interval"], "left").select(
        "symbol",
        "interval",
        F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        "first_date",
        "last_date",
        F.col("rows").isNotNull().alias("available"),
    )


def interval_coverage(matrix: DataFrame) -> DataFrame:
    return matrix.groupBy("interval").agg(
        F.count_if("available").alias("available"),
        F.count_if(~F.col("available")).alias("missing"),
        (F.avg(F.col("available").cast("double")) * 100).alias("coverage_percentage"),
    )


def missing_patterns(matrix: DataFrame, categories: DataFrame) -> DataFrame:
    """Missing symbol-interval pairs per category."""
    return (
        matrix.join(categories.select("symbol", "category"), "symbol")
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("total_combinations"),
            F.count_if(~F.col("available")).alias("missing_combinations"),
        )
        .withColumn(
            "missing_percentage",
            F.round(F.col("missing_combinations") * 100.0 / F.col("total_combinations"), 2),
        )
    )


def missing_recommendations(patterns: DataFrame) -> DataFrame:
    pct = F.col("missing_percentage")
    level = F.when(pct > 50, "HIGH PRIORITY").when(pct > 25, "MEDIUM PRIORITY")
    return patterns.withColumn("priority", level).where("priority IS NOT NULL").select(
        "category",
        "priority",
        F.format_string("%s: %s has %.1f%% missing combinations", level, F.initcap("category"), pct).alias(
            "recommendation"
        ),
    )


def download_status(matrix: DataFrame, as_of: str, stale_days: int = 2) -> DataFrame:
    """Per symbol: complete, partial or missing, and outdated intervals."""
    n_all = F.count(F.lit(1))
    n_have = F.count_if("available")
    late = F.datediff(F.lit(as_of).cast("date"), F.col("last_date")) > stale_days
    return matrix.groupBy("symbol").agg(
        F.when(n_have == 0, "missing").when(n_have == n_all, "complete").otherwise("partial").alias("status"),
        n_have.alias("intervals_available"),
        F.array_join(
            F.array_sort(F.collect_set(F.when(~F.col("available"), F.col("interval")))), ","
        ).alias("missing_intervals"),
        F.count_if(late).alias("outdated_intervals"),
    )


def download_priorities(status: DataFrame) -> DataFrame:
    one = status.agg(
        F.count_if(F.col("status") == "missing").alias("n1"),
        F.count_if(F.col("status") == "partial").alias("n2"),
        F.sum("outdated_intervals").alias("n3"),
    )
    texts = (
        "Download data for symbols with no data",
        "Complete data for symbols with partial data",
        "Update outdated datasets",
    )
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("priority"), F.lit(t).alias("recommendation"), F.col(f"n{i}").alias("n"))
            for i, t in enumerate(texts, 1)
        ]
    )
    return one.select(F.inline(rows)).where("n > 0")


def economic_coverage(df: DataFrame, as_of: str) -> DataFrame:
    """Per indicator: rows, range, nulls, age, values beyond 10 x q99 or below 0.1 x q01."""
    edges = quantiles(df, ["symbol"], "value", [0.01, 0.99], ["_q01", "_q99"])
    age = F.datediff(F.lit(as_of).cast("date"), F.max("date"))
    out = (
        df.join(edges, "symbol", "left")
        .groupBy("symbol")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
            F.count_if(F.col("value").isNull()).alias("null_count"),
            age.alias("days_since_last_update"),
            F.count_if((F.col("value") > F.col("_q99") * 10) | (F.col("value") < F.col("_q01") * 0.1)).alias("_x"),
            F.count("value").alias("_n"),
        )
    )
    return out.select(
        "symbol",
        "rows",
        "first_date",
        "last_date",
        "null_count",
        F.round(F.col("null_count") * 100.0 / F.col("rows"), 2).alias("null_percentage"),
        "days_since_last_update",
        freshness_status(F.col("days_since_last_update")).alias("data_freshness_status"),
        (F.col("days_since_last_update") > 90).alias("is_stale"),
        F.when(F.col("_n") > 10, F.col("_x")).otherwise(F.lit(0)).cast("long").alias("extreme_values"),
    )


def evaluation_summary(parts: dict[str, DataFrame]) -> DataFrame:
    """(data_type, available, total, percentage) of each section's one-row (available, total)."""
    out = None
    for name, df in parts.items():
        row = df.select(
            F.lit(name).alias("data_type"),
            F.col("available").cast("long"),
            F.col("total").cast("long"),
            F.round(F.try_divide(F.col("available") * 100.0, F.col("total")), 2).alias("availability_percentage"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def zscore_outliers(df: DataFrame, value: str, group: Sequence[str], limit: float = 3.0) -> DataFrame:
    stats = df.groupBy(*group).agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    z = F.try_divide(F.col(value) - F.col("_m"), F.col("_s"))
    return (
        df.join(stats, list(group))
        .withColumn("zscore", z)
        .withColumn("is_zscore_outlier", F.coalesce(F.abs("zscore") > limit, F.lit(False)))
        .drop("_m", "_s")
    )


def iqr_outliers(df: DataFrame, value: str, group: Sequence[str], factor: float = 1.5) -> DataFrame:
    edges = quantiles(df, group, value, [0.25, 0.75], ["_q1", "_q3"])
    iqr = F.col("_q3") - F.col("_q1")
    out = (F.col(value) < F.col("_q1") - factor * iqr) | (F.col(value) > F.col("_q3") + factor * iqr)
    return (
        df.join(edges, list(group))
        .withColumn("is_iqr_outlier", F.coalesce(out, F.lit(False)))
        .drop("_q1", "_q3")
    )
