"""Corporate events joined to bars by instrument and date distance.

Bars and events are keyed by (instrument, date) and each side holds one row per day after
aggregation, so a series is bounded by the calendar. Interval joins copy the aggregated
event day to the days around it and join on equality: no nested loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.frames import series

DAY = ["instrument", "date"]


def spread_days(daily: DataFrame, before: int, after: int) -> DataFrame:
    """Copy each event day to the days ``-before .. +after`` around it."""
    offsets = F.explode(F.sequence(F.lit(-before), F.lit(after)))
    return (
        daily.withColumn("_k", offsets)
        .withColumnRenamed("date", "event_date")
        .withColumn("date", F.date_add("event_date", F.col("_k")))
    )


def presence_flag(bars: DataFrame, events: DataFrame, name: str) -> DataFrame:
    """True for instruments with at least one event."""
    present = events.select("instrument").distinct().withColumn(name, F.lit(True))
    return bars.join(present, "instrument", "left").withColumn(
        name, F.coalesce(F.col(name), F.lit(False))
    )


def next_event(bars: DataFrame, events: DataFrame, near_days: int = 3) -> DataFrame:
    """Forward as-of join: days to the next event on or after the bar's date."""
    days = events.select(*DAY).distinct().withColumn("_event", F.col("date"))
    merged = bars.withColumn("_bar", F.lit(True)).join(days, DAY, "full_outer")
    ahead = series().rowsBetween(0, Window.unboundedFollowing)
    nxt = F.first("_event", ignorenulls=True).over(ahead)
    out = (
        merged.withColumn("days_to_earnings", F.datediff(nxt, F.col("date")))
        .where("_bar")
        .withColumn(
            "earnings_week",
            F.coalesce(F.abs("days_to_earnings") <= near_days, F.lit(False)),
        )
        .drop("_bar", "_event")
    )
    return presence_flag(out, events, "has_earnings_data")


def prior_event(bars: DataFrame, events: DataFrame, name: str) -> DataFrame:
    """Backward as-of join: days since the last event on or before the bar's date."""
    days = events.select(*DAY).distinct().withColumn("_event", F.col("date"))
    merged = bars.withColumn("_bar", F.lit(True)).join(days, DAY, "full_outer")
    back = series().rowsBetween(Window.unboundedPreceding, 0)
    last = F.last("_event", ignorenulls=True).over(back)
    return (
        merged.withColumn(name, F.datediff(F.col("date"), last)).where("_bar").drop("_bar", "_event")
    )


def filing_flags(bars: DataFrame, filings: DataFrame, near_days: int = 5) -> DataFrame:
    """Any 8-K, 10-K or 10-Q within ``near_days``; ``filings`` has instrument, date, form_type."""
    kinds = {"recent_8k_filing": "8-K", "recent_10k_filing": "10-K", "recent_10q_filing": "10-Q"}
    daily = filings.groupBy(*DAY).agg(
        *[F.max((F.col("form_type") == k).cast("int")).alias(n) for n, k in kinds.items()]
    )
    near = spread_days(daily, near_days, near_days).groupBy(*DAY).agg(
        *[F.max(n).alias(n) for n in kinds]
    )
    out = bars.join(near, DAY, "left").withColumns(
        {n: F.coalesce(F.col(n) == 1, F.lit(False)) for n in kinds}
    )
    return presence_flag(out, filings, "has_sec_filings")


def insider_flags(bars: DataFrame, trades: DataFrame, near_days: int = 7) -> DataFrame:
    """Buys, sells and signed value in millions within ``near_days``."""
    kind = F.lower("transaction_type")
    buy, sell = kind.isin("purchase", "buy"), kind.isin("sale", "sell")
    signed = F.when(buy, F.col("value")).when(sell, -F.col("value")).otherwise(0.0)
    daily = trades.groupBy(*DAY).agg(
        F.max(buy.cast("int")).alias("_b"),
        F.max(sell.cast("int")).alias("_s"),
        F.sum(signed).alias("_v"),
    )
    near = spread_days(daily, near_days, near_days).groupBy(*DAY).agg(
        F.max("_b").alias("_b"), F.max("_s").alias("_s"), F.sum("_v").alias("_v")
    )
    out = (
        bars.join(near, DAY, "left")
        .withColumns(
            {
                "recent_insider_buying": F.coalesce(F.col("_b") == 1, F.lit(False)),
                "recent_insider_selling": F.coalesce(F.col("_s") == 1, F.lit(False)),
                "insider_activity_score": F.coalesce(F.col("_v") / 1_000_000, F.lit(0.0)),
            }
        )
        .drop("_b", "_s", "_v")
    )
    return presence_flag(out, trades, "has_insider_trading")


def parse_ratio(ratio: Column) -> Column:
    """"a:b" as a double, 1.0 when it is anything else."""
    parts = F.split(ratio, ":")
    left = F.element_at(parts, 1).try_cast("double")
    right = F.try_element_at(parts, F.lit(2)).try_cast("double")
    return F.when(F.size(parts) == 2, F.coalesce(F.try_divide(left, right), F.lit(1.0))).otherwise(1.0)


def action_flags(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """Dividend day and +-3 days; split +-1 day with its factor.

    When several splits touch a day the latest one (then the largest factor) sets the factor.
    """
    kind = F.lower("action_type")
    daily = actions.groupBy(*DAY).agg(
        F.max((kind == "dividend").cast("int")).alias("_div"),
        F.max((kind == "split").cast("int")).alias("_spl"),
        F.max(F.when(kind == "split", parse_ratio(F.col("ratio")))).alias("_factor"),
    )
    k = F.col("_k")
    split_here = (F.col("_spl") == 1) & (F.abs(k) <= 1)
    near = spread_days(daily, 3, 3).groupBy(*DAY).agg(
        F.max(((F.col("_div") == 1) & (k == 0)).cast("int")).alias("_ex"),
        F.max("_div").alias("_div"),
        F.max(split_here.cast("int")).alias("_spl"),
        F.max_by("_factor", F.when(split_here, F.col("event_date"))).alias("_factor"),
    )
    out = (
        bars.join(near, DAY, "left")
        .withColumns(
            {
                "ex_dividend_date": F.coalesce(F.col("_ex") == 1, F.lit(False)),
                "recent_dividend": F.coalesce(F.col("_div") == 1, F.lit(False)),
                "recent_split": F.coalesce(F.col("_spl") == 1, F.lit(False)),
                "split_adjustment_factor": F.coalesce(
                    F.when(F.col("_spl") == 1, F.col("_factor")), F.lit(1.0)
                ),
            }
        )
        .drop("_ex", "_div", "_spl", "_factor")
    )
    return presence_flag(out, actions, "has_corporate_actions")
