"""Small selections: latest rows, first per key, thinning, feature columns, lookups."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.quality import numeric_columns


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key by an explicit order.

    ``min_by`` combines map-side, so a key with many copies never sorts in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
    )


def latest_rows(df: DataFrame, n: int, keys: Sequence[str] = ("instrument",), order: str = "date") -> DataFrame:
    """Last ``n`` rows of each series of a daily panel."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def top_per_key(df: DataFrame, n: int, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Best ``n`` rows per key, with their 1-based place. Spark prunes rows before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def most_liquid(df: DataFrame) -> DataFrame:
    means = df.groupBy("instrument").agg(F.avg("volume").alias("mean_volume"))
    return means.orderBy(F.desc("mean_volume"), "instrument").limit(1)


def thin_dates(df: DataFrame, value: str, min_share: float = 0.7) -> DataFrame:
    """Keep dates where at least ``min_share`` of all instruments hold a value."""
    held = df.where(F.col(value).isNotNull())
    total = held.select("instrument").distinct().agg(F.count(F.lit(1)).alias("_all"))
    dates = held.groupBy("date").agg(F.count(F.lit(1)).alias("_n"))
    keep = dates.crossJoin(F.broadcast(total)).where(F.col("_n") >= F.col("_all") * min_share)
    return held.join(keep.select("date"), "date", "left_semi")


def thin_dates_by_count(df: DataFrame, value: str, min_count: int = 2) -> DataFrame:
    held = df.where(F.col(value).isNotNull())
    keep = held.groupBy("date").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_count)
    return held.join(keep.select("date"), "date", "left_semi")


def column_fill_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, non_null_share) in one pass."""
    one = df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns])
    return one.unpivot([], list(columns), "feature", "non_null_share")


def thin_columns(df: DataFrame, columns: Sequence[str], min_share: float = 0.3) -> DataFrame:
    """Drop sparse columns. The schema must be known, so one row of shares is collected."""
    one = df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns]).first()
    return df.drop(*[c for c in columns if (one[c] or 0.0) < min_share])


# column-name patterns that are not features: fixed values
NOT_FEATURES = (
    "target_",
    "pred_",
    "instrument",
    "date",
    "close",
    "open",
    "high",
    "low",
    "volume",
    "close_adj",
    "true_",
    "sector",
)


def feature_columns(df: DataFrame, patterns: Sequence[str] = NOT_FEATURES) -> list[str]:
    """Numeric columns whose name holds none of the patterns; a schema walk at plan time."""
    return [c for c in numeric_columns(df) if not any(p in c.lower() for p in patterns)]


def valid_symbol(column: Column) -> Column:
    return F.regexp_replace(column, "[.-]", "").rlike("^[A-Za-z0-9]+$")


# feature category by name, first match wins: fixed values
FEATURE_KINDS = (
    ("momentum", ("momentum",)),
    ("spread", ("spread",)),
    ("mean_reversion", ("reversion", "rank", "deviation")),
    ("basket", ("basket",)),
    ("relationship", ("lead", "lag")),
)


def feature_category(column: Column) -> Column:
    out = None
    for kind, parts in FEATURE_KINDS:
        hit = column.rlike("|".join(re.escape(p) for p in parts))
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out


# indicator lookups: fixed values
INDICATOR_CATEGORIES = {
    "employment": ("UNRATE", "PAYEMS", "CIVPART"),
    "interest_rates": ("FEDFUNDS", "DGS10", "DGS2", "DFF"),
    "inflation": ("CPIAUCSL", "CPILFESL", "PCEPI"),
    "growth": ("GDP", "GDPC1"),
    "markets": ("VIXCLS", "DEXUSEU", "DTWEXBGS"),
    "commodities": ("DCOILWTICO", "GOLDAMGBD228NLBM"),
    "industrial": ("INDPRO",),
}
INDICATOR_IMPORTANCE = {
    "high": ("UNRATE", "GDP", "FEDFUNDS", "CPIAUCSL", "PAYEMS", "DGS10", "VIXCLS"),
    "medium": ("DEXUSEU", "DCOILWTICO", "INDPRO", "DGS2"),
}
SECTOR_NAMES = {
    "Health Care": "Healthcare",
    "Financials": "Financial Services",
    "Industrials": "Industrial",
    "Communications": "Communication Services",
}


def lookup(column: Column, table: dict[str, Sequence[str]], default: str) -> Column:
    out = None
    for name, members in table.items():
        hit = column.isin(list(members))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(default)


def normal_sector(column: Column) -> Column:
    out = column
    for old, new in SECTOR_NAMES.items():
        out = F.when(column == old, new).otherwise(out)
    return out


def fund_category(name: Column) -> Column:
    """Fund category by name keywords, NULL for names that are no fund."""
    kind = (
        F.when(name.contains("Bond") | name.contains("Treasury"), "Bond ETF")
        .when(name.contains("Gold") | name.contains("Silver") | name.contains("Commodity"), "Commodity ETF")
        .when(name.contains("Real Estate") | name.contains("REIT"), "Real Estate ETF")
        .when(name.contains("S&P 500"), "Large Cap Blend")
        .when(
            name.contains("Russell"),
            F.when(name.contains("2000"), "Small Cap Blend").otherwise("Large Cap Blend"),
        )
        .otherwise("Sector ETF")
    )
    return F.when(name.contains("ETF") | name.contains("Fund"), kind)
