"""Query filters as plain values, and their translation to DataFrame predicates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# accepted values: fixed values
INTERVALS = ("daily", "hourly", "30min", "15min", "5min", "1min")
DATA_TYPES = (
    "market_data",
    "economic_data",
    "news_data",
    "trends_data",
    "earnings_data",
    "sec_filings",
    "insider_trading",
    "corporate_actions",
)
SENTIMENT_LABELS = ("positive", "negative", "neutral")
NEWS_CATEGORIES = ("earnings", "market", "economic", "company")
FILING_TYPES = ("10-K", "10-Q", "8-K", "proxy", "3", "4", "5")
ACTION_TYPES = ("split", "dividend", "spinoff", "merger", "acquisition")
TRANSACTION_TYPES = ("purchase", "sale", "gift", "exercise")


@dataclass(frozen=True)
class DateRange:
    """Inclusive range; ISO strings, a trailing Z allowed; a bare end date lasts all day."""

    start: str
    end: str | None = None

    def predicate(self, column: Column) -> Column:
        ts = column.cast("timestamp")
        out = ts >= F.lit(self.start.replace("Z", "")).cast("timestamp")
        if self.end is None:
            return out
        end = self.end.replace("Z", "")
        if len(end) == 10:
            return out & (ts < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp"))
        return out & (ts <= F.lit(end).cast("timestamp"))


@dataclass(frozen=True)
class InstrumentFilter:
    symbols: Sequence[str] | None = None
    symbol_pattern: str | None = None
    exclude_symbols: Sequence[str] | None = None

    def predicate(self, column: Column) -> Column:
        out = F.lit(True)
        if self.exclude_symbols:
            out = out & ~column.isin(list(self.exclude_symbols))
        if self.symbols:
            out = out & column.isin(list(self.symbols))
        if self.symbol_pattern:
            out = out & column.rlike(f"^(?:{self.symbol_pattern})")
        return out


@dataclass(frozen=True)
class DataTypeFilter:
    data_type: str
    interval: str | None = None
    include_indicators: Sequence[str] | None = None
    exclude_indicators: Sequence[str] | None = None
    min_volume: int | None = None
    price_range: tuple[float, float] | None = None
    economic_category: str | None = None
    importance: str | None = None
    frequency: str | None = None
    sentiment_label: str | None = None
    sentiment_score_range: tuple[float, float] | None = None
    news_category: str | None = None
    sources: Sequence[str] | None = None
    geo: str | None = None
    category: int | None = None
    min_search_interest: int | None = None

    def __post_init__(self) -> None:
        if self.data_type not in DATA_TYPES:
            raise ValueError(f"unknown data type {self.data_type}")
        if self.interval is not None and self.interval not in INTERVALS:
            raise ValueError(f"unknown interval {self.interval}")


@dataclass(frozen=True)
class QueryFilter:
    date_range: DateRange | None = None
    instruments: InstrumentFilter | None = None
    data_types: Sequence[DataTypeFilter] = field(default_factory=tuple)
    limit: int | None = None
    offset: int | None = None
    sort_by: str | None = None
    sort_order: str = "asc"


def market_predicates(df: DataFrame, f: DataTypeFilter) -> DataFrame:
    if f.min_volume is not None:
        df = df.where(F.col("volume") >= f.min_volume)
    if f.price_range is not None:
        df = df.where(F.col("close").between(*f.price_range))
    return df


def indicator_projection(df: DataFrame, indicators: Sequence[str], f: DataTypeFilter) -> DataFrame:
    """Keep the wanted indicator columns; the scan then reads no others."""
    present = [c for c in indicators if c in df.columns]
    if f.include_indicators is not None:
        df = df.drop(*[c for c in present if c not in f.include_indicators])
    if f.exclude_indicators:
        df = df.drop(*f.exclude_indicators)
    return df


def economic_predicates(df: DataFrame, f: DataTypeFilter) -> DataFrame:
    for name, want in (
        ("category", f.economic_category),
        ("importance", f.importance),
        ("frequency", f.frequency),
    ):
        if want is not None:
            df = df.where(F.col(name) == want)
    return df


def news_predicates(df: DataFrame, f: DataTypeFilter, symbols: Sequence[str] | None = None) -> DataFrame:
    if f.sentiment_label is not None:
        df = df.where(F.col("sentiment_label") == f.sentiment_label)
    if f.sentiment_score_range is not None:
        df = df.where(F.col("sentiment_score").between(*f.sentiment_score_range))
    if f.news_category is not None:
        df = df.where(F.col("category") == f.news_category)
    if f.sources:
        df = df.where(F.col("source").isin(list(f.sources)))
    if symbols:
        df = df.where(F.arrays_overlap("symbols", F.array(*[F.lit(s) for s in symbols])))
    return df


def trends_predicates(df: DataFrame, f: DataTypeFilter) -> DataFrame:
    if f.geo is not None:
        df = df.where(F.col("geo") == f.geo)
    if f.category is not None:
        df = df.where(F.col("category") == f.category)
    if f.min_search_interest is not None:
        df = df.where(F.col("search_score") >= f.min_search_interest)
    return df


def sort_page(df: DataFrame, f: QueryFilter) -> DataFrame:
    """Sort if the column exists, then offset, then limit."""
    if f.sort_by and f.sort_by in df.columns:
        c = F.col(f.sort_by)
        ties = [x for x in df.columns if x != f.sort_by and x in ("symbol", "date")]
        df = df.orderBy(c.desc() if f.sort_order == "desc" else c.asc(), *ties)
    if f.offset:
        df = df.offset(f.offset)
    if f.limit is not None:
        df = df.limit(f.limit)
    return df
