"""Declared schema of each lake dataset."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L, _I, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.TimestampType()


def _struct(**cols) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in cols.items()])


# columns of the stored files: fixed values
BARS = _struct(
    date=_TS,
    open=_D,
    high=_D,
    low=_D,
    close=_D,
    volume=_L,
    **{
        c: _D
        for c in (
            "sma_20",
            "sma_50",
            "sma_200",
            "sma_5",
            "vwap",
            "price_change",
            "price_change_abs",
            "volatility_20",
            "volatility_10",
            "volume_sma_20",
            "volume_sma_10",
            "volume_ratio",
        )
    },
)
INDICATOR_COLUMNS = tuple(f.name for f in BARS.fields[6:])
ECONOMIC = _struct(
    date=_TS, value=_D, indicator_name=_S, category=_S, frequency=_S, importance=_S, description=_S
)
NEWS = _struct(
    article_id=_S,
    title=_S,
    description=_S,
    content=_S,
    source=_S,
    author=_S,
    url=_S,
    published_at=_S,
    symbols=T.ArrayType(_S),
    sentiment_score=_D,
    sentiment_label=_S,
    category=_S,
)
TRENDS = _struct(
    keyword=_S,
    symbol=_S,
    timeframe=_S,
    geo=_S,
    category=_I,
    search_interest=T.ArrayType(_struct(date=_S, search_score=_I)),
    related_queries=_struct(top=T.ArrayType(_S), rising=T.ArrayType(_S)),
)
EARNINGS = _struct(
    symbol=_S,
    date=_S,
    hour=_S,
    quarter=_I,
    year=_I,
    eps_estimate=_D,
    eps_actual=_D,
    revenue_estimate=_D,
    revenue_actual=_D,
    source=_S,
)
FILINGS = _struct(symbol=_S, form_type=_S, type=_S, filing_date=_S, date=_S)
INSIDER = _struct(symbol=_S, transaction_type=_S, transaction_date=_S, date=_S, value=_D)
ACTIONS = _struct(symbol=_S, action_type=_S, type=_S, effective_date=_S, date=_S, ratio=_S)
CATALOG = _struct(
    symbol=_S, name=_S, sector=_S, market_cap_category=_S, exchange=_S, status=_S, country=_S
)
CORRUPT = "_corrupt_record"


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, _S, True)])
