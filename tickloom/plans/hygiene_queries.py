"""Queries for cleaning and event joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import corporate_events as ce
from tickloom.operators import hygiene as h
from tickloom.operators import season as z
from tickloom.plans import views as v
from tickloom.plans.registry import query, r, register, rounded, with_ctes

_W = "PARTITION BY instrument ORDER BY date"
_OHLC = ("open", "high", "low", "close")


def _rs(cols, digits=8):
    return ", ".join(r(c, c, digits) for c in cols)


register(
    "adjusted_close",
    "SEL-20",
    lambda s, sf: rounded(
        h.resolve_adjusted_close(v.dirty_bars(s, sf).drop("close_adj").withColumn("adj_close", F.col("open") * 0.5)).select(
            "instrument", "date", "close_adj"
        ),
        9,
    ),
    with_ctes(v.dirty_bars_sql(), f"SELECT instrument, date, {r('open * 0.5', 'close_adj', 9)} FROM bars"),
)
register(
    "column_standardisation",
    "SEL-19",
    lambda s, sf: rounded(
        h.standard_columns(
            v.bars(s, sf).select(
                F.col("instrument").alias("Instrument"),
                F.col("date").alias("DATE"),
                F.col("close").alias("Last Close"),
                F.col("volume").alias(" Total Volume"),
            )
        ),
        8,
    ),
    with_ctes([v.bars_sql()], f"SELECT instrument, date, {r('close', 'last_close', 8)}, volume AS total_volume FROM bars"),
)
register(
    "ohlc_repair",
    "SEL-21",
    lambda s, sf: rounded(h.repair_ohlc(v.dirty_bars(s, sf)).select("instrument", "date", *_OHLC, "volume"), 8),
    with_ctes(
        v.dirty_bars_sql(),
        f"""SELECT instrument, date, {r('open', 'open', 8)}, {r('greatest(high, open, close)', 'high', 8)},
        {r('least(low, open, close)', 'low', 8)}, {r('close', 'close', 8)}, CASE WHEN volume < 0 THEN 0 ELSE volume END AS volume
        FROM bars WHERE NOT (open IS NULL AND high IS NULL AND low IS NULL AND close IS NULL AND volume IS NULL)""",
    ),
)
register(
    "threshold_filter",
    "SEL-8",
    lambda s, sf: rounded(
        h.threshold_filter(v.dirty_bars(s, sf), 50, 1000.0).select("instrument", "date", *_OHLC, "volume"), 8
    ),
    with_ctes(
        v.dirty_bars_sql(),
        f"SELECT instrument, date, {_rs(_OHLC, 8)}, volume FROM bars WHERE volume >= 50 AND open >= 1000 AND high >= 1000 AND low >= 1000 AND close >= 1000",
    ),
)
register(
    "sufficient_history",
    "SEL-9",
    lambda s, sf: h.sufficient_history(v.event_bars(s, sf), 20).select("instrument", "date", "volume"),
    with_ctes(
        [v.EVENT_BARS_SQL],
        "SELECT instrument, date, volume FROM ebars WHERE instrument IN (SELECT instrument FROM ebars GROUP BY 1 HAVING count(*) >= 20)",
    ),
)


def _clip_sql(c):
    return r(
        f"CASE WHEN {c} IS NOT NULL THEN CASE WHEN n > 10 THEN least(greatest(CAST({c} AS DOUBLE), lo_{c}), hi_{c}) ELSE CAST({c} AS DOUBLE) END END",
        c,
        8,
    )


_WCOLS = (*_OHLC, "volume", "close_adj")
register(
    "winsorised_bars",
    "WIN-30",
    lambda s, sf: rounded(h.winsorise(v.dirty_bars(s, sf), _WCOLS).select("instrument", "date", *_WCOLS), 8),
    with_ctes(
        [
            *v.dirty_bars_sql(),
            "lim AS (SELECT instrument, count(*) AS n, "
            + ", ".join(
                f"quantile_cont(CAST({c} AS DOUBLE), 0.01) AS lo_{c}, quantile_cont(CAST({c} AS DOUBLE), 0.99) AS hi_{c}" for c in _WCOLS
            )
            + " FROM bars GROUP BY 1)",
        ],
        f"SELECT instrument, date, {', '.join(_clip_sql(c) for c in _WCOLS)} FROM bars JOIN lim USING (instrument)",
    ),
)
register(
    "calendar_alignment",
    "JOIN-6",
    lambda s, sf: rounded(
        h.align_calendar(v.dirty_bars(s, sf)).select("instrument", "date", *_OHLC, "volume"), 8
    ),
    with_ctes(
        [
            *v.dirty_bars_sql(),
            "grid AS (SELECT date, instrument FROM (SELECT DISTINCT date FROM bars), (SELECT DISTINCT instrument FROM bars))",
            f"""filled AS (SELECT g.instrument, g.date, open, high, low, close,
            last_value(volume IGNORE NULLS) OVER (PARTITION BY g.instrument ORDER BY g.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS volume
            FROM grid g LEFT JOIN bars b ON g.instrument = b.instrument AND g.date = b.date)""",
        ],
        f"SELECT instrument, date, {_rs(_OHLC, 8)}, volume FROM filled WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL",
    ),
)
register(
    "row_quality_score",
    "WIN-31",
    lambda s, sf: rounded(h.row_quality_score(v.dirty_bars(s, sf, "supplier")).select("instrument", "date", "data_quality_score")),
    with_ctes(
        [
            *v.dirty_bars_sql("supplier"),
            f"mv AS (SELECT instrument, abs(close_adj / lag(close_adj) OVER ({_W}) - 1) AS m FROM bars)",
            "pen AS (SELECT instrument, 2.0 * count(*) FILTER (m > 0.5) AS p FROM mv GROUP BY 1)",
            "base AS (SELECT 100 - 50.0 * avg(CASE WHEN volume IS NULL THEN 1 ELSE 0 END) AS b FROM bars)",
        ],
        f"SELECT instrument, date, {r('greatest(least(b - p, 100), 0)', 'data_quality_score')} FROM bars JOIN pen USING (instrument), base",
    ),
)
register(
    "as_of_time",
    "WIN-32",
    lambda s, sf: h.as_of_time(v.bars(s, sf)).select("instrument", "date", "as_of_time"),
    with_ctes([v.bars_sql()], "SELECT instrument, date, date AS as_of_time FROM bars"),
)
register(
    "ohlc_violations",
    "AGG-14",
    lambda s, sf: h.ohlc_violations(v.dirty_bars(s, sf)),
    with_ctes(
        v.dirty_bars_sql(),
        " UNION ALL ".join(
            f"SELECT '{n}' AS rule, count(*) AS n FROM bars WHERE {e}" for n, e in h.OHLC_RULES.items()
        ),
    ),
)

# ---- corporate events -----------------------------------------------------------------


def earnings(s, sf):
    return v.event_days(s, sf).where("event_type = 'signup'").select("instrument", "date")


def filings(s, sf):
    e = v.event_days(s, sf).where("event_type IN ('view', 'click', 'error')")
    form = F.when(F.col("event_type") == "view", "8-K").when(F.col("event_type") == "click", "10-K").otherwise("10-Q")
    return e.select("instrument", "date", form.alias("form_type"))


def trades(s, sf):
    e = v.event_days(s, sf).where("event_type IN ('purchase', 'error')")
    kind = F.when(F.col("event_type") == "purchase", F.when(F.col("k") % 2 == 0, "Purchase").otherwise("BUY")).otherwise("sale")
    return e.select("instrument", "date", kind.alias("transaction_type"), (F.col("value") * 10000).alias("value"))


def actions(s, sf):
    e = v.event_days(s, sf).where("event_type = 'signup'")
    kind = F.when(F.col("k") % 2 == 0, "dividend").otherwise("Split")
    ratio = F.when(F.col("k") % 3 == 0, F.concat_ws(":", F.col("k").cast("string"), F.lit("2"))).otherwise("n/a")
    return e.select("instrument", "date", kind.alias("action_type"), ratio.alias("ratio"))


_EARN = "earn AS (SELECT DISTINCT instrument, date FROM ev WHERE event_type = 'signup')"
_BASE = [v.EVENT_BARS_SQL, v.EVENT_DAYS_SQL]

register(
    "next_event_join",
    "JOIN-7 JOIN-11",
    lambda s, sf: ce.next_event(v.event_bars(s, sf).select("instrument", "date"), earnings(s, sf)),
    with_ctes(
        [*_BASE, _EARN],
        """SELECT b.instrument, b.date, CAST(min(e.date - b.date) AS INTEGER) AS days_to_earnings,
        coalesce(min(e.date - b.date) <= 3, false) AS earnings_week,
        b.instrument IN (SELECT instrument FROM earn) AS has_earnings_data
        FROM ebars b LEFT JOIN earn e ON e.instrument = b.instrument AND e.date >= b.date GROUP BY 1, 2""",
    ),
)
_FIL = """fil AS (SELECT instrument, date, CASE event_type WHEN 'view' THEN '8-K' WHEN 'click' THEN '10-K' ELSE '10-Q' END AS form_type
  FROM ev WHERE event_type IN ('view', 'click', 'error'))"""
register(
    "filing_proximity_join",
    "JOIN-8",
    lambda s, sf: ce.filing_flags(v.event_bars(s, sf).select("instrument", "date"), filings(s, sf)),
    with_ctes(
        [*_BASE, _FIL],
        "SELECT b.instrument, b.date, "
        + ", ".join(
            f"coalesce(bool_or(form_type = '{k}'), false) AS {n}"
            for n, k in (("recent_8k_filing", "8-K"), ("recent_10k_filing", "10-K"), ("recent_10q_filing", "10-Q"))
        )
        + """, b.instrument IN (SELECT instrument FROM fil) AS has_sec_filings
        FROM ebars b LEFT JOIN fil f ON f.instrument = b.instrument AND abs(f.date - b.date) <= 5 GROUP BY 1, 2""",
    ),
)
_TRD = """trd AS (SELECT instrument, date, CASE WHEN event_type = 'purchase' THEN CASE WHEN k % 2 = 0 THEN 'Purchase' ELSE 'BUY' END ELSE 'sale' END AS tt,
  value * 10000 AS value FROM ev WHERE event_type IN ('purchase', 'error'))"""
register(
    "insider_proximity_join",
    "JOIN-9",
    lambda s, sf: rounded(ce.insider_flags(v.event_bars(s, sf).select("instrument", "date"), trades(s, sf))),
    with_ctes(
        [*_BASE, _TRD],
        f"""SELECT b.instrument, b.date, coalesce(bool_or(lower(tt) IN ('purchase', 'buy')), false) AS recent_insider_buying,
        coalesce(bool_or(lower(tt) IN ('sale', 'sell')), false) AS recent_insider_selling,
        {r("coalesce(sum(CASE WHEN lower(tt) IN ('purchase', 'buy') THEN t.value ELSE -t.value END) / 1000000, 0)", 'insider_activity_score')},
        b.instrument IN (SELECT instrument FROM trd) AS has_insider_trading
        FROM ebars b LEFT JOIN trd t ON t.instrument = b.instrument AND abs(t.date - b.date) <= 7 GROUP BY 1, 2""",
    ),
)
_ACT = """act AS (SELECT instrument, date, k % 2 = 0 AS is_div, CASE WHEN k % 3 = 0 THEN k / 2.0 ELSE 1.0 END AS factor
  FROM ev WHERE event_type = 'signup'),
aday AS (SELECT instrument, date, bool_or(is_div) AS d, bool_or(NOT is_div) AS s, max(factor) FILTER (NOT is_div) AS factor FROM act GROUP BY 1, 2)"""
register(
    "corporate_action_join",
    "JOIN-10 FN-9",
    lambda s, sf: rounded(ce.action_flags(v.event_bars(s, sf).select("instrument", "date"), actions(s, sf))),
    with_ctes(
        [*_BASE, _ACT],
        f"""SELECT b.instrument, b.date, coalesce(bool_or(d AND a.date = b.date), false) AS ex_dividend_date,
        coalesce(bool_or(d), false) AS recent_dividend, coalesce(bool_or(s AND abs(a.date - b.date) <= 1), false) AS recent_split,
        {r("coalesce(arg_max(factor, a.date) FILTER (s AND abs(a.date - b.date) <= 1), 1.0)", 'split_adjustment_factor')},
        b.instrument IN (SELECT instrument FROM act) AS has_corporate_actions
        FROM ebars b LEFT JOIN aday a ON a.instrument = b.instrument AND abs(a.date - b.date) <= 3 GROUP BY 1, 2""",
    ),
)
register(
    "event_presence",
    "JOIN-11",
    lambda s, sf: ce.presence_flag(v.event_bars(s, sf).select("instrument", "date"), actions(s, sf), "has_event"),
    with_ctes(
        [*_BASE, _ACT],
        "SELECT instrument, date, instrument IN (SELECT instrument FROM act) AS has_event FROM ebars",
    ),
)


@query(
    "event_intensity",
    "WIN-50",
    with_ctes(
        [
            *_BASE,
            _EARN,
            _FIL,
            _TRD,
            """fl AS (SELECT b.instrument, b.date,
            (SELECT coalesce(min(e.date - b.date) <= 3, false) FROM earn e WHERE e.instrument = b.instrument AND e.date >= b.date) AS earnings_week,
            EXISTS (SELECT 1 FROM fil f WHERE f.instrument = b.instrument AND abs(f.date - b.date) <= 5 AND form_type = '8-K') AS f8,
            EXISTS (SELECT 1 FROM fil f WHERE f.instrument = b.instrument AND abs(f.date - b.date) <= 5 AND form_type = '10-K') AS f10,
            b.instrument IN (SELECT instrument FROM trd) AS ins FROM ebars b)""",
        ],
        """SELECT instrument, date, CAST(3 * CAST(earnings_week AS INTEGER) + 2 * CAST(f8 AS INTEGER) + 2 * CAST(f10 AS INTEGER)
        + CAST(ins AS INTEGER) AS INTEGER) AS corporate_event_intensity FROM fl""",
    ),
)
def _intensity(s, sf):
    b = v.event_bars(s, sf).select("instrument", "date")
    b = ce.insider_flags(ce.filing_flags(ce.next_event(b, earnings(s, sf)), filings(s, sf)), trades(s, sf))
    flags = ["earnings_week", "recent_8k_filing", "recent_10k_filing", "has_insider_trading"]
    return z.event_intensity(b, flags).select(
        "instrument", "date", F.col("corporate_event_intensity").cast("int").alias("corporate_event_intensity")
    )
