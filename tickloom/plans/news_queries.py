"""Queries for news, text sentiment and daily sentiment."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import news as nw
from tickloom.plans import views as v
from tickloom.plans.registry import query, r, register, rounded, with_ctes

_A = [v.ARTICLES_SQL]


def _symbol_news(s, sf):
    """Per-symbol articles with headline and label; a source stands in for the placeholder."""
    a = v.articles(s, sf)
    score = F.coalesce("sentiment", F.lit(0.0))
    return a.select(
        "article_id",
        F.col("instrument").alias("symbol"),
        F.when(F.col("lang") != "de", F.col("date")).alias("date"),
        F.when(F.col("source") == "src4", "test_source").otherwise(F.col("source")).alias("source"),
        F.when(F.col("source") == "src5", F.concat(F.lit("Sample news headline "), F.substring_index("text", ".", 1)))
        .when(F.col("source") == "src6", F.lit(" "))
        .otherwise(F.substring_index("text", ".", 1))
        .alias("headline"),
        nw.sentiment_label(score).alias("sentiment_label"),
    )


_SN = """
sn AS (
  SELECT article_id, instrument AS symbol, CASE WHEN lang <> 'de' THEN date END AS date,
    CASE WHEN source = 'src4' THEN 'test_source' ELSE source END AS source,
    CASE WHEN source = 'src5' THEN 'Sample news headline ' || split_part(text, '.', 1) WHEN source = 'src6' THEN ' ' ELSE split_part(text, '.', 1) END AS headline,
    CASE WHEN coalesce(sentiment, 0) > 0.1 THEN 'positive' WHEN coalesce(sentiment, 0) < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment_label
  FROM articles),
fl AS (SELECT *, source IN ('sample_news_generator', 'test_source', 'dummy_source') OR headline LIKE '%Sample news headline%' OR headline LIKE '%Test headline%'
   OR headline LIKE '%Dummy news%' OR headline LIKE '%Example article%' AS dummy FROM sn)"""

register(
    "news_text_filter",
    "SEL-11 FN-3",
    lambda s, sf: nw.filter_news(v.articles(s, sf), text="text", dedupe="text", language="en").select("article_id", "date", "instrument"),
    with_ctes(
        _A,
        """SELECT article_id, date, instrument FROM (SELECT * FROM articles WHERE length(text) BETWEEN 50 AND 5000
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY article_id) = 1) WHERE lang = 'en'""",
    ),
)
register(
    "placeholder_filter",
    "SEL-12",
    lambda s, sf: _symbol_news(s, sf).where(~nw.is_placeholder(F.col("source"), F.col("headline"))).select("article_id", "source"),
    with_ctes([*_A, _SN], "SELECT article_id, source FROM fl WHERE NOT dummy"),
)
register(
    "collected_news_gate",
    "SEL-13",
    lambda s, sf: nw.collected_gate(_symbol_news(s, sf), F.col("headline"), "the").select("article_id"),
    with_ctes([*_A, _SN], "SELECT article_id FROM sn WHERE length(trim(headline)) >= 20 AND lower(headline) LIKE '%the%'"),
)
_POS = " + ".join(f"CAST(contains(lower(text), '{w}') AS INTEGER)" for w in nw.POSITIVE_WORDS)
_NEG = " + ".join(f"CAST(contains(lower(text), '{w}') AS INTEGER)" for w in nw.NEGATIVE_WORDS)
_LEX = f"""
hit AS (SELECT article_id, text, {_POS} AS p, {_NEG} AS n FROM articles),
lex AS (SELECT article_id, CASE WHEN p + n > 0 THEN (p - n) / (p + n) ELSE 0.0 END AS s FROM hit)"""
register(
    "lexicon_sentiment",
    "ML-21",
    lambda s, sf: rounded(v.articles(s, sf).select("article_id", nw.lexicon_score(F.col("text")).alias("sentiment_score"))),
    with_ctes([*_A, _LEX], f"SELECT article_id, {r('s', 'sentiment_score')} FROM lex"),
)
register(
    "sentiment_label",
    "FN-12",
    lambda s, sf: rounded(
        nw.with_label(v.articles(s, sf).withColumn("sentiment_score", nw.lexicon_score(F.col("text")))).select(
            "article_id", "sentiment_score", "sentiment_label", "confidence"
        )
    ),
    with_ctes(
        [*_A, _LEX],
        f"""SELECT article_id, {r('s', 'sentiment_score')}, CASE WHEN s > 0.1 THEN 'positive' WHEN s < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
        {r('abs(s)', 'confidence')} FROM lex""",
    ),
)


# ---- rule-based polarity with a lexicon Spark derives from the labelled articles ----------------


def _lexicon(s, sf):
    words = v.articles(s, sf).where("sentiment IS NOT NULL").select(
        "article_id", "sentiment", F.explode(F.array_distinct(nw.tokens(F.col("text")))).alias("token")
    )
    return (
        words.groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("sentiment") * 4 - 2, 3).alias("valence"))
        .where("n >= 20")
        .select("token", "valence")
    )


_TOK = """
tk AS (SELECT article_id, sentiment, list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda w: w <> '') AS w FROM articles),
lexi AS (SELECT token, round(avg(sentiment) * 4 - 2, 3) AS valence FROM (SELECT article_id, sentiment, unnest(list_distinct(w)) AS token FROM tk WHERE sentiment IS NOT NULL)
  GROUP BY 1 HAVING count(*) >= 20),
pos AS (SELECT article_id, w[i] AS token, CASE WHEN i > 1 THEN w[i - 1] END AS before FROM (SELECT article_id, w, unnest(generate_series(1, len(w))) AS i FROM tk)),
val AS (SELECT article_id, CASE WHEN before IN ('not', 'no', 'never', 'neither', 'without') THEN -0.74 ELSE 1.0 END *
  CASE WHEN before IN ('very', 'extremely', 'really', 'so', 'highly') THEN valence + sign(valence) * 0.293 ELSE valence END AS x FROM pos JOIN lexi USING (token)),
pol AS (SELECT a.article_id, a.sentiment, coalesce(s / sqrt(s * s + 15), 0) AS polarity FROM articles a LEFT JOIN (SELECT article_id, sum(x) AS s FROM val GROUP BY 1) USING (article_id))"""
register(
    "rule_based_polarity",
    "ML-22",
    lambda s, sf: rounded(nw.polarity_scores(v.articles(s, sf), _lexicon(s, sf))),
    with_ctes([*_A, _TOK], f"SELECT article_id, {r('polarity', 'polarity')} FROM pol"),
)


@query(
    "sentiment_evaluation",
    "ML-23",
    with_ctes(
        [*_A, _TOK],
        f"""SELECT count(sentiment) AS n, {r('corr(polarity, sentiment)', 'correlation', 5)},
        {r("avg(CASE WHEN sentiment IS NOT NULL THEN CAST((CASE WHEN polarity > 0.1 THEN 1 WHEN polarity < -0.1 THEN -1 ELSE 0 END) = sign(sentiment) AS INTEGER) END)", 'accuracy', 5)} FROM pol""",
    ),
)
def _evaluate(s, sf):
    a = v.articles(s, sf)
    p = nw.polarity_scores(a, _lexicon(s, sf)).join(a.select("article_id", "sentiment"), "article_id").where("sentiment IS NOT NULL")
    label = F.when(F.col("polarity") > 0.1, 1).when(F.col("polarity") < -0.1, -1).otherwise(0)
    return rounded(
        p.agg(
            F.count("sentiment").alias("n"),
            F.corr("polarity", "sentiment").alias("correlation"),
            F.avg((label == F.signum("sentiment")).cast("double")).alias("accuracy"),
        ),
        5,
    )


@query(
    "provider_sentiment",
    "FN-13",
    with_ctes(
        [*_A, _LEX],
        f"""SELECT article_id, {r("CASE WHEN src_hit THEN 0.5 * rel ELSE s END", 'score')}, CASE WHEN src_hit THEN 'bullish'
        WHEN s > 0.1 THEN 'positive' WHEN s < -0.1 THEN 'negative' ELSE 'neutral' END AS label
        FROM (SELECT article_id, s, hour / 24.0 AS rel, instrument IN ('3', CAST(hour AS VARCHAR)) AS src_hit FROM articles JOIN lex USING (article_id))""",
    ),
)
def _provider(s, sf):
    def entry(ticker):
        return F.struct(
            ticker.alias("ticker"),
            (F.col("hour") / 24.0).alias("relevance"),
            F.lit(0.5).alias("score"),
            F.lit("Bullish").alias("label"),
        )

    a = v.articles(s, sf).withColumn("entries", F.array(entry(F.lit("3")), entry(F.col("hour").cast("string"))))
    got = nw.provider_sentiment(F.col("entries"), F.col("instrument"), nw.lexicon_score(F.col("text")))
    return rounded(a.select("article_id", got.alias("g")).select("article_id", "g.score", "g.label"))


_W = "PARTITION BY instrument ORDER BY date"


@query(
    "ensemble_sentiment",
    "WIN-63",
    with_ctes(
        [*_A, _LEX],
        f"""SELECT article_id, {r("CASE WHEN sentiment IS NOT NULL AND n_chars > 0 THEN (sentiment + s) / 2 ELSE s END", 'score')}
        FROM (SELECT article_id, sentiment, s, length(text) AS n_chars FROM articles JOIN lex USING (article_id))""",
    ),
)
def _ensemble(s, sf):
    a = v.articles(s, sf).withColumns({"lexicon": nw.lexicon_score(F.col("text"))})
    return rounded(a.select("article_id", nw.ensemble_score(["sentiment", "lexicon"], "lexicon").alias("score")))


# source weights: fixed values of the stand-in data
_WEIGHTS = {"src1": 1.2, "src2": 0.8, "src3": 0.5}


@query(
    "source_reliability",
    "JOIN-17",
    with_ctes(
        _A,
        f"""SELECT article_id, source, {r("CASE source WHEN 'src1' THEN 1.2 WHEN 'src2' THEN 0.8 WHEN 'src3' THEN 0.5 ELSE 1.0 END", 'source_weight')},
        {r("sentiment * CASE source WHEN 'src1' THEN 1.2 WHEN 'src2' THEN 0.8 WHEN 'src3' THEN 0.5 ELSE 1.0 END", 'weighted')} FROM articles""",
    ),
)
def _reliability(s, sf):
    table = s.createDataFrame(list(_WEIGHTS.items()), "source string, source_weight double")
    a = nw.reliability_weights(v.articles(s, sf), table)
    return rounded(a.select("article_id", "source", "source_weight", (F.col("sentiment") * F.col("source_weight")).alias("weighted")))


# ---- daily aggregation -----------------------------------------------------------------------


def _scored(s, sf):
    """Articles scored by value: events give dense groups, with NULL scores among them."""
    e = v.table(s, sf, "events")
    return e.select(
        F.col("event_type").alias("source"),
        (F.col("user_id") % 20).cast("string").alias("instrument"),
        F.col("ts").cast("date").alias("date"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("value") < 150, F.sin("value")).alias("sentiment"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("importance"),
        F.col("event_id").alias("article_id"),
    )


_SC = """
sc AS (SELECT event_id AS article_id, event_type AS source, CAST(user_id % 20 AS VARCHAR) AS instrument, CAST(ts AS DATE) AS date, ts,
  CASE WHEN value < 150 THEN sin(value) END AS sentiment, CASE WHEN event_type <> 'view' THEN value END AS importance FROM events),
live AS (SELECT instrument, date, count(*) AS article_count FROM sc GROUP BY 1, 2 HAVING count(sentiment) > 0)"""


def _daily(name, covers, exprs, digits=6):
    def run(s, sf):
        return rounded(nw.daily_sentiment(_scored(s, sf)).select("instrument", "date", *exprs), digits)

    ints = {"article_count", "unique_sources"}
    body = ", ".join(f"{e} AS {c}" if c in ints else r(e, c, digits) for c, e in exprs.items())
    register(
        name, covers, run, with_ctes([_SC], f"SELECT instrument, date, {body} FROM sc JOIN live USING (instrument, date) GROUP BY 1, 2")
    )


_daily(
    "daily_sentiment",
    "AGG-4",
    {
        "article_count": "count(*)",
        "unique_sources": "count(DISTINCT source)",
        "sentiment_mean": "avg(sentiment)",
        "sentiment_std": "coalesce(stddev_samp(sentiment), 0)",
        "sentiment_median": "quantile_cont(sentiment, 0.5)",
        "sentiment_min": "min(sentiment)",
        "sentiment_max": "max(sentiment)",
    },
)
_daily(
    "sentiment_polarity_split",
    "AGG-5",
    {
        "positive_pct": "count(*) FILTER (sentiment > 0.1) / count(sentiment)",
        "negative_pct": "count(*) FILTER (sentiment < -0.1) / count(sentiment)",
        "neutral_pct": "1 - count(*) FILTER (sentiment > 0.1) / count(sentiment) - count(*) FILTER (sentiment < -0.1) / count(sentiment)",
    },
)
_daily("sentiment_skew", "AGG-6", {"sentiment_skew": "skewness(sentiment)"})
register(
    "recency_weighted_sentiment",
    "AGG-7",
    lambda s, sf: rounded(nw.daily_sentiment(_scored(s, sf)).select("instrument", "date", "sentiment_recency_weighted")),
    with_ctes(
        [_SC, "wt AS (SELECT *, exp(-0.1 * (epoch_us(max(ts) OVER (PARTITION BY instrument, date)) - epoch_us(ts)) / 3.6e9) AS w FROM sc)"],
        f"""SELECT instrument, date, {r('sum(w * sentiment) / sum(w) FILTER (sentiment IS NOT NULL)', 'sentiment_recency_weighted')}
        FROM wt JOIN live USING (instrument, date) GROUP BY 1, 2""",
    ),
)
_daily(
    "importance_weighted_sentiment",
    "AGG-8",
    {"sentiment_volume_weighted": "sum(coalesce(importance, 1) * sentiment) / sum(coalesce(importance, 1)) FILTER (sentiment IS NOT NULL)"},
)
_daily("news_shock", "AGG-9", {"news_shock": "least(count(*) / 5.0, 2)"})


def _avg(c, n):
    return f"CASE WHEN count({c}) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) = {n} THEN avg({c}) OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END"


_DAY = "dy AS (SELECT instrument, date, avg(sentiment) AS m, count(*) AS c FROM sc JOIN live USING (instrument, date) GROUP BY 1, 2)"
_MA = (3, 7, 14, 30)
register(
    "sentiment_averages",
    "WIN-61",
    lambda s, sf: rounded(
        nw.sentiment_averages(nw.daily_sentiment(_scored(s, sf))).select(
            "instrument", "date", *[f"{p}_{n}d" for n in _MA for p in ("sentiment_ma", "article_count_ma", "sentiment_momentum")]
        )
    ),
    with_ctes(
        [_SC, _DAY],
        "SELECT instrument, date, "
        + ", ".join(
            f"{r(_avg('m', n), f'sentiment_ma_{n}d')}, {r(_avg('c', n), f'article_count_ma_{n}d')}, {r(f'm - {_avg(chr(109), n)}', f'sentiment_momentum_{n}d')}"
            for n in _MA
        )
        + " FROM dy",
    ),
)
register(
    "sentiment_changes",
    "WIN-62",
    lambda s, sf: rounded(
        nw.sentiment_changes(nw.daily_sentiment(_scored(s, sf))).select(
            "instrument", "date", "sentiment_change_1d", "article_count_change_1d", "sentiment_volatility_7d"
        )
    ),
    with_ctes(
        [_SC, _DAY],
        f"""SELECT instrument, date, {r(f'm - lag(m) OVER ({_W})', 'sentiment_change_1d')}, c - lag(c) OVER ({_W}) AS article_count_change_1d,
        {r(f'CASE WHEN count(m) OVER ({_W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) = 7 THEN stddev_samp(m) OVER ({_W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) END', 'sentiment_volatility_7d')} FROM dy""",
    ),
)


@query(
    "sentiment_merge",
    "JOIN-4",
    with_ctes(
        [v.EVENT_BARS_SQL, _SC, _DAY],
        f"SELECT instrument, date, volume, {r('m', 'sentiment_mean')}, c AS article_count FROM ebars LEFT JOIN dy USING (instrument, date)",
    ),
)
def _merge(s, sf):
    d = nw.daily_sentiment(_scored(s, sf)).select("instrument", "date", "sentiment_mean", "article_count")
    b = v.event_bars(s, sf).select("instrument", "date", "volume")
    return rounded(b.join(d, ["instrument", "date"], "left"))


# ---- reports -----------------------------------------------------------------------------------

register(
    "news_coverage",
    "AGG-25",
    lambda s, sf: rounded(nw.news_coverage(_symbol_news(s, sf))),
    with_ctes(
        [*_A, _SN],
        f"""SELECT symbol, count(*) AS total_articles, count(*) FILTER (NOT dummy) AS real_articles, count(*) FILTER (dummy) AS dummy_articles,
        {r('count(*) FILTER (dummy) * 100.0 / count(*)', 'contamination_rate')}, count(*) FILTER (NOT dummy AND trim(headline) = '') AS empty_headlines,
        count(*) FILTER (NOT dummy AND length(headline) < 10) AS short_headlines, count(*) FILTER (NOT dummy AND date IS NULL) AS missing_dates FROM fl GROUP BY 1""",
    ),
)
register(
    "news_distributions",
    "AGG-25 AGG-32",
    lambda s, sf: nw.news_distributions(_symbol_news(s, sf)),
    with_ctes(
        [*_A, _SN],
        """SELECT 'source' AS dimension, source AS value, count(*) AS n FROM sn GROUP BY source UNION ALL SELECT 'sentiment_label', sentiment_label, count(*) FROM sn GROUP BY sentiment_label
        UNION ALL SELECT 'month', strftime(date, '%Y-%m'), count(*) FROM sn GROUP BY 2 UNION ALL SELECT 'total', 'all', count(*) FROM sn""",
    ),
)
register(
    "news_quality",
    "AGG-31",
    lambda s, sf: rounded(nw.news_quality(_symbol_news(s, sf), 51, 50)),
    with_ctes(
        [*_A, _SN, "per AS (SELECT symbol, count(*) AS n FROM sn GROUP BY 1)"],
        f"""SELECT count(*) AS symbols_with_news, CAST(sum(n) AS BIGINT) AS total_articles, {r('avg(n)', 'average_articles_per_symbol')},
        count(*) FILTER (n >= 51) AS good_coverage, count(*) FILTER (n < 50) AS poor_coverage FROM per""",
    ),
)
register(
    "collection_report",
    "AGG-32",
    lambda s, sf: nw.collection_report(_symbol_news(s, sf)),
    with_ctes(
        [*_A, _SN],
        """SELECT count(*) AS total_articles, min(date) AS earliest, max(date) AS latest, count(DISTINCT symbol) AS symbols_processed,
        count(*) FILTER (sentiment_label = 'positive') AS positive, count(*) FILTER (sentiment_label = 'negative') AS negative,
        count(*) FILTER (sentiment_label = 'neutral') AS neutral FROM sn""",
    ),
)
