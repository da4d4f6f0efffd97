"""News cleaning, text sentiment and daily sentiment per instrument."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.frames import KEYS, ORDER, prior, roll_mean, roll_std, row_mean
from tickloom.functions.ranks import quantiles

# words of the lexicon score: fixed values
POSITIVE_WORDS = ("good", "great", "excellent", "positive", "up", "rise", "gain", "profit", "growth")
NEGATIVE_WORDS = ("bad", "terrible", "negative", "down", "fall", "loss", "decline", "drop")
# placeholder articles: fixed values
DUMMY_SOURCES = ("sample_news_generator", "test_source", "dummy_source")
DUMMY_HEADLINES = ("Sample news headline", "Test headline", "Dummy news", "Example article")
LABEL_EDGE = 0.1
DECAY = 0.1


def filter_news(
    df: DataFrame,
    text: str = "content",
    dedupe: str = "url",
    order: Sequence[str] = ("article_id",),
    language: str | None = None,
    required: Sequence[str] = ("date", "instrument"),
    shortest: int = 50,
    longest: int = 5_000,
) -> DataFrame:
    """Length band, first article per ``dedupe`` value, language, required keys.

    Winners are picked on a hash of the dedupe column with a map-side combined ``min``, so
    copies of one article never meet in one task and texts are not shuffled for it.
    """
    kept = df.where(F.length(F.coalesce(F.col(text), F.lit(""))).between(shortest, longest))
    kept = kept.withColumn("_k", F.sha2(F.col(dedupe).cast("string"), 256))
    first = kept.groupBy("_k").agg(F.min(F.struct(*order)).alias("_o")).select("_o.*")
    kept = kept.join(first, list(order), "left_semi").drop("_k")
    if language:
        kept = kept.where(F.col("lang") == language)
    return kept.dropna("any", subset=list(required))


def is_placeholder(source: Column, headline: Column) -> Column:
    hit = source.isin(*DUMMY_SOURCES)
    for p in DUMMY_HEADLINES:
        hit = hit | headline.contains(p)
    return F.coalesce(hit, F.lit(False))


def collected_gate(df: DataFrame, headline: str, must_have: str | None = None) -> DataFrame:
    out = df.where(F.length(F.trim(headline)) >= 20)
    return out.where(F.lower(headline).contains(must_have)) if must_have else out


def sentiment_label(score: Column) -> Column:
    return F.when(score > LABEL_EDGE, "positive").when(score < -LABEL_EDGE, "negative").otherwise("neutral")


def with_label(df: DataFrame, score: str = "sentiment_score") -> DataFrame:
    return df.withColumns(
        {"sentiment_label": sentiment_label(F.col(score)), "confidence": F.abs(score)}
    )


def lexicon_score(text: Column) -> Column:
    """(pos - neg) / (pos + neg) over word presence; whole text, inside codegen."""
    low = F.lower(text)

    def hits(words: Sequence[str]) -> Column:
        return sum((F.contains(low, F.lit(w)).cast("int") for w in words), F.lit(0))

    pos, neg = hits(POSITIVE_WORDS), hits(NEGATIVE_WORDS)
    return F.when(pos + neg > 0, (pos - neg) / (pos + neg)).otherwise(0.0)


# words of the rule-based score: fixed values
NEGATIONS = ("not", "no", "never", "neither", "without")
BOOSTERS = ("very", "extremely", "really", "so", "highly")
NEGATION_FACTOR, BOOST = -0.74, 0.293


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z]+"), lambda w: w != "")


def polarity_scores(df: DataFrame, lexicon: DataFrame, key: str = "article_id", text: str = "text") -> DataFrame:
    """Rule-based polarity s / sqrt(s^2 + 15) per article, 0 without a lexicon word.

    ``lexicon`` has token and valence. Each token carries its predecessor, so negation and
    boosters need no window; the lexicon join drops the other tokens before any shuffle.
    """
    words = df.select(key, tokens(F.col(text)).alias("_w"))
    flat = words.select(
        key,
        F.inline(
            F.transform("_w", lambda w, i: F.struct(w.alias("token"), F.get("_w", i - 1).alias("before")))
        ),
    )
    v = F.col("valence")
    boosted = F.when(F.col("before").isin(*BOOSTERS), v + F.signum(v) * BOOST).otherwise(v)
    signed = F.when(F.col("before").isin(*NEGATIONS), boosted * NEGATION_FACTOR).otherwise(boosted)
    sums = flat.join(lexicon.select("token", "valence"), "token").groupBy(key).agg(F.sum(signed).alias("_s"))
    s = F.col("_s")
    return df.select(key).join(sums, key, "left").select(
        key, F.coalesce(s / F.sqrt(s * s + 15), F.lit(0.0)).alias("polarity")
    )


def provider_sentiment(entries: Column, symbol: Column, fallback: Column) -> Column:
    """Struct(score, label) from the provider's entry of the ticker, else the text score."""
    hit = F.try_element_at(F.filter(entries, lambda e: e["ticker"] == symbol), F.lit(1))
    score = F.coalesce(hit["relevance"], F.lit(0.0)) * F.coalesce(hit["score"], F.lit(0.0))
    return F.when(
        hit.isNotNull(),
        F.struct(score.alias("score"), F.lower(F.coalesce(hit["label"], F.lit("neutral"))).alias("label")),
    ).otherwise(F.struct(fallback.alias("score"), sentiment_label(fallback).alias("label")))


def ensemble_score(columns: Sequence[str], primary: str) -> Column:
    """Mean of the model scores a row has, else the primary model's."""
    return F.coalesce(row_mean([F.col(c) for c in columns]), F.col(primary), F.lit(0.0))


def reliability_weights(df: DataFrame, weights: DataFrame) -> DataFrame:
    """Source weight, 1.0 for unknown sources."""
    return df.join(weights, "source", "left").withColumn(
        "source_weight", F.coalesce("source_weight", F.lit(1.0))
    )


# ---- daily aggregation -------------------------------------------------------------------


def unbiased_skew(x: Column) -> Column:
    """Bias-corrected skewness, NULL below three values, 0 without spread."""
    n = F.count(x)
    g = F.skewness(x)
    return F.when(
        n >= 3, F.when(F.var_pop(x) > 0, g * F.sqrt(n * (n - 1)) / (n - 2)).otherwise(0.0)
    )


def daily_sentiment(
    news: DataFrame,
    min_articles: int = 1,
    decay: float = DECAY,
    timestamp: str | None = "ts",
    importance: str | None = "importance",
) -> DataFrame:
    """One row per instrument and date.

    Every sum combines map-side. The recency weight exp(-decay * hours to the group's last
    article) needs the group's latest time first, so that is a small joined aggregate.
    """
    group = ["instrument", "date"]
    x = F.col("sentiment")
    med = quantiles(news, group, "sentiment", [0.5], ["sentiment_median"])
    rows = news
    extra = []
    if timestamp:
        last = news.groupBy(*group).agg(F.max(timestamp).alias("_last"))
        hours = (F.unix_micros(F.col("_last")) - F.unix_micros(F.col(timestamp))) / 3.6e9
        rows = rows.join(last, group)
        rw = F.when(x.isNotNull(), F.exp(-decay * hours))
        extra.append(F.try_divide(F.sum(rw * x), F.sum(rw)).alias("sentiment_recency_weighted"))
    if importance:
        iw = F.when(x.isNotNull(), F.coalesce(F.col(importance), F.lit(1.0)))
        extra.append(F.try_divide(F.sum(iw * x), F.sum(iw)).alias("sentiment_volume_weighted"))
    pos = F.avg(F.when(x.isNotNull(), (x > LABEL_EDGE).cast("double")))
    neg = F.avg(F.when(x.isNotNull(), (x < -LABEL_EDGE).cast("double")))
    out = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("article_count"),
        F.countDistinct("source").alias("unique_sources"),
        F.avg(x).alias("sentiment_mean"),
        F.coalesce(F.stddev_samp(x), F.lit(0.0)).alias("sentiment_std"),
        F.min(x).alias("sentiment_min"),
        F.max(x).alias("sentiment_max"),
        pos.alias("positive_pct"),
        neg.alias("negative_pct"),
        (1 - pos - neg).alias("neutral_pct"),
        unbiased_skew(x).alias("sentiment_skew"),
        F.least(F.count(F.lit(1)) / 5.0, F.lit(2.0)).alias("news_shock"),
        *extra,
    )
    return out.where((F.col("article_count") >= min_articles) & F.col("sentiment_mean").isNotNull()).join(
        med, group
    )


def sentiment_averages(df: DataFrame, windows: Sequence[int] = (3, 7, 14, 30), keys=KEYS, order=ORDER) -> DataFrame:
    out = {}
    for n in windows:
        ma = roll_mean(F.col("sentiment_mean"), n, keys, order)
        out[f"sentiment_ma_{n}d"] = ma
        out[f"article_count_ma_{n}d"] = roll_mean(F.col("article_count"), n, keys, order)
        out[f"sentiment_momentum_{n}d"] = F.col("sentiment_mean") - ma
    return df.withColumns(out)


def sentiment_changes(df: DataFrame, keys=KEYS, order=ORDER) -> DataFrame:
    s, c = F.col("sentiment_mean"), F.col("article_count")
    return df.withColumns(
        {
            "sentiment_change_1d": s - prior(s, 1, keys, order),
            "article_count_change_1d": c - prior(c, 1, keys, order),
            "sentiment_volatility_7d": roll_std(s, 7, keys, order),
        }
    )


# ---- reports -------------------------------------------------------------------------------


def news_coverage(df: DataFrame) -> DataFrame:
    """Per symbol: real and placeholder articles and field problems of the real ones."""
    dummy = is_placeholder(F.col("source"), F.col("headline"))
    real = ~dummy
    return df.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("total_articles"),
        F.count_if(real).alias("real_articles"),
        F.count_if(dummy).alias("dummy_articles"),
        (F.avg(dummy.cast("double")) * 100).alias("contamination_rate"),
        F.count_if(real & (F.trim("headline") == "")).alias("empty_headlines"),
        F.count_if(real & (F.length("headline") < 10)).alias("short_headlines"),
        F.count_if(real & F.col("date").isNull()).alias("missing_dates"),
    )


def news_distributions(df: DataFrame) -> DataFrame:
    """Counts by source, label, month and in total: one grouping-sets pass."""
    rows = df.select("source", "sentiment_label", F.date_format("date", "yyyy-MM").alias("month"))
    dims = ["source", "sentiment_label", "month"]
    grouped = rows.groupingSets([[F.col(d)] for d in dims] + [[]], *[F.col(d) for d in dims]).agg(
        F.count(F.lit(1)).alias("n"), *[F.grouping(d).alias(f"_g_{d}") for d in dims]
    )
    kind, value = F.lit("total"), F.lit("all")
    for d in dims:
        kind = F.when(F.col(f"_g_{d}") == 0, d).otherwise(kind)
        value = F.when(F.col(f"_g_{d}") == 0, F.col(d)).otherwise(value)
    return grouped.select(kind.alias("dimension"), value.alias("value"), "n")


def news_quality(df: DataFrame, good: int = 10, poor: int = 5) -> DataFrame:
    per = df.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(
        F.count(F.lit(1)).alias("symbols_with_news"),
        F.sum("_n").alias("total_articles"),
        F.avg("_n").alias("average_articles_per_symbol"),
        F.count_if(F.col("_n") >= good).alias("good_coverage"),
        F.count_if(F.col("_n") < poor).alias("poor_coverage"),
    )


def collection_report(df: DataFrame) -> DataFrame:
    symbols = df.select("symbol").distinct().agg(F.count(F.lit(1)).alias("symbols_processed"))
    return df.agg(
        F.count(F.lit(1)).alias("total_articles"),
        F.min("date").alias("earliest"),
        F.max("date").alias("latest"),
        *[F.count_if(F.col("sentiment_label") == k).alias(k) for k in ("positive", "negative", "neutral")],
    ).crossJoin(symbols)
