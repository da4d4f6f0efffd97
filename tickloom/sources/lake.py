"""Lake reader: filtered, pruned scans of parquet and JSON datasets.

Market and economic data are read from ``interval=/symbol=`` partitions or from one file per
symbol (``daily/AAPL.parquet``); the symbol comes from the path. Schemas are declared, so
no scan infers anything, and a corrupt file or record is skipped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.frames import nan_to_null
from tickloom.sources import filters as fl
from tickloom.sources import schemas as sc


class Lake:
    """``Lake(spark, root).get_market_data(["AAPL"], "daily")`` and friends."""

    def __init__(self, spark: SparkSession, root: str, layout: str = "partitions", json_lines: bool = True):
        if layout not in ("partitions", "files"):
            raise ValueError("layout is 'partitions' or 'files'")
        self.spark, self.root, self.layout, self.json_lines = spark, root.rstrip("/"), layout, json_lines

    # ---- parquet ----

    def _parquet(self, folder: str, schema: T.StructType, interval: str | None, symbols) -> DataFrame:
        reader = self.spark.read.option("ignoreCorruptFiles", True)
        if self.layout == "partitions":
            keys = [T.StructField("interval", T.StringType())] if interval else []
            keys.append(T.StructField("symbol", T.StringType()))
            df = reader.schema(T.StructType([*schema.fields, *keys])).parquet(f"{self.root}/{folder}")
            if interval:
                df = df.where(F.col("interval") == interval).drop("interval")
        else:
            path = f"{self.root}/{folder}/{interval}" if interval else f"{self.root}/{folder}"
            if symbols:
                reader = reader.option("pathGlobFilter", "{" + ",".join(symbols) + "}.parquet")
            name = F.regexp_extract("_metadata.file_name", r"^(.*)\.parquet$", 1)
            df = reader.schema(schema).parquet(path).withColumn("symbol", name)
        if symbols:
            df = df.where(F.col("symbol").isin(list(symbols)))
        return nan_to_null(df)

    def get_market_data(
        self,
        symbols: Sequence[str] | None = None,
        interval: str = "daily",
        date_range: fl.DateRange | None = None,
        **filters,
    ) -> DataFrame:
        f = fl.DataTypeFilter("market_data", interval, **filters)
        df = self._parquet("market_data", sc.BARS, interval, symbols)
        df = fl.indicator_projection(fl.market_predicates(df, f), sc.INDICATOR_COLUMNS, f)
        return df.where(date_range.predicate(F.col("date"))) if date_range else df

    def get_economic_data(
        self,
        indicators: Sequence[str] | None = None,
        date_range: fl.DateRange | None = None,
        category: str | None = None,
        importance: str | None = None,
        frequency: str | None = None,
    ) -> DataFrame:
        f = fl.DataTypeFilter(
            "economic_data", economic_category=category, importance=importance, frequency=frequency
        )
        df = fl.economic_predicates(self._parquet("economic_data", sc.ECONOMIC, None, indicators), f)
        return df.where(date_range.predicate(F.col("date"))) if date_range else df

    # ---- json ----

    def _raw_json(self, folder: str, schema: T.StructType, pattern: str | None = None) -> DataFrame:
        reader = (
            self.spark.read.schema(sc.with_corrupt(schema))
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", sc.CORRUPT)
            .option("ignoreCorruptFiles", True)
            .option("recursiveFileLookup", True)
            .option("multiLine", not self.json_lines)
        )
        if pattern:
            reader = reader.option("pathGlobFilter", pattern)
        return reader.json(f"{self.root}/{folder}")

    def _json(self, folder: str, schema: T.StructType, pattern: str | None = None) -> DataFrame:
        """Records of every file; rows that do not parse are dropped, the rest is kept. ``skipped_json`` counts them."""
        return self._raw_json(folder, schema, pattern).where(F.col(sc.CORRUPT).isNull()).drop(sc.CORRUPT)

    def get_news_data(
        self,
        symbols: Sequence[str] | None = None,
        date_range: fl.DateRange | None = None,
        sentiment_label: str | None = None,
        sources: Sequence[str] | None = None,
        **filters,
    ) -> DataFrame:
        f = fl.DataTypeFilter("news_data", sentiment_label=sentiment_label, sources=sources, **filters)
        df = fl.news_predicates(self._json("news_data", sc.NEWS), f, symbols)
        return df.where(date_range.predicate(F.col("published_at"))) if date_range else df

    def get_trends_data(
        self,
        keywords: Sequence[str] | None = None,
        date_range: fl.DateRange | None = None,
        geo: str | None = None,
        **filters,
    ) -> DataFrame:
        """One row per keyword and point of interest."""
        f = fl.DataTypeFilter("trends_data", geo=geo, **filters)
        df = self._json("trends_data", sc.TRENDS)
        if keywords:
            df = df.where(F.col("keyword").isin(list(keywords)))
        df = df.withColumn("_p", F.explode("search_interest")).select(
            "keyword",
            "symbol",
            "timeframe",
            "geo",
            "category",
            F.col("_p.date").alias("date"),
            F.col("_p.search_score").alias("search_score"),
        )
        df = fl.trends_predicates(df, f)
        return df.where(date_range.predicate(F.col("date"))) if date_range else df

    def _dated(self, folder, schema, symbols, kind, kinds, dates, date_range) -> DataFrame:
        df = self._json(folder, schema).withColumn("event_date", F.coalesce(*dates).cast("date"))
        if symbols:
            df = df.where(F.col("symbol").isin(list(symbols)))
        if kinds:
            df = df.where(kind.isin(list(kinds)))
        return df.where(date_range.predicate(F.col("event_date"))) if date_range else df

    def get_earnings_data(self, symbols=None, date_range=None, source: str | None = None) -> DataFrame:
        return self._dated(
            "earnings_data",
            sc.EARNINGS,
            symbols,
            F.col("source"),
            [source] if source else None,
            [F.col("date")],
            date_range,
        )

    def get_sec_filings(self, symbols=None, filing_types=None, date_range=None) -> DataFrame:
        kind = F.coalesce("form_type", "type")
        df = self._dated(
            "sec_filings",
            sc.FILINGS,
            symbols,
            kind,
            filing_types,
            [F.col("filing_date"), F.col("date")],
            date_range,
        )
        return df.withColumn("form_type", kind)

    def get_insider_trading(self, symbols=None, transaction_types=None, date_range=None) -> DataFrame:
        return self._dated(
            "insider_trading",
            sc.INSIDER,
            symbols,
            F.col("transaction_type"),
            transaction_types,
            [F.col("transaction_date"), F.col("date")],
            date_range,
        )

    def get_corporate_actions(self, symbols=None, action_types=None, date_range=None) -> DataFrame:
        kind = F.coalesce("action_type", "type")
        df = self._dated(
            "corporate_actions",
            sc.ACTIONS,
            symbols,
            kind,
            action_types,
            [F.col("effective_date"), F.col("date")],
            date_range,
        )
        return df.withColumn("action_type", kind)

    def catalog(self, name: str) -> DataFrame:
        """Instrument list stored as JSON records under ``catalog/``."""
        return self._json(f"catalog/{name}", sc.CATALOG)

    # ---- combined ----

    def query(self, q: fl.QueryFilter) -> DataFrame:
        """Scan each data type, union by name, then filter, sort and page: one lazy plan."""
        out = None
        for f in q.data_types:
            df = self._one(f)
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        if out is None:
            raise ValueError("no data type in the query")
        if q.instruments and "symbol" in out.columns:
            out = out.where(q.instruments.predicate(F.col("symbol")))
        if q.date_range and "date" in out.columns:
            out = out.where(q.date_range.predicate(F.col("date")))
        return fl.sort_page(out, q)

    def _one(self, f: fl.DataTypeFilter) -> DataFrame:
        if f.data_type == "market_data":
            df = self._parquet("market_data", sc.BARS, f.interval or "daily", None)
            return fl.indicator_projection(fl.market_predicates(df, f), sc.INDICATOR_COLUMNS, f)
        if f.data_type == "economic_data":
            return fl.economic_predicates(self._parquet("economic_data", sc.ECONOMIC, None, None), f)
        if f.data_type == "news_data":
            df = fl.news_predicates(self._json("news_data", sc.NEWS), f)
            return df.withColumn("date", F.col("published_at").cast("timestamp"))
        if f.data_type == "trends_data":
            df = self.get_trends_data(geo=f.geo, category=f.category, min_search_interest=f.min_search_interest)
            return df.withColumn("date", F.col("date").cast("timestamp"))
        get = {
            "earnings_data": self.get_earnings_data,
            "sec_filings": self.get_sec_filings,
            "insider_trading": self.get_insider_trading,
            "corporate_actions": self.get_corporate_actions,
        }[f.data_type]
        return get().withColumn("date", F.col("event_date").cast("timestamp")).drop("event_date")

    # ---- what a scan leaves out ----

    def skipped_parquet(self, folder: str, schema: T.StructType) -> DataFrame:
        """(path, length, n_records, n_broken, n_unkeyed, reason): parquet files that a scan of ``folder`` leaves out.

        The files that give rows are counted from their footers, without a column; the others of the listing are ``no rows``: the footer
        is broken, or the file was written without rows. Files without any byte hold nothing and are not listed.
        """
        reader = self.spark.read.option("ignoreCorruptFiles", True).option("recursiveFileLookup", True)
        read = reader.schema(schema).parquet(f"{self.root}/{folder}").groupBy(F.col("_metadata.file_path").alias("_at")).count()
        none = F.lit(0).cast("bigint")
        return self._left_out(folder, read.select("_at", F.col("count").alias("n_records"), none.alias("n_broken"), none.alias("n_unkeyed")))

    def skipped_json(self, folder: str, schema: T.StructType) -> DataFrame:
        """As ``skipped_parquet`` for JSON files, with those of which some records are left out or lack the key, the first column of ``schema``.

        Records that are not JSON count as broken, whatever the other columns hold.
        """
        key, torn = F.col(schema.fieldNames()[0]), F.col(sc.CORRUPT).isNotNull()
        records = self._raw_json(folder, schema).select(F.col("_metadata.file_path").alias("_at"), torn.alias("torn"), key.isNull().alias("bare"))
        counts = (F.count_if("torn").alias("n_broken"), F.count_if(F.col("bare") & ~F.col("torn")).alias("n_unkeyed"))
        return self._left_out(folder, records.groupBy("_at").agg(F.count(F.lit(1)).alias("n_records"), *counts))

    def _left_out(self, folder: str, read: DataFrame) -> DataFrame:
        listing = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{self.root}/{folder}")
        at = F.col("_metadata.file_path")  # both sides name a file alike, with the same escapes
        files = listing.select(at.alias("_at"), F.col("path"), F.col("length")).where(~F.col("path").rlike(r"/[_.][^/]*$"))
        met = files.join(read, "_at", "left")
        reason = (
            F.when(F.col("n_records").isNull(), "no rows")
            .when(F.col("n_broken") == F.col("n_records"), "no record parses")
            .when(F.col("n_broken") > 0, "broken records")
            .when(F.col("n_unkeyed") > 0, "records without key")
        )
        counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_records", "n_broken", "n_unkeyed")]
        return met.select("path", "length", *counts, reason.alias("reason")).where("reason IS NOT NULL")

    # ---- listings ----

    def _files(self, folder: str) -> DataFrame:
        """Path and size of every file; the content column is pruned, so nothing is read."""
        return (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(f"{self.root}/{folder}")
            .select("path", "length")
            .where(~F.col("path").rlike(r"/[_.][^/]*$"))
        )

    def _parts(self, folder: str) -> DataFrame:
        if self.layout == "partitions":
            sym, itv = r"/symbol=([^/]+)/", r"/interval=([^/]+)/"
        else:
            sym, itv = r"/([^/]+)\.parquet$", r"/market_data/([^/]+)/"
        return self._files(folder).select(
            F.regexp_extract("path", itv, 1).alias("interval"),
            F.regexp_extract("path", sym, 1).alias("symbol"),
            "path",
            "length",
        )

    def list_available_symbols(self, data_type: str = "market_data", interval: str | None = "daily") -> DataFrame:
        if data_type == "market_data":
            df = self._parts("market_data")
            return (df.where(F.col("interval") == interval) if interval else df).select("symbol").distinct()
        if data_type == "economic_data":
            return self._parts("economic_data").select("symbol").distinct()
        if data_type == "news_data":
            return self.get_news_data().select(F.explode("symbols").alias("symbol")).distinct()
        return self._one(fl.DataTypeFilter(data_type)).select("symbol").distinct()

    def inventory(self) -> DataFrame:
        """Symbols per interval."""
        return self._parts("market_data").groupBy("interval").agg(F.countDistinct("symbol").alias("symbols"))

    def storage_usage(self) -> DataFrame:
        return self._parts("market_data").groupBy("interval").agg(
            F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
        )
