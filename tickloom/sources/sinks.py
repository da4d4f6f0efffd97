"""Writers: partitioned parquet, JSON reports and the news upsert."""

from __future__ import annotations

from datetime import date as Date
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts that the new articles of one day are written in, so that a busy day is not one task.
DAY_PARTS = 8


def write_bars(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``interval=/symbol=`` partitions, one file per symbol and year.

    The year in the shuffle key keeps a symbol with a third of all rows off a single task.
    """
    keys = [c for c in ("interval", "symbol") if c in df.columns]
    (
        df.repartition(*[F.col(k) for k in keys], F.year("date"))
        .sortWithinPartitions(*keys, "date")
        .write.mode(mode)
        .partitionBy(*keys)
        .parquet(path)
    )


def write_result(df: DataFrame, path: str, run_id: str, mode: str = "overwrite") -> DataFrame:
    """Parquet result plus a one-row metadata table beside it; returns the metadata."""
    df.write.mode(mode).parquet(f"{path}/data")
    spark = df.sparkSession
    stored = spark.read.parquet(f"{path}/data")
    meta = stored.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(run_id).alias("run_id"),
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(",".join(sorted(df.columns))).alias("columns"),
    )
    meta.write.mode(mode).json(f"{path}/metadata")
    return spark.read.schema("run_id string, n_rows long, n_columns int, columns string").json(f"{path}/metadata")


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Long-form report table as JSON lines."""
    df.write.mode(mode).json(path)


def _unseen(incoming: DataFrame, seen: DataFrame, date: str) -> DataFrame:
    """The earliest copy of every incoming id that ``seen`` does not hold, by map-side combined ``min``."""
    cols = [c for c in incoming.columns if c not in ("article_id", date)]
    first = incoming.groupBy("article_id").agg(F.min(F.struct(date, *cols)).alias("_row"))
    return first.select("article_id", "_row.*").join(seen.select("article_id"), "article_id", "left_anti")


def upsert_news(
    stored: DataFrame, incoming: DataFrame, as_of: Column, keep_days: int = 90, date: str = "date"
) -> DataFrame:
    """Stored articles plus new ids, without articles older than ``keep_days``; a table, see ``upsert_news_store`` for files."""
    keep = F.col(date) >= F.date_sub(as_of, keep_days)
    return stored.where(keep).unionByName(_unseen(incoming.where(keep), stored, date).select(stored.columns))


def upsert_news_store(incoming: DataFrame, path: str, as_of: Date, keep_days: int = 90) -> DataFrame:
    """Add the new ids of ``incoming`` to a store with one folder per ``date``, drop old days, return the store.

    Only ids are read from the store and only the days that receive articles get files; no stored article is written again. Days before
    ``as_of - keep_days`` go as whole folders, after the new files are in place, so a run that is repeated ends in the same store. An
    id counts as stored whatever its day, also on a day that goes now. Rows with a null id or date are left out. The first run makes the store.
    """
    spark = incoming.sparkSession
    limit = as_of - timedelta(days=keep_days)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    kind = incoming.schema
    stored = spark.read.schema(kind).parquet(path) if fs.exists(root) else spark.createDataFrame([], kind)
    known = F.col("article_id").isNotNull() & (F.col("date") >= F.lit(limit))
    part = F.pmod(F.xxhash64("article_id"), F.lit(DAY_PARTS))
    fresh = _unseen(incoming.where(known), stored, "date").select(*incoming.columns)
    fresh.repartition("date", part).write.mode("append").partitionBy("date").parquet(path)
    for day in fs.listStatus(root):  # one entry for each day kept
        name = day.getPath().getName()
        if name.startswith("date=") and name.removeprefix("date=") < limit.isoformat():
            fs.delete(day.getPath(), True)
    return spark.read.schema(kind).parquet(path).select(*incoming.columns)
