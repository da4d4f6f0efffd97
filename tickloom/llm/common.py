"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from tickloom.session import scratch

#: Characters of text that one step inside a task works on at once; a longer text is one step of its own.
STEP_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """A text column with nulls as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def steps(texts: list[str], most: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` that hold at most ``most`` characters, or one text."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow's form of a table's columns; needs the session, so ask on the driver."""
    return to_arrow_schema(_parse_datatype_string(ddl))


def batch_of(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    """A batch of one row at least."""
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kind, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=kind)


def map_texts(
    df: DataFrame, id_col: str, text_col: str, schema: str, work: Callable[[list, list[str]], dict[str, list]]
) -> DataFrame:
    """Run ``work(ids, texts)`` over bounded steps of each Arrow batch; it returns the columns of ``schema``.

    Only the two columns named reach Python; null texts arrive as empty ones.
    """
    kind = arrow_schema(schema)
    narrow = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in steps(texts):
                got = work(ids[a:b], texts[a:b])
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in kind], schema=kind)

    return narrow.mapInArrow(run, schema)


def hash_sample(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """The distinct rows whose hash of ``columns`` lies in the lowest share that holds about ``rows`` of them.

    The share follows from a count, so no task sends more than its own few rows; all rows if there are not more.
    """
    share = min(1.0, rows / max(1, df.count()))
    return df.where(F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) < int(share * (1 << 30))).distinct()


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read back, and its path for ``discard``."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete tables of ``stored`` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
