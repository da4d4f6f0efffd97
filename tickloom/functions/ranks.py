"""Exact ranks and quantiles of groups of any size.

A date or a metric may hold a third of all rows, so no group is sorted in one task and
no value list is collected. Equal values collapse in a map-side combined count first.
Groups with more than ``rows_per_bucket`` distinct values are cut into value ranges; the
cut points come from a sample chosen by value hash, so a re-run task sees the same ones.
Ranks are counted inside a range and shifted by the size of the ranges below: exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 500_000
MAX_BUCKETS = 1_024
_SAMPLES_PER_CUT = 16


def value_ranks(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """One row per (keys, value): ``_c`` equal rows, ``_below`` smaller rows, ``_size`` rows."""
    keys = list(keys)
    vals = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    sizes = vals.groupBy(*keys).agg(
        F.sum("_c").alias("_size"), F.count(F.lit(1)).alias("_distinct")
    )
    cuts_wanted = F.least(
        F.ceil(F.col("_distinct") / F.lit(rows_per_bucket)), F.lit(MAX_BUCKETS)
    )
    stride = F.greatest(
        F.lit(1), F.floor(F.col("_distinct") / (cuts_wanted * _SAMPLES_PER_CUT))
    )
    large = sizes.where(F.col("_distinct") > rows_per_bucket).select(
        *keys, stride.alias("_stride")
    )
    cuts = (
        vals.join(large, keys)
        .where(F.pmod(F.xxhash64(value), F.col("_stride")) == 0)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(value)).alias("_sample"))
        .select(
            *keys,
            F.filter("_sample", lambda v, i: i % _SAMPLES_PER_CUT == _SAMPLES_PER_CUT - 1).alias("_cuts"),
        )
    )
    below_cut = F.size(F.filter("_cuts", lambda c: c < F.col(value)))
    ranged = (
        vals.join(cuts, keys, "left")
        .withColumn("_range", F.when(F.col("_cuts").isNull(), 0).otherwise(below_cut))
        .drop("_cuts")
    )
    lower = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*keys, "_range")
        .agg(F.sum("_c").alias("_rc"))
        .withColumn("_off", F.coalesce(F.sum("_rc").over(lower), F.lit(0)))
        .drop("_rc")
        .join(sizes.select(*keys, "_size"), keys)
    )
    smaller = (
        Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        ranged.withColumn("_in", F.coalesce(F.sum("_c").over(smaller), F.lit(0)))
        .join(offsets, [*keys, "_range"])
        .select(*keys, value, "_c", (F.col("_off") + F.col("_in")).alias("_below"), "_size")
    )


def ranked_rows(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """The rows with keys and a value: ``_below`` smaller rows, ``_upto`` smaller or equal ones, ``_size`` rows of the group.

    For few groups (their sizes are broadcast) of mostly distinct values: rows are shuffled and sorted once, and nothing is
    joined back by value. Groups of more than ``rows_per_bucket`` rows are cut into cells by a sample of rows. A cut value is
    a cell of its own, whose rows need no order, so a value of very many rows is dealt over tasks.
    """
    keys = list(keys)
    there = F.col(value).isNotNull()
    for k in keys:
        there = there & F.col(k).isNotNull()
    rows = df.where(there)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    order = Window.partitionBy(*keys).orderBy(value)
    small = rows.join(F.broadcast(sizes.where(F.col("_size") <= rows_per_bucket)), keys).select(
        *df.columns,
        (F.rank().over(order) - 1).cast("long").alias("_below"),
        F.count(F.lit(1)).over(order).alias("_upto"),
        "_size",
    )
    large = sizes.where(F.col("_size") > rows_per_bucket)
    return small.unionByName(_ranked_cells(rows, large, keys, value, rows_per_bucket))


def _ranked_cells(rows: DataFrame, large: DataFrame, keys: list[str], value: str, rows_per_bucket: int) -> DataFrame:
    """``ranked_rows`` of the groups in ``large``."""
    by_row = F.xxhash64(*rows.columns)
    cuts_wanted = F.least(F.ceil(F.col("_size") / F.lit(rows_per_bucket)), F.lit(MAX_BUCKETS))
    stride = F.greatest(F.lit(1), F.floor(F.col("_size") / (cuts_wanted * _SAMPLES_PER_CUT)))
    cut_values = F.filter("_sample", lambda v, i: i % _SAMPLES_PER_CUT == _SAMPLES_PER_CUT - 1)
    cuts = (
        rows.join(F.broadcast(large.select(*keys, "_size", stride.alias("_stride"))), keys)
        .where(F.pmod(by_row, F.col("_stride")) == 0)
        .groupBy(*keys, "_size")
        .agg(F.array_sort(F.collect_list(value)).alias("_sample"))
        .select(*keys, F.array_distinct(cut_values).alias("_cuts"))
    )
    # a group whose sample is empty has no cut and is one cell
    cuts = large.join(cuts, keys, "left").withColumn("_cuts", F.coalesce("_cuts", F.filter(F.array(F.lit(None).cast(rows.schema[value].dataType)), F.isnotnull)))
    lower = F.size(F.filter("_cuts", lambda c: c < F.col(value)))
    upper = F.size(F.filter("_cuts", lambda c: c <= F.col(value)))
    celled = rows.join(F.broadcast(cuts), keys).select(
        *rows.columns, "_size", (lower + upper).alias("_cell"), (upper > lower).alias("_one")
    )
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        celled.groupBy(*keys, "_cell")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_off", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    )
    parts = F.ceil(F.col("_rows") / F.lit(rows_per_bucket))
    dealt = celled.join(F.broadcast(cells), [*keys, "_cell"]).withColumn(
        "_part", F.when(F.col("_one"), F.pmod(by_row, parts)).otherwise(0)
    )
    order = Window.partitionBy(*keys, "_cell", "_part").orderBy(value)
    inside = F.when(F.col("_one"), 0).otherwise(F.rank().over(order) - 1).cast("long")
    upto = F.when(F.col("_one"), F.col("_rows")).otherwise(F.count(F.lit(1)).over(order))
    return dealt.select(
        *rows.columns, (F.col("_off") + inside).alias("_below"), (F.col("_off") + upto).alias("_upto"), "_size"
    )


def with_average_rank(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    rank: str = "rank",
    size: str = "n",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add the 1-based rank with ties averaged and the non-null group size."""
    table = value_ranks(df, keys, value, rows_per_bucket).select(
        *keys,
        value,
        (F.col("_below") + (F.col("_c") + 1) / 2.0).alias(rank),
        F.col("_size").alias(size),
    )
    return df.join(table, [*keys, value], "left")


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    names: Sequence[str],
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Exact linearly interpolated quantiles per group, one column per probability."""
    group = list(keys)
    if not group:
        df, group = df.withColumn("_all", F.lit(0)), ["_all"]
    table = value_ranks(df, group, value, rows_per_bucket)
    return quantiles_of(table, group, value, probs, names).select(*keys, *names)


def quantiles_of(
    table: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """``quantiles`` from a ``value_ranks`` table."""
    aggs = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("_size") - 1)
        for side, k in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            covers = (F.col("_below") <= k) & (k < F.col("_below") + F.col("_c"))
            aggs.append(F.max(F.when(covers, F.col(value))).alias(f"_{side}{i}"))
        aggs.append(F.max(pos - F.floor(pos)).alias(f"_w{i}"))
    cols = [
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_w{i}")).alias(name)
        for i, name in enumerate(names)
    ]
    return table.groupBy(*keys).agg(*aggs).select(*keys, *cols)
