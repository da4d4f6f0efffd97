"""Row numbering and block windows for series too long for one task.

A key may own a third of all rows. A plain window would sort that key in one task, so
the series is cut into blocks of ``block_rows`` consecutive rows. Rows near a block edge
are copied into the neighbouring block (the halo), the window runs per (key, block), and
the copies are dropped. Bounded frames give the same values as over the whole series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 65_536


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
) -> DataFrame:
    """Add 0-based ``_n`` per key without sorting a whole key in one task.

    ``bucket`` must be monotone in the first order column (for example an hour or a
    month). Counts per (key, bucket) come from a narrow, map-side combined pass; their
    running sum is the offset of each bucket, and rows are numbered inside a bucket only.
    ``order`` has to be total within a key.
    """
    tagged = df.withColumn("_tb", bucket)
    counts = tagged.groupBy(*keys, "_tb").agg(F.count(F.lit(1)).alias("_c"))
    earlier = (
        Window.partitionBy(*keys).orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(
        *keys, "_tb", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_off")
    )
    inside = Window.partitionBy(*keys, "_tb").orderBy(*order)
    numbered = tagged.withColumn("_i", F.row_number().over(inside))
    return (
        numbered.join(offsets, [*keys, "_tb"])
        .withColumn("_n", F.col("_off") + F.col("_i") - 1)
        .drop("_tb", "_off", "_i")
    )


def in_blocks(
    df: DataFrame,
    fn: Callable[[DataFrame, Sequence[str], str], DataFrame],
    *,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    lookback: int,
    lookahead: int = 0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Run ``fn(df, keys + [_blk], "_n")`` per block of each series.

    ``lookback``/``lookahead`` are the rows the operator reads before and after a row;
    chained frames add up. ``fn`` may add columns but must keep rows.
    """
    if max(lookback, lookahead) > block_rows:
        raise ValueError("block_rows must be at least the lookback and the lookahead")
    b = F.floor(F.col("_n") / block_rows).cast("long")
    j = F.col("_n") % block_rows
    homes = F.array_compact(
        F.array(
            b,
            F.when(j >= block_rows - lookback, b + 1),
            F.when((j < lookahead) & (b > 0), b - 1),
        )
    )
    spread = (
        number_rows(df, keys, order, bucket)
        .withColumn("_own", b)
        .withColumn("_blk", F.explode(homes))
    )
    out = fn(spread, [*keys, "_blk"], "_n")
    return out.filter(F.col("_blk") == F.col("_own")).drop("_blk", "_own", "_n")
