"""Distributed prefix sums (W1, W4, S1 for big files).

The reference keeps running counters while it reads one stream in order.  A
single global window (``Window.orderBy(...)`` with no partition) would put
every row into one task, so both helpers here use the two-level pattern:
totals per coarse bucket (a table whose size is bounded by the number of
buckets), a prefix sum over that small table, then a per-bucket window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize

LEVELS = 3  # widths of 2 ** 16 at each level leave at most 2 ** 15 buckets of 64-bit orders on top


def prefix_sum(df: DataFrame, order: str, value: str, out: str, group: list[str] | tuple = (),
               width: int = 1 << 16, levels: int = LEVELS) -> DataFrame:
    """Exclusive running sum of ``value`` ordered by the integer ``order``
    column, restarting per ``group`` (W1/W4 and every "offset" the reference
    keeps as a counter).

    Rows are bucketed by ``order`` in steps of ``width``; the row-level window
    spans one bucket, and each bucket's start is the prefix sum of the bucket
    totals, found in the same way ``levels`` times.  However sparse the order
    (hashed ids leave a bucket to each row), the window on top covers a few
    thousand buckets, and no window ever holds a whole group.
    """
    group = list(group)
    o = F.col(order).cast("long")
    bucket, total, start = f"_bucket{levels}", f"_total{levels}", f"_start{levels}"
    df = df.withColumn(bucket, F.expr(f"(`{order}` - pmod(`{order}`, {width}L)) div {width}L").cast("long"))
    totals = df.groupBy(*group, bucket).agg(F.sum(value).alias(total))
    if levels == LEVELS:
        totals = materialize(totals)     # every level reads it: the rows are worked out once for all of them
    if levels > 1:
        starts = prefix_sum(totals, bucket, total, start, group, 1 << 16, levels - 1).drop(total)
    else:
        top = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
        starts = totals.select(*group, bucket, F.coalesce(F.sum(total).over(top), F.lit(0)).alias(start))
    within = Window.partitionBy(*group, bucket).orderBy(o).rowsBetween(Window.unboundedPreceding, -1)
    return (df.join(starts, [*group, bucket])
              .withColumn(out, (F.col(start) + F.coalesce(F.sum(value).over(within), F.lit(0))).cast("long"))
              .drop(bucket, start))


def dense_offsets(rows: DataFrame, group: str, order: list[str], out: str) -> DataFrame:
    """0-based row number per ``group`` for rows produced by a file scan.

    ``order = [block, mid]`` where ``block`` is the split start and ``mid`` is
    ``monotonically_increasing_id()`` taken right after the scan: inside one
    split the ids are consecutive, so the position inside the split is
    ``mid - min(mid)``.  Only the per-split table (one row per split) is
    aggregated and prefix-summed; AQE broadcasts it when its measured size
    allows, so that the data itself is not shuffled.
    """
    block, mid = order
    splits = rows.groupBy(group, block).agg(F.min(mid).alias("_min_mid"), F.count("*").alias("_n"))
    w = Window.partitionBy(group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_start", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    return (rows.join(splits, [group, block])
            .withColumn(out, (F.col("_start") + F.col(mid) - F.col("_min_mid")).cast("long"))
            .drop("_start", "_min_mid"))
