"""Running sums inside a group without sending the whole group to one task.

``exclusive_prefix_sum`` cuts the integer order key into blocks of ``block``
consecutive values. A running sum inside each block (<= ``block`` rows per
window partition) plus the running sum of the block totals before it (one row
per block: max key / ``block`` rows per group) gives the sum over all smaller
keys. The input is read by two branches; when it is an aggregate (page counts,
as in every use here) both branches share its shuffle (Spark reuses the
exchange), otherwise pass a materialised table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK = 1 << 16


def exclusive_prefix_sum(df: DataFrame, group: Sequence[str], order: str, value: str, out: str, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Add ``out`` = sum of ``value`` over rows of the same group with a smaller ``order``.

    ``order`` is a non-negative integer, unique within a group.
    """
    group = list(group)
    cur = df.withColumn("_blk", F.floor(F.col(order) / block).cast("bigint"))
    inside = Window.partitionBy(*group, "_blk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    cur = cur.withColumn("_p_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    totals = cur.groupBy(*group, "_blk").agg(F.sum(value).alias("_s"))
    before = Window.partitionBy(*group).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*group, "_blk", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_p_blk"))
    return (
        null_safe_join(cur, totals, [*group, "_blk"])
        .withColumn(out, (F.col("_p_in") + F.col("_p_blk")).cast("bigint"))
        .drop("_blk", "_p_in", "_p_blk")
    )


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL; the right key columns are dropped."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])
