"""Price level 1..5 from four per-industry thresholds, with a 'default' row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def price_level(df: DataFrame, thresholds: DataFrame, price: str = "price", ind: str = "ind", out: str = "price_level") -> DataFrame:
    """``1 + #(thresholds <= price)``: an exact edge moves up a level; NULL price -> NULL.

    ``thresholds`` is a small (ind, array) dimension, joined by Spark's size-checked
    broadcast; industries without a row use the 'default' row.
    """
    own = thresholds.select(F.col("ind").alias("_t_ind"), F.col("thresholds").alias("_t_own"))
    default = thresholds.select(F.col("ind").alias("_t_key"), F.col("thresholds").alias("_t_default"))
    # rows without their own thresholds look up the 'default' row; the key is a
    # computed column, so both lookups stay equi-joins
    j = df.join(own, df[ind] == own["_t_ind"], "left").withColumn(
        "_t_want", F.when(F.col("_t_own").isNull(), F.lit("default"))
    )
    j = j.join(default, j["_t_want"] == default["_t_key"], "left")
    t = F.coalesce(F.col("_t_own"), F.col("_t_default"))
    level = (F.lit(1) + F.size(F.filter(t, lambda x: F.col(price) >= x))).cast("int")
    return j.withColumn(out, F.when(F.col(price).isNotNull() & t.isNotNull(), level)).drop("_t_ind", "_t_own", "_t_want", "_t_key", "_t_default")
