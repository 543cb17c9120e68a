"""Code -> name lookups and code validation against the code tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow import dims

# a code table given as rows becomes a literal map in the projection up to this size and a
# joined table beyond it: a choice of plan, with the same names either way
MAX_LITERAL_ROWS = 10_000


def lookup_name(df: DataFrame, code_col: str, dim: DataFrame | Sequence[tuple[str, str]], out_col: str) -> DataFrame:
    """Add ``out_col`` = name of the code; unknown codes fall back to the code itself.

    A code table given as (code, name) rows (the fixed tables in ``dims``) is
    a literal map looked up inside the projection: no join, no shuffle; of rows
    with one code the last wins. A DataFrame table is left-joined (its size
    decides broadcast or not); it has no order, so of rows with one code the
    largest name wins.
    """
    if not isinstance(dim, DataFrame):
        rows = list(dict(dim).items())  # the last row of a code wins
        if not rows:
            return df.withColumn(out_col, F.col(code_col))
        if len(rows) <= MAX_LITERAL_ROWS:
            m = F.create_map(*[F.lit(x) for code, name in rows for x in (code, name)])
            return df.withColumn(out_col, F.coalesce(F.try_element_at(m, F.col(code_col)), F.col(code_col)))
        # too large for a literal: the same table, joined
        dim = df.sparkSession.createDataFrame(rows, dims.CODE_SCHEMA)
    d = dim.select(F.col("code").alias("_lk_code"), F.col("name").alias("_lk_name"))
    d = d.groupBy("_lk_code").agg(F.max("_lk_name").alias("_lk_name"))
    j = df.join(d, df[code_col] == d["_lk_code"], "left")
    return j.withColumn(out_col, F.coalesce(F.col("_lk_name"), F.col(code_col))).drop("_lk_code", "_lk_name")


def attach_code_names(
    df: DataFrame,
    city_col: str = "city_code",
    zip_col: str = "zip_code",
    ind_col: str | None = None,
    city_dim=None,
    district_dim=None,
    industry_dim=None,
) -> DataFrame:
    """Add ``city`` and ``district`` (and ``industry``) names for the batch codes."""
    out = lookup_name(df, city_col, dims.CITIES if city_dim is None else city_dim, "city")
    out = lookup_name(out, zip_col, dims.DISTRICTS if district_dim is None else district_dim, "district")
    if ind_col:
        out = lookup_name(out, ind_col, dims.INDUSTRIES if industry_dim is None else industry_dim, "industry")
    return out
