"""Merging per-batch fragments into one dataset.

Fragments carry ``file_name`` and ``row_index`` (from the reader's hidden
metadata columns). Codes come from the name ``{kind}_{city}_{zip}_{ind}...``;
names with fewer than three parts keep their own city/district. The global
de-duplication keeps the first row of each key in (file_name, row_index)
order, as a partial aggregate (see ``dedupe.keep_first``), so a key shared by
a third of all rows still leaves each map task as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow import dims
from placeflow.functions.text import tab_name, to_double_strict
from placeflow.operators.dedupe import keep_first
from placeflow.operators.lookup import lookup_name

# names of the merged outputs; a fragment glob must not read them back in
MERGED_NAMES = ("final_data.parquet", "raw_data.parquet")
ORDER = ("file_name", "row_index")


def parse_fragment_codes(df: DataFrame, kind: str = "final") -> DataFrame:
    """Add city_code, zip_code, ind_code from the file name (NULL with < 3 parts)."""
    stem = F.replace(F.replace(F.col("file_name"), F.lit(f"{kind}_"), F.lit("")), F.lit(".parquet"), F.lit(""))
    parts = F.split(stem, "_", -1)
    has = F.size(parts) >= 3
    out = df
    for i, c in enumerate(("city_code", "zip_code", "ind_code")):
        parsed = F.when(has, F.get(parts, i))
        # our own layout carries the codes as partition columns already
        out = out.withColumn(c, F.coalesce(F.col(c), parsed) if c in df.columns else parsed)
    return out


def _overwrite_names(df: DataFrame, with_industry: bool) -> DataFrame:
    out = lookup_name(df, "city_code", dims.CITIES, "_city_name")
    out = lookup_name(out, "zip_code", dims.DISTRICTS, "_district_name")
    coded = F.col("city_code").isNotNull()
    out = out.withColumn("city", F.when(coded, F.col("_city_name")).otherwise(F.col("city") if "city" in df.columns else F.lit(None).cast("string")))
    out = out.withColumn("district", F.when(coded, F.col("_district_name")).otherwise(F.col("district") if "district" in df.columns else F.lit(None).cast("string")))
    out = out.drop("_city_name", "_district_name")
    if with_industry:
        out = lookup_name(out, "ind_code", dims.INDUSTRIES, "_ind_name")
        out = out.withColumn("industry", F.when(coded, F.col("_ind_name")).otherwise(F.col("industry") if "industry" in df.columns else F.lit(None).cast("string"))).drop("_ind_name")
    return out


def _without_merged(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("file_name").isin(*MERGED_NAMES))


def dedupe_keys(columns: Sequence[str]) -> list[str]:
    """[name, phone] when both exist, else [name, address], else none."""
    if "name" in columns and "phone" in columns:
        return ["name", "phone"]
    if "name" in columns and "address" in columns:
        return ["name", "address"]
    return []


def merge_final(frags: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Final fragments -> one de-duplicated dataset (codes overwrite city/district); of rows
    with one key the first by ``order`` stays."""
    named = _overwrite_names(parse_fragment_codes(_without_merged(frags), "final"), with_industry=False)
    keys = dedupe_keys(named.columns)
    out = keep_first(named, keys, list(order)) if keys else named
    for c in ("lat", "lng"):
        if c in out.columns and dict(out.dtypes)[c] == "string":
            out = out.withColumn(c, to_double_strict(c))
    return out


def merge_raw(frags: DataFrame) -> DataFrame:
    """Raw fragments -> one dataset with city, district and industry names; no de-duplication."""
    return _overwrite_names(parse_fragment_codes(_without_merged(frags), "raw"), with_industry=True)


def dedupe_report(frags: DataFrame) -> DataFrame:
    """One row: rows before, after and removed by the global de-duplication."""
    f = _without_merged(frags)
    keys = dedupe_keys(f.columns)
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.struct("file_name", "row_index")
    return f.agg(F.count(F.lit(1)).alias("before_dedup"), F.count_distinct(key).alias("after_dedup")).withColumn(
        "removed", F.col("before_dedup") - F.col("after_dedup")
    )


def fragment_counts(frags: DataFrame, kind: str = "final") -> DataFrame:
    """Rows per fragment file, and whether its name carries batch codes."""
    coded = parse_fragment_codes(frags.select("file_name"), kind)
    return coded.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.col("city_code").isNotNull()).alias("has_codes")
    )


def export_tabs(frags: DataFrame, limit: int = 50) -> DataFrame:
    """One spreadsheet tab per fragment file, in file-name order."""
    return frags.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "file_name", tab_name("file_name", limit).alias("tab"), "n_rows"
    ).orderBy("file_name")
