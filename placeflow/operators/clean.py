"""Merchant cleaning: text and phone normalisation, then per-batch de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow.functions.text import normalize_phone, normalize_place_text
from placeflow.operators.dedupe import dedupe_merchants
from placeflow.operators.lookup import attach_code_names


def clean_merchants(
    raw: DataFrame,
    name_raw: str = "name_raw",
    phone_raw: str = "phone_raw",
    address_raw: str = "address_raw",
    strip_prefix_cols: bool = True,
) -> DataFrame:
    """Add cleaned ``name``, ``phone``, ``address``; the raw columns are dropped."""
    return (
        raw.withColumn("name", normalize_place_text(name_raw, strip_prefix_cols))
        .withColumn("phone", normalize_phone(phone_raw))
        .withColumn("address", normalize_place_text(address_raw, strip_prefix_cols))
        .drop(name_raw, phone_raw, address_raw)
    )


MERCHANT_CLEAN_COLS = ["seq", "city_code", "zip_code", "ind_code", "page_no", "city", "district", "name", "phone", "address"]


def merchant_clean(raw: DataFrame) -> DataFrame:
    """merchant_raw -> cleaned, de-duplicated merchants with city/district names."""
    cleaned = clean_merchants(raw)
    deduped = dedupe_merchants(cleaned)
    return attach_code_names(deduped).select(*MERCHANT_CLEAN_COLS)


def district_counts(df: DataFrame, col: str = "district") -> DataFrame:
    """Rows per value, NULLs dropped, largest first (ties by value)."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc(col))
    )
