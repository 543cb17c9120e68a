"""Typed final table in the fixed 14-column order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow import dims
from placeflow.functions.text import fill_string, to_double_strict
from placeflow.operators.lookup import lookup_name

# ---- fixed values: the final schema, in order ----
FINAL_COLUMNS = ["id", "name", "ind", "city", "district", "address", "floor", "lat", "lng", "phone",
                 "review_summary", "rating", "price_level", "hidden_tags"]
STRING_COLUMNS = [c for c in FINAL_COLUMNS if c not in ("lat", "lng")]
BATCH = ["city_code", "zip_code", "ind_code"]


def attach_chunk_tags(parsed: DataFrame, batches: DataFrame) -> DataFrame:
    """hidden_tags of the chunk's input row whose temp_id equals the reply id."""
    t = batches.select(*BATCH, "chunk_no", F.col("temp_id").alias("id"), "hidden_tags")
    return parsed.join(t, [*BATCH, "chunk_no", "id"], "left")


def finalize_places(parsed: DataFrame, industry_dim=None, keep_codes: bool = True, extra=()) -> DataFrame:
    """Reply rows -> final rows: ``ind`` from the batch, numeric lat/lng, '' for missing text."""
    out = lookup_name(parsed, "ind_code", dims.INDUSTRIES if industry_dim is None else industry_dim, "ind")
    cols = []
    for c in FINAL_COLUMNS:
        if c in ("lat", "lng"):
            cols.append((to_double_strict(c) if c in out.columns else F.lit(None).cast("double")).alias(c))
        elif c in out.columns:
            cols.append(fill_string(c).alias(c))
        else:
            cols.append(F.lit("").alias(c))
    keep = ([*BATCH] if keep_codes else []) + list(extra)
    return out.select(*cols, *keep)
