"""CSV exchange with spreadsheet users: every cell a string, header row first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.functions.text import fill_string, tab_name, to_double_strict
from placeflow.sources import versions

NUMERIC = ("lat", "lng")
# cells keep their outer spaces, quotes and newlines both ways
CSV = {"header": "true", "escape": '"', "quoteAll": "true", "multiLine": "true", "emptyValue": "",
       "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def export_rows(df: DataFrame) -> DataFrame:
    """Every column as text, missing as ''."""
    return df.select(*[fill_string(c).alias(c) for c in df.columns])


def export_exchange(df: DataFrame, path: str) -> None:
    """Replace the tab (a CSV directory) with ``df``; an empty input leaves it alone, and readers
    keep the old tab until the new one is whole."""
    if df.isEmpty():
        return
    versions.replace_table(export_rows(df), path, "csv", CSV)


def export_targets(frames: dict[str, DataFrame], root: str) -> None:
    """One tab per named dataset (final, geo cache, raw)."""
    for name, df in frames.items():
        export_exchange(df, f"{root}/{name}")


def fragment_tabs(frags: DataFrame, limit: int = 50) -> DataFrame:
    """The rows of each tab: of fragments whose names are cut to the same tab name, the last in
    file-name order holds the tab."""
    named = frags.withColumn("tab", tab_name("file_name", limit))
    last = named.groupBy("tab").agg(F.max("file_name").alias("file_name"))
    return named.join(last, ["tab", "file_name"])


def export_fragment_tabs(frags: DataFrame, root: str, limit: int = 50) -> None:
    """Each fragment to its own tab, named by the first ``limit`` characters of its stem."""
    rows = fragment_tabs(frags, limit).drop("row_index", "file_name")
    versions.replace_parts(export_rows(rows), root, ["tab"], "csv", CSV)


def read_fragment_tabs(spark: SparkSession, root: str, columns: Sequence[str]) -> DataFrame:
    """All current tabs with their names, every cell a string."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    paths = versions.part_paths(spark, root)
    if not paths:
        return spark.createDataFrame([], f"{schema}, tab string")
    cells = spark.read.options(**CSV).schema(f"{schema}, tab string").option("basePath", root).csv(paths)
    return cells.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns], "tab")


def import_rows(df: DataFrame, numeric: Sequence[str] = NUMERIC) -> DataFrame:
    """Text cells -> typed rows: numeric columns coerced (bad -> NULL), other blanks stay ''."""
    return df.select(*[(to_double_strict(c) if c in numeric else F.coalesce(F.col(c), F.lit(""))).alias(c) for c in df.columns])


def import_exchange(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Read a tab with its header, all columns as strings, and type it."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    raw = spark.read.options(**CSV).schema(schema).csv(versions.table_path(spark, path))
    return import_rows(raw)


def write_back(spark: SparkSession, tab: str, columns: Sequence[str], path: str) -> bool:
    """Replace the dataset at ``path`` with an edited tab; an empty tab changes nothing."""
    rows = import_exchange(spark, tab, columns)
    if rows.isEmpty():
        return False
    versions.replace_table(rows, path)
    return True
