"""Dimension tables: code -> name tables, the synonym dictionary and price thresholds.

These are small, bounded configuration tables. They are built as DataFrames so
operators can join them (Spark broadcasts them; each builder checks its size),
and callers may pass their own instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: the code tables of the source pipeline (code, name) ----
CITIES = [("001", "台北市")]
DISTRICTS = [
    ("111", "士林區"), ("103", "大同區"), ("106", "大安區"), ("104", "中山區"),
    ("100", "中正區"), ("114", "內湖區"), ("116", "文山區"), ("112", "北投區"),
    ("105", "松山區"), ("110", "信義區"), ("115", "南港區"), ("108", "萬華區"),
]
INDUSTRIES = [
    ("0017", "旅行業"), ("0009", "旅宿業"), ("0007", "交通運輸業"), ("0018", "觀光遊樂業"),
    ("0008", "其他業別-餐飲"), ("0020", "其他業別-農特產及手工藝品"), ("0021", "其他業別-加油站"),
    ("0015", "其他業別-體育用品"), ("0016", "其他業別-其他服務"), ("0025", "其他業別-服飾"),
    ("0026", "其他業別-皮鞋皮件"), ("0027", "其他業別-美容護膚"), ("0023", "其他業別-商圈及其他"),
    ("0030", "其他業別-藝文圖書"), ("0031", "其他業別"),
]
# default run configuration: city 001, every district, industry 0009
DEFAULT_CITY = "001"
DEFAULT_INDUSTRIES = ["0009"]

# ---- fixed values: price thresholds per industry name, plus 'default' ----
# four upper edges -> levels 1..5; an exact edge moves up one level
PRICE_THRESHOLDS = [
    ("旅宿業", [1500.0, 3000.0, 5000.0, 8000.0]),
    ("default", [200.0, 500.0, 1000.0, 2000.0]),
]

# ---- our own small synonym dictionary of invented brands: tag -> space-separated aliases ----
# (one one-character alias '家', multi-alias tags, one tag only the fuzzy rule reaches:
# 'pinewood' has no alias that occurs verbatim in a cleaned name)
SYNONYMS = [
    ("bluelamp", "藍燈 lamp"),
    ("coffee", "咖啡 cafe"),
    ("clovershop", "三葉草 clover"),
    ("stonebridge", "石橋館 sbg"),
    ("snack", "點心 夜市"),
    ("hotel", "酒店 飯店 旅館"),
    ("home", "家"),
    ("pinewood", "松林社咖啡"),
]

CODE_SCHEMA = T.StructType([T.StructField("code", T.StringType()), T.StructField("name", T.StringType())])

# a dimension above this many rows is not marked for broadcast by the builders here
MAX_BROADCAST_ROWS = 100_000


def _small(spark: SparkSession, rows, schema) -> DataFrame:
    """A dimension from local rows, marked for broadcast when its size allows
    (checked here); a larger one is left to Spark's own join choice."""
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= MAX_BROADCAST_ROWS else df


def dim_city(spark: SparkSession, rows=None) -> DataFrame:
    return _small(spark, CITIES if rows is None else rows, CODE_SCHEMA)


def dim_district(spark: SparkSession, rows=None) -> DataFrame:
    return _small(spark, DISTRICTS if rows is None else rows, CODE_SCHEMA)


def dim_industry(spark: SparkSession, rows=None) -> DataFrame:
    return _small(spark, INDUSTRIES if rows is None else rows, CODE_SCHEMA)


def dim_price(spark: SparkSession, rows=None) -> DataFrame:
    schema = T.StructType([
        T.StructField("ind", T.StringType()),
        T.StructField("thresholds", T.ArrayType(T.DoubleType())),
    ])
    return _small(spark, PRICE_THRESHOLDS if rows is None else rows, schema)


def synonyms(spark: SparkSession, rows=None) -> DataFrame:
    """(tag, alias_text, aliases): alias_text lower-cased whole, aliases its tokens."""
    schema = T.StructType([T.StructField("tag", T.StringType()), T.StructField("alias_text", T.StringType())])
    df = _small(spark, SYNONYMS if rows is None else rows, schema)
    lowered = F.lower(F.col("alias_text"))
    return df.select(
        "tag",
        lowered.alias("alias_text"),
        F.filter(F.split(F.trim(lowered), r"\s+"), lambda a: a != "").alias("aliases"),
    )


def values_sql(rows, columns) -> str:
    """The same rows as a SQL VALUES list (Spark and DuckDB both accept it)."""
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(columns)})"
