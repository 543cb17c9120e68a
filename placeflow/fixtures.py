"""Derived input tables, built from the driver's TPC-H-ish tables.

Each fixture is one SQL text that Spark and DuckDB both accept (``split_part``,
``||``, ``CAST AS STRING``, ``CAST(floor(..) AS BIGINT)``). In Spark the
``{name}`` placeholders are bound to DataFrames through ``spark.sql(text,
name=df)``; the oracle binds them to DuckDB views of the same name. Fixtures
that sit on top of an operator's output (e.g. ``merchant_clean``) take that
output as a parameter, so each engine feeds its own result in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from placeflow.dims import CITIES, DISTRICTS, INDUSTRIES, values_sql

# k groups three consecutive customers into one shop written three ways
MERCHANT_RAW = """
SELECT c_custkey AS seq, '001' AS city_code,
 split_part('""" + ",".join(code for code, _ in DISTRICTS) + """', ',', CAST(k % 12 AS INT) + 1) AS zip_code,
 split_part('0009,0008,0017', ',', CAST(k % 3 AS INT) + 1) AS ind_code,
 CAST(floor(c_custkey / 60.0) AS BIGINT) + 1 AS page_no,
 split_part('藍燈 ＬＡＭＰ,松林舍　咖啡,臺灣三葉草,石橋館,士林夜市點心,山海之家,望海大酒店', ',', CAST(k % 7 AS INT) + 1) || CAST(k % 50 AS STRING) AS name_raw,
 CASE WHEN k % 11 = 0 THEN NULL
      WHEN c_custkey % 3 = 0 THEN '(02) 2' || CAST(1000000 + k AS STRING)
      WHEN c_custkey % 3 = 1 THEN '０２-2' || CAST(1000000 + k AS STRING)
      ELSE '02 2' || CAST(1000000 + k AS STRING) || CASE WHEN k % 5 = 0 THEN '＃12' ELSE '' END END AS phone_raw,
 '臺北市' || split_part('""" + ",".join(name for _, name in DISTRICTS) + """', ',', CAST(k % 12 AS INT) + 1)
   || '中山北路' || split_part('一段,二段,三段,四段', ',', CAST(k % 4 AS INT) + 1) || ' ' || CAST(k % 400 AS STRING) || '之' || CAST(k % 3 AS STRING) || '號' AS address_raw
FROM (SELECT c_custkey, CAST(floor(c_custkey / 3.0) AS BIGINT) AS k FROM {customer}) t
"""

# one resolver answer per distinct address key; k = smallest floor(seq / 3) of the key
GAZETTEER = """
SELECT full_address_key,
       25.0 + CAST(k % 1000 AS DOUBLE) / 10000.0 AS lat,
       121.5 + CAST(k % 777 AS DOUBLE) / 10000.0 AS lng,
       k
FROM (SELECT full_address_key, min(CAST(floor(seq / 3.0) AS BIGINT)) AS k
      FROM {keyed} GROUP BY full_address_key) g
"""

# cache versions: gen 0 misses every 4th key; gen 1 moves every 5th; every 13th lost its lng
GEO_CACHE = """
SELECT full_address_key, lat, CASE WHEN k % 13 = 0 THEN NULL ELSE lng END AS lng,
       CAST(0 AS BIGINT) AS gen, k AS seq
FROM {gazetteer} WHERE k % 4 <> 0
UNION ALL
SELECT full_address_key, lat + 0.5 AS lat, lng + 0.5 AS lng, CAST(1 AS BIGINT) AS gen, k AS seq
FROM {gazetteer} WHERE k % 5 = 0
"""

# run requests, one per customer: some codes are not in the code tables
RUN_REQUESTS = """
SELECT c_custkey AS request_id,
 split_part('001,001,001,002', ',', CAST(c_custkey % 4 AS INT) + 1) AS city_code,
 split_part('111,103,999,106,104,100,114,116,112,105,110,115,108', ',', CAST(c_custkey % 13 AS INT) + 1) AS zip_code,
 split_part('0009,0008,0017,9999,0042', ',', CAST(c_custkey % 5 AS INT) + 1) AS ind_code
FROM {customer}
"""

# part rows as priced items: p_type's size word stands in for the industry
PRICE_INPUT = """
SELECT p_partkey AS item_id,
 CASE WHEN p_size % 2 = 0 THEN '旅宿業' ELSE split_part(p_type, ' ', 1) END AS ind,
 p_retailprice AS price
FROM {part}
"""


def dim_sql(kind: str) -> str:
    rows = {"city": CITIES, "district": DISTRICTS, "industry": INDUSTRIES}[kind]
    return values_sql(rows, ["code", "name"])


def bind(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """Run a fixture text in Spark with ``{name}`` bound to DataFrames."""
    return spark.sql(text, **frames)


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def merchant_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, MERCHANT_RAW, **tables(spark, sf_dir, "customer"))


def duck(text: str, **views: str) -> str:
    """The same fixture text for DuckDB, placeholders bound to view/CTE names."""
    out = text
    for k, v in views.items():
        out = out.replace("{" + k + "}", v)
    return out

# run configs, one per customer: unknown city every 17th, industry lists with
# unknown codes and repeats, district lists that are NULL / known / all unknown / mixed with repeats
RUN_CONFIGS = """
SELECT c_custkey AS run_id,
 CASE WHEN c_custkey % 17 = 0 THEN '002' ELSE '001' END AS city,
 split_part('0009;0009,0008;0017,9999;9999,0042;0008,0008', ';', CAST(c_custkey % 5 AS INT) + 1) AS industries_text,
 CASE WHEN c_custkey % 4 = 0 THEN NULL
      ELSE split_part('111,103;999,998;105,999,105', ';', CAST(c_custkey % 4 AS INT)) END AS districts_text
FROM {customer}
"""


# replies per chunk, from the enrichment batches: optional fence and leading sentence,
# header 'ID | ...', one line per row; with c = chunk_no + zip + industry code, every 5th chunk has a short first row, every
# 7th trailing pipes, every 11th a 14-field row, every 13th is empty; some 'N/A', some quoted reviews that hold a
# separator and quotes, some lines of blank space
RESPONSES = """
SELECT city_code, zip_code, ind_code, chunk_no,
  CASE WHEN c % 13 = 6 THEN ''
  ELSE CASE WHEN c % 2 = 0 THEN '```csv' || chr(10) ELSE '' END
    || CASE WHEN c % 3 = 0 THEN 'Here is the table you asked for.' || chr(10) || chr(10) ELSE '' END
    || 'ID | 店名|縣市|行政區|地址|樓層|緯度|經度|電話|評論|星級數|價格區間' || chr(10)
    || listagg(line, chr(10)) WITHIN GROUP (ORDER BY idx)
    || CASE WHEN c % 2 = 0 THEN chr(10) || '```' ELSE '' END
  END AS response
FROM (
  SELECT city_code, zip_code, ind_code, chunk_no, idx,
    chunk_no + CAST(zip_code AS BIGINT) + CAST(ind_code AS BIGINT) AS c,
    CASE WHEN c % 5 = 1 AND idx % 30 = 0
      THEN temp_id || '|' || name || '|' || city || '|' || district || '|' || address || '||'
           || CASE WHEN lat IS NULL THEN '' ELSE printf('%.4f', lat) END || '|'
           || CASE WHEN lng IS NULL THEN '' ELSE printf('%.4f', lng) END || '|' || phone || '|short'
      ELSE temp_id || '|' || name || '|' || city || '|' || district || '|' || address || '|'
           || CASE WHEN idx % 4 = 0 THEN CAST(idx % 9 + 1 AS STRING) || 'F' ELSE '' END || '|'
           || CASE WHEN lat IS NULL THEN '' WHEN idx % 10 = 3 THEN 'abc' ELSE printf('%.4f', lat) END || '|'
           || CASE WHEN lng IS NULL THEN '' WHEN idx % 10 = 7 THEN ' ' || printf('%.4f', lng) || ' ' ELSE printf('%.4f', lng) END || '|'
           || phone || '|' || CASE WHEN idx % 8 = 5 THEN '"quoted | review of ' || name || ' ""x"" y"' ELSE 'review of ' || name END || '|'
           || CASE WHEN idx % 6 = 0 THEN 'N/A' ELSE CAST(idx % 5 AS STRING) || '.5/5' END || '|'
           || CAST(500 + (idx % 7) * 250 AS STRING)
           || CASE WHEN c % 7 = 3 THEN '|' ELSE '' END
           || CASE WHEN c % 11 = 4 AND idx % 30 = 2 THEN '|x|y' ELSE '' END
    END || CASE WHEN idx % 9 = 4 THEN chr(10) || '   ' ELSE '' END AS line
  FROM {batches}) t
GROUP BY city_code, zip_code, ind_code, chunk_no, c
"""


def duck_agg(text: str) -> str:
    """Spark's ``listagg(x, sep) WITHIN GROUP (ORDER BY y)`` as DuckDB's ``string_agg(x, sep ORDER BY y)``."""
    import re
    return re.sub(r"listagg\((\w+), ([^)]*?\)?)\) WITHIN GROUP \(ORDER BY (\w+)\)", r"string_agg(\1, \2 ORDER BY \3)", text)


_FINAL_COLS = "id, name, ind, city, district, address, floor, lat, lng, phone, review_summary, rating, price_level, hidden_tags"

# final fragments: one file per batch; every 6th line again in a re-run file (4 name
# parts, codes from the first three); some lines in a legacy file without codes. A row's
# position is computed from batch, chunk and line, so that no window orders all rows
FRAGMENTS = """
SELECT """ + _FINAL_COLS + """,
  'final_' || city_code || '_' || zip_code || '_' || ind_code || '.parquet' AS file_name,
  CAST(chunk_no * 1000 + line_no AS BIGINT) AS row_index
FROM {final}
UNION ALL
SELECT """ + _FINAL_COLS + """,
  'final_' || city_code || '_' || zip_code || '_' || ind_code || '_rerun.parquet' AS file_name,
  CAST(chunk_no * 1000 + line_no AS BIGINT) AS row_index
FROM {final} WHERE line_no % 6 = 0
UNION ALL
SELECT """ + _FINAL_COLS + """, 'final_legacy.parquet' AS file_name,
  ((CAST(city_code AS BIGINT) * 1000 + CAST(zip_code AS BIGINT)) * 10000 + CAST(ind_code AS BIGINT)) * 100000000 + chunk_no * 1000 + line_no AS row_index
FROM {final} WHERE line_no % 17 = 5
"""

# raw fragments: the enrichment input rows of each batch, in index order
RAW_FRAGMENTS = """
SELECT seq, city, district, name, industry, phone, address, lat, lng, hidden_tags,
  'raw_' || city_code || '_' || zip_code || '_' || ind_code || '.parquet' AS file_name, idx AS row_index
FROM {batches}
"""

# exchange tab read back: all text, with odd spellings among the coordinates
EXCHANGE = """
SELECT id, name, ind, city, district, address, floor,
  CASE CAST(CAST(row_index AS BIGINT) % 9 AS INT) WHEN 0 THEN NULL WHEN 1 THEN '25.0' WHEN 2 THEN ' 25.0 ' WHEN 3 THEN 'abc'
       WHEN 4 THEN '1.0d' WHEN 5 THEN '1_000' WHEN 6 THEN 'NaN' WHEN 7 THEN 'inf' ELSE lat END AS lat,
  CASE WHEN CAST(row_index AS BIGINT) % 4 = 1 THEN '' ELSE lng END AS lng,
  CASE WHEN CAST(row_index AS BIGINT) % 5 = 2 THEN NULL ELSE phone END AS phone,
  review_summary, rating, price_level, hidden_tags
FROM {rows}
"""


# captured listing pages per batch and page, built from merchant_raw: header row in <td>,
# some cells padded with spaces or holding '&amp;', a repeated header inside some
# tables, a small 2-column table before the target on every 5th page; after the
# last data page each batch gets extra pages for one of four stop scenarios
# (zip_code % 4): marker; failed + empty runs; a run reset by a hit; three empties.
_ROW = "<tr>" + "<td>{}</td>" * 5 + "</tr>"
_HEAD = _ROW.format("特店名稱", "業別", "電話", "地址", "備註").replace("業別", "行業別")
_KINDS = {  # page kind -> SQL text of its html
    "marker": "'<html><body><div>查無資料</div></body></html>'",
    "maintenance": "'<html><body><p>系統維護中</p></body></html>'",
    "failed": "NULL",
    "empty": "'<html><body><table><tr><td>特店名稱</td><td>說明</td></tr></table></body></html>'",
    "hit": "'<html><body><table>" + _HEAD + _ROW.format(
        "延伸店' || zip_code || '", "業別' || ind_code || '", "02-1234", "延伸路' || CAST(d AS STRING) || '號", "-")
    + "</table></body></html>'",
}
# the six extra pages of each stop scenario
_SCENARIOS = [
    ["marker", "hit", "failed", "failed", "failed", "failed"],
    ["empty", "failed", "maintenance", "empty", "empty", "hit"],
    ["empty", "empty", "hit", "empty", "empty", "hit"],
    ["hit", "empty", "empty", "empty", "hit", "failed"],
]


def _extra_pages() -> str:
    days = range(1, len(_SCENARIOS[0]) + 1)
    cases = " ".join(f"WHEN scenario = {s} AND d = {d} THEN {_KINDS[kinds[d - 1]]}" for s, kinds in enumerate(_SCENARIOS) for d in days)
    pages = " UNION ALL ".join(
        f"SELECT city_code, zip_code, ind_code, p + {d} AS page_no, {d} AS d, scenario FROM {{last_page}}" for d in days)
    return f"SELECT city_code, zip_code, ind_code, page_no, CASE {cases} END AS html FROM ({pages}) e"


LISTING_PAGES = """
SELECT city_code, zip_code, ind_code, page_no, html FROM (
  SELECT city_code, zip_code, ind_code, page_no,
    '<html><body>' || CASE WHEN page_no % 5 = 0 THEN '<table><tr><td>特店名稱</td><td>x</td></tr></table>' ELSE '' END
    || '<table class="list">' || '<tr><td>特店名稱</td><td>行業別</td><td>電話</td><td>地址</td><td>備註</td></tr>'
    || listagg(tr, '') WITHIN GROUP (ORDER BY seq) || '</table></body></html>' AS html
  FROM (
    SELECT city_code, zip_code, ind_code, page_no, seq,
      '<tr><td>' || CASE WHEN seq % 4 = 1 THEN '  ' || name_raw || ' ' ELSE name_raw END
        || CASE WHEN seq % 10 = 0 THEN ' &amp; Co' ELSE '' END
        || '</td><td>業別' || ind_code || '</td><td>' || coalesce(phone_raw, '') || '</td><td>' || address_raw
        || '</td><td>' || CAST(seq AS STRING) || '</td></tr>'
        || CASE WHEN seq % 23 = 7 THEN '<tr><td>特店名稱</td><td>行業別</td><td>電話</td><td>地址</td><td>備註</td></tr>' ELSE '' END AS tr
    FROM {merchant_raw}) r
  GROUP BY city_code, zip_code, ind_code, page_no
  UNION ALL
""" + _extra_pages() + """
) pages
"""

LISTING_LAST_PAGE = """
SELECT city_code, zip_code, ind_code, max(page_no) AS p, CAST(zip_code AS INT) % 4 AS scenario
FROM {merchant_raw} GROUP BY city_code, zip_code, ind_code
"""
