"""File sources/sinks round trips, and behaviour under a hot key."""

import os
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Window
from pyspark.sql import functions as F

from placeflow.operators import enrich, merge
from placeflow.operators.dedupe import keep_first
from placeflow.sources import exchange, fragments


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_read_legacy_fragments_and_merge(spark):
    root = tempfile.mkdtemp(prefix="frags-")
    a = pa.table({"id": ["1", "2"], "name": ["A", "B"], "phone": ["p1", "p2"], "city": ["x", "x"], "district": ["y", "y"]})
    b = pa.table({"id": ["9"], "name": ["A"], "phone": ["p1"], "city": ["x"], "district": ["y"], "extra": ["e"]})
    pq.write_table(a, os.path.join(root, "final_001_111_0009.parquet"))
    pq.write_table(b, os.path.join(root, "final_001_103_0008.parquet"))
    pq.write_table(a, os.path.join(root, "final_data.parquet"))  # our own published output: never re-read
    with open(os.path.join(root, "final_broken.parquet"), "wb") as f:
        f.write(b"not parquet")
    frags = fragments.read_fragments(spark, root)
    assert set(frags.columns) >= {"file_name", "row_index", "extra"}
    merged = {(r.name, r.phone): (r.id, r.district) for r in merge.merge_final(frags).collect()}
    # first wins in (file_name, row_index) order: 103 sorts before 111
    assert merged == {("A", "p1"): ("9", "大同區"), ("B", "p2"): ("2", "士林區")}
    report = fragments.read_report(spark, root, frags)
    assert {r.file_name: r.status for r in report.collect()} == {
        "final_001_111_0009.parquet": "ok", "final_001_103_0008.parquet": "ok", "final_data.parquet": "ok", "final_broken.parquet": "skipped"}
    assert fragments.whole_files(frags, report).count() == frags.count()
    counts = {r.file_name: r.n_rows for r in merge.fragment_counts(frags).collect()}
    assert counts["final_001_111_0009.parquet"] == 2


def test_write_batches_keeps_codes_and_replaces_only_its_batches(spark):
    root = tempfile.mkdtemp(prefix="batches-")
    df = spark.createDataFrame([("001", "111", "0009", "a"), ("001", "103", "0008", "b")], "city_code string, zip_code string, ind_code string, v string")
    fragments.write_batches(df, root)
    fragments.write_batches(spark.createDataFrame([("001", "111", "0009", "c")], df.schema), root)
    back = fragments.read_batches(spark, root, "v string, city_code string, zip_code string, ind_code string")
    got = sorted((r.ind_code, r.v) for r in back.collect())
    assert got == [("0008", "b"), ("0009", "c")]


def test_exchange_round_trip(spark):
    root = tempfile.mkdtemp(prefix="tab-")
    df = spark.createDataFrame([("1", "店, \"A\"", 25.0123, None), ("2", None, None, 121.5)], "id string, name string, lat double, lng double")
    exchange.export_exchange(df, f"{root}/final")
    back = exchange.import_exchange(spark, f"{root}/final", ["id", "name", "lat", "lng"])
    got = sorted(tuple(r) for r in back.collect())
    assert got == [("1", '店, "A"', 25.0123, None), ("2", "", None, 121.5)]
    exchange.export_exchange(df.limit(0), f"{root}/final")  # empty input leaves the tab alone
    assert exchange.import_exchange(spark, f"{root}/final", ["id", "name", "lat", "lng"]).count() == 2


def test_keep_first_hot_key_is_partially_aggregated(spark):
    # one key holds a third of the rows
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        (F.lit(n) - F.col("id")).alias("o"),
        F.col("id").alias("v"),
    ).repartition(8)
    out = keep_first(df, ["k"], ["o"])
    plan = _plan(out)
    assert "partial_min" in plan and plan.index("partial_min") > plan.index("Exchange")  # partial agg sits below the exchange
    w = Window.partitionBy("k").orderBy("o")
    brute = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert out.exceptAll(brute).count() == 0 and brute.exceptAll(out).count() == 0
    hot = out.filter("k = -1").first()
    assert hot.v == n - 3  # the largest id on the hot key has the smallest o


def test_index_within_matches_row_number_under_skew(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("b"), (F.col("id") % 50).cast("string"))).alias("city_code"),
        F.lit("111").alias("zip_code"), F.lit("0009").alias("ind_code"),
        (F.col("id") / 40).cast("bigint").alias("page_no"),
        F.col("id").alias("seq"),
    )
    got = enrich.index_within(rows, ["city_code", "zip_code", "ind_code"], "page_no", ["seq"])
    w = Window.partitionBy("city_code", "zip_code", "ind_code").orderBy("page_no", "seq")
    brute = rows.withColumn("idx", (F.row_number().over(w) - 1).cast("bigint"))
    assert got.select(*brute.columns).exceptAll(brute).count() == 0
    assert got.count() == brute.count()


def test_exclusive_prefix_sum_matches_window(spark):
    from placeflow.operators.prefix import exclusive_prefix_sum

    df = spark.range(3000).select(
        (F.col("id") % 3).cast("string").alias("g"),
        (F.col("id") * 7 + (F.col("id") % 5)).alias("o"),  # sparse, unique per group
        (F.col("id") % 11).alias("v"),
    )
    got = exclusive_prefix_sum(df, ["g"], "o", "v", "p", block=16)
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    brute = df.withColumn("p", F.coalesce(F.sum("v").over(w), F.lit(0)).cast("bigint"))
    assert got.select(*brute.columns).exceptAll(brute).count() == 0
    assert got.count() == brute.count()


def test_listing_row_cap(spark, sf_dir):
    from placeflow.plans import queries
    from placeflow.sources import listing

    pages = queries._listing_pages(spark, sf_dir)
    full = listing.listing_merchants(pages)
    capped = listing.listing_merchants(pages, max_rows_per_batch=10)
    per_batch_full = {tuple(r[:3]): r[3] for r in full.groupBy("city_code", "zip_code", "ind_code").count().collect()}
    for r in capped.groupBy("city_code", "zip_code", "ind_code").agg(F.count(F.lit(1)).alias("n"), F.max("page_no").alias("last")).collect():
        n_full = per_batch_full[tuple(r[:3])]
        assert r.n <= n_full
        # pages are read while fewer than 10 rows were collected: the last page may overshoot
        before_last = capped.filter((F.col("city_code") == r.city_code) & (F.col("zip_code") == r.zip_code)
                                    & (F.col("ind_code") == r.ind_code) & (F.col("page_no") < r.last)).count()
        assert before_last < 10


def test_incremental_fold_is_replay_safe(spark):
    from placeflow.streaming.incremental import _fold_fragments, read_state

    root = tempfile.mkdtemp(prefix="state-")
    a = spark.createDataFrame(
        [("1", "A", "p1", "x", "y", "final_001_111_0009.parquet", 0), ("2", "B", "p2", "x", "y", "final_001_111_0009.parquet", 1)],
        "id string, name string, phone string, city string, district string, file_name string, row_index bigint")
    b = spark.createDataFrame([("9", "A", "p1", "x", "y", "final_001_103_0008.parquet", 0)], a.schema)
    fold = _fold_fragments(f"{root}/state", 8)
    fold(a, 0)
    fold(b, 1)
    once = sorted(tuple(r) for r in read_state(spark, f"{root}/state").select("id", "name", "phone").collect())
    fold(b, 1)  # the same epoch again, as after a failure
    twice = sorted(tuple(r) for r in read_state(spark, f"{root}/state").select("id", "name", "phone").collect())
    assert once == twice == [("2", "B", "p2"), ("9", "A", "p1")]


def test_export_fragment_tabs(spark):
    root = tempfile.mkdtemp(prefix="tabs-")
    long_name = "final_001_111_0009_" + "x" * 60 + ".parquet"
    frags = spark.createDataFrame(
        [("1", "A", "final_001_111_0009.parquet", 0), ("2", "B", long_name, 0)],
        "id string, name string, file_name string, row_index bigint")
    exchange.export_fragment_tabs(frags, root)
    tabs = sorted(d for d in os.listdir(root) if d.startswith("tab="))
    assert tabs == ["tab=final_001_111_0009", "tab=" + long_name.replace(".parquet", "")[:50]]


def test_index_within_keeps_null_codes_and_pages(spark):
    rows = spark.createDataFrame(
        [(None, "111", "0009", 1, 1), (None, "111", "0009", 1, 2), ("001", "111", "0009", None, 3), ("001", "111", "0009", 2, 4)],
        "city_code string, zip_code string, ind_code string, page_no bigint, seq bigint")
    got = {r.seq: r.idx for r in enrich.index_within(rows, ["city_code", "zip_code", "ind_code"], "page_no", ["seq"]).collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: 1}
