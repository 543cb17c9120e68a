"""End-to-end job on captured pages: write stages, skip finished batches, merge and publish."""

import os
import tempfile

from pyspark.sql import functions as F

from placeflow import fixtures as fx
from placeflow.operators import finalize as fin
from placeflow.plans import pipeline, queries
from placeflow.sources import geo_cache

SMALL = "/root/testdata/sf0.001"


def test_pipeline_end_to_end(spark):
    out = tempfile.mkdtemp(prefix="pipeline-")
    raw = fx.merchant_raw(spark, SMALL)
    last = fx.bind(spark, fx.LISTING_LAST_PAGE, merchant_raw=raw)
    pages = fx.bind(spark, fx.LISTING_PAGES, merchant_raw=raw, last_page=last)
    _, _, resolver = queries._geo_inputs(spark, SMALL)

    ledger = pipeline.run(spark, pages, f"{out}/data", f"{out}/cache", queries._echo_client, resolver=resolver).collect()
    assert ledger and all(r.status == "done" for r in ledger)
    final = spark.read.parquet(f"{out}/data/final")
    assert final.count() > 0
    assert final.filter(F.col("ind_code") == "0009").count() > 0  # codes stay strings
    assert geo_cache.committed_versions(spark, f"{out}/cache") == [0]
    cached = geo_cache.read_geo_cache(spark, f"{out}/cache").count()
    assert cached > 0

    # a second run finds every batch finished and writes nothing new
    n_final = final.count()
    again = pipeline.run(spark, pages, f"{out}/data", f"{out}/cache", queries._echo_client, resolver=resolver).collect()
    assert all(r.status == "done" for r in again)
    assert spark.read.parquet(f"{out}/data/final").count() == n_final

    # resuming from the saved raw table finds nothing to do either
    resumed = pipeline.run(spark, None, f"{out}/data", f"{out}/cache", queries._echo_client, use_raw=True).collect()
    assert resumed and all(r.status == "done" for r in resumed)

    merged = pipeline.merge_and_publish(spark, f"{out}/data")
    assert merged.columns == fin.FINAL_COLUMNS
    n = merged.count()
    assert 0 < n <= n_final
    keys = merged.groupBy("name", "phone").count().filter("count > 1").count()
    assert keys == 0
    assert os.path.isdir(f"{out}/data/raw_data")


def test_each_outside_call_is_made_once(spark):
    """A model that answers differently every time: outputs must come from one set of replies."""
    out = tempfile.mkdtemp(prefix="pipeline-")
    raw = fx.merchant_raw(spark, SMALL)
    pages = fx.bind(spark, fx.LISTING_PAGES, merchant_raw=raw, last_page=fx.bind(spark, fx.LISTING_LAST_PAGE, merchant_raw=raw))
    calls, keys = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def client():
        import uuid

        def call(prompt):
            calls.add(1)
            return "ID|name\n" + "\n".join(f"{uuid.uuid4()}|{uuid.uuid4()}" for _ in range(3)) + "\n" + "|".join("x" * 20)
        return call

    def resolver():
        def find(key):
            keys.add(1)
            return 1.0, 2.0
        return find

    pipeline.run(spark, pages, f"{out}/data", f"{out}/cache", client, resolver=resolver)
    saved = spark.read.parquet(f"{out}/data/calls")
    asked = spark.read.parquet(f"{out}/data/resolved")
    assert calls.value == saved.count() > 0
    assert keys.value == asked.count() == asked.select("full_address_key").distinct().count() > 0
    final = spark.read.parquet(f"{out}/data/final")
    chunks = saved.count()
    assert final.count() == 3 * chunks and spark.read.parquet(f"{out}/data/rejects").count() == chunks
    text = "\n".join(r["response"] for r in saved.select("response").collect())
    assert all(r["id"] in text for r in final.select("id").collect())
    ledger = spark.read.parquet(f"{out}/data/ledger").collect()
    assert len(ledger) == chunks and all((r["n_rows"], r["n_rejects"], r["attempts"]) == (3, 1, 1) for r in ledger)
    cached = geo_cache.read_geo_cache(spark, f"{out}/cache")
    assert cached.count() == asked.count()


def test_merge_order_does_not_depend_on_the_plan(spark):
    out = tempfile.mkdtemp(prefix="pipeline-")
    rows = [(f"id{i}", "same", "p", "001", "111" if i % 2 else "103", "0009", i // 4, i % 4) for i in range(40)]
    import random
    results = []
    for seed, parts in ((1, 3), (2, 17)):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "id string, name string, phone string, city_code string, zip_code string, ind_code string, chunk_no bigint, line_no bigint").repartition(parts)
        root = f"{out}/{seed}"
        pipeline.fragments.write_batches(df, f"{root}/final")
        frags = pipeline.fragments.read_batches(spark, f"{root}/final", pipeline.FINAL_SCHEMA)
        results.append([r.id for r in pipeline.merge_final(frags, pipeline.MERGE_ORDER).collect()])
    assert results[0] == results[1] == ["id0"]
