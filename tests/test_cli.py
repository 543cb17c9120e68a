"""The command line drives run -> merge -> export on captured pages."""

import os
import tempfile

from placeflow import fixtures as fx
from placeflow.__main__ import main
from placeflow.plans import queries

SMALL = "/root/testdata/sf0.001"


def test_cli_run_merge_export(spark):
    root = tempfile.mkdtemp(prefix="cli-")
    raw = fx.merchant_raw(spark, SMALL)
    last = fx.bind(spark, fx.LISTING_LAST_PAGE, merchant_raw=raw)
    fx.bind(spark, fx.LISTING_PAGES, merchant_raw=raw, last_page=last).write.parquet(f"{root}/pages")
    _, _, resolver = queries._geo_inputs(spark, SMALL)
    resolver.write.parquet(f"{root}/gazetteer")
    args = ["run", "--pages", f"{root}/pages", "--out", f"{root}/out", "--cache", f"{root}/cache",
            "--client", "placeflow.plans.queries:_echo_client", "--resolver", f"{root}/gazetteer",
            "--zip", "111,103", "--industry", "0009,0008"]
    assert main(args) == 0
    final = spark.read.parquet(f"{root}/out/final")
    got = {(r.zip_code, r.ind_code) for r in final.select("zip_code", "ind_code").distinct().collect()}
    assert got and got <= {("111", "0009"), ("111", "0008"), ("103", "0009"), ("103", "0008")}
    assert main(["merge", "--out", f"{root}/out"]) == 0
    assert main(["export", "--out", f"{root}/out", "--tabs", f"{root}/tabs"]) == 0
    assert os.path.isdir(f"{root}/tabs/final") and os.path.isdir(f"{root}/tabs/raw")
