"""Command line: ``python -m placeflow <command>`` (or the same via spark-submit).

    run     --pages PATH --out DIR --cache DIR --client MOD:FACTORY
            [--resolver PATH | --resolver-fn MOD:FACTORY]
            [--city 001] [--zip 111,103] [--industry 0009,0008]
            [--use-raw] [--partitions N] [--per-round N]
    merge   --out DIR
    export  --out DIR --tabs DIR [--cache DIR]
    import  --tabs DIR --out DIR 

``--pages`` is a parquet table (city_code, zip_code, ind_code, page_no, html).
Defaults follow the source pipeline: city 001, every district, industry 0009.
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import SparkSession

from placeflow import dims
from placeflow.session import DEFAULT_CONF, ensure_checkpoint_dir, ship_package
from placeflow.sources.journal import PER_ROUND


def _load(ref: str):
    mod, _, name = ref.partition(":")
    return getattr(importlib.import_module(mod), name)


def _session() -> SparkSession:
    builder = SparkSession.builder.appName("placeflow")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="placeflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run")
    r.add_argument("--pages", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--cache", required=True)
    r.add_argument("--client", required=True, help="module:factory returning prompt -> reply")
    r.add_argument("--resolver", help="parquet table full_address_key, lat, lng")
    r.add_argument("--resolver-fn", help="module:factory returning key -> (lat, lng) | None")
    r.add_argument("--city", default=dims.DEFAULT_CITY)
    r.add_argument("--zip", help="district codes, comma separated (default: all)")
    r.add_argument("--industry", default=",".join(dims.DEFAULT_INDUSTRIES))
    r.add_argument("--use-raw", action="store_true", help="resume from the saved raw table")
    r.add_argument("--partitions", type=int, help="tasks that call the resolver and the model at once")
    r.add_argument("--per-round", type=int, default=PER_ROUND, help="chunks or keys whose answers are written at once")
    m = sub.add_parser("merge")
    m.add_argument("--out", required=True)
    m.add_argument("--allow-incomplete", action="store_true", help="publish without batches whose files are damaged")
    e = sub.add_parser("export")
    e.add_argument("--out", required=True)
    e.add_argument("--tabs", required=True)
    e.add_argument("--cache")
    i = sub.add_parser("import")
    i.add_argument("--tabs", required=True)
    i.add_argument("--out", required=True)
    args = ap.parse_args(argv)

    spark = _session()
    from placeflow.plans import pipeline

    if args.cmd == "run":
        from pyspark.sql import functions as F

        config = spark.createDataFrame(
            [(0, args.city, args.industry.split(","), args.zip.split(",") if args.zip else None)],
            "run_id int, city string, industries array<string>, districts array<string>",
        )
        resolver = None
        if args.resolver:
            resolver = spark.read.parquet(args.resolver)
        elif args.resolver_fn:
            resolver = _load(args.resolver_fn)
        pages = spark.read.parquet(args.pages)
        ledger = pipeline.run(spark, pages, args.out, args.cache, _load(args.client), resolver=resolver, config=config,
                              use_raw=args.use_raw, partitions=args.partitions, per_round=args.per_round)
        ledger.groupBy("status").agg(F.count(F.lit(1)).alias("items")).show()
    elif args.cmd == "merge":
        pipeline.merge_and_publish(spark, args.out, args.allow_incomplete)
    elif args.cmd == "export":
        from placeflow.sources import exchange, fragments

        frames = {name: fragments.read_published(spark, f"{args.out}/{name}_data") for name in ("final", "raw")}
        if args.cache:
            from placeflow.sources import geo_cache

            frames["geo_cache"] = geo_cache.read_geo_cache(spark, args.cache)
        exchange.export_targets(frames, args.tabs)
    elif args.cmd == "import":
        from placeflow.operators.finalize import FINAL_COLUMNS
        from placeflow.sources import exchange

        exchange.write_back(spark, f"{args.tabs}/final", FINAL_COLUMNS, f"{args.out}/final_data")
    return 0


if __name__ == "__main__":
    sys.exit(main())
