"""The whole place job as one Spark application (all batches in one plan per stage).

    pages -> rows -> clean + dedupe -> geocode (cached) -> tags -> saved raw table
      -> chunked enrichment -> typed final table -> merge + global dedupe -> published

Stage boundaries are written tables under ``out_root`` (the saved raw table is
what enrichment starts from, as in the source pipeline), so a lost executor
costs at most the current stage. Batches whose final output exists are skipped.
Resolver and model are asked once: their answers are written as they come to journals
(``resolved``, ``calls``) and everything else is derived from these. A run that is lost goes on
from its journals; chunks without a usable reply are asked again by the next run, also in
batches that are otherwise finished.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow import dims
from placeflow.operators import enrich, geocode, tagging
from placeflow.operators import finalize as fin
from placeflow.operators.clean import clean_merchants
from placeflow.operators.dedupe import dedupe_merchants
from placeflow.operators.lookup import attach_code_names
from placeflow.operators.merge import merge_final, merge_raw
from placeflow.plans import work_items as wi
from placeflow.session import materialize
from placeflow.sources import delimited, fragments, geo_cache, journal, listing

BATCH = ["city_code", "zip_code", "ind_code"]
FINAL_SCHEMA = (
    "id string, name string, ind string, city string, district string, address string, floor string, "
    "lat double, lng double, phone string, review_summary string, rating string, price_level string, "
    "hidden_tags string, chunk_no bigint, line_no bigint, city_code string, zip_code string, ind_code string"
)
CHUNK_COLUMNS = "chunk_no bigint, fingerprint string, city_code string, zip_code string, ind_code string"
# the order in which batches and their lines are merged
MERGE_ORDER = [*BATCH, "chunk_no", "line_no"]


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def finished_batches(spark: SparkSession, out_root: str) -> DataFrame:
    """Batches whose final output exists (partition values of the final table)."""
    if not _exists(spark, f"{out_root}/final"):  # nothing written yet
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in BATCH))
    return fragments.read_batches(spark, f"{out_root}/final", FINAL_SCHEMA).select(*BATCH).distinct()


def current_chunks(spark: SparkSession, out_root: str) -> DataFrame:
    """The chunks that the current batches consist of (BATCH, chunk_no, fingerprint)."""
    if not _exists(spark, f"{out_root}/chunks"):
        return spark.createDataFrame([], CHUNK_COLUMNS)
    return fragments.read_batches(spark, f"{out_root}/chunks", CHUNK_COLUMNS).drop("file_name", "row_index")


def rows_from_pages(pages: DataFrame, max_rows_per_batch: int | None = None) -> DataFrame:
    """Listing pages -> raw merchant rows in the cleaner's input shape."""
    rows = listing.listing_merchants(pages, max_rows_per_batch=max_rows_per_batch)
    return rows.select(
        *BATCH, "page_no", F.col("row_no").alias("seq"),
        F.col("name").alias("name_raw"), "industry_text",
        F.col("phone").alias("phone_raw"), F.col("address").alias("address_raw"),
    )


def prepare_raw(raw_rows: DataFrame, cache: DataFrame, resolver=None, synonyms: DataFrame | None = None, fuzzy: bool = True,
                save: Callable[[DataFrame], DataFrame] = materialize, bulk: bool = False, partitions: int | None = None,
                answers_root: str | None = None, per_round: int = journal.PER_ROUND):
    """Clean, de-duplicate, geocode and tag; returns (raw table, new cache rows).

    A resolver function is asked through the journal at ``answers_root``; without one ``save``
    writes the resolver's answers and returns the written table."""
    spark = raw_rows.sparkSession
    cleaned = dedupe_merchants(clean_merchants(raw_rows))
    named = attach_code_names(cleaned, ind_col="ind_code").withColumnRenamed("industry", "industry_name")
    rows, new_cache = geocode.geocode(named, cache, resolver, bulk, partitions, save, answers_root, per_round)
    rows = tagging.synonym_tags(rows, synonyms if synonyms is not None else dims.synonyms(spark), fuzzy=fuzzy)
    industry = F.coalesce(F.col("industry_text"), F.col("industry_name")) if "industry_text" in rows.columns else F.col("industry_name")
    return rows.withColumn("industry", industry).drop("industry_name", geocode.KEY), new_cache


def finalize_calls(raw: DataFrame, calls: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(final rows with chunk_no and line_no, reply rejects, ledger) from the saved calls."""
    rows, rejects = delimited.read_delimited(calls.filter(F.col("response").isNotNull()), [*BATCH, "chunk_no"])
    final = fin.finalize_places(fin.attach_chunk_tags(rows, enrich.enrichment_batches(raw)), extra=("chunk_no", "line_no"))
    return final, rejects, enrich.enrichment_ledger(calls, rows, rejects)


def run(
    spark: SparkSession,
    pages: DataFrame | None,
    out_root: str,
    cache_root: str,
    client_factory: Callable[[], Callable[[str], str]],
    resolver=None,
    config: DataFrame | None = None,
    synonyms: DataFrame | None = None,
    max_rows_per_batch: int | None = None,
    use_raw: bool = False,
    bulk: bool = False,
    partitions: int | None = None,
    per_round: int = journal.PER_ROUND,
    max_attempts: int = journal.MAX_ATTEMPTS,
) -> DataFrame:
    """Process every pending batch; returns the work-item ledger.

    ``use_raw`` resumes from the saved raw table instead of the pages; ``partitions`` is the
    number of tasks that call the resolver and the model at once, ``per_round`` the number of
    keys or chunks whose answers a lost run may lose, ``max_attempts`` the tries of a chunk
    over all runs.
    """
    done = finished_batches(spark, out_root)
    known = fragments.read_batches(spark, f"{out_root}/raw") if use_raw else pages
    if config is not None:
        items = wi.expand_run_config(config).filter(F.col("zip_code").isNotNull()).select(*BATCH).distinct()
        known = known.join(items, BATCH, "left_semi")
    # which batches this run works on, fixed before anything is written
    all_batches = materialize(known.select(*BATCH).distinct())
    pending = materialize(all_batches.join(done, BATCH, "left_anti"))

    if not use_raw:
        raw_rows = rows_from_pages(pages.join(pending, BATCH, "left_semi"), max_rows_per_batch)
        raw, new_cache = prepare_raw(raw_rows, geo_cache.read_geo_cache(spark, cache_root), resolver, synonyms, bulk=bulk,
                                     partitions=partitions, answers_root=f"{out_root}/resolved", per_round=per_round)
        fragments.write_batches(raw, f"{out_root}/raw")
        if resolver is not None and not new_cache.isEmpty():
            geo_cache.write_geo_cache(spark, cache_root, new_cache)

    # enrichment starts from the saved raw table: this run's batches and those with open chunks
    replies = f"{out_root}/calls"
    known = enrich.read_calls(spark, replies)
    listed = current_chunks(spark, out_root).select("fingerprint", *BATCH)
    unanswered = known.where(~F.col("answered") & (F.col("attempts") < max_attempts)).select("fingerprint")
    again = listed.join(unanswered, "fingerprint", "left_semi").select(*BATCH).join(all_batches, BATCH, "left_semi")
    work = materialize(pending.unionByName(again).distinct())
    saved = fragments.read_batches(spark, f"{out_root}/raw").drop("file_name", "row_index").join(work, BATCH, "left_semi")
    prompts = materialize(enrich.with_fingerprint(enrich.enrichment_prompts(enrich.enrichment_batches(saved))))
    enrich.ask_model(prompts, client_factory, replies, max_attempts=max_attempts, partitions=partitions, per_round=per_round)
    fragments.write_batches(prompts.select(*BATCH, "chunk_no", "fingerprint"), f"{out_root}/chunks")
    all_calls = materialize(enrich.saved_calls(current_chunks(spark, out_root), replies))
    final, _, _ = finalize_calls(saved, all_calls.join(work, BATCH, "left_semi"))
    fragments.write_batches(final, f"{out_root}/final")
    _, rejects, ledger = finalize_calls(saved, all_calls)
    rejects.write.mode("overwrite").parquet(f"{out_root}/rejects")
    ledger.write.mode("overwrite").parquet(f"{out_root}/ledger")

    batch_rows = wi.batch_row_counts(fragments.read_batches(spark, f"{out_root}/raw"))
    return wi.attach_status(all_batches, batch_rows, finished_batches(spark, out_root))


def merge_and_publish(spark: SparkSession, out_root: str, allow_incomplete: bool = False) -> DataFrame:
    """Merge all final batches (global first-wins dedupe) and the raw batches; publish both.

    A batch file that cannot be read stops the merge and nothing is published. With
    ``allow_incomplete`` every batch file is checked first: the report is published as
    ``merge_report``, batches with a damaged file become pending again (the next run makes
    them anew) and the merge goes on without them."""
    if allow_incomplete:
        reports = []
        for kind in ("final", "raw"):
            report = materialize(fragments.batch_report(spark, f"{out_root}/{kind}").withColumn("kind", F.lit(kind)))
            fragments.quarantine(spark, f"{out_root}/{kind}", report)
            reports.append(report)
        fragments.publish(reports[0].unionByName(reports[1]), f"{out_root}/merge_report")
    final = merge_final(fragments.read_batches(spark, f"{out_root}/final", FINAL_SCHEMA), MERGE_ORDER)
    fragments.publish(final.select(*fin.FINAL_COLUMNS), f"{out_root}/final_data")
    fragments.publish(merge_raw(fragments.read_batches(spark, f"{out_root}/raw")), f"{out_root}/raw_data")
    return fragments.read_published(spark, f"{out_root}/final_data")
