"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Every query reads the driver tables (or data Spark derives from them) whole.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow import dims
from placeflow import fixtures as fx
from placeflow.functions.text import normalize_phone, normalize_place_text
from placeflow.operators import clean, enrich, tagging
from placeflow.operators import finalize as fin
from placeflow.operators import geocode as geo
from placeflow.operators import merge as mg
from placeflow.operators import price as pr
from placeflow.operators.dedupe import keep_first, upsert_latest
from placeflow.operators.lookup import attach_code_names, lookup_name
from placeflow.plans import pipeline
from placeflow.plans import work_items as wi
from placeflow.session import materialize, scratch_dir
from placeflow.sources import delimited
from placeflow.sources import exchange as ex
from placeflow.sources import fragments, journal
from placeflow.sources import listing as ls
from placeflow.streaming import incremental as inc

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name_or_fn):
    """Register a query under its function name or an explicit name."""
    if callable(name_or_fn):
        REGISTRY[name_or_fn.__name__] = name_or_fn
        return name_or_fn

    def deco(fn):
        REGISTRY[name_or_fn] = fn
        return fn
    return deco


def _merchant_clean(spark, sf_dir):
    return clean.merchant_clean(fx.merchant_raw(spark, sf_dir))


@query("normalize_place_text")
def _q_normalize_place_text(spark, sf_dir):
    raw = fx.merchant_raw(spark, sf_dir)
    return raw.select("seq", normalize_place_text("name_raw").alias("name"), normalize_place_text("address_raw").alias("address"))


@query("normalize_phone")
def _q_normalize_phone(spark, sf_dir):
    raw = fx.merchant_raw(spark, sf_dir)
    return raw.select("seq", normalize_phone("phone_raw").alias("phone"))


@query
def normalize_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    t = normalize_place_text("text")
    return docs.select("doc_id", t.alias("text_clean"), F.length(t).cast("bigint").alias("n_chars_clean"))


@query
def dedupe_first(spark, sf_dir):
    return _merchant_clean(spark, sf_dir)


@query
def district_counts(spark, sf_dir):
    return clean.district_counts(_merchant_clean(spark, sf_dir))


@query
def events_first_per_user(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "ts", "event_id", "event_type", "value")
    return keep_first(ev, ["user_id"], ["ts", "event_id"]).drop("ts")


@query
def events_last_per_user(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "ts", "event_id", "event_type", "value")
    return keep_first(ev, ["user_id"], ["ts", "event_id"], last=True).drop("ts")


# ---------------- dimensions, requests and work items ----------------


def _dims(spark):
    return dims.dim_city(spark), dims.dim_district(spark), dims.dim_industry(spark)


def _requests(spark, sf_dir):
    return fx.bind(spark, fx.RUN_REQUESTS, **fx.tables(spark, sf_dir, "customer"))


def _done_batches(raw):
    # stand-in for "final output exists": batches with an even district code
    return raw.filter((F.col("zip_code").cast("int") % 2) == 0).select(*wi.BATCH).distinct()


def _configs(spark, sf_dir):
    cfg = fx.bind(spark, fx.RUN_CONFIGS, **fx.tables(spark, sf_dir, "customer"))
    return cfg.select(
        "run_id", "city",
        F.split("industries_text", ",").alias("industries"),
        F.split("districts_text", ",").alias("districts"),
    )


@query
def code_lookup(spark, sf_dir):
    c, d, i = _dims(spark)
    named = attach_code_names(_requests(spark, sf_dir), ind_col="ind_code", city_dim=c, district_dim=d, industry_dim=i)
    return named.select("request_id", "city", "district", "industry")


@query
def rejected_codes(spark, sf_dir):
    return wi.rejected_codes(_requests(spark, sf_dir), *_dims(spark))


def _work_items(spark, sf_dir, with_done):
    req = wi.keep_known_codes(_requests(spark, sf_dir), *_dims(spark))
    items = req.groupBy(*wi.BATCH).agg(F.count(F.lit(1)).alias("n_requests"))
    raw = fx.merchant_raw(spark, sf_dir)
    return items, wi.attach_status(items, wi.batch_row_counts(raw), _done_batches(raw) if with_done else None), raw


@query
def work_items(spark, sf_dir):
    return _work_items(spark, sf_dir, True)[1]


@query
def pending_work_items(spark, sf_dir):
    _, items, raw = _work_items(spark, sf_dir, False)
    return wi.skip_finished(items, _done_batches(raw))


@query
def dispatch_plan(spark, sf_dir):
    return wi.dispatch_plan(_work_items(spark, sf_dir, False)[0])


@query
def run_work_items(spark, sf_dir):
    return wi.expand_run_config(_configs(spark, sf_dir))


@query
def dispatch_work_items(spark, sf_dir):
    return wi.expand_run_config(_configs(spark, sf_dir), fallback_to_all_districts=False)


@query
def run_summary(spark, sf_dir):
    items = wi.expand_run_config(_configs(spark, sf_dir))
    raw = fx.merchant_raw(spark, sf_dir)
    ledger = wi.attach_status(items, wi.batch_row_counts(raw), _done_batches(raw))
    return wi.run_summary(ledger)


# ---------------- geocoding ----------------


def _geo_inputs(spark, sf_dir):
    # keyed merchants feed the gazetteer, the cache and the rows: materialise once
    mc = materialize(geo.add_full_address_key(_merchant_clean(spark, sf_dir)))
    gaz = fx.bind(spark, fx.GAZETTEER, keyed=mc)
    cache = fx.bind(spark, fx.GEO_CACHE, gazetteer=gaz)
    # the resolver knows every key but every 7th
    resolver = gaz.filter((F.col("k") % 7) != 0)
    return mc, cache, resolver


@query
def full_address_key(spark, sf_dir):
    return geo.add_full_address_key(_merchant_clean(spark, sf_dir)).select("seq", "full_address_key")


@query
def cache_read(spark, sf_dir):
    _, cache, _ = _geo_inputs(spark, sf_dir)
    return geo.dedupe_cache(cache)


@query
def geocode_join(spark, sf_dir):
    mc, cache, _ = _geo_inputs(spark, sf_dir)
    return geo.geocode_join(mc, geo.dedupe_cache(cache)).select("seq", "full_address_key", "lat", "lng")


@query
def geocode_pending(spark, sf_dir):
    mc, cache, _ = _geo_inputs(spark, sf_dir)
    return geo.pending_keys(geo.geocode_join(mc, geo.dedupe_cache(cache)))


@query
def geocode_resolve(spark, sf_dir):
    mc, cache, resolver = _geo_inputs(spark, sf_dir)
    rows, _ = geo.geocode(mc, cache, resolver)
    return rows.select("seq", "full_address_key", "lat", "lng")


@query
def cache_upsert(spark, sf_dir):
    mc, cache, resolver = _geo_inputs(spark, sf_dir)
    _, new_rows = geo.geocode(mc, cache, resolver)
    fresh = new_rows.select("full_address_key", "lat", "lng", F.lit(2).cast("bigint").alias("gen"), F.lit(0).cast("bigint").alias("seq"))
    return upsert_latest(cache, fresh, "full_address_key").select("full_address_key", "lat", "lng", "gen")


# ---------------- tagging ----------------


@query
def synonym_tags(spark, sf_dir):
    mc = _merchant_clean(spark, sf_dir)
    return tagging.synonym_tags(mc, dims.synonyms(spark), fuzzy=False).select("seq", "name", "hidden_tags")


@query
def synonym_tags_fuzzy(spark, sf_dir):
    mc = _merchant_clean(spark, sf_dir)
    return tagging.synonym_tags(mc, dims.synonyms(spark), fuzzy=True).select("seq", "name", "hidden_tags")


@query
def document_tags(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").alias("name"))
    return tagging.synonym_tags(docs, dims.synonyms(spark), fuzzy=False).select("doc_id", "hidden_tags")


# ---------------- enrichment: batches, prompts, replies, final rows ----------------


def _enrich_batches(spark, sf_dir):
    mc, cache, resolver = _geo_inputs(spark, sf_dir)
    rows, _ = geo.geocode(mc, cache, resolver)
    rows = tagging.synonym_tags(rows, dims.synonyms(spark), fuzzy=False)
    rows = lookup_name(rows, "ind_code", dims.INDUSTRIES, "industry")
    # the saved raw table of the source pipeline: enrichment starts from it
    return materialize(enrich.enrichment_batches(rows))


def _responses(spark, sf_dir):
    return fx.bind(spark, fx.RESPONSES, batches=_enrich_batches(spark, sf_dir))


def _parsed(spark, sf_dir):
    return delimited.read_delimited(_responses(spark, sf_dir), ["city_code", "zip_code", "ind_code", "chunk_no"])


@query
def enrichment_batches(spark, sf_dir):
    return _enrich_batches(spark, sf_dir).select("city_code", "zip_code", "ind_code", "seq", "idx", "chunk_no", "temp_id")


@query
def enrichment_prompts(spark, sf_dir):
    return enrich.enrichment_prompts(_enrich_batches(spark, sf_dir))


@query
def parse_response(spark, sf_dir):
    return _parsed(spark, sf_dir)[0]


@query
def response_rejects(spark, sf_dir):
    return _parsed(spark, sf_dir)[1]


@query
def finalize_places(spark, sf_dir):
    batches = _enrich_batches(spark, sf_dir)
    rows, _ = delimited.read_delimited(fx.bind(spark, fx.RESPONSES, batches=batches), ["city_code", "zip_code", "ind_code", "chunk_no"])
    return fin.finalize_places(fin.attach_chunk_tags(rows, batches))


def _echo_client():
    """A stand-in model: answers each prompt with its own input rows as a reply table."""
    def call(prompt: str) -> str:
        body = prompt.split(enrich.PROMPT_INPUT_HEADER, 1)[1].splitlines()[1:]
        out = [enrich.REPLY_FIELDS_ZH]
        for line in body:
            f = line.split(",")
            if len(f) >= 9:
                out.append("|".join([f[0], f[3], f[1], f[2], f[6], "", f[7], f[8], f[5], "", "", ""]))
        return "\n".join(out)
    return call


@query
def enrichment_calls(spark, sf_dir):
    calls = enrich.call_enrichment(enrich.enrichment_prompts(_enrich_batches(spark, sf_dir)), _echo_client)
    rows, _ = delimited.read_delimited(calls, ["city_code", "zip_code", "ind_code", "chunk_no"])
    return rows


def _moody_client():
    """The stand-in model, useless at first for some batches and always for others: by the
    codes in the first row's id (city_zip_ind_index), city left out."""
    echo, asked = _echo_client(), {}

    def call(prompt: str) -> str:
        first = prompt.split(enrich.PROMPT_INPUT_HEADER, 1)[1].splitlines()[1].split(",")[0]
        kind = sum(int(x) for x in first.split("_")[1:3]) % 5
        asked[prompt] = asked.get(prompt, 0) + 1
        if kind == 4 or kind == 2 and asked[prompt] == 1:
            return "Sorry, no table today."
        return echo(prompt)
    return call


@query
def enrichment_ledger(spark, sf_dir):
    """Calls saved once; rows, rejects and the ledger all come from the saved replies."""
    calls = materialize(enrich.call_enrichment(enrich.enrichment_prompts(_enrich_batches(spark, sf_dir)), _moody_client))
    rows, rejects = delimited.read_delimited(calls.filter(F.col("response").isNotNull()), ["city_code", "zip_code", "ind_code", "chunk_no"])
    return enrich.enrichment_ledger(calls, rows, rejects)


def _later_client(run: int):
    """``_moody_client`` that answers the first kind from the second run on."""
    echo = _echo_client()

    def call(prompt: str) -> str:
        first = prompt.split(enrich.PROMPT_INPUT_HEADER, 1)[1].splitlines()[1].split(",")[0]
        kind = sum(int(x) for x in first.split("_")[1:3]) % 5
        return "Sorry, no table today." if kind == 4 or kind == 2 and run == 0 else echo(prompt)
    return call


@query
def enrichment_resume(spark, sf_dir):
    """Four runs over one journal: only chunks without a reply are asked again, up to nine tries."""
    root = scratch_dir(spark, "resume-calls")
    prompts = materialize(enrich.with_fingerprint(enrich.enrichment_prompts(_enrich_batches(spark, sf_dir))))
    for run in range(4):
        enrich.ask_model(prompts, functools.partial(_later_client, run), root, max_attempts=9)
    calls = materialize(enrich.saved_calls(prompts, root))
    rows, rejects = delimited.read_delimited(calls.filter(F.col("response").isNotNull()), ["city_code", "zip_code", "ind_code", "chunk_no"])
    times = journal.read_journal(spark, root, enrich.CALL_SCHEMA).groupBy("city_code", "zip_code", "ind_code", "chunk_no").agg(
        F.count(F.lit(1)).alias("n_asked"))
    return enrich.enrichment_ledger(calls, rows, rejects).join(times, ["city_code", "zip_code", "ind_code", "chunk_no"])


def _length_resolver(run: int):
    """A stand-in service: coordinates from a key's length and digits; some keys it does not
    know, some it always fails on, some in the first run only."""
    def find(key: str):
        n = len(key)
        if n % 7 == 0:
            return None
        if n % 11 == 0 or n % 3 == 0 and run == 0:
            raise ValueError("busy")
        return float(n), float(sum(c in "0123456789" for c in key))
    return find


@query
def resolver_calls(spark, sf_dir):
    """Distinct pending keys asked of a resolver function in three runs over one journal."""
    mc, cache, _ = _geo_inputs(spark, sf_dir)
    pending = materialize(geo.pending_keys(geo.geocode_join(mc, geo.dedupe_cache(cache))))
    root = scratch_dir(spark, "resume-keys")
    for run in range(3):
        answers = geo.resolve_with_journal(pending, functools.partial(_length_resolver, run), root, max_attempts=2)
    return answers


@query
def resume_from_raw(spark, sf_dir):
    """The job started from saved raw batches: chunks, calls, replies and typed final rows."""
    root = scratch_dir(spark, "resume-raw")
    raw = _enrich_batches(spark, sf_dir).drop("idx", "chunk_no", "temp_id")
    fragments.write_batches(raw, f"{root}/raw")
    pipeline.run(spark, None, root, f"{root}/cache", _echo_client, use_raw=True)
    final = fragments.read_batches(spark, f"{root}/final", pipeline.FINAL_SCHEMA)
    return final.select(*fin.FINAL_COLUMNS, "chunk_no", "line_no", "city_code", "zip_code", "ind_code")


# ---------------- merge, exchange, price level ----------------


def _final_with_order(spark, sf_dir):
    batches = _enrich_batches(spark, sf_dir)
    rows, _ = delimited.read_delimited(fx.bind(spark, fx.RESPONSES, batches=batches), ["city_code", "zip_code", "ind_code", "chunk_no"])
    final = fin.finalize_places(fin.attach_chunk_tags(rows, batches), extra=("chunk_no", "line_no"))
    return materialize(final), batches


def _fragments(spark, sf_dir):
    final, _ = _final_with_order(spark, sf_dir)
    return materialize(fx.bind(spark, fx.FRAGMENTS, final=final))


@query
def merge_fragments(spark, sf_dir):
    return mg.merge_final(_fragments(spark, sf_dir)).select(*fin.FINAL_COLUMNS, "file_name", "row_index")


@query
def merge_fragment_files(spark, sf_dir):
    """Final rows written as batch folders, read back with their positions, merged in batch,
    chunk and line order, published and read again."""
    final, _ = _final_with_order(spark, sf_dir)
    root = scratch_dir(spark, "fragment-files")
    fragments.write_batches(final, f"{root}/final")
    frags = fragments.read_batches(spark, f"{root}/final", pipeline.FINAL_SCHEMA)
    fragments.publish(mg.merge_final(frags, pipeline.MERGE_ORDER).select(*fin.FINAL_COLUMNS), f"{root}/final_data")
    return fragments.read_published(spark, f"{root}/final_data")


@query
def alias_tags(spark, sf_dir):
    """A large dictionary (the words of the benchmark, tagged by their first letters) over the
    whole texts of all documents."""
    words = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{5,}"), 0)).alias("w")).distinct()
    syn = words.groupBy(F.substring("w", 1, 2).alias("tag")).agg(F.array_sort(F.collect_list("w")).alias("aliases"))
    syn = syn.withColumn("alias_text", F.array_join("aliases", " "))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return tagging.synonym_tags(docs, syn, name="text", out="tags", fuzzy=False).select("doc_id", "tags")


@query
def replaced_batches(spark, sf_dir):
    """All batches written, then those of odd district codes again with other rows; what is
    current is read back."""
    final, _ = _final_with_order(spark, sf_dir)
    root = scratch_dir(spark, "replaced-batches")
    fragments.write_batches(final, root)
    again = final.where(F.col("zip_code").cast("int") % 2 == 1).where(F.col("line_no") % 3 > 0)
    fragments.write_batches(again.withColumn("name", F.concat("name", F.lit("*"))), root)
    return fragments.read_batches(spark, root, pipeline.FINAL_SCHEMA).drop("file_name", "row_index")


@query
def mixed_fragments(spark, sf_dir):
    """Fragment files that disagree: coordinates as numbers or text, a column some lack, whole
    numbers of two sizes."""
    final, _ = _final_with_order(spark, sf_dir)
    rows = final.select("id", "name", "floor", "lat", "lng", "chunk_no", "line_no")
    root = scratch_dir(spark, "mixed-fragments")
    part = [rows.where(F.col("line_no") % 3 == i) for i in range(3)]
    part[1] = part[1].withColumns({"lat": F.col("lat").cast("string"), "lng": F.coalesce(F.col("lng").cast("string"), F.lit("n/a"))})
    part[2] = part[2].drop("floor").withColumn("chunk_no", F.col("chunk_no").cast("int"))
    for i, df in enumerate(part):
        df.write.parquet(f"{root}/final_{i}.parquet")
    schema = "id string, name string, floor string, lat double, lng double, chunk_no bigint, line_no bigint"
    return fragments.read_fragments(spark, root, schema=schema).drop("file_name", "row_index")


@query
def tab_files(spark, sf_dir):
    """Fragments written as CSV tabs and read back; long names are cut to the same tab."""
    stem = F.concat(F.replace("file_name", F.lit(".parquet"), F.lit("")), F.lit("_" + "x" * 40), F.col("row_index") % 3, F.lit(".parquet"))
    frags = materialize(_fragments(spark, sf_dir).withColumn("file_name", stem))
    root = scratch_dir(spark, "tab-files")
    ex.export_fragment_tabs(frags.select(*fin.FINAL_COLUMNS, "file_name", "row_index"), root)
    return ex.read_fragment_tabs(spark, root, fin.FINAL_COLUMNS)


@query
def exchange_files(spark, sf_dir):
    """The merged dataset as a CSV tab (with quotes, newlines and outer spaces) and back."""
    merged = mg.merge_final(_fragments(spark, sf_dir)).select(*fin.FINAL_COLUMNS)
    odd = merged.withColumn("review_summary", F.concat(F.lit(' "a"\n, '), F.col("review_summary"), F.lit("\r\n|  ")))
    root = scratch_dir(spark, "exchange")
    ex.export_exchange(odd, f"{root}/tab")
    return ex.import_exchange(spark, f"{root}/tab", fin.FINAL_COLUMNS)


@query
def merge_raw(spark, sf_dir):
    raw = fx.bind(spark, fx.RAW_FRAGMENTS, batches=_enrich_batches(spark, sf_dir))
    return mg.merge_raw(raw).select("seq", "city", "district", "industry", "name", "file_name", "row_index")


@query
def dedupe_report(spark, sf_dir):
    return mg.dedupe_report(_fragments(spark, sf_dir))


@query
def fragment_counts(spark, sf_dir):
    return mg.fragment_counts(_fragments(spark, sf_dir))


@query
def merged_district_counts(spark, sf_dir):
    return clean.district_counts(mg.merge_final(_fragments(spark, sf_dir)))


@query
def export_tabs(spark, sf_dir):
    return mg.export_tabs(_fragments(spark, sf_dir))


@query
def export_rows(spark, sf_dir):
    merged = mg.merge_final(_fragments(spark, sf_dir)).select(*fin.FINAL_COLUMNS, "file_name", "row_index")
    return ex.export_rows(merged)


@query
def import_rows(spark, sf_dir):
    merged = mg.merge_final(_fragments(spark, sf_dir)).select(*fin.FINAL_COLUMNS, "file_name", "row_index")
    tab = fx.bind(spark, fx.EXCHANGE, rows=ex.export_rows(merged))
    return ex.import_rows(tab)


PRICE_ROWS = dims.PRICE_THRESHOLDS + [("MEDIUM", [900.0, 950.0, 1000.0, 1500.0])]


@query
def price_level(spark, sf_dir):
    items = fx.bind(spark, fx.PRICE_INPUT, **fx.tables(spark, sf_dir, "part"))
    return pr.price_level(items, dims.dim_price(spark, PRICE_ROWS))


# ---------------- listing pages ----------------


def _listing_pages(spark, sf_dir):
    raw = fx.merchant_raw(spark, sf_dir)
    last = fx.bind(spark, fx.LISTING_LAST_PAGE, merchant_raw=raw)
    return fx.bind(spark, fx.LISTING_PAGES, merchant_raw=raw, last_page=last)


@query
def listing_rows(spark, sf_dir):
    return ls.extract_rows(ls.classify_pages(_listing_pages(spark, sf_dir)))


@query
def listing_cutoff(spark, sf_dir):
    return ls.page_cutoff(ls.classified_pages(_listing_pages(spark, sf_dir)))


@query
def listing_cap(spark, sf_dir):
    rows = ls.extract_rows(ls.classified_pages(_listing_pages(spark, sf_dir)))
    per_page = rows.groupBy("city_code", "zip_code", "ind_code", "page_no").agg(F.count(F.lit(1)).alias("n_rows"))
    return ls.page_cap(per_page, max_limit=40)


@query
def listing_merchants(spark, sf_dir):
    return ls.listing_merchants(_listing_pages(spark, sf_dir))


# ---------------- streaming re-runs ----------------

N_ARRIVALS = 3


@query
def merge_incremental(spark, sf_dir):
    """Fragments arrive in three drops; each run folds only the new files."""
    root = scratch_dir(spark, "merge-incremental")
    _fragments(spark, sf_dir).write.parquet(f"{root}/staged")
    staged = spark.read.parquet(f"{root}/staged")
    schema = staged.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    out = None
    for part in range(N_ARRIVALS):
        staged.filter(F.pmod(F.hash("file_name"), F.lit(N_ARRIVALS)) == part).write.mode("append").parquet(f"{root}/src")
        out = inc.merge_incremental(spark, f"{root}/src", schema, f"{root}/state", f"{root}/ckpt")
    return out.select(*fin.FINAL_COLUMNS, "file_name", "row_index")


@query
def cache_upsert_stream(spark, sf_dir):
    """Resolver answers arrive in two drops and are upserted into a versioned cache."""
    mc, cache, resolver = _geo_inputs(spark, sf_dir)
    _, new_rows = geo.geocode(mc, cache, resolver)
    root = scratch_dir(spark, "cache-stream")
    cache.select("full_address_key", "lat", "lng", "gen", "seq").write.parquet(f"{root}/cache/v=0")
    new_rows.write.parquet(f"{root}/staged")
    staged = spark.read.parquet(f"{root}/staged")
    out = None
    for part in range(2):
        staged.filter(F.pmod(F.hash("full_address_key"), F.lit(2)) == part).write.mode("append").parquet(f"{root}/src")
        out = inc.cache_upsert_stream(spark, f"{root}/src", f"{root}/cache", f"{root}/ckpt")
    return out.select("full_address_key", "lat", "lng")
FLAGSHIP = "merge_fragments"


@query
def page_kinds(spark, sf_dir):
    """The listing page classifier over the driver's raw web pages, whole."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
    return ls.classify_pages(pages).select("page_id", "n_tables", "kind")
