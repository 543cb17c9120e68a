"""Work items: which (city, district, industry) batches a run covers, and their state.

A run config row is ``(run_id, city, industries array, districts array or NULL)``.
The code lists are the small, fixed code tables (passed as Python lists, like
any job parameter); expanding a config to its batches uses ``explode`` over
those bounded arrays, so there is no join of data against data here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeflow import dims

BATCH = ["city_code", "zip_code", "ind_code"]


def _codes(rows) -> list[str]:
    return [c for c, _ in rows]


def _lit_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _keep_known(arr: Column, known: Column) -> Column:
    return F.filter(arr, lambda x: F.array_contains(known, x))


def expand_run_config(
    config: DataFrame,
    fallback_to_all_districts: bool = True,
    city_codes: Sequence[str] | None = None,
    district_codes: Sequence[str] | None = None,
    industry_codes: Sequence[str] | None = None,
) -> DataFrame:
    """Config rows -> (run_id, city_code, zip_code, ind_code, run_status).

    * unknown city -> the run fails (no items, ``run_status='failed'``)
    * unknown industries are dropped; none left -> the run fails
    * districts NULL or empty -> all; otherwise the known ones. If none is known,
      all districts with ``fallback_to_all_districts`` (scheduled runs), none
      without it (the per-district dispatcher, which also keeps repeats).
    Runs without items (failed, or no known district without fallback) keep one
    row with NULL district and industry so the ledger can count them.
    """
    all_c = _lit_array(_codes(dims.CITIES) if city_codes is None else city_codes)
    all_d = _lit_array(_codes(dims.DISTRICTS) if district_codes is None else district_codes)
    all_i = _lit_array(_codes(dims.INDUSTRIES) if industry_codes is None else industry_codes)
    req_d = F.col("districts")
    known_d = _keep_known(req_d, all_d)
    if fallback_to_all_districts:
        known_d = F.array_distinct(known_d)
        chosen = F.when(req_d.isNull() | (F.size(req_d) == 0) | (F.size(known_d) == 0), all_d).otherwise(known_d)
    else:
        chosen = F.when(req_d.isNull() | (F.size(req_d) == 0), all_d).otherwise(known_d)
    inds = F.array_distinct(_keep_known(F.col("industries"), all_i))
    ok = F.array_contains(all_c, F.col("city")) & (F.size(inds) > 0)
    # the district x industry product of one run, as one bounded array
    pairs = F.flatten(F.transform(chosen, lambda z: F.transform(inds, lambda i: F.struct(z.alias("zip_code"), i.alias("ind_code")))))
    staged = config.select(
        "run_id",
        F.col("city").alias("city_code"),
        F.when(ok, "success").otherwise("failed").alias("run_status"),
        F.when(ok, pairs).alias("_pairs"),
    )
    # explode_outer: a run without items keeps one row with NULL codes for the ledger
    return staged.select(
        "run_id",
        F.when(F.col("run_status") == "success", F.col("city_code")).alias("city_code"),
        F.explode_outer("_pairs").alias("_p"),
        "run_status",
    ).select("run_id", "city_code", "_p.zip_code", "_p.ind_code", "run_status")


def batch_row_counts(rows: DataFrame, batch_cols: Sequence[str] = BATCH) -> DataFrame:
    """Rows per batch (partial aggregation before the shuffle)."""
    return rows.groupBy(*batch_cols).agg(F.count(F.lit(1)).alias("n_rows"))


def attach_status(items: DataFrame, batch_rows: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Item status: 'done' if its output exists, else 'ready' with rows, else 'empty'.

    ``batch_rows`` has one row per batch (bounded by the code tables), so the
    join is a broadcast by Spark's own size check.
    """
    out = items.join(batch_rows, BATCH, "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)).cast("bigint"))
    status = F.when(F.col("n_rows") > 0, "ready").otherwise("empty")
    if done is not None:
        d = done.select(*BATCH).distinct().withColumn("_done", F.lit(True))
        out = out.join(d, BATCH, "left")
        status = F.when(F.col("_done"), "done").otherwise(status)
        out = out.withColumn("status", status).drop("_done")
    else:
        out = out.withColumn("status", status)
    return out


def skip_finished(items: DataFrame, done: DataFrame) -> DataFrame:
    """Items whose output does not exist yet (left anti join on the batch codes)."""
    return items.join(done.select(*BATCH).distinct(), BATCH, "left_anti")


def keep_known_codes(requests: DataFrame, city_dim: DataFrame, district_dim: DataFrame, industry_dim: DataFrame) -> DataFrame:
    """Requests whose three codes all exist (left semi joins)."""
    out = requests
    for col, dim in (("city_code", city_dim), ("zip_code", district_dim), ("ind_code", industry_dim)):
        out = out.join(dim.select(F.col("code").alias(col)), col, "left_semi")
    return out


def rejected_codes(requests: DataFrame, city_dim: DataFrame, district_dim: DataFrame, industry_dim: DataFrame) -> DataFrame:
    """(kind, code, n_requests) for every requested code missing from its table."""
    parts = []
    for kind, col, dim in (("city", "city_code", city_dim), ("district", "zip_code", district_dim), ("industry", "ind_code", industry_dim)):
        miss = requests.select(col).join(dim.select(F.col("code").alias(col)), col, "left_anti")
        parts.append(miss.groupBy(col).agg(F.count(F.lit(1)).alias("n_requests")).select(F.lit(kind).alias("kind"), F.col(col).alias("code"), "n_requests"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_summary(ledger: DataFrame) -> DataFrame:
    """Per run: status, items counted, items processed (not failed) and their states."""
    return ledger.groupBy("run_id").agg(
        F.max("run_status").alias("status"),
        F.count("zip_code").alias("total_count"),
        F.count_if(F.col("zip_code").isNotNull() & (F.col("run_status") == "success")).alias("processed_count"),
        F.count_if(F.col("status") == "done").alias("done_count"),
        F.count_if(F.col("status") == "ready").alias("ready_count"),
        F.count_if(F.col("zip_code").isNotNull() & (F.col("status") == "empty")).alias("empty_count"),
    )


def dispatch_plan(items: DataFrame) -> DataFrame:
    """One task per (city, district), its industries packed together."""
    return items.groupBy("city_code", "zip_code").agg(
        F.concat_ws(",", F.array_sort(F.collect_set("ind_code"))).alias("industries"),
        F.count(F.lit(1)).alias("n_items"),
    )
