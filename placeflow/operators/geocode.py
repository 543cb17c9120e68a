"""Geocoding against a keyed cache, resolving only what the cache lacks.

Plan: rows get a ``full_address_key``; they are left-joined to the cache (Spark
picks broadcast or sort-merge by size, AQE splits a hot key); only the
*distinct* keys still missing a coordinate go to the resolver, once each; the
answers are joined back and become the next cache version.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.functions.text import full_address
from placeflow.operators.dedupe import keep_first
from placeflow.session import materialize
from placeflow.sources import journal

KEY = "full_address_key"
RESOLVED_SCHEMA = "full_address_key string, lat double, lng double"


def add_full_address_key(df: DataFrame, address: str = "address", district: str = "district", city: str = "city") -> DataFrame:
    return df.withColumn(KEY, full_address(address, district, city))


def dedupe_cache(cache: DataFrame, order=("gen", "seq"), last: bool = False) -> DataFrame:
    """One row per key: the first version on read, the last on write."""
    cols = [c for c in (KEY, "lat", "lng") if c in cache.columns]
    order = [o for o in order if o in cache.columns] or [KEY]
    return keep_first(cache, [KEY], order, last=last).select(*cols)


def geocode_join(rows: DataFrame, cache: DataFrame) -> DataFrame:
    """Rows left-joined to the (deduplicated) cache on the address key."""
    c = cache.select(KEY, "lat", "lng")
    base = rows.drop("lat", "lng") if "lat" in rows.columns else rows
    return base.join(c, KEY, "left")


def needs_geocode(lat: str = "lat", lng: str = "lng"):
    return F.col(lat).isNull() | F.col(lng).isNull()


def pending_keys(joined: DataFrame) -> DataFrame:
    """Distinct keys that still miss a coordinate (each resolved once)."""
    return joined.filter(needs_geocode()).select(KEY).distinct()


def resolve_with_table(pending: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Resolver answers from a table: inner join, so unknown keys stay unresolved."""
    g = gazetteer.select(KEY, "lat", "lng").filter(F.col("lat").isNotNull() & F.col("lng").isNotNull())
    return pending.join(g, KEY, "inner")


def resolve_with_function(pending: DataFrame, make_resolver: Callable[[], Callable], bulk: bool = False,
                          partitions: int | None = None) -> DataFrame:
    """Resolver answers from a user function, run inside the executors.

    ``make_resolver()`` is called once per partition (build the client there).
    The returned function resolves each distinct key once: ``resolve(key) ->
    (lat, lng) | None``, or with ``bulk=True`` ``resolve(keys) -> [(lat, lng) |
    None, ...]`` for one Arrow batch of keys at a time. Every key gives one row: failures
    (exceptions, or a bulk answer of another length) leave lat and lng NULL with the reason
    in ``error``; a plain None has no error. Calls run in ``partitions`` tasks at once. After
    ``journal.StopAsking`` a task asks no more; its other keys hold that error.
    """

    def told(e: BaseException) -> str:  # the caller's own service: reported, not hidden
        if not isinstance(e, Exception) and not journal.ends_run(e):
            raise e
        return (journal.STOPPED if journal.ends_run(e) else "") + f"{type(e).__name__}: {e}"

    def answers(resolve, keys: list[str]) -> list[tuple]:
        if bulk:
            try:
                got = list(resolve(keys))
            except BaseException as e:
                return [(None, told(e))] * len(keys)
            if len(got) != len(keys):
                return [(None, f"{len(got)} answers for {len(keys)} keys")] * len(keys)
            return [(hit, None) for hit in got]
        out, stopped = [], None
        for k in keys:
            try:
                out.append((None, stopped) if stopped else (resolve(k), None))
            except BaseException as e:
                out.append((None, told(e)))
                stopped = out[-1][1] if journal.ends_run(e) else None
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resolve, stopped = make_resolver(), None
        for pdf in batches:
            keys = list(pdf[KEY])
            got = [(None, stopped)] * len(keys) if stopped else answers(resolve, keys)
            stopped = stopped or next((e for _, e in got[-1:] if e and e.startswith(journal.STOPPED)), None)
            yield pd.DataFrame({
                KEY: pd.Series(keys, dtype=object),
                "lat": pd.Series([None if hit is None else float(hit[0]) for hit, _ in got], dtype="float64"),
                "lng": pd.Series([None if hit is None else float(hit[1]) for hit, _ in got], dtype="float64"),
                "error": pd.Series([e for _, e in got], dtype=object),
            })

    calls = pending.repartition(partitions) if partitions else pending
    out = calls.mapInPandas(run, f"{RESOLVED_SCHEMA}, error string")
    return out.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("lat", "lng")})


def apply_resolved(joined: DataFrame, resolved: DataFrame) -> DataFrame:
    """Overwrite both coordinates of rows that needed a lookup and got an answer."""
    r = resolved.select(KEY, F.col("lat").alias("_r_lat"), F.col("lng").alias("_r_lng"))
    out = joined.join(r, KEY, "left")
    got = needs_geocode() & F.col("_r_lat").isNotNull()
    return (
        out.withColumn("lat", F.when(got, F.col("_r_lat")).otherwise(F.col("lat")))
        .withColumn("lng", F.when(got, F.col("_r_lng")).otherwise(F.col("lng")))
        .drop("_r_lat", "_r_lng")
    )


def resolve(pending: DataFrame, resolver: DataFrame | Callable | None, bulk: bool = False, partitions: int | None = None) -> DataFrame:
    """Answers (key, lat, lng, error) for the pending keys; none without a resolver."""
    if resolver is None:
        return pending.sparkSession.createDataFrame([], f"{RESOLVED_SCHEMA}, error string")
    if isinstance(resolver, DataFrame):
        return resolve_with_table(pending, resolver).withColumn("error", F.lit(None).cast("string"))
    return resolve_with_function(pending, resolver, bulk, partitions)


def read_answers(spark: SparkSession, root: str) -> DataFrame:
    """The state of every key in the journal: lat, lng, error, answered, attempts (one for each
    time the key was asked). A plain None is an answer: the service does not know the key."""
    asked = journal.read_journal(spark, root, f"{RESOLVED_SCHEMA}, error string")
    asked = asked.withColumn("attempts", F.when(F.startswith("error", F.lit(journal.STOPPED)), 0).otherwise(1))
    return journal.state(asked, [KEY], ["lat", "lng", "error"], F.col("error").isNull())


def resolve_with_journal(pending: DataFrame, make_resolver: Callable[[], Callable], root: str, bulk: bool = False,
                         partitions: int | None = None, max_attempts: int = journal.MAX_ATTEMPTS,
                         per_round: int = journal.PER_ROUND) -> DataFrame:
    """``resolve_with_function`` for the keys that the journal at ``root`` has no answer for;
    returns (key, lat, lng, error, attempts) of all pending keys from the journal."""
    spark = pending.sparkSession
    pending = materialize(pending)
    todo = journal.still_open(pending, read_answers(spark, root), [KEY], max_attempts)
    n_tasks = partitions or spark.sparkContext.defaultParallelism
    journal.ask_in_rounds(todo, [KEY], lambda keys: resolve_with_function(keys, make_resolver, bulk, n_tasks), root, per_round)
    return pending.join(read_answers(spark, root), KEY).select(KEY, "lat", "lng", "error", "attempts")


def usable(resolved: DataFrame) -> DataFrame:
    """The answers that hold both coordinates: what the cache may keep."""
    return resolved.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull()).select(KEY, "lat", "lng")


def geocode(rows: DataFrame, cache: DataFrame, resolver: DataFrame | Callable | None = None, bulk: bool = False,
            partitions: int | None = None, save: Callable[[DataFrame], DataFrame] = lambda answers: answers,
            answers_root: str | None = None, per_round: int = journal.PER_ROUND) -> tuple[DataFrame, DataFrame]:
    """Full step: (rows with lat/lng, new cache rows to upsert).

    Both results read the answers: with ``answers_root`` those of a resolver function are kept
    in a journal there; otherwise ``save`` should write them and return the written table, so
    that the resolver is asked once for each key.
    """
    keyed = add_full_address_key(rows) if KEY not in rows.columns else rows
    joined = geocode_join(keyed, dedupe_cache(cache))
    pending = pending_keys(joined)
    if answers_root and callable(resolver) and not isinstance(resolver, DataFrame):
        resolved = usable(resolve_with_journal(pending, resolver, answers_root, bulk, partitions, per_round=per_round))
    else:
        resolved = usable(save(resolve(pending, resolver, bulk, partitions)))
    return apply_resolved(joined, resolved), resolved
