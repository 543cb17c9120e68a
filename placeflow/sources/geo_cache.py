"""Versioned geocode cache: ``root/v=<n>/`` holds the rows that writer n added.

A writer claims its number by creating ``root/_claims/<n>``, which one caller only can do
(``versions.create_exclusive``), then writes its own rows, and nothing that anyone reads is ever
replaced. Readers take the committed folders (``_SUCCESS`` present) and the row of the highest
version for each key, so writers at the same time lose nothing, whoever ends first, and a
crashed one leaves only a folder that nobody reads. ``compact`` folds the committed versions into
one whose rows keep the version they came from: a slower writer with a lower number may still
commit, and its rows lose to later ones and win over earlier ones as before. A claim is a lease:
``vacuum`` ends those older than its hours and deletes what their writers left.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.operators.dedupe import keep_first
from placeflow.sources.versions import create_exclusive, hadoop, read_small

CACHE_SCHEMA = "full_address_key string, lat double, lng double, gen bigint, seq bigint"
RESOLVED_SCHEMA = "full_address_key string, lat double, lng double"


def _versions(spark: SparkSession, root: str, committed_only: bool) -> list[int]:
    fs, path, jvm = hadoop(spark, root)
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if not (st.isDirectory() and name.startswith("v=") and name[2:].isdigit()):
            continue
        if committed_only and not fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            continue
        out.append(int(name[2:]))
    return sorted(out)


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions whose writer finished (``_SUCCESS`` present): what readers see."""
    return _versions(spark, root, committed_only=True)


def all_versions(spark: SparkSession, root: str) -> list[int]:
    """Every version folder, including ones a crashed writer left unfinished."""
    return _versions(spark, root, committed_only=False)


def _includes(spark: SparkSession, root: str, version: int) -> list[int]:
    """Versions that a compacted folder replaces."""
    fs, _, jvm = hadoop(spark, root)
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/_includes/{version}")
    if not fs.exists(path):
        return []
    return [int(x) for x in read_small(spark, f"{root}/_includes/{version}").split()]


def _live(spark: SparkSession, root: str) -> list[int]:
    done = committed_versions(spark, root)
    fs, _, jvm = hadoop(spark, root)
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(f"{root}/_includes")):
        return done
    gone = {x for v in done for x in _includes(spark, root, v)}
    return [v for v in done if v not in gone]


def _rows(spark: SparkSession, root: str, versions: list[int]) -> DataFrame:
    """Rows of some versions with the version ``v`` they were added by."""
    rows = (spark.read.schema(f"{CACHE_SCHEMA}, origin bigint, v bigint").option("basePath", root)
            .parquet(*[f"{root}/v={v}" for v in versions]))
    return rows.withColumn("v", F.coalesce("origin", "v")).drop("origin")


def _latest(rows: DataFrame) -> DataFrame:
    return keep_first(rows, ["full_address_key"], ["v", "gen", "seq"], last=True)


def read_geo_cache(spark: SparkSession, root: str) -> DataFrame:
    """One row per key, the latest; a cache that does not exist is empty, one that cannot be
    read is an error."""
    live = _live(spark, root)
    if not live:
        return spark.createDataFrame([], CACHE_SCHEMA)
    return _latest(_rows(spark, root, live)).drop("v")


def _claimed(spark: SparkSession, root: str) -> list[int]:
    fs, path, _ = hadoop(spark, f"{root}/_claims")
    names = [st.getPath().getName() for st in fs.listStatus(path)] if fs.exists(path) else []
    return [int(x) for x in names if x.isdigit()]


def claim(spark: SparkSession, root: str) -> int:
    """The next free version number, ours alone."""
    while True:
        n = max([*all_versions(spark, root), *_claimed(spark, root)], default=-1) + 1
        if create_exclusive(spark, f"{root}/_claims/{n}", uuid.uuid4().hex):
            return n


def _commit(spark: SparkSession, root: str, n: int, rows: DataFrame) -> int:
    rows.write.mode("error").parquet(f"{root}/v={n}")
    fs, path, jvm = hadoop(spark, f"{root}/_claims/{n}")
    if not fs.exists(path):
        raise RuntimeError(f"the claim of version {n} was ended before its rows were written")
    return n


def write_geo_cache(spark: SparkSession, root: str, new_rows: DataFrame) -> int:
    """Add ``new_rows`` (key, lat, lng); of a key with several rows the last wins. Returns the
    version written. Errors of the rows' own plan are raised as they are."""
    n = claim(spark, root)
    fresh = new_rows.select("full_address_key", "lat", "lng").withColumn("gen", F.lit(n).cast("bigint")).withColumn("seq", F.lit(0).cast("bigint"))
    return _commit(spark, root, n, keep_first(fresh, ["full_address_key"], ["gen", "seq"], last=True))


def compact(spark: SparkSession, root: str) -> int | None:
    """Fold the live versions into one new one; the old folders stay for running readers."""
    live = _live(spark, root)
    if len(live) < 2:
        return None
    n = claim(spark, root)
    create_exclusive(spark, f"{root}/_includes/{n}", " ".join(map(str, live)))
    return _commit(spark, root, n, _latest(_rows(spark, root, live)).withColumnRenamed("v", "origin"))


def vacuum(spark: SparkSession, root: str, hours: float = 24) -> list[int]:
    """End claims older than ``hours`` that have no committed version, and delete their folders
    and those of replaced versions of that age; returns the version numbers."""
    fs, _, jvm = hadoop(spark, root)
    before = (time.time() - 3600 * hours) * 1000
    path = lambda name: jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    done, live, gone = set(committed_versions(spark, root)), set(_live(spark, root)), []
    claimed = _claimed(spark, root)
    for n in sorted({*claimed, *all_versions(spark, root)} - live):
        held = path(f"_claims/{n}") if n in claimed else path(f"v={n}")
        if fs.getFileStatus(held).getModificationTime() >= before:
            continue
        if n not in done:  # the writer finds its claim gone
            fs.delete(path(f"_claims/{n}"), False)
        if fs.delete(path(f"v={n}"), True) or n not in done:
            gone.append(n)
    return gone
