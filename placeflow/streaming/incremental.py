"""Scheduled re-runs as incremental streams.

Both jobs read new files with a file source (``trigger(availableNow=True)``:
take what arrived, then stop) and fold each micro-batch into a state table.

* ``merge_incremental``: survivors + new fragment rows -> first-wins per key in
  (file_name, row_index) order. The state is a log of segments: a micro-batch writes one
  segment with its own winners, so what an epoch writes follows the batch and not the state.
  The first of a key is a minimum, so readers take the first row of each key over all
  segments, and the order, number and repetition of segments do not matter: a replayed epoch
  adds rows that change nothing. ``fan`` segments of one level are folded into one of the next,
  so a row is written again once a level, and a reader finds few segments. The list of segments
  is switched as a whole (``versions``), so a crash at any point leaves the state before it.
  The result equals the batch merge of everything seen (fragments are immutable: a rewritten
  file under an old name is not picked up again). ``prune_state`` deletes folded segments.
* ``cache_upsert_stream``: new resolver answers -> last-wins into the cache.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from placeflow.operators.dedupe import keep_first
from placeflow.operators.merge import ORDER, dedupe_keys, merge_final
from placeflow.sources import geo_cache, versions

FAN = 8


def _rows(spark: SparkSession, state_root: str, segments: list[dict]) -> DataFrame:
    """The first row of each key over some segments (they may differ in columns)."""
    rows = spark.read.option("mergeSchema", "true").parquet(*[f"{state_root}/{e['folder']}" for e in segments])
    keys = dedupe_keys(rows.columns)
    if keys:
        return rows if len(segments) == 1 else keep_first(rows, keys, ORDER)
    return rows.dropDuplicates(list(ORDER))


def read_state(spark: SparkSession, state_root: str) -> DataFrame | None:
    """All survivors; None where nothing was merged yet."""
    segments = versions.entries(spark, state_root)
    return _rows(spark, state_root, segments) if segments else None


def _add_segment(rows: DataFrame, state_root: str, level: int, remove: list[str]) -> None:
    folder = versions.new_folder("segment")
    rows.write.parquet(f"{state_root}/{folder}")
    versions.append(rows.sparkSession, state_root, [{"folder": folder, "level": level}], remove)


def fold_segments(spark: SparkSession, state_root: str, fan: int = FAN) -> int:
    """Fold full levels into the next ones; returns the number of folds."""
    done = 0
    while True:
        levels: dict[int, list[dict]] = {}
        for e in versions.entries(spark, state_root):
            levels.setdefault(e["level"], []).append(e)
        full = min((level for level, some in levels.items() if len(some) >= fan), default=None)
        if full is None:
            return done
        _add_segment(_rows(spark, state_root, levels[full]), state_root, full + 1, [e["folder"] for e in levels[full]])
        done += 1


def _fold_fragments(state_root: str, fan: int = FAN):
    def fold(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        versions.begin(spark, state_root)
        if batch.isEmpty():
            return
        _add_segment(merge_final(batch), state_root, 0, [])
        fold_segments(spark, state_root, fan)
    return fold


def prune_state(spark: SparkSession, state_root: str, hours: float = 24) -> int:
    """Delete segments that were folded, or never listed, more than ``hours`` ago."""
    return versions.vacuum(spark, state_root, hours)


def merge_incremental(spark: SparkSession, source_root: str, schema: str, state_root: str, checkpoint: str, fan: int = FAN) -> DataFrame:
    """Fold every fragment file that arrived since the last run into the merged state.

    Fragment rows must carry ``file_name`` and ``row_index`` (as the batch reader adds them).
    """
    stream = spark.readStream.schema(schema).parquet(source_root)
    q = (
        stream.writeStream.foreachBatch(_fold_fragments(state_root, fan))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return read_state(spark, state_root)


def cache_upsert_stream(spark: SparkSession, source_root: str, cache_root: str, checkpoint: str) -> DataFrame:
    """Merge newly arrived resolver answers (key, lat, lng files) into the versioned cache."""
    stream = spark.readStream.schema(geo_cache.RESOLVED_SCHEMA).parquet(source_root)

    def fold(batch: DataFrame, epoch: int) -> None:
        if not batch.isEmpty():
            geo_cache.write_geo_cache(batch.sparkSession, cache_root, batch)

    q = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return geo_cache.read_geo_cache(spark, cache_root)
