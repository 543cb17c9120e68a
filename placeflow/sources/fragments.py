"""Fragment files: per-batch outputs written once, read back with their file name
and row position (parquet's hidden ``_metadata`` columns; no per-file loop)."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.functions.text import to_double_strict
from placeflow.sources import versions

BATCH = ["city_code", "zip_code", "ind_code"]


# larger files are checked by their footers alone
CHECKED_BYTES = 64 << 20


def check_files(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, file_name, n_rows, file_schema, error) of every Parquet file under ``paths``: each
    is read whole by a task; a damaged one has its error and no schema."""

    def check(batches):
        for batch in batches:
            out = []
            for path, length, content in zip(*[batch.column(c).to_pylist() for c in range(3)]):
                rows = schema = error = None
                try:
                    f = pq.ParquetFile(pa.BufferReader(content))
                    for _ in f.iter_batches():
                        pass
                    rows, schema = f.metadata.num_rows, f.schema_arrow.remove_metadata().to_string()
                except Exception as e:  # whatever the damage is, the file is reported
                    error = f"{type(e).__name__}: {e}"[:300]
                out.append((path, path.rsplit("/", 1)[-1], rows, schema, error))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()))] if out else
                [pa.array([], t) for t in (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())],
                names=["path", "file_name", "n_rows", "file_schema", "error"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    found = files.load(list(paths))
    # a file whose bytes the store itself rejects is listed, but has no content
    read = files.option("ignoreCorruptFiles", "true").load(list(paths))
    report = read.where(F.col("length") <= CHECKED_BYTES).select("path", "length", "content").mapInArrow(
        check, "path string, file_name string, n_rows long, file_schema string, error string")
    listed = found.where(F.col("length") <= CHECKED_BYTES).select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"))
    report = listed.join(report.drop("file_name"), "path", "left").withColumn(
        "error", F.when(F.col("file_schema").isNull(), F.coalesce("error", F.lit("its bytes could not be read"))))
    large = []
    for (path,) in found.where(F.col("length") > CHECKED_BYTES).select("path").collect():
        schema = error = None
        try:
            schema = spark.read.parquet(path).schema.simpleString()
        except Exception as e:
            error = f"{type(e).__name__}: {e}"[:300]
        large.append((path, path.rsplit("/", 1)[-1], None, schema, error))
    return report.unionByName(spark.createDataFrame(large, report.schema)) if large else report


def _target(types: set[str]) -> str:
    """One type for a column that files have in several."""
    if len(types) == 1:
        return next(iter(types))
    whole = {"tinyint", "smallint", "int", "bigint"}
    if types <= whole:
        return "bigint"
    return "double" if types <= whole | {"float", "double"} else "string"


def _as(column: str, have: str, want: str) -> Column:
    if have == want:
        return F.col(column)
    if have == "string" and want == "double":
        return to_double_strict(column)
    return F.col(column).try_cast(want)


def read_fragments(spark: SparkSession, root: str, kind: str = "final", schema: str | None = None) -> DataFrame:
    """All ``{kind}_*.parquet`` files under ``root`` with ``file_name`` and ``row_index``.

    Files may differ in columns and in column types: those of equal footers are read together
    with their own types, cast to ``schema`` (or to a type that holds all of them: text where
    numbers and text meet) and united; a column that a file lacks is null. Damaged files
    are left out and the rest proceed: ``check_files`` names them with their errors.
    """
    files = check_files(spark, f"{root}/{kind}_*.parquet").select("path", "file_schema").collect()
    groups: dict[str, list[str]] = {}
    for f in files:
        if f["file_schema"] is not None:
            groups.setdefault(f["file_schema"], []).append(f["path"])
    if not groups and schema is None:
        raise FileNotFoundError(f"no readable {kind}_*.parquet file in {root}")
    frames = []
    for paths in (sorted(groups[k]) for k in sorted(groups)):
        df = spark.read.parquet(*paths)
        frames.append(df.select(*df.columns, F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row_index")))
    types: dict[str, set[str]] = {}
    for df in frames:
        for name, t in df.dtypes:
            types.setdefault(name, set()).add(t)
    if schema is None:
        want = {name: _target(t) for name, t in types.items()}
    else:
        want = {f.name: f.dataType.simpleString() for f in spark.createDataFrame([], schema).schema} | {"file_name": "string", "row_index": "bigint"}
    out = spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in want.items()))
    for df in frames:
        have = dict(df.dtypes)
        out = out.unionByName(df.select(*[_as(c, have[c], t).alias(c) for c, t in want.items() if c in have]), allowMissingColumns=True)
    last = ["file_name", "row_index"]
    return out.select(*[c for c in out.columns if c not in last], *last)


def read_report(spark: SparkSession, root: str, frags: DataFrame, kind: str = "final") -> DataFrame:
    """(file_name, expected_rows, read_rows, status) of every listed file: ``ok``, ``skipped``
    (nothing could be read) or ``partial`` (some rows were lost). Expected rows come from the
    footers alone (a count without columns), read rows from reading every column."""
    listed = (spark.read.format("binaryFile").load(f"{root}/{kind}_*.parquet")
              .select(F.element_at(F.split("path", "/"), -1).alias("file_name")))
    reader = spark.read.option("ignoreCorruptFiles", "true").schema("file_name string")
    expected = (reader.parquet(f"{root}/{kind}_*.parquet").groupBy(F.col("_metadata.file_name").alias("file_name"))
                .agg(F.count(F.lit(1)).alias("expected_rows")))
    read = frags.groupBy("file_name").agg(F.count(F.xxhash64(*[c for c in frags.columns if c != "file_name"])).alias("read_rows"))
    both = listed.join(expected, "file_name", "left").join(read, "file_name", "left")
    status = (F.when(F.col("expected_rows").isNull(), "skipped")
              .when(F.coalesce("read_rows", F.lit(0)) < F.col("expected_rows"), "partial").otherwise("ok"))
    return both.select("file_name", "expected_rows", F.coalesce("read_rows", F.lit(0)).alias("read_rows"), status.alias("status"))


def whole_files(frags: DataFrame, report: DataFrame) -> DataFrame:
    """Rows of the files that were read to their end."""
    return frags.join(report.filter(F.col("status") != "ok").select("file_name"), "file_name", "left_anti").select(*frags.columns)


def read_batches(spark: SparkSession, root: str, schema: str | None = None) -> DataFrame:
    """The current rows of our own layout ``root/city_code=/zip_code=/ind_code=/commit=``; the
    schema keeps the codes strings. A file that cannot be read is an error (``batch_report``
    names it)."""
    paths = versions.part_paths(spark, root)
    # codes such as 0009 must come back from partition paths as strings
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    if paths == []:
        return spark.createDataFrame([], schema or ", ".join(f"{c} string" for c in BATCH)).select("*", F.lit("").alias("file_name"), F.lit(0).cast("long").alias("row_index"))
    rows = reader.parquet(root) if paths is None else reader.option("basePath", root).parquet(*paths)
    return rows.select("*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row_index")).drop("commit")


def batch_report(spark: SparkSession, root: str) -> DataFrame:
    """``check_files`` over the current batch files, each with its partition folder ``part``."""
    paths = versions.part_paths(spark, root)
    report = check_files(spark, *(paths or [root]))
    part = F.regexp_extract("path", r"((?:[^/=]+=[^/]*/)*[^/=]+=[^/]*)/commit=[^/]*/[^/]*$", 1)
    return report.withColumn("part", part)


def quarantine(spark: SparkSession, root: str, report: DataFrame) -> list[str]:
    """Take the batches with a damaged file out of the current ones, so that they are pending
    again; their folders stay where they are. Returns the partition folders."""
    bad = sorted({r["part"] for r in report.where(F.col("error").isNotNull()).select("part").distinct().collect()})
    if bad:
        versions.switch(spark, root, lambda old: {"parts": {k: v for k, v in old.get("parts", {}).items() if k not in bad}})
    return bad


def write_batches(df: DataFrame, root: str, batch_cols: Sequence[str] = BATCH) -> None:
    """Replace exactly the batches present in ``df``, all at once: their rows are written to new
    folders and become the current ones when the list of folders is switched.

    The ``rebalance`` hint groups rows by batch for few files per batch while AQE splits a hot
    batch over several tasks and merges small ones.
    """
    versions.replace_parts(df, root, batch_cols)


def publish(df: DataFrame, path: str) -> None:
    """Replace a merged dataset: readers see the old rows until all new ones are there."""
    versions.replace_table(df, path)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(versions.table_path(spark, path))
