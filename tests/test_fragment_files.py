"""Fragment files that differ in their types, and damaged ones."""

import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from placeflow.plans import pipeline
from placeflow.sources import fragments


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="frag-files-")


def _damage(path, cut=False):
    """Overwrite bytes in the middle, or cut the end off."""
    with open(path, "rb") as f:
        data = f.read()
    with open(path, "wb") as f:
        f.write(data[:-20] if cut else data[:4] + b"\x00" * 60 + data[64:])


def test_files_of_unlike_types_lose_no_row(spark, root):
    pq.write_table(pa.table({"id": ["1", "2"], "lat": [25.5, None], "n": pa.array([1, 2], pa.int32())}), f"{root}/final_001_111_0009.parquet")
    pq.write_table(pa.table({"id": ["3", "4"], "lat": ["24.25", "bad"], "n": pa.array([3, 4], pa.int64())}), f"{root}/final_001_103_0008.parquet")
    pq.write_table(pa.table({"lat": pa.array([23.5], pa.float32()), "more": ["m"]}), f"{root}/final_001_104_0008.parquet")
    typed = fragments.read_fragments(spark, root, schema="id string, lat double, n bigint")
    got = sorted((tuple(r)[:3] for r in typed.collect()), key=repr)
    assert got == sorted([("1", 25.5, 1), ("2", None, 2), ("3", 24.25, 3), ("4", None, 4), (None, 23.5, None)], key=repr)
    free = fragments.read_fragments(spark, root)
    assert dict(free.dtypes) == {"id": "string", "lat": "string", "n": "bigint", "more": "string", "file_name": "string", "row_index": "bigint"}
    assert {(r.id, r.lat, r.more) for r in free.collect()} == {("1", "25.5", None), ("2", None, None), ("3", "24.25", None), ("4", "bad", None), (None, "23.5", "m")}


def test_damaged_files_are_named(spark, root):
    for i, name in enumerate(("a", "b", "c")):
        pq.write_table(pa.table({"id": [f"{i}{j}" for j in range(2000)]}), f"{root}/final_{name}.parquet")
    _damage(f"{root}/final_b.parquet")
    _damage(f"{root}/final_c.parquet", cut=True)
    report = {r.file_name: r for r in fragments.check_files(spark, f"{root}/final_*.parquet").collect()}
    assert report["final_a.parquet"].n_rows == 2000 and report["final_a.parquet"].error is None
    assert report["final_b.parquet"].error and report["final_c.parquet"].error
    assert fragments.read_fragments(spark, root).count() == 2000
    _damage(f"{root}/final_a.parquet")
    with pytest.raises(FileNotFoundError):  # no file is left
        fragments.read_fragments(spark, root)


def test_incomplete_merge_needs_a_word(spark, root):
    rows = [(f"id{i}", f"n{i}", "p", "001", zip_code, "0009", 0, i) for i, zip_code in enumerate(["111", "103", "111", "104"])]
    schema = "id string, name string, phone string, city_code string, zip_code string, ind_code string, chunk_no bigint, line_no bigint"
    df = spark.createDataFrame(rows, schema)
    for kind in ("final", "raw"):
        fragments.write_batches(df, f"{root}/{kind}")
    pipeline.merge_and_publish(spark, root)
    at = fragments.read_batches(spark, f"{root}/final", schema)
    bad = [r[0] for r in at.where("zip_code = '103'").select(F.input_file_name()).distinct().collect()]
    for path in bad:
        _damage(path.replace("file://", ""))
    with pytest.raises(Exception):  # nothing is left out without a word
        pipeline.merge_and_publish(spark, root)
    assert fragments.read_published(spark, f"{root}/final_data").count() == 4
    assert pipeline.merge_and_publish(spark, root, allow_incomplete=True).count() == 3
    report = fragments.read_published(spark, f"{root}/merge_report")
    named = {(r.kind, r.part) for r in report.where("error is not null").collect()}
    assert named == {("final", "city_code=001/zip_code=103/ind_code=0009")}
    done = {r.zip_code for r in pipeline.finished_batches(spark, root).collect()}
    assert done == {"111", "104"}  # the damaged batch is pending again
