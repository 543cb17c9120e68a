"""Tables that are replaced all at once, claims of which each has one holder, and the merge log."""

import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from placeflow.sources import exchange, fragments, geo_cache, versions
from placeflow.streaming import incremental

KEYS = "full_address_key string, lat double, lng double"


class Killed(Exception):
    pass


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="versions-")


def killed_before_switch(monkeypatch, act):
    """Run ``act`` and stop it when its rows are written and the list is not."""
    def die(*args, **kwargs):
        raise Killed
    with monkeypatch.context() as m:
        m.setattr(versions, "switch", die)
        with pytest.raises(Killed):
            act()


def test_one_holder_of_each_claim(spark, root):
    with ThreadPoolExecutor(16) as pool:
        for i in range(20):
            at = f"{root}/{i}"
            got = list(pool.map(lambda _: geo_cache.claim(spark, at), range(16)))
            assert sorted(got) == list(range(16))


def test_exclusive_by_renaming(spark, root, monkeypatch):
    """The way taken on HDFS, here one after the other."""
    monkeypatch.setattr(versions, "_link", versions._rename)
    assert versions.create_exclusive(spark, f"{root}/a/claim", "first")
    monkeypatch.setattr(versions, "hadoop", lambda s, p, f=versions.hadoop: f(s, p))
    assert not versions.create_exclusive(spark, f"{root}/a/claim", "second")
    assert versions.read_small(spark, f"{root}/a/claim") == "first"


def test_lists_of_writers_at_the_same_time(spark, root):
    versions.begin(spark, root)
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: versions.append(spark, root, [{"folder": f"segment={i}"}]), range(24)))
    assert sorted(e["folder"] for e in versions.entries(spark, root)) == sorted(f"segment={i}" for i in range(24))
    assert versions.current(spark, root)[0] == 24


def test_compaction_after_a_writer_died(spark, root):
    rows = lambda *r: spark.createDataFrame(list(r), KEYS)
    geo_cache.write_geo_cache(spark, root, rows(("a", 1.0, 1.0), ("b", 1.0, 1.0)))
    dead = geo_cache.claim(spark, root)  # this writer never comes back
    slow = geo_cache.claim(spark, root)  # this one commits after the compaction
    geo_cache.write_geo_cache(spark, root, rows(("a", 3.0, 3.0)))
    assert (dead, slow) == (1, 2)
    assert geo_cache.compact(spark, root) == 4
    got = lambda: {r.full_address_key: r.lat for r in geo_cache.read_geo_cache(spark, root).collect()}
    assert got() == {"a": 3.0, "b": 1.0}
    late = rows(("a", 2.0, 2.0), ("b", 2.0, 2.0)).withColumns({"gen": F.lit(slow).cast("bigint"), "seq": F.lit(0).cast("bigint")})
    geo_cache._commit(spark, root, slow, late)
    assert got() == {"a": 3.0, "b": 2.0}  # above version 0, below version 3
    assert geo_cache.compact(spark, root) == 5
    assert got() == {"a": 3.0, "b": 2.0}
    assert geo_cache.vacuum(spark, root, hours=1) == []  # leases still run
    assert geo_cache.vacuum(spark, root, hours=-1) == [0, 1, 2, 3, 4]
    assert got() == {"a": 3.0, "b": 2.0} and geo_cache.all_versions(spark, root) == [5]
    with pytest.raises(RuntimeError):  # its lease was ended meanwhile
        geo_cache._commit(spark, root, dead, late)


def test_published_table_survives_a_killed_writer(spark, root, monkeypatch):
    at = f"{root}/t"
    with pytest.raises(FileNotFoundError):
        killed_before_switch(monkeypatch, lambda: fragments.publish(spark.range(3), at))
        fragments.read_published(spark, at)
    fragments.publish(spark.range(5), at)
    before = fragments.read_published(spark, at)
    killed_before_switch(monkeypatch, lambda: fragments.publish(spark.range(7), at))
    assert fragments.read_published(spark, at).count() == 5
    fragments.publish(spark.range(9), at)
    assert fragments.read_published(spark, at).count() == 9
    assert before.count() == 5  # a reader that began earlier
    assert versions.vacuum(spark, at, hours=-1) == 3
    assert fragments.read_published(spark, at).count() == 9


def test_batches_survive_a_killed_writer(spark, root, monkeypatch):
    schema = "v string, city_code string, zip_code string, ind_code string"
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    at = f"{root}/b"
    read = lambda: sorted(tuple(r)[:4] for r in fragments.read_batches(spark, at, schema).select("v", *fragments.BATCH).collect())
    killed_before_switch(monkeypatch, lambda: fragments.write_batches(rows(("x", "001", "111", "0009")), at))
    assert read() == []
    fragments.write_batches(rows(("a", "001", "111", "0009"), ("b", "001", "103", "0008"), ("z", None, "a b/c%", "")), at)
    first = read()
    assert len(first) == 3
    killed_before_switch(monkeypatch, lambda: fragments.write_batches(rows(("c", "001", "111", "0009")), at))
    assert read() == first
    fragments.write_batches(rows(("c", "001", "111", "0009")), at)
    fragments.write_batches(rows(), at)  # nothing in it: nothing replaced
    assert [r[0] for r in read()] == ["b", "c", "z"]
    assert versions.vacuum(spark, at, hours=-1) == 3
    assert [r[0] for r in read()] == ["b", "c", "z"]


def test_tab_survives_a_killed_writer(spark, root, monkeypatch):
    df = spark.createDataFrame([("1", 'a "b"\n')], "id string, name string")
    exchange.export_exchange(df, f"{root}/tab")
    killed_before_switch(monkeypatch, lambda: exchange.export_exchange(df.union(df), f"{root}/tab"))
    assert [tuple(r) for r in exchange.import_exchange(spark, f"{root}/tab", ["id", "name"]).collect()] == [("1", 'a "b"\n')]


def test_later_file_of_a_tab_wins(spark, root):
    stem = "final_001_111_0009_" + "x" * 40
    frags = spark.createDataFrame(
        [("1", f"{stem}_a.parquet", 0), ("2", f"{stem}_b.parquet", 0), ("3", f"{stem}_b.parquet", 1), ("4", "final_001_103_0008.parquet", 0)],
        "id string, file_name string, row_index bigint")
    for _ in range(2):  # again: whole tabs are replaced
        exchange.export_fragment_tabs(frags, root)
        got = sorted(tuple(r) for r in exchange.read_fragment_tabs(spark, root, ["id"]).collect())
        assert got == [("2", stem[:50]), ("3", stem[:50]), ("4", "final_001_103_0008")]


def test_other_layouts_are_left_alone(spark, root):
    spark.range(3).write.parquet(f"{root}/old")
    assert fragments.read_published(spark, f"{root}/old").count() == 3
    with pytest.raises(ValueError):
        fragments.publish(spark.range(1), f"{root}/old")


def _size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


SCHEMA = "id string, name string, phone string, city string, district string, file_name string, row_index bigint"


def _batch(spark, n, first, epoch):
    return spark.range(first, first + n).select(
        F.col("id").cast("string").alias("id"), F.concat(F.lit("n"), "id").alias("name"), F.lit("p").alias("phone"), F.lit("c").alias("city"),
        F.lit("d").alias("district"), F.lit(f"final_{epoch:04d}.parquet").alias("file_name"), F.col("id").alias("row_index"))


def test_bytes_written_follow_the_batch(spark, root):
    """The same batch against a small and a large state."""
    written = []
    for n in (1_000, 100_000):
        state = f"{root}/{n}"
        fold = incremental._fold_fragments(state)
        fold(_batch(spark, n, 0, 0), 0)
        before = _size(state)
        fold(_batch(spark, 500, n - 250, 1), 1)
        written.append(_size(state) - before)
        assert incremental.read_state(spark, state).count() == n + 250
    assert written[1] < 1.3 * written[0]


def test_log_equals_batch_merge(spark, root):
    """Overlapping batches in odd order, folds, a replay, a death between rows and list."""
    from placeflow.operators.merge import merge_final
    state, batches = f"{root}/s", [_batch(spark, 40, 15 * (i * 7 % 11), 20 - i) for i in range(11)]
    fold = incremental._fold_fragments(state, 3)
    for i, b in enumerate(batches):
        fold(b, i)
        if i % 4 == 0:
            fold(b, i)
    whole = batches[0]
    for b in batches[1:]:
        whole = whole.union(b)
    want = sorted(map(tuple, merge_final(whole).select("id", "file_name").collect()))
    assert sorted(map(tuple, incremental.read_state(spark, state).select("id", "file_name").collect())) == want
    assert max(e["level"] for e in versions.entries(spark, state)) >= 2
    assert len(versions.entries(spark, state)) <= 2 * 3
    assert incremental.prune_state(spark, state, hours=-1) > 0
    assert sorted(map(tuple, incremental.read_state(spark, state).select("id", "file_name").collect())) == want
    assert incremental.read_state(spark, f"{root}/none") is None
