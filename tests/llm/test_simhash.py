"""SimHash groups against all pairs."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from placeflow.llm import simhash


def plain_fingerprint(text, size=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    parts = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps, radius):
    """Smallest index reached, over all pairs."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_every_pair_within_the_radius(radius):
    rng = random.Random(3)
    masks = [m % 2**64 for m in simhash.masks(radius)]
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        flips = sum(1 << b for b in rng.sample(range(64), rng.randint(0, radius)))
        assert any(flips & m == 0 for m in masks)


def test_fingerprints(odd_docs, odd_rows, small_docs):
    got = sorted(((r["doc_id"], r["fp"] % 2**64) for r in simhash.fingerprints(odd_docs).collect()), key=repr)
    assert got == sorted(((d, plain_fingerprint(t)) for d, t, *_ in odd_rows), key=repr)
    for r in small_docs.join(simhash.fingerprints(small_docs), "doc_id").limit(60).collect():
        assert r["fp"] % 2**64 == plain_fingerprint(r["text"])


def test_groups_of_documents(small_docs):
    rows = small_docs.select("doc_id", "text").orderBy("doc_id").collect()
    groups = plain_groups([plain_fingerprint(r["text"]) for r in rows], 4)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(small_docs).collect()}
    assert got == {r["doc_id"]: rows[g]["doc_id"] for r, g in zip(rows, groups)}


def test_groups_with_crowded_buckets(spark):
    """A ball of near fingerprints larger than a small bucket, chains and strangers."""
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    fps = {centre}
    for _ in range(300):
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    chain = rng.getrandbits(64)
    for _ in range(40):
        chain ^= sum(1 << b for b in rng.sample(range(64), 4))
        fps.add(chain)
    fps |= {rng.getrandbits(64) for _ in range(100)}
    fps = sorted(fps)
    df = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in fps], "fp long")
    got = {r["node"] % 2**64: r["root"] for r in simhash.fingerprint_groups(df, 4).collect()}
    groups = plain_groups(fps, 4)
    for i, f in enumerate(fps):
        for j in (groups[i], rng.randrange(len(fps))):
            same = groups[i] == groups[j]
            assert (i == j or got.get(f, f) == got.get(fps[j], fps[j])) == same


def test_odd_rows(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    zero = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert {r["component_id"] for r in zero} == {1} and len(zero) == 4
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_of_each(odd_docs, no_docs):
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(4) == 1 and ids.count(None) == 2 and 2 not in ids and 3 not in ids and 1 in ids
    assert simhash.one_of_each(no_docs).count() == 0
    only_null = odd_docs.where(F.col("doc_id").isNull())
    assert simhash.one_of_each(only_null).count() == 2


def test_one_of_each_where_an_id_has_several_texts(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(80)) for x in "abcd")
    rows = [(1, a), (5, a), (5, b), (7, c), (7, d), (8, d), (7, d)]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in kept.collect()) == [(1, a), (5, b), (7, c), (7, d)]


def test_rounds_of_few_links_take_few_tasks(spark, monkeypatch):
    """However many shuffle partitions there are: a round is written by a task a core at most."""
    from placeflow.llm import common
    rng = random.Random(9)
    edges = [(rng.randrange(500), rng.randrange(500)) for _ in range(400)] + [(i, i + 1) for i in range(1000, 1040)]
    files, plain = [], common.stage

    def counted(df, name, codec=None):
        out = plain(df, name, codec)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(common, "stage", counted)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(old, ("64", "false")):
            spark.conf.set(k, v)
        rows = common.components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    root = {}
    for a, b in edges:
        a, b = root.setdefault(a, a), root.setdefault(b, b)
        root = {x: min(a, b) if r in (a, b) else r for x, r in root.items()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r["node"]: r["root"] for r in rows} == {x: root[x] for x in linked}
    assert len(files) > 2 and max(files[1:]) <= spark.sparkContext.defaultParallelism
