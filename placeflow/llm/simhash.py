"""SimHash near-duplicate groups by covering locality-sensitive hashing.

Fingerprint: words of the lower-cased (A-Z) text, shingles of ``shingle`` words, XXH64
(seed 42) of each, bit majority. Two fingerprints are linked when they differ in at most
``radius`` bits. Every bit position i gets a non-zero vector m(i) of radius+1 bits; table v
(v = 1 .. 2^(radius+1)-1) masks the positions whose m(i) has an odd inner product with v.
The vectors of up to ``radius`` differing positions span less than the whole space, so some
v is orthogonal to all of them: its mask hides every difference and the pair collides there.

Defined results: null text counts as empty; a text without words has fingerprint zero and is
linked like any other; rows with equal fingerprints share a component; a null doc_id gets the
component of its fingerprint, whose id is the smallest doc_id that is not null (null if there
is none); repeated rows each return a row; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow.llm.common import bucket_links, in_chunks, join_checked, stage, texts

BITS = 64
SEED = 42
CHUNK = 8192  # shingles whose bits are unpacked at once


def fingerprint_of(text: str, shingle: int) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII case and space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1:].tolist()
    digest = xxhash.xxh64_digest
    votes = np.zeros(BITS, np.int64)
    for i in range(0, len(starts), CHUNK):
        got = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[i:i + CHUNK], ends[i:i + CHUNK])])
        votes += np.unpackbits(np.frombuffer(got, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, th, fp; longs): hash of the text and its fingerprint as a signed 64-bit number."""
    def run(batches):
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            fps = np.empty(len(text), np.uint64)
            for a, b in in_chunks([1] * len(text), 64):  # few Python strings at a time
                fps[a:b] = [fingerprint_of(t, shingle) for t in text.slice(a, b - a).to_pylist()]
            yield pa.RecordBatch.from_arrays([ids, batch.column(2), pa.array(fps.view(np.int64))], names=["doc_id", "th", "fp"])

    return texts(docs).withColumn("th", F.xxhash64("text")).mapInArrow(run, "doc_id long, th long, fp long")


def masks(radius: int) -> list[int]:
    """The covering masks as signed 64-bit numbers; m(i) runs through the non-zero vectors."""
    space = 1 << (radius + 1)
    vectors = [1 + i % (space - 1) for i in range(BITS)]
    made = []
    for v in range(1, space):
        bits = sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2)
        made.append(bits - (1 << BITS) if bits >> (BITS - 1) else bits)
    return made


def fingerprint_groups(fps: DataFrame, radius: int = 4) -> DataFrame:
    """(node, root) over distinct fingerprints ``fp`` with at least one link."""
    tables = F.array(*[F.lit(m) for m in masks(radius)])
    keyed = fps.select("fp", F.posexplode(tables).alias("t", "mask")).select(
        F.xxhash64("t", F.col("fp").bitwiseAND(F.col("mask"))).alias("b"), F.col("fp").alias("id"))
    return bucket_links(keyed, None, lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= radius, "simhash")


def components_of(docs: DataFrame, shingle: int, radius: int) -> DataFrame:
    """doc_id, th (hash of the text), fp, root (names the component) and component_id of every row."""
    marked = stage(fingerprints(docs, shingle), "simhash-fps")
    distinct = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = fingerprint_groups(distinct.select("fp"), radius)
    classes = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(names, "root").select("fp", "root", "component_id")
    return marked.join(classes, "fp")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    return components_of(docs, shingle, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id, of rows
    with that id the smallest. A row is known by doc_id and text, so that an id may stand for
    texts of several components. Rows with null doc_id, which nothing names, stay."""
    found = stage(components_of(docs, shingle, radius), "simhash-found")
    key = ["id", "th"]
    named = found.select(F.col("doc_id").alias("id"), "th", "root", "component_id")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col("row.doc_id").cast("long").alias("id"),
                       F.xxhash64(F.coalesce(F.col("row.text"), F.lit(""))).alias("th"))
    gone = stage(named.where("id <> component_id").select(*key).distinct(), "simhash-gone")
    kept = join_checked(rows, gone, key, "left_anti")
    first = named.where("id = component_id")
    several = stage(first.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root"), "simhash-several")
    if several.isEmpty():
        return kept.select("row.*")
    twice = stage(join_checked(first.select(*key, "root").distinct(), several, ["root"]), "simhash-twice")
    again = join_checked(kept, twice, key).groupBy("root").agg(F.min("row").alias("row"))
    return join_checked(kept, twice.select(*key), key, "left_anti").select("row").unionByName(again.select("row")).select("row.*")
