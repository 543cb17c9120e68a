"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask over token positions: the tokens under it are hashed, the others are
ignored, so a substitution at an ignored place still gives the same hash. The hashes of all
benchmark items are joined with those at every position of the documents; each hit fixes an
alignment of document and item, and along it every stretch of ``overlap`` tokens (the whole
item if shorter) is compared: a document is contaminated by an item when some stretch has at
least ``similarity`` of its tokens equal. The two masks meet every stretch of 13 tokens with
up to two substitutions, and with the two of ``SHORT`` also every item of 10 to 12 tokens with
two and of 9 tokens with one, so at the default parameters nothing is missed.

Tokens are runs of letters and digits, lower-cased. Only document tokens that the benchmark
has too can match, so documents are mapped to the benchmark's vocabulary; its index goes to
the tasks in blocks of at most about ``block_chars`` characters, each a full pass, so that
any number of items is handled in bounded memory and no shuffle of the documents is needed.

Defined results: null texts count as empty; items of fewer than ``min_tokens`` tokens prove
nothing and match nothing; items shorter than a seed are sought as a whole without
substitutions; repeated items are all reported; an item with null id counts in n_items but
is not in ``items``; repeated document rows each return a row; empty tables and extra columns
are fine.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from placeflow.llm.common import in_chunks, stage, texts

MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
WHOLE = 13  # tokens from which on the masks above meet every stretch with two substitutions
SHORT = ((0, 1, 3, 4, 5), (0, 1, 2, 5, 6))  # for items of fewer tokens, beside the others
TOKEN = re.compile(r"[^\W_]+")
CHUNK = 1 << 20  # document characters compared at once
PAIRS = 1 << 20  # hits expanded at once
FILTER = 1 << 20


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def _key(ids: np.ndarray, mask: tuple[int, ...], which: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash under the mask at every position, and whether no token under it is unknown (0)."""
    n = max(0, len(ids) - mask[-1])
    key = np.full(n, which + 1, np.uint64)
    known = np.ones(n, bool)
    for offset in mask:
        part = ids[offset:offset + n]
        known &= part > 0
        key = (key ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key, known


class Index:
    """One block of the benchmark: vocabulary, distinct items and their seed hashes."""

    def __init__(self, items: list[tuple[int | None, str]], overlap: int, similarity: float, min_tokens: int):
        self.vocab: dict[str, int] = {}
        self.overlap, self.similarity = overlap, similarity
        owners: dict[tuple[int, ...], list] = defaultdict(list)
        for item, text in items:
            ids = tuple(self.vocab.setdefault(t, len(self.vocab) + 1) for t in tokens(text or ""))
            if len(ids) >= min_tokens:
                owners[ids].append(item)
        self.items = [np.array(ids, np.int64) for ids in owners]
        self.owners = list(owners.values())
        span = max(m[-1] for m in MASKS) + 1
        # (mask, least and most tokens of the items it is for)
        made = [(m, span, None) for m in MASKS]
        if any(span <= len(x) < WHOLE for x in self.items):
            made += [(m, span, WHOLE - 1) for m in SHORT]
        made += [(tuple(range(n)), n, n) for n in sorted({len(x) for x in self.items if len(x) < span})]
        self.seeds = [m for m, _, _ in made]
        keys, at = [], []
        for k, x in enumerate(self.items):
            for s, (mask, low, high) in enumerate(made):
                if low <= len(x) and (high is None or len(x) <= high):
                    key, _ = _key(x, mask, s)
                    keys.append(key)
                    at.append(np.stack([np.full(len(key), k), np.arange(len(key))], axis=1))
        self.keys = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        self.at = np.concatenate(at) if at else np.empty((0, 2), np.int64)
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.at = self.keys[order], self.at[order]
        self.filter = np.zeros(FILTER, bool)
        self.filter[(self.keys % np.uint64(FILTER)).astype(np.int64)] = True

    def hits(self, ids: np.ndarray) -> np.ndarray:
        """Distinct (item, diagonal) of all seed hits; diagonal: document minus item position."""
        found = [np.empty((0, 2), np.int64)]
        for s, mask in enumerate(self.seeds):
            key, known = _key(ids, mask, s)
            place = np.flatnonzero(known)
            place = place[self.filter[(key[place] % np.uint64(FILTER)).astype(np.int64)]]
            low = np.searchsorted(self.keys, key[place], "left")
            many = np.searchsorted(self.keys, key[place], "right") - low
            place, low, many = place[many > 0], low[many > 0], many[many > 0]
            for a, b in in_chunks(many.tolist(), PAIRS):
                doc = np.repeat(place[a:b], many[a:b])
                entry = np.repeat(low[a:b] - np.concatenate([[0], np.cumsum(many[a:b])[:-1]]), many[a:b]) + np.arange(len(doc))
                item, q = self.at[entry].T
                found.append(np.unique(np.stack([item, doc - q], axis=1), axis=0))
        return np.unique(np.concatenate(found), axis=0)

    def match(self, ids: np.ndarray) -> dict[int, int]:
        """Most equal tokens in a stretch, for each item that a document (its ids) overlaps."""
        best: dict[int, int] = {}
        for k, diagonal in self.hits(ids).tolist():
            item = self.items[k]
            lo, hi = max(0, -diagonal), min(len(item), len(ids) - diagonal)
            equal = np.zeros(len(item) + 1, np.int64)
            equal[1 + lo:1 + hi] = item[lo:hi] == ids[diagonal + lo:diagonal + hi]
            run = equal.cumsum()
            size = min(self.overlap, len(item))
            top = int((run[size:] - run[:len(item) + 1 - size]).max())
            if len(item) < max(m[-1] for m in MASKS) + 1 and top < len(item):
                continue
            if top >= self.similarity * size and top > best.get(k, 0):
                best[k] = top
        return best


FOUND = StructType([StructField("n_items", LongType()), StructField("equal_tokens", LongType()),
                    StructField("items", ArrayType(LongType()))])


def _against(docs: DataFrame, index: Index) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        index = shared.value
        known = index.vocab.get
        for batch in batches:
            sizes = [len(s) for s in batch.column(1).cast(pa.binary()).to_pylist()] if len(batch) else []
            for a, b in in_chunks(sizes, CHUNK):
                items, counts, tops = [], [], []
                for text in batch.column(1).slice(a, b - a).to_pylist():
                    words = tokens(text)
                    ids = np.fromiter((known(w, 0) for w in words), np.int64, len(words))
                    best = index.match(ids) if len(index.keys) and ids.any() else {}
                    own = [o for k in best for o in index.owners[k]]
                    counts.append(len(own))
                    items.append(sorted(o for o in own if o is not None))
                    tops.append(max(best.values(), default=0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(counts, pa.int64()),
                     pa.array(tops, pa.int64()), pa.array(items, pa.list_(pa.int64()))],
                    names=["row", "n_items", "equal_tokens", "items"])

    return docs.mapInArrow(run, StructType([docs.schema["row"], *FOUND.fields]))


def contaminated_rows(docs: DataFrame, benchmark: DataFrame, overlap: int = 13, similarity: float = 0.8,
                      min_tokens: int = 5, block_chars: int = 4_000_000) -> DataFrame:
    """The rows of ``docs`` as they are (column ``row``) with n_items, equal_tokens (most in a
    stretch) and items (sorted ids)."""
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text"))
    total = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + total // block_chars
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.coalesce(F.col("row.text"), F.lit("")).alias("text"))

    def against(rows, k):
        block = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).toArrow()
        return _against(rows, Index(list(zip(block.column(0).to_pylist(), block.column(1).to_pylist())),
                                    overlap, similarity, min_tokens))

    if blocks == 1:
        return against(rows, 0)
    # several passes over the same numbered rows, put together by number
    placed = stage(rows.withColumn("at", F.monotonically_increasing_id()), "decontam-docs")
    passes = None
    for k in range(blocks):
        one = against(placed.select(F.struct("at").alias("row"), "text"), k)
        passes = one if passes is None else passes.unionByName(one)
    summed = passes.groupBy(F.col("row.at").alias("at")).agg(
        F.sum("n_items").alias("n_items"), F.max("equal_tokens").alias("equal_tokens"),
        F.array_sort(F.flatten(F.collect_list("items"))).alias("items"))
    return placed.select("at", "row").join(summed, "at").drop("at")


def contamination(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """doc_id, contaminated, n_items, equal_tokens, items of every row."""
    return contaminated_rows(texts(docs), benchmark, **parameters).select(
        "row.doc_id", (F.col("n_items") > 0).alias("contaminated"), "n_items", "equal_tokens", "items")
