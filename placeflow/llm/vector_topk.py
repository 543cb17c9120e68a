"""Exact top-k search by inner product: a Voronoi join.

Rows are drawn as pivots (a bounded sample) and every vector belongs to the cell of its nearest
pivot. Of each cell only a summary is kept: its rows and the largest distance to its pivot.
For a query q the k-th best score among the sampled rows is a lower bound of its k-th best
score at all; a cell of pivot p and radius R holds no score above q.p + |q| R. Query vectors, the
smaller side, are grouped by cell as well and copied, in packs, only to the cells (in blocks of
at most about ``BLOCK`` rows) that can reach the lower bound; each block is solved by a matrix
product, and the results of a query's blocks are merged. Bounds only leave out what cannot be
among the results, with a margin for rounding, so the search is exact.

Scores are sums of integers: float products where every sum stays below 2^53, Python
integers otherwise (a score beyond 64 bits counts as the nearest long).

Defined results: vectors that are null or hold null or non-finite components (scaled ones
included) take no part; of vectors of unlike length the shorter one is filled with zeros, so an
empty vector scores 0 with all; a row is never a candidate of itself, but another row with the
same id is; a null id is no query and comes last among ties; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from placeflow.llm.common import stage

SAMPLE = 4096      # rows sampled for pivots and lower bounds
MAX_CELLS = 1024
BLOCK = 8192       # data rows solved at once
PACK = 256         # queries copied together
EXACT = float(1 << 53)
NO_ID = np.iinfo(np.int64).max


def scaled(df: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(uid, id, vec): floor(scale * x) of the vectors that take part; uid tells rows apart."""
    big = F.transform(F.col(vec_col), lambda x: F.lit(float(scale)) * x.cast("double"))
    # floor() of a double is a long; doubles beyond 2^52 are whole numbers already
    vec = F.transform(big, lambda y: F.when(F.abs(y) < 2.0 ** 52, F.floor(y).cast("double")).otherwise(y))
    fine = ~F.exists(vec, lambda y: y.isNull() | F.isnan(y) | (F.abs(y) == float("inf")))
    return (df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where(F.col("vec").isNotNull() & fine)
            .select(F.monotonically_increasing_id().alias("uid"), "id", "vec"))


def stacked(arrays: list[np.ndarray], width: int = 0) -> np.ndarray:
    """Vectors as rows of a matrix; shorter ones are filled with zeros."""
    width = max([width, *map(len, arrays)])
    out = np.zeros((len(arrays), width))
    for i, a in enumerate(arrays):
        out[i, :len(a)] = a
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    w = min(a.shape[1], b.shape[1])
    return a[:, :w] @ b[:, :w].T


def norms(a: np.ndarray) -> np.ndarray:
    top = np.abs(a).max(axis=1, initial=0)  # no overflow of squares
    safe = np.where(top > 0, top, 1)
    return np.sqrt(((a / safe[:, None]) ** 2).sum(axis=1)) * top


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    width = max(rows.shape[1], pivots.shape[1])
    rows, pivots = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (rows, pivots))
    out = np.empty((len(rows), len(pivots)))
    for j, p in enumerate(pivots):
        out[:, j] = norms(rows - p)
    return out


def _unpack(column, dtype=np.float64) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype) for x in column.to_pylist()]


def cells(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(uid, id, cell, far, vec): the nearest pivot of each row and the distance to it."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def assign(batches):
        pivots = shared.value
        size = norms(pivots)
        for batch in batches:
            if not len(batch):
                continue
            arrays = [np.array(x, np.float64) for x in batch.column(2).to_pylist()]
            m = stacked(arrays)
            with np.errstate(over="ignore", invalid="ignore"):
                near = size ** 2 - 2 * product(m, pivots)
            cell = np.nan_to_num(near, nan=np.inf).argmin(axis=1)  # any choice is right: the distance below is exact
            far = np.empty(len(m))
            for j in np.unique(cell):
                far[cell == j] = distances(m[cell == j], pivots[j:j + 1])[:, 0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cell, pa.int32()), pa.array(far), pa.array([x.tobytes() for x in arrays], pa.binary())],
                names=["uid", "id", "cell", "far", "vec"])

    return rows.mapInArrow(assign, "uid long, id long, cell int, far double, vec binary")


def lower_bounds(queries: np.ndarray, uids: np.ndarray, sample: np.ndarray, sample_uids: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each query in the sample, itself left out, less a margin."""
    if len(sample) <= k:
        return np.full(len(queries), -np.inf)
    with np.errstate(over="ignore", invalid="ignore"):
        scores = product(queries, sample)
        scores[uids[:, None] == sample_uids[None, :]] = -np.inf
        scores = np.nan_to_num(scores, nan=-np.inf, posinf=-np.inf)
        best = np.partition(scores, len(sample) - k, axis=1)[:, len(sample) - k]
        # scores from 2^63 on are returned as equal
        return np.minimum(best - 1e-9 * norms(queries) * norms(sample).max() - 1, 9.2e18)


def needed(queries: np.ndarray, bounds: np.ndarray, pivots: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Which queries may find a result in which cells."""
    size = norms(queries)[:, None]
    with np.errstate(over="ignore", invalid="ignore"):
        reach = product(queries, pivots) + size * radius + 1e-9 * size * (norms(pivots) + radius) + 1
    return ~(reach < bounds[:, None]) & (radius >= 0)  # what cannot be compared is needed


def packs(queries: DataFrame, sample, pivots, radius, n_blocks, k: int) -> DataFrame:
    """Queries of a cell in packs, one row for each block of each cell that one of them needs."""
    shared = queries.sparkSession.sparkContext.broadcast((sample, pivots, radius, n_blocks))

    def pack(batches):
        (sample, sample_uids), pivots, radius, n_blocks = shared.value
        for batch in batches:
            for start in range(0, len(batch), PACK):
                some = batch.slice(start, PACK)
                m = stacked(_unpack(some.column(4)))
                uids = some.column(0).to_numpy()
                ids = some.column(1).to_numpy()
                bounds = lower_bounds(m, uids, sample, sample_uids, k)
                to = needed(m, bounds, pivots, radius)
                out = []
                for j in np.flatnonzero(to.any(axis=0)):
                    mine = to[:, j]
                    packed = (uids[mine].tobytes(), ids[mine].tobytes(), bounds[mine].tobytes(), np.ascontiguousarray(m[mine]).tobytes())
                    out += [(int(j), b, *packed) for b in range(n_blocks[j])]
                for i in range(0, len(out), 64):
                    part = list(zip(*out[i:i + 64]))
                    n = len(part[0])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part[0], pa.int32()), pa.array(part[1], pa.int32()), pa.array([1] * n, pa.int32()),
                         pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), *[pa.array(p, pa.binary()) for p in part[2:]]],
                        names=["cell", "block", "kind", "uid", "id", "uids", "ids", "bounds", "vecs"])

    # a cell's queries side by side; a crowded cell is cut by uid
    near = queries.repartitionByRange("cell", "uid").sortWithinPartitions("cell", "uid")
    return near.mapInArrow(pack, WORK)


WORK = "cell int, block int, kind int, uid long, id long, uids binary, ids binary, bounds binary, vecs binary"


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def exact_scores(q: np.ndarray, m: np.ndarray) -> list[int]:
    a = [int(x) for x in q]
    return [sum(x * int(y) for x, y in zip(a, row) if y) for row in m]


def solve(k: int):
    """Function over rows sorted by block, data rows before query packs: the k best rows of
    the block for each query. Only the data of one block is held."""

    def run(batches):
        key, vectors, uids, ids = None, [], [], []
        m = None
        for batch in batches:
            out: list[tuple] = []
            for cell, block, kind, uid, id_, u, i, bounds, vecs in zip(*[batch.column(c).to_pylist() for c in range(9)]):
                if (cell, block) != key:
                    key, vectors, uids, ids, m = (cell, block), [], [], [], None
                if kind == 0:
                    vectors.append(np.frombuffer(vecs))
                    uids.append(uid)
                    ids.append(id_)
                    continue
                if m is None:
                    m, row_uids, row_ids = stacked(vectors), np.array(uids, np.int64), np.array(ids, np.int64)
                    longest = norms(m).max(initial=0)
                q_uids, q_ids, low = np.frombuffer(u, np.int64), np.frombuffer(i, np.int64), np.frombuffer(bounds)
                q = np.frombuffer(vecs).reshape(len(q_uids), -1)
                with np.errstate(over="ignore", invalid="ignore"):
                    small = norms(q) * longest < EXACT
                    scores = product(q, m)
                for r in range(len(q)):
                    fit = np.flatnonzero(~(scores[r] < low[r]) & (row_uids != q_uids[r]))
                    if small[r]:
                        places = fit[best_of(scores[r][fit], row_ids[fit], k)]
                        out += [(q_uids[r], q_ids[r], row_ids[p], int(scores[r][p])) for p in places]
                    else:
                        exact = [max(-(1 << 63), min((1 << 63) - 1, x)) for x in exact_scores(q[r], m[fit])]
                        order = sorted(range(len(fit)), key=lambda x: (-exact[x], row_ids[fit[x]]))[:k]
                        out += [(q_uids[r], q_ids[r], row_ids[fit[x]], exact[x]) for x in order]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in map(list, zip(*out))],
                                                 names=["uid", "query_id", "vec_id", "score"])

    return run


def top_k(df: DataFrame, k: int = 5, every: int = 50, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding",
          sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the rows whose id ``every`` divides."""
    spark = df.sparkSession
    rows = stage(scaled(df, scale, id_col, vec_col), "vectors")
    n = rows.count()
    # a bounded sample by hash of the row; pivots are its first rows
    drawn = rows.where(F.pmod(F.xxhash64("uid"), F.lit(1 << 30)) <= int(min(1.0, 1.2 * sample / max(n, 1)) * (1 << 30)))
    drawn = drawn.orderBy(F.xxhash64("uid"), "uid").limit(sample).collect()
    if not drawn:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sampled = stacked([np.array(r["vec"], np.float64) for r in drawn])
    uids = np.array([r["uid"] for r in drawn], np.int64)
    pivots = sampled[:max(1, min(MAX_CELLS, int(n ** 0.5 / 4), len(drawn)))]
    placed = stage(cells(rows, pivots), "cells")
    radius, n_blocks = np.full(len(pivots), -1.0), np.zeros(len(pivots), np.int64)
    for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect():
        radius[r["cell"]], n_blocks[r["cell"]] = r["far"], -(-r["n"] // block)
    queries = packs(placed.where(F.col("id") % every == 0), (sampled, uids), pivots, radius, n_blocks.tolist(), k)
    blocks = F.element_at(F.array(*[F.lit(int(max(1, b))) for b in n_blocks]), F.col("cell") + 1)
    data = placed.select("cell", F.pmod(F.xxhash64("uid"), blocks).cast("int").alias("block"), F.lit(0).alias("kind"),
                         "uid", F.coalesce("id", F.lit(NO_ID)).alias("id"),
                         *[F.lit(None).cast("binary").alias(c) for c in ("uids", "ids", "bounds")], F.col("vec").alias("vecs"))
    work = data.unionByName(queries).repartition("cell", "block").sortWithinPartitions("cell", "block", "kind")
    found = work.mapInArrow(solve(k), "uid long, query_id long, vec_id long, score long")
    order = Window.partitionBy("uid").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"),
                    F.when(F.col("vec_id") < NO_ID, F.col("vec_id")).alias("vec_id"), "score"))
