"""Helpers shared by the corpus operators: staged tables, null-safe columns, chunked
Arrow batches, size-checked joins, connected components and links inside buckets."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.session import scratch_dir

# most rows a table may have to be marked for broadcast (narrow rows: under 60 MB)
MAX_BROADCAST_ROWS = 400_000
# most array elements, where a row holds an array of numbers or pairs of them
MAX_BROADCAST_ELEMENTS = 1_500_000
EDGES_PER_TASK = 50_000


_SCOPES: list[list[DataFrame]] = []


def stage(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back: cuts the
    lineage, survives lost executors and keeps parquet statistics. ``codec``: another
    compression than the session's."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.__dict__["_staged"] = path
    if _SCOPES:
        _SCOPES[-1].append(out)
    return out


def drop(*tables: DataFrame) -> None:
    """Delete staged tables whose successors are written. Nothing may read them any more, also
    not to make up for a lost executor: what came from them is a written table itself."""
    for df in tables:
        path = df.__dict__.pop("_staged", None)
        if path:
            target = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def held(df: DataFrame) -> DataFrame:
    """A staged table that no block of ``kept`` deletes."""
    df.__dict__["_held"] = True
    return df


@contextmanager
def kept() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """At the end of the block the tables staged in it are deleted, but for those that went through
    the function it gives."""
    mine: list[DataFrame] = []
    stay: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        stay.append(df)
        return df

    _SCOPES.append(mine)
    try:
        yield keep
    finally:
        _SCOPES.pop()
    stay += [df for df in mine if df.__dict__.get("_held")]
    drop(*[df for df in mine if not any(df is x for x in stay)])
    if _SCOPES:
        _SCOPES[-1].extend(stay)
    release()


def release() -> None:
    """The files of finished shuffles go when the driver's unused plans do."""
    gc.collect()
    spark = SparkSession.getActiveSession()
    if spark is not None:
        spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and ``more``; other columns are left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def in_chunks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes add up to ``most`` or are a single row: bounds what a
    Python worker holds while rows of any length stay whole."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def given_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for mapInArrow, after which the memory that it held goes back to the system: an idle Python worker
    stays beside the later stages for a minute."""
    def wrapped(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)

    return wrapped


def join_checked(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner",
                 weight: Column | None = None) -> DataFrame:
    """Join with a staged ``right`` side, broadcast only when its counted rows (and the sum of
    ``weight``, where a row holds an array) are within the bounds above; larger tables take
    Spark's shuffled join."""
    rows, elements = right.agg(F.count("*"), F.coalesce(F.sum(weight if weight is not None else F.lit(0)), F.lit(0))).first()
    small = rows <= MAX_BROADCAST_ROWS and elements <= MAX_BROADCAST_ELEMENTS
    return left.join(F.broadcast(right) if small else right, on, how)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b; longs) reaches.

    Alternating large-star and small-star rounds; each round is two aggregations and two
    joins on the node, and the edge table is written to the shared folder between rounds.
    The number of rounds grows with the logarithm of the longest path. A round of few edges
    runs in as many tasks as there are cores, however many shuffle partitions there are: one
    task for every EDGES_PER_TASK edges. Nodes without an edge do not appear."""
    e = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .distinct(), name)

    def mark(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = mark(e)
    tasks = max(edges.sparkSession.sparkContext.defaultParallelism, 2 * before[0] // EDGES_PER_TASK)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.coalesce(tasks).distinct().coalesce(tasks)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.coalesce(tasks).unionByName(low.withColumnRenamed("m", "v").coalesce(tasks)).distinct().coalesce(tasks)
        last, e = e, stage(small, name)
        after = mark(e)
        drop(last)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct().coalesce(tasks))


def united(tables: list[DataFrame]) -> DataFrame:
    first, *rest = tables
    for df in rest:
        first = first.unionByName(df)
    return first


PIVOTS = 2


def bucket_links(keyed: DataFrame, attrs: DataFrame | None, close: Callable[[Column, Column], Column], name: str,
                 verify: Callable[[DataFrame], DataFrame] = lambda pairs: pairs, small: int = 32, by: str = "id",
                 rounds: int = 1, need: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(node, root) of the graph that links rows sharing a bucket when they are near.

    ``keyed`` has ``b`` (bucket) and ``id`` (longs), and may have ``f``; else ``attrs`` gives
    every ``id`` its ``f`` (None: the id itself); ``close`` decides a pair by its ``f``; ``verify`` keeps the true
    ones among (x, y) pairs of ids. With ``by="f"`` the nodes are the ``f`` (longs), and
    ``verify`` returns pairs of them. No link is lost and no large bucket is paired up whole:

    * buckets of up to ``small`` members give all their pairs;
    * in larger ones every member is compared with a few pivots of its bucket (chosen by a hash
      of ``f``, so buckets with the same members have the same pivots). A bucket whose
      members are then all in one component is done; in any other the members outside its
      largest component are compared with the members of other components.

    ``need`` (for a carried ``f``) tells from the ``f`` of a pair how many buckets near ones share at least.
    Pairs of small buckets that share fewer are not verified, unless they share a large one as well,
    where all that are not linked yet are compared.

    The buckets are gone through in ``rounds`` parts, so that only that share of the members is
    shuffled and staged at a time; ``keyed`` is read twice in each.
    """
    carried = "f" in keyed.columns

    def near(pairs, need=None):  # (x, y) structs of id and f
        more = [(need(F.col("x.f"), F.col("y.f")) if need else F.lit(1)).alias("need")]
        return (pairs.where((F.col("x.id") != F.col("y.id")) & close(F.col("x.f"), F.col("y.f")))
                .select(F.least("x.id", "y.id").alias("x"), F.greatest("x.id", "y.id").alias("y"), *more))

    def summed(pairs, count):  # each pair once
        if need is None:
            return pairs.select("x", "y").distinct()
        return pairs.groupBy("x", "y").agg(count.alias("c"), F.min("need").alias("need"))

    def enough(pairs):
        return pairs.select("x", "y") if need is None else pairs.where("c >= need").select("x", "y")

    def grouped(links):
        with kept() as keep:
            return keep(stage(components(links.toDF("a", "b"), f"{name}-cc"), f"{name}-roots"))

    def compared(some):
        """Close pairs of some buckets, and the members of the large ones (None: there are none)."""
        if carried:  # dealt out by bucket once, for the sizes and for the members
            dealt = some.repartition("b")
            wide = dealt.groupBy("b").agg(F.count("*").alias("n")).where("n > 1")
            members = dealt.join(wide.hint("shuffle_hash"), "b").select("b", "n", F.struct("id", "f").alias("m"))
        else:
            size = stage(some.groupBy("b").agg(F.count("*").alias("n"), F.min("id").alias("x"), F.max("id").alias("y")).where("n > 1"), f"{name}-buckets")
            wide = stage(size.where("n > 2").select("b", "n"), f"{name}-wide")
            members = _with_f(join_checked(some, wide, ["b"]).select("b", "n", "id"), attrs, ["id"], name).select("b", "n", F.col("id").alias("m"))
        members = stage(members, f"{name}-members")
        if not carried:
            drop(wide)
        release()
        few = members.where(F.col("n") <= small).select("b", "m")
        found = near(few.select("b", F.col("m").alias("x")).join(few.select("b", F.col("m").alias("y")).hint("shuffle_hash"), "b")
                     .where("x.id < y.id").select("x", "y"), need)
        if not carried:  # the two members are known already
            found = found.unionByName(near(_with_f(size.where("n = 2").select("x", "y").distinct(), attrs, ["x", "y"], name)))
        many = members.where(F.col("n") > small).select("b", "m")
        if many.isEmpty():
            return stage(summed(found, F.count("*")), f"{name}-close"), None
        picks = many.groupBy("b").agg(*[F.min(F.struct(F.xxhash64("m.f", F.lit(r)), "m"))["m"].alias(f"p{r}")
                                        for r in range(PIVOTS)])
        picks = stage(picks.select("b", F.explode(F.array_distinct(F.array(*[f"p{r}" for r in range(PIVOTS)]))).alias("y")),
                      f"{name}-pivots")
        found = found.unionByName(near(join_checked(many.withColumnRenamed("m", "x"), picks, ["b"])))
        return stage(summed(found, F.count("*")), f"{name}-close"), stage(many, f"{name}-many")

    parts, larges = [], []
    for part in range(rounds):
        with kept() as keep:
            pairs, large = compared(keyed.where(F.pmod(F.xxhash64("b"), F.lit(rounds)) == part) if rounds > 1 else keyed)
            parts.append(keep(pairs))
            larges += [keep(large)] if large is not None else []
    near_ones = enough(parts[0]) if rounds == 1 else stage(enough(summed(united(parts), F.sum("c") if need else None)), f"{name}-close")
    if rounds > 1:
        drop(*parts)
    with kept() as keep:
        links = keep(stage(verify(near_ones).distinct(), f"{name}-links"))
    drop(near_ones, *parts[:1])
    has_many = len(larges) > 0
    many = united(larges) if has_many else None
    roots = grouped(links)
    drop(links)
    if not has_many:
        return roots
    named = stage(many.select("b", "m", F.col(f"m.{by}").alias("node")).join(roots, "node", "left")
                  .select("b", "m", F.coalesce("root", "node").alias("root")), f"{name}-named")
    per = named.groupBy("b", "root").agg(F.count("*").alias("c"))
    main = per.groupBy("b").agg(F.max(F.struct("c", "root"))["root"].alias("main"), F.count("*").alias("k")).where("k > 1")
    main = stage(main.select("b", "main"), f"{name}-open")
    drop(*larges)
    if main.isEmpty():
        drop(named, main)
        return roots
    still = stage(join_checked(named, main, ["b"]), f"{name}-still")
    drop(named, main)
    rest = still.where("root <> main").select("b", F.col("m").alias("x"), F.col("root").alias("own"))
    cross = rest.join(still.select("b", F.col("m").alias("y"), "root"), "b").where("own <> root").select("x", "y")
    with kept() as keep:
        more = keep(stage(verify(stage(near(cross).select("x", "y").distinct(), f"{name}-close")).distinct(), f"{name}-links"))
    drop(still)
    whole = grouped(roots.unionByName(more.toDF("node", "root")))  # what is known and the links between
    drop(roots, more)
    return whole


def _with_f(df: DataFrame, attrs: DataFrame | None, ids: list[str], name: str) -> DataFrame:
    """Turns each id column into a struct of id and its ``f``."""
    if attrs is None:
        return df.withColumns({c: F.struct(F.col(c).alias("id"), F.col(c).alias("f")) for c in ids})
    df = stage(df, f"{name}-ids")
    wanted = df.select(F.explode(F.array(*ids)).alias("id")).distinct()
    known = stage(join_checked(attrs.select("id", "f"), stage(wanted, f"{name}-wanted"), ["id"]), f"{name}-attrs")
    for c in ids:
        df = join_checked(df, known.select(F.col("id").alias(c), F.struct("id", "f").alias("_pair")), [c])
        df = df.withColumn(c, F.col("_pair")).drop("_pair")
    return df
