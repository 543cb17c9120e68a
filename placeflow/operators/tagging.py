"""Hidden tags from a synonym dictionary.

A tag applies to a name when one of its aliases occurs in the lower-cased name,
or, failing that, when the best-window similarity of the name and the tag's
whole alias text (spaces included) is at least ``threshold``. Tags come out
sorted and comma-joined; an empty name gets ''.

Plan, the same tags either way:
* a dictionary of up to ``COMPILED_ALIASES`` aliases is compiled into the plan: exact hits
  are one ``contains`` per alias in a projection, and the similarity of each *distinct*
  name to every tag is one Arrow-batched function with the dictionary in its closure;
* a larger one is matched exactly by automata over the aliases (``ALIASES_AT_ONCE`` to each,
  broadcast one after the other; a text is read once by each where it lies, in memory linear
  in the text), and by similarity through an equi-join on rare characters.

Both similarity paths first test a necessary condition: with t = threshold / 100, a window
of length w <= m (the shorter length) scores t only if 2 * LCS >= t * (m + w), and w >= LCS,
so LCS, and with it the shared multiset of characters, is at least c = m * t / (2 - t). With
the k-th of equal characters as a character of its own, any m - c + 1 characters of the
shorter text include one of the longer text: the join is on those that the other side has least.
Similar tags, and exact ones of several automata, are joined back by name (AQE splits a hot name).
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from placeflow.functions.fuzzy import similar_tags_udf, similar_udf

# larger dictionaries are joined: more terms in one projection make no usable plan
COMPILED_ALIASES = 300
# aliases of one automaton: bounds what the driver and a task hold
ALIASES_AT_ONCE = 100_000


def load_dictionary(syn: DataFrame) -> list[tuple[str, str, list[str]]] | None:
    """Collect a small dictionary: [(tag, alias_text, aliases)] sorted by tag, or
    None when it is too large to compile (the join path handles it exactly)."""
    rows = syn.select("tag", "alias_text", "aliases").limit(COMPILED_ALIASES + 1).collect()
    if len(rows) > COMPILED_ALIASES or sum(len(r.aliases or []) for r in rows) > COMPILED_ALIASES:
        return None
    return sorted((r.tag, r.alias_text, list(r.aliases or [])) for r in rows)


def exact_tags_by_join(names: DataFrame, syn: DataFrame) -> DataFrame:
    """(lname, tag) for any dictionary size: every tag with an alias in the distinct name."""
    return with_exact_tags(names.select("lname"), "lname", syn, "_tags").select("lname", F.explode("_tags").alias("tag"))


def with_exact_tags(df: DataFrame, text: str, syn: DataFrame, out: str) -> DataFrame:
    """Adds ``out``: the distinct tags with an alias in ``text``, for any dictionary size. Found in
    place by one automaton; what several find meets by a digest of the text, so a text is
    neither repeated for its tags nor moved for them more than once."""
    aliases = syn.select("tag", F.explode("aliases").alias("alias")).filter((F.col("alias") != "") & F.col("tag").isNotNull()).distinct()
    shards = max(1, -(-aliases.count() // ALIASES_AT_ONCE))
    finders = []
    for shard in range(shards):
        some = aliases.filter(F.pmod(F.xxhash64("alias", "tag"), F.lit(shards)) == shard).collect()
        finders.append(_finder(df.sparkSession, [(r.tag, r.alias) for r in some]))
    if shards == 1:
        return df.withColumn(out, finders[0](F.col(text)))
    digest = F.unhex(F.sha2(F.col(text), 256))
    found = [df.select(digest.alias("_digest"), F.lit(i).alias("shard"), f(F.col(text)).alias("tags")) for i, f in enumerate(finders)]
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    # of a text that occurs often one row leaves each task
    hits = hits.groupBy("_digest", "shard").agg(F.any_value("tags").alias("tags")).filter(F.size("tags") > 0)
    hits = hits.groupBy("_digest").agg(F.array_distinct(F.flatten(F.collect_list("tags"))).alias(out))
    joined = df.withColumn("_digest", digest).join(hits, "_digest", "left").drop("_digest")
    return joined.withColumn(out, F.coalesce(F.col(out), F.array().cast("array<string>")))


def _finder(spark: SparkSession, pairs: list[tuple[str, str]]):
    """Arrow-batched function: text -> distinct tags of the aliases in a bounded list of (tag, alias)."""
    shared = spark.sparkContext.broadcast(pairs)

    @arrow_udf(T.ArrayType(T.StringType()))
    def find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton, tags = ahocorasick.Automaton(), {}
        for tag, alias in shared.value:
            tags.setdefault(alias, []).append(tag)
        for alias, some in tags.items():
            automaton.add_word(alias, some)
        if tags:
            automaton.make_automaton()
        for batch in texts:
            hits = ({tag for _, some in automaton.iter(x) for tag in some} if tags and x else () for x in batch.to_pylist())
            yield pa.array([sorted(h) for h in hits], pa.list_(pa.string()))

    return find


def exact_tags(lname: Column, dictionary) -> Column:
    """array<string> of tags with an alias contained in ``lname``, in tag order."""
    hits = []
    for tag, _, aliases in dictionary:
        if not aliases:
            continue
        cond = None
        for a in aliases:
            c = F.contains(lname, F.lit(a))
            cond = c if cond is None else (cond | c)
        hits.append(F.when(cond, F.lit(tag)))
    if not hits:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*hits))


def _chars(col: Column) -> Column:
    # one element per code point, newlines included
    return F.regexp_extract_all(col, F.lit("(?s)."), 0)


def fuzzy_tags(names: DataFrame, syn: DataFrame, threshold: float = 80.0, dictionary=None) -> DataFrame:
    """(lname, tag) pairs whose similarity reaches ``threshold`` (above 0).

    ``names`` has distinct non-empty ``lname``. With a compiled ``dictionary`` every name is
    compared in place; without, pairs come from a join on shared characters.
    """
    if threshold <= 0:
        raise ValueError("threshold must be above 0: at 0 every tag would apply to every name")
    if dictionary is not None:
        pairs = [(tag, text) for tag, text, _ in dictionary if text]
        similar = similar_tags_udf(pairs, threshold)
        return names.select("lname", F.explode(similar(F.col("lname"))).alias("tag"))
    texts = syn.select("tag", "alias_text").filter(F.col("alias_text") != "").distinct()
    cands = similar_candidates(names, texts.select("alias_text").distinct(), threshold)
    similar = cands.filter(similar_udf(threshold)(F.col("lname"), F.col("alias_text")))
    return similar.join(texts, "alias_text").select("lname", "tag").distinct()


def _characters(df: DataFrame, text: str) -> DataFrame:
    """(text, size, ch, k): the k-th occurrence of each character of the distinct texts."""
    counts = df.select(text, F.length(text).alias("size"), F.explode(_chars(F.col(text))).alias("ch")).groupBy(text, "size", "ch").count()
    return counts.select(text, "size", "ch", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("k"))


def _rarest(chars: DataFrame, text: str, other: DataFrame, least: float) -> DataFrame:
    """Of each text the characters that ``other`` has least: as many as must include a shared
    one if ``least`` of the text's characters are shared."""
    seen = other.groupBy("ch", "k").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(text).orderBy(F.coalesce("n", F.lit(0)), "ch", "k")
    ranked = chars.join(seen, ["ch", "k"], "left").withColumn("rank", F.row_number().over(order))
    needed = F.greatest(F.ceil(F.col("size") * least - 1e-9), F.lit(1))
    return ranked.filter(F.col("n").isNotNull() & (F.col("rank") <= F.col("size") - needed + 1)).select(text, "size", "ch", "k")


def similar_candidates(names: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(lname, alias_text): every pair that can reach ``threshold``, without the pairs that share
    only common characters."""
    t = min(threshold, 100.0) / 100
    n, a = _characters(names, "lname"), _characters(texts, "alias_text")
    short_n = _rarest(n, "lname", a, t / (2 - t)).withColumnRenamed("size", "own")
    short_a = _rarest(a, "alias_text", n, t / (2 - t)).withColumnRenamed("size", "own")
    first = short_n.join(a, ["ch", "k"]).filter("own <= size").select("lname", "alias_text")
    second = short_a.join(n, ["ch", "k"]).filter("own < size").select("lname", "alias_text")
    return first.unionByName(second).distinct()


def synonym_tags(df: DataFrame, syn: DataFrame, name: str = "name", out: str = "hidden_tags", fuzzy: bool = True,
                 threshold: float = 80.0, method: str = "auto") -> DataFrame:
    """``method``: 'projection' (dictionary compiled into the plan), 'join'
    (substring equi-join, any size), or 'auto' (projection while it fits)."""
    dictionary = load_dictionary(syn) if method in ("auto", "projection") else None
    if method == "projection" and dictionary is None:
        raise ValueError("dictionary too large for the projection method; use 'join' or 'auto'")
    lname = F.lower(F.coalesce(F.col(name), F.lit("")))
    base = df.withColumn("_lname", lname)
    if dictionary is not None:
        with_exact = base.withColumn("_exact", exact_tags(F.col("_lname"), dictionary))
    else:
        with_exact = with_exact_tags(base, "_lname", syn, "_exact")
    if not fuzzy:
        tags = F.array_sort(F.col("_exact"))
        return with_exact.withColumn(out, F.when(F.col("_lname") == "", "").otherwise(F.concat_ws(",", tags))).drop("_lname", "_exact")
    names = base.filter(F.col("_lname") != "").select(F.col("_lname").alias("lname")).distinct()
    fz = fuzzy_tags(names, syn, threshold, dictionary).groupBy("lname").agg(F.collect_set("tag").alias("_fuzzy"))
    j = with_exact.join(fz, with_exact["_lname"] == fz["lname"], "left")
    tags = F.array_sort(F.array_union(F.col("_exact"), F.coalesce(F.col("_fuzzy"), F.array().cast("array<string>"))))
    return j.withColumn(out, F.when(F.col("_lname") == "", "").otherwise(F.concat_ws(",", tags))).drop("_lname", "_exact", "_fuzzy", "lname")
