"""Quality rules by distribution divergence; DataFrame functions only.

Every document gives two histograms: its characters by class (CLASSES) and its words by the
common words of its language (words with at least ``min_share`` of all words of the language,
so 1 / min_share of them at most; all others are one more class). Each is compared with the
same histogram over all documents of the language by the Jensen-Shannon distance (base 2, 0
to 1). A document is rejected when its characters are further than ``max_char_distance``, or its
words further than ``max_word_distance`` times the distance of a text that has no common word
of the language at all: such a text always fails, whatever share of the language the common
words make up. Histograms of fewer than ``min_chars`` characters or ``min_words`` words decide
nothing, as chance alone moves them far. The ``max_languages`` languages with the most words,
``min_reference`` at least, have histograms of their own; others, and null, use those over all
documents. Base counts are kept beside the verdict (see the columns).

A text's common words are counted in its own sorted array, then joined as (word, count) rows
with the bounded table of common words; nothing is grouped by a word or language there.

Defined results: null text counts as empty (no words: base_failed); a null doc_id stays null;
repeated rows each return a row and count in the references; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeflow.llm.common import kept, stage, texts

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
# in this order; what an earlier class took is not counted again
CLASSES = {"lower": r"\p{Ll}", "space": SPACE, "upper": r"\p{Lu}", "digit": r"\p{Nd}", "symbol": SYMBOLS, "punct": r"\p{P}"}
WINDOW = 5
ALL = "*"  # the reference over all documents
MAX_LITERALS = 20_000  # common words that the filter before the join may hold; no effect on the result


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def js_term(a: Column, b: Column) -> Column:
    """What one class with shares ``a`` and ``b`` adds to twice the Jensen-Shannon divergence."""
    def part(x, y):
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    return part(a, b) + part(b, a)


def js_root(total: Column) -> Column:
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two arrays of shares."""
    return js_root(F.aggregate(F.zip_with(p, q, js_term), F.lit(0.0), lambda s, x: s + x))


def shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x)
    return F.transform(counts, lambda c: F.when(total > 0, c / total).otherwise(F.lit(0.0)))


def repeated_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in a window of five that the text holds twice or more."""
    n = F.size("words")
    hashed = df.withColumn("wh", F.transform("words", lambda w: F.xxhash64(w)))
    hashed = hashed.withColumn("win", F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("wh", i + k) for k in range(WINDOW)]))
    ).otherwise(F.array().cast("array<bigint>")))
    # sorted windows with their places, only for texts that repeat one at all
    sorted_ = hashed.withColumn("s", F.when(
        F.size(F.array_distinct("win")) < F.size("win"),
        F.array_sort(F.transform("win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = sorted_.withColumn("at", F.array_sort(F.transform(F.filter(
        "s", lambda x, i: F.coalesce(F.get("s", i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("s", i + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])))
    steps = F.transform("at", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get("at", k + 1), x + WINDOW) - x))
    return twice.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))).drop("wh", "win", "s", "at")


def char_classes(df: DataFrame) -> DataFrame:
    """Adds one count (code points) per class, and ``other``; each class is taken out in turn."""
    df = df.withColumn("rest", F.col("text"))
    for name, pattern in CLASSES.items():
        df = df.withColumn("less", F.regexp_replace("rest", pattern + "+", "")).withColumn(
            name, (F.length("rest") - F.length("less")).cast("long")).drop("rest").withColumnRenamed("less", "rest")
    return df.withColumn("other", F.length("rest").cast("long")).drop("rest")


def common_words(src: DataFrame, min_share: float, min_reference: int, max_languages: int) -> tuple[DataFrame, DataFrame]:
    """(ref, total) and (ref, word, n): the references and their common words, counted over all
    documents; at most 1 + ``max_languages`` references of 1 / min_share words each."""
    with kept() as keep:
        counted = stage(src.select("lang", F.explode(words_of(F.col("text"))).alias("word"))
                        .groupBy("lang", "word").agg(F.count("*").alias("n")), "rules-words")
        totals = counted.groupBy(F.col("lang").alias("ref")).agg(F.sum("n").alias("total"))
        every = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total")).first()["total"]
        top = totals.where((F.col("total") >= min_reference) & (F.col("ref") != ALL)).orderBy(F.desc("total"), "ref").limit(max_languages)
        refs = keep(stage(top.unionByName(src.sparkSession.createDataFrame([(ALL, every)], "ref string, total long")), "rules-refs"))
        # the bounded totals go to the words, not the words to their language
        each = counted.withColumnRenamed("lang", "ref").join(F.broadcast(refs.where(F.col("ref") != ALL)), "ref").where(
            F.col("n") >= F.col("total") * min_share).select("ref", "word", "n")
        over_all = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= F.lit(every) * min_share)
        words = keep(stage(each.unionByName(over_all.select(F.lit(ALL).alias("ref"), "word", "n")), "rules-common"))
    return refs, words


def counts_of(words: Column) -> Column:
    """array<struct<word, k>>: each distinct word of an array with its count (by one sort)."""
    placed = F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("i")))
    ends = F.filter(placed, lambda x: F.coalesce(F.get(words, x["i"] + 1) != x["word"], F.lit(True)))
    return F.transform(ends, lambda x: F.struct(x["word"].alias("word"), (x["i"] + 1).alias("upto")))


def quality_rules(docs: DataFrame, min_share: float = 0.001, max_char_distance: float = 0.3, max_word_distance: float = 0.9,
                  min_chars: int = 200, min_words: int = 100, min_reference: int = 10_000, max_languages: int = 200) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    char_distance and word_distance (rounded; null below the length guards)."""
    src = texts(docs, F.coalesce(F.col("lang"), F.lit("")).alias("lang"))
    refs, words = common_words(src, min_share, min_reference, max_languages)
    known = [r["ref"] for r in refs.where(F.col("ref") != ALL).select("ref").collect()]
    distinct = words.select("word").distinct()
    named = src.withColumn("ref", F.when(F.col("lang").isin(known), F.col("lang")).otherwise(F.lit(ALL)))
    cols = named.withColumn("words", words_of(F.col("text")))
    cols = cols.withColumn("lines", F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    cols = cols.withColumn("n_words", F.size("words").cast("long")).withColumn(
        "n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    cols = repeated_words(char_classes(cols))
    some = F.col("words")
    if distinct.count() <= MAX_LITERALS:  # leaves fewer rows for the join
        some = F.filter("words", lambda w: w.isin([r["word"] for r in distinct.collect()]))
    cols = cols.withColumn("seen", F.sort_array(F.when(F.col("n_words") >= min_words, some))).drop("words", "text")
    cols = cols.withColumn("ends", counts_of(F.col("seen"))).withColumn("seen", F.transform("ends", lambda x, i: F.struct(
        x["word"].alias("word"), (x["upto"] - F.coalesce(F.get("ends", i - 1)["upto"], F.lit(0))).cast("long").alias("k"))))
    names = [*CLASSES, "other"]
    feats = stage(cols.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "lang", "ref", "n_words", "n_dup_lines",
                              "n_repeat_words", "seen", *names), "rules-features")
    return verdict(feats, refs, words, names, max_char_distance, max_word_distance, min_chars, min_words)


def verdict(feats, refs, words, names, max_char, max_word, min_chars, min_words) -> DataFrame:
    """The distances to the references and the decision."""
    per = feats.groupBy("lang").agg(*[F.sum(c).alias(c) for c in names])
    every = per.agg(*[F.sum(c).alias(c) for c in names]).select(F.lit(ALL).alias("ref"), *names)
    chars = per.withColumnRenamed("lang", "ref").where(F.col("ref") != ALL).unionByName(every).select("ref", F.array(*names).alias("ref_chars"))
    sums = words.groupBy("ref").agg(F.sum("n").alias("common"))
    known = refs.join(sums, "ref", "left").join(chars, "ref", "left")
    share = F.when(F.col("total") > 0, F.coalesce("common", F.lit(0)) / F.col("total")).otherwise(F.lit(0.0))
    known = stage(known.withColumn("q_common", share).withColumn("q_other", 1 - F.col("q_common")).withColumn(
        "absent", js_root(F.col("q_common") + js_term(F.lit(1.0), F.col("q_other")))), "rules-references")

    # a common word that a text lacks adds its own share q: sum over all q, corrected for the words seen
    shares_q = words.join(F.broadcast(refs), "ref").select("ref", "word", (F.col("n") / F.col("total")).alias("q"))
    row = ["rid", "doc_id", "ref", "n_words", "n_dup_lines", "n_repeat_words", *names]
    seen = feats.select(*row, F.explode_outer("seen").alias("seen")).select(*row, F.col("seen.word").alias("word"), F.col("seen.k").alias("k"))
    hits = seen.join(F.broadcast(shares_q), ["ref", "word"], "left")
    both = hits.groupBy(*row).agg(
        F.coalesce(F.sum(F.when(F.col("q").isNotNull(), F.col("k"))), F.lit(0)).alias("n_common"),
        F.coalesce(F.sum(js_term(F.col("k") / F.col("n_words"), F.col("q")) - F.col("q")), F.lit(0.0)).alias("js_seen"))
    both = both.join(F.broadcast(known.drop("total", "common")), "ref", "left")  # 1 + max_languages rows
    own = F.array(*names)
    n_chars = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    out = both.withColumn("char_distance", F.when(n_chars >= min_chars, F.round(js_distance(shares(own), shares(F.col("ref_chars"))), 4)))
    apart = F.col("js_seen") + F.col("q_common") + js_term(1 - F.col("n_common") / F.col("n_words"), F.col("q_other"))
    out = out.withColumn("word_distance", F.when(F.col("n_words") >= min_words, F.round(js_root(apart), 4)))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    far = (F.coalesce("char_distance", F.lit(0.0)) > max_char) | (F.coalesce("word_distance", F.lit(0.0)) > max_word * F.col("absent"))
    return out.select("doc_id", "n_words", (n_chars - F.col("space")).alias("word_chars"), F.col("symbol").alias("n_symbols"),
                      "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~far).alias("kept"),
                      "char_distance", "word_distance")
