"""Spelling variants: neighbours at one edit through pairs of trie nodes.

All words stand in a trie read forward and in one read backward, whose nodes are numbered.
A word cut at a place is then a pair of integers: the forward node before the place and the
backward node behind it. Two words that differ by one replaced letter have the same pair when
that letter is skipped; a word with one letter more has, with that letter skipped, the pair
the other one has when it is cut there. Equal pairs mean equal letters, so the join on the pairs
gives exact neighbours without comparing words.

The words are dealt to tasks by sorted ranges and each task numbers its own nodes; the few
nodes that can lie in several ranges are the beginnings of the words at the borders, and
have numbers of their own. The words that share a skipped pair differ in that one letter, so a
join key has at most as many of them as the alphabet has letters.

Defined results: null text has no words; with a null doc_id no letter is deleted; repeated
rows count each time; extra columns are not looked at; an empty table gives no rows. Only runs
of at least ``shortest`` letters can give a word, as deleting makes a run shorter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeflow.llm.common import stage

SHORTEST = 7
RANGE = 200_000       # words numbered by one task, about
HELD = 1 << 20        # distinct words counted in a task before they are handed on
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(doc_id: int | None, text: str, shortest: int, every: int, runs: re.Pattern) -> Counter:
    """Words of a text and their times, a letter taken out of those whose checksum ``every`` divides."""
    found: Counter = Counter()
    start = None if doc_id is None else zlib.crc32(b"%d:" % doc_id)
    lowered = text.encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass")
    for run, n in Counter(runs.findall(lowered)).items():
        if start is not None:
            h = zlib.crc32(run.encode(), start)
            if h % every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
        if len(run) >= shortest:
            found[run] += n
    return found


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, every: int = 31, least: int = 2) -> DataFrame:
    """(word, n) of the words with at least ``least`` occurrences in all documents."""
    letters = f"[A-Za-zÀ-ÿ]{{{shortest},}}"

    def gather(batches):
        runs = re.compile(letters)
        seen: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.update(words_of(doc_id, text, shortest, every, runs))
                if len(seen) > HELD:
                    yield counted(seen)
                    seen = Counter()
        yield counted(seen)

    def counted(seen):
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    rows = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(gather, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def number_nodes(words: list[str], first: int, border: dict[str, int]) -> list[list[int]]:
    """Node numbers of each word's beginnings (the empty one and the word included) in the trie
    of sorted ``words``: from ``first`` on, but for those that ``border`` knows."""
    out, last, path, after = [], "", [border[""]], first
    for word in words:
        same, most = 0, min(len(word), len(last))
        while same < most and word[same] == last[same]:
            same += 1
        path = path[:same + 1]
        for end in range(same + 1, len(word) + 1):
            # no longer beginning is at a border unless this one is
            node = border.get(word[:end]) if path[-1] < 0 else None
            if node is None:
                node, after = after, after + 1
            path.append(node)
        out.append(path)
        last = word
    return out


def nodes(words: DataFrame, n: int, name: str) -> DataFrame:
    """(word, nodes, fresh): ``words`` (distinct) with the numbers of their beginnings, and which
    letters are unlike the one before."""
    spark = words.sparkSession
    ranges = -(-n // RANGE)
    borders: list[str] = []
    if ranges > 1:  # a bounded sample cuts the words into ranges of about equal size
        share = min(1.0, 40 * ranges / n)
        drawn = sorted(r[0] for r in words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))).select("word").collect())
        borders = [drawn[i * len(drawn) // ranges] for i in range(1, ranges)] if drawn else []
    prefixes = dict.fromkeys([""] + [b[:i] for b in borders for i in range(1, len(b) + 1)])
    border = {p: -1 - i for i, p in enumerate(prefixes)}
    shared = spark.sparkContext.broadcast((sorted(set(borders)), border))

    def deal(batches):
        import bisect
        borders = shared.value[0]
        for batch in batches:
            part = [bisect.bisect_right(borders, w) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), batch.column(0)], names=["part", "word"])

    def number(table):
        some = sorted(table.column("word").to_pylist())
        first = table.column("part")[0].as_py() << 40
        return pa.table({"word": pa.array(some, pa.string()),
                         "nodes": pa.array(number_nodes(some, first, shared.value[1]), pa.list_(pa.int64())),
                         "fresh": pa.array([[a != b for a, b in zip(w, " " + w)] for w in some], pa.list_(pa.bool_()))})

    dealt = words.select("word").mapInArrow(deal, "part long, word string")
    return stage(dealt.groupBy("part").applyInArrow(number, "word string, nodes array<long>, fresh array<boolean>"), name)


def keyed(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The words as (id, word, n) and their pairs (before, behind, id, skips, first): ``skips``
    where a letter is left out, ``first`` where it is the first of equal letters in a row, so
    that leaving it out is counted once. The id of a word is its own forward node."""
    n = words.count()
    forward = nodes(words, n, "forward")
    backward = nodes(words.select(F.reverse("word").alias("word")), n, "backward")
    both = words.join(forward, "word").join(backward.select(F.reverse("word").alias("word"), F.col("nodes").alias("back")), "word")
    both = stage(both.select(F.element_at("nodes", -1).alias("id"), "word", "n", "nodes", "back", forward["fresh"]), "numbered")
    size = F.size("fresh")

    def pair(i: Column, skipped: int) -> Column:
        return F.struct(F.get("nodes", i).alias("before"), F.get("back", size - i - skipped).alias("behind"), F.col("id"),
                        F.lit(bool(skipped)).alias("skips"), F.get("fresh", i).alias("first"))

    cut = F.transform(F.sequence(F.lit(0), size), lambda i: pair(i, 0))
    skip = F.transform(F.sequence(F.lit(0), size - 1), lambda i: pair(i, 1))
    return both.select("id", "word", "n"), both.select(F.inline(F.concat(skip, cut)))


def neighbours(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The words as (id, word, n) and (id, near): each near pair of words in both directions."""
    known, pairs = keyed(words)
    x = pairs.where("skips").select("before", "behind", F.col("id").alias("x"), "first")
    y = pairs.select("before", "behind", F.col("id").alias("y"), "skips")
    met = x.join(y, ["before", "behind"]).where((F.col("skips") & (F.col("x") != F.col("y"))) | (~F.col("skips") & F.col("first")))
    # a replaced letter is met from both sides, a longer word meets the shorter one only
    sides = F.when(F.col("skips"), F.array(F.struct(F.col("x").alias("id"), F.col("y").alias("near")))).otherwise(
        F.array(F.struct(F.col("x").alias("id"), F.col("y").alias("near")), F.struct(F.col("y").alias("id"), F.col("x").alias("near"))))
    return known, stage(met.select(F.inline(sides)), "near")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word of each chain of ``forms`` (word, form). A form occurs at least
    ten times as often as its word, so chains are short and end; every round doubles its step."""
    reach = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = stage(reach.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if longer.where("moved").isEmpty():
            return longer.select("word", "root")
        reach = longer.select("word", "root")


def variants(docs: DataFrame, factor: int = 10, shortest: int = SHORTEST, every: int = 31, least: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the documents."""
    words = stage(vocabulary(docs, shortest, every, least), "spellings")
    known, near = neighbours(words)
    with_n = near.join(known.select(F.col("id").alias("near"), F.col("word").alias("form"), F.col("n").alias("form_n")), "near")
    # of the most frequent the smallest word
    best = with_n.groupBy("id").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("k"), "form")).alias("b"))
    chosen = (known.join(best, "id", "left")
              .withColumn("fits", F.coalesce(-F.col("b.k") >= F.col("n") * factor, F.lit(False)))
              .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                      F.when(F.col("fits"), F.col("b.form")).alias("form"), F.when(F.col("fits"), -F.col("b.k")).alias("form_n")))
    chosen = stage(chosen, "forms")
    ends = roots(chosen.where(F.col("form").isNotNull()).select("word", "form"))
    return chosen.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
