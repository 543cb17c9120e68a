"""Token counts from the pieces of distinct pre-tokens.

A pre-token is a run of spaces with the word after it, or one line feed: no vocabulary piece
crosses such a border, so a text has as many tokens as its pre-tokens together. The library
splits every distinct pre-token once; the counts are joined to the per-document frequencies
and summed, without the ids of any text.

The frequent pre-tokens (at most ``head``, chosen by their frequency in all documents) reach
the tasks as a broadcast table of that bounded size and are summed where the text is read;
only the rarer ones, which no hot key can be among, travel through the shuffled join.

Defined results: null text counts as empty and has 0 tokens; a null doc_id stays null;
repeated rows each return a row; extra columns are ignored; a text without rare pre-tokens
or without any still returns its row.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow.llm.common import in_chunks, stage, texts

HEAD = 1 << 18
CHUNK = 1 << 20  # characters split at once
# a literal U+2581 is what the library writes for a space
PRE_TOKEN = re.compile(" *[^ \n]+| +|\n")


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a text as the library sees it: one space is put in front of a text."""
    return PRE_TOKEN.findall(" " + text.replace("▁", " ")) if text else []


class PieceCounter:
    """Pieces of single pre-tokens, counted by the library."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        borders = [p for p in map(self.model.id_to_piece, range(self.model.get_piece_size()))
                   if "\n" in p or "▁" in p.lstrip("▁")]
        if borders:
            raise ValueError(f"pieces cross the borders of pre-tokens: {borders[:5]}")

    def count(self, tokens: list[str]) -> list[int]:
        """The library puts a space in front: it stands for the first one of a pre-token that
        has any; others are put behind a line feed, which makes two tokens with that space."""
        spaced = [t[0] == " " for t in tokens]
        ids = self.model.encode([t[1:] if s else "\n" + t for t, s in zip(tokens, spaced)], num_threads=1)
        # a single space has no text behind it, and the library returns nothing for it
        return [len(x) if s and t != " " else 1 if s else len(x) - 2 for x, t, s in zip(ids, tokens, spaced)]


def _strings(batch, column):
    sizes = [len(s) for s in batch.column(column).cast(pa.binary()).to_pylist()] if len(batch) else []
    for a, b in in_chunks(sizes, CHUNK):
        yield a, b, batch.column(column).slice(a, b - a).to_pylist()


def vocabulary(docs: DataFrame, model: bytes) -> DataFrame:
    """(pre_token, n, pieces): each distinct pre-token of all documents, its frequency and
    the number of its pieces."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def gather(batches):
        for batch in batches:
            seen: Counter = Counter()
            for _, _, some in _strings(batch, 0):
                for text in some:
                    seen.update(pre_tokens(text))
                if len(seen) > HEAD:  # a bounded table; Spark adds the parts up
                    yield counted(seen)
                    seen = Counter()
            yield counted(seen)

    def counted(seen):
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                          names=["pre_token", "n"])

    def pieces(batches):
        counter = PieceCounter(shared.value)
        for batch in batches:
            for a, b, some in _strings(batch, 0):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                     pa.array(counter.count(some), pa.int64())], names=["pre_token", "n", "pieces"])

    parts = texts(docs).select("text").mapInArrow(gather, "pre_token string, n long")
    return parts.groupBy("pre_token").agg(F.sum("n").alias("n")).mapInArrow(pieces, "pre_token string, n long, pieces long")


def frequent(vocab: DataFrame, head: int) -> dict[str, int]:
    """Pieces of the pre-tokens above the smallest frequency that at most ``head`` reach."""
    powers = vocab.groupBy(F.floor(F.log2("n") * 4).alias("p")).agg(F.count("*").alias("c")).orderBy(F.desc("p")).collect()
    total, least = 0, None
    for row in powers:  # one row for each quarter of a power of two
        total += row["c"]
        if total > head:
            break
        least = row["p"]
    if least is None:
        return {}
    rows = vocab.where(F.floor(F.log2("n") * 4) >= least).select("pre_token", "pieces").toArrow()
    return dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()))


def token_counts(docs: DataFrame, model_path: str, head: int = HEAD) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row."""
    with open(model_path, "rb") as f:
        model = f.read()
    vocab = stage(vocabulary(docs, model), "pre-tokens")
    shared = docs.sparkSession.sparkContext.broadcast(frequent(vocab, head))

    def split(batches):
        known = shared.value
        for batch in batches:
            for a, b, some in _strings(batch, 1):
                rows, tokens, times, here = [], [], [], []
                for i, text in enumerate(some, a):
                    seen = Counter(pre_tokens(text))
                    common = 0
                    for token, n in seen.items():
                        pieces = known.get(token)
                        if pieces is None:
                            rows.append(i)
                            tokens.append(token)
                            times.append(n)
                        else:
                            common += n * pieces
                    here.append(common)
                own = range(a, b)
                at = pa.array([*own, *rows])
                empty = [None] * len(here)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(2).take(at),
                     pa.array([len(x.encode("utf-8", "surrogatepass")) for x in some] + [None] * len(rows), pa.int64()),
                     pa.array(here + [None] * len(rows), pa.int64()), pa.array(empty + tokens, pa.string()),
                     pa.array(empty + times, pa.int64())],
                    names=["doc_id", "row", "n_bytes", "common", "pre_token", "n"])

    # rows are told apart by their place in the input, as ids may be null or repeated
    placed = texts(docs).withColumn("row", F.monotonically_increasing_id())
    parts = stage(placed.mapInArrow(split, "doc_id long, row long, n_bytes long, common long, pre_token string, n long"), "token-parts")
    rare = parts.where("pre_token is not null").join(vocab.select("pre_token", "pieces"), "pre_token").select(
        "row", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_bytes"),
        (F.col("n") * F.col("pieces")).alias("tokens"))
    own = parts.where("pre_token is null").select("row", "doc_id", "n_bytes", F.col("common").alias("tokens"))
    return own.unionByName(rare).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("tokens").alias("n_tokens")).drop("row")
