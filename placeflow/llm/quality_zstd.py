"""Quality score from two zstandard dictionaries.

One dictionary is trained on labelled good texts, one on bad ones. A text is cut into blocks
of ``BLOCK`` bytes, all of them compressed with either dictionary. With G and B the bytes
needed in total and n the bytes of the text, (B - G + PRIOR * m) / (n + PRIOR) is the
normalised difference: large when the text looks like the good ones. m is the mean of
(B - G) / n, so a text of a few bytes, which proves little, stays near the middle. Blocks
keep a long text from becoming its own dictionary. An increasing
step function (pool adjacent violators, on labelled rows that no dictionary saw) turns the
difference into the share of good texts, which is the score.

Dictionaries and calibration use a bounded sample of labelled rows (``sample`` texts, the
first ``SAMPLE_BYTES`` bytes of each class for its dictionary) in one task each; the model is
two dictionaries of ``DICTIONARY`` bytes and at most ``sample`` steps, and is broadcast.

Defined results: null text counts as empty and, like every empty text, has difference m;
without labels of both classes every score is the share of good rows (0.5 without labels);
a null doc_id is scored and never held out; repeated rows each return a row; extra columns
are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow.llm.common import in_chunks, stage, texts
from placeflow.llm.labelled import held_out, training_rows

BLOCK = 2048
PRIOR = 64  # bytes
DICTIONARY = 112 * 1024
LEVEL = 3
SAMPLE = 12_288
SAMPLE_BYTES = 12 << 20
CHUNK = 1 << 20


def blocks(raw: bytes) -> list[bytes]:
    return [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]


class Model:
    def __init__(self, good: bytes, bad: bytes, edges: list[float], shares: list[float], mean: float = 0.0):
        self.good, self.bad, self.edges, self.shares, self.mean = good, bad, edges, shares, mean

    def compressors(self) -> list[zstd.ZstdCompressor]:
        made = []
        for raw in (self.good, self.bad):
            d = zstd.ZstdCompressionDict(raw) if raw else None
            if d:
                d.precompute_compress(level=LEVEL)
            made.append(zstd.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False))
        return made

    def difference(self, text: str, pair: list[zstd.ZstdCompressor]) -> float:
        raw = text.encode("utf-8", "surrogatepass")
        good, bad = (sum(len(c.compress(x)) for x in blocks(raw)) for c in pair)
        return (bad - good + PRIOR * self.mean) / (len(raw) + PRIOR)

    def scores(self, differences: np.ndarray) -> np.ndarray:
        return np.interp(differences, self.edges, self.shares)


def calibrate(difference: np.ndarray, label: np.ndarray) -> tuple[list[float], list[float]]:
    """Points (difference, share of label 1) of the best increasing step function."""
    order = np.argsort(difference, kind="stable")
    pools: list[list[float]] = []  # sum of labels, rows, sum of differences
    for d, y in zip(difference[order].tolist(), label[order].tolist()):
        pools.append([y, 1, d])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return [p[2] / p[1] for p in pools], [(p[0] + 0.5) / (p[1] + 1) for p in pools]


def fit(rows: list[tuple[str, int]]) -> Model:
    """Fit on (text, label) rows: every third one calibrates, the others train dictionaries."""
    label = np.array([y for _, y in rows], float)
    flat = Model(b"", b"", [0.0], [float(label.mean()) if len(label) else 0.5])
    if not 0 < label.mean() < 1 if len(label) else True:
        return flat
    dictionaries = []
    for kind in (1, 0):
        some, size = [], 0
        for i, (text, y) in enumerate(rows):
            if i % 3 and y == kind and size < SAMPLE_BYTES:
                raw = text.encode("utf-8", "surrogatepass")
                some += blocks(raw)
                size += len(raw)
        try:
            dictionaries.append(zstd.train_dictionary(min(DICTIONARY, max(256, size // 8)), some).as_bytes())
        except zstd.ZstdError:  # too little text for the trainer: the text itself serves
            dictionaries.append(b"".join(some)[-DICTIONARY:])
    model = Model(*dictionaries, [0.0], [0.5])
    pair = model.compressors()
    calibrating = rows[::3]
    model.mean = float(np.mean([model.difference(t, pair) * (1 + PRIOR / max(1, len(t.encode("utf-8", "surrogatepass"))))
                                for t, _ in calibrating]))
    model.edges, model.shares = calibrate(np.array([model.difference(t, pair) for t, _ in calibrating]),
                                          np.array([y for _, y in calibrating], float))
    return model


def train(docs: DataFrame, labels: DataFrame, modulus: int, remainder: int, sample: int = SAMPLE) -> Model:
    rows = stage(training_rows(docs, labels, "quality", modulus, remainder, sample), "quality-rows")

    def fitted(batches):
        found = [x for batch in batches for x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(found))], pa.binary())], names=["model"])

    # a bounded sample; in the order of a hash, so that the same rows give the same model
    one = rows.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").select("text", "label")
    got = one.mapInArrow(fitted, "model binary").first()
    return pickle.loads(got["model"]) if got else fit([])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, difference and score (0 to 1) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        pair = model.compressors()
        for batch in batches:
            sizes = [len(s) for s in batch.column(1).cast(pa.binary()).to_pylist()] if len(batch) else []
            for a, b in in_chunks(sizes, CHUNK):
                d = np.array([model.difference(t, pair) for t in batch.column(1).slice(a, b - a).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(d, pa.float64()), pa.array(model.scores(d), pa.float64())],
                    names=["doc_id", "difference", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, difference double, score double")


def quality(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, sample: int = SAMPLE,
            threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``threshold`` on), difference."""
    return score(docs, train(docs, labels, modulus, remainder, sample)).select(
        "doc_id", held_out(modulus, remainder).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "difference")
