"""Toxicity score of a factorization machine over hashed terms.

Terms of a text: its distinct words (letters and digits, lower-cased) and the first
``PREFIX`` letters of each, hashed to 62 bits. The machine has a weight and a short vector
per term; a text scores w0 + sum of weights + sum over term pairs of the product of their
vectors, so that pairs which are toxic only together are learnt as well as single terms.
It is fitted (log loss) on a bounded sample of labelled rows in one task. Every term of
``MIN_DOCS`` texts or more can enter; three steps settle which ones do:

* weights of all of them together with an L1 penalty of ``LASSO`` times the noise of a term
  that says nothing, so terms without a say get zero;
* what these weights leave unexplained is looked at pair by pair, for the ``PAIR_TERMS`` terms
  of most toxic texts. Pairs that stand out by ``MIN_PAIR_Z`` standard errors start with vectors
  that reproduce them (leading eigenvectors of the matrix of such pairs), whether or not
  either term means anything alone;
* weights and vectors of the terms of both kinds are fitted together (Adam).

Texts with equal terms and label count once. The model that is broadcast has at most
``MAX_TERMS`` terms.

Defined results: null text counts as empty and gets the score of no terms; without labels of
both classes every score is the share of toxic rows (0.5 without any labels); a null doc_id
is scored and never held out; repeated rows each return a row; extra columns are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from placeflow.llm.common import given_back, in_chunks, stage, texts
from placeflow.llm.labelled import held_out, training_rows

WORD = re.compile(r"[^\W_]+")
PREFIX = 4
MIN_DOCS = 6
LASSO, LASSO_STEPS = 2.5, 150
PAIR_TERMS, MIN_PAIR_Z = 2048, 7.0
PAIR_START = 0.5  # largest component of a vector that a pair starts with
MAX_TERMS = 1 << 15
SAMPLE = 16_384
FACTORS = 8
EPOCHS = 40
CACHE = 300_000
CHUNK = 1 << 20
TEXTS = 256  # texts whose terms are Python objects at once
SPAN = 1 << 17  # terms gone through at once in the fit


def _hash(term: str) -> int:
    return xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass"), 11) >> 2


def word_terms(word: str) -> tuple[int, ...]:
    return (_hash(word), _hash(word[:PREFIX] + "*")) if len(word) > PREFIX else (_hash(word),)


def terms(text: str) -> set[int]:
    return {t for w in set(WORD.findall(text.lower())) for t in word_terms(w)}


class Machine:
    """Weights w, vectors v of the terms in ``rows`` (hash to row) and the constant w0."""

    def __init__(self, keys: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.rows = dict(zip(keys.tolist(), range(len(keys))))
        self.w0, self.w, self.v = w0, w, v

    def margin(self, rows: list[int]) -> float:
        v = self.v[rows]
        s = v.sum(axis=0)
        return float(self.w0 + self.w[rows].sum() + 0.5 * ((s * s).sum() - (v * v).sum()))


def probability(margin):
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def spans(n: int, size: int = SPAN) -> Iterator[slice]:
    return (slice(i, i + size) for i in range(0, n, size))


def sums_by(at: np.ndarray, values: Callable[[slice], np.ndarray], k: int) -> np.ndarray:
    """Sums of ``values`` by ``at``, in the same order as one ``bincount`` but a span at a time,
    so that no second array as long as the terms of all texts is held."""
    total = np.zeros(k)
    for part in spans(len(at)):
        np.add.at(total, at[part].astype(np.intp), values(part))
    return total


def sparse_weights(owner: np.ndarray, code: np.ndarray, label: np.ndarray, k: int) -> tuple[np.ndarray, float]:
    """Weights of ``k`` terms and the constant of a logistic regression with an L1 penalty
    (accelerated proximal gradient). A term counts by 1 / sqrt(its texts), so that the noise in
    its gradient, and with it the penalty, is the same for rare and frequent ones."""
    n = len(label)
    scale = 1 / np.sqrt(np.bincount(code, minlength=k))

    def by_text(v):
        return sums_by(owner, lambda part: scale[code[part]] * v[code[part]], n)

    def by_term(u):
        return sums_by(code, lambda part: scale[code[part]] * u[owner[part]], k)

    v = np.ones(k)
    for _ in range(15):  # largest eigenvalue, for the step
        v = by_term(by_text(v))
        size = np.linalg.norm(v)
        v /= size
    step = 1 / (0.275 * size)
    share = label.mean()
    bound = LASSO * np.sqrt(share * (1 - share)) * step
    w0, w, ahead, t = np.log(share / (1 - share)), np.zeros(k), np.zeros(k), 1.0
    for _ in range(LASSO_STEPS):
        margin = by_text(ahead)
        for _ in range(2):
            p = probability(margin + w0)
            w0 -= (p - label).sum() / max(1e-9, (p * (1 - p)).sum())
        moved = ahead - step * by_term(probability(margin + w0) - label)
        new = np.sign(moved) * np.maximum(np.abs(moved) - bound, 0)
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / later * (new - w), new, later
    return w * scale, float(w0)


def pair_vectors(owner: np.ndarray, code: np.ndarray, label: np.ndarray, expected: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Terms of the pairs that the ``expected`` probabilities fail to explain, and vectors whose
    products follow those pairs."""
    n = len(label)
    toxic = sums_by(code, lambda part: label[owner[part]], k)
    top = np.sort(np.argsort(-toxic, kind="stable")[:PAIR_TERMS])
    at = np.full(k, -1, "i4")
    at[top] = np.arange(len(top))
    inside = at[code] >= 0
    owner, code = owner[inside], at[code[inside]]
    error, spread = (label - expected).astype("f4"), (expected * (1 - expected)).astype("f4")
    summed, variance = np.zeros((2, len(top), len(top)), "f4")
    for a in range(0, n, 1024):
        lo, hi = np.searchsorted(owner, [a, a + 1024])
        block = np.zeros((min(1024, n - a), len(top)), "f4")
        block[owner[lo:hi] - a, code[lo:hi]] = 1
        summed += block.T @ (block * error[a:a + 1024, None])
        variance += block.T @ (block * spread[a:a + 1024, None])
    variance += 0.25  # few expected texts tell little
    np.sqrt(variance, out=variance)
    z = np.divide(summed, variance, out=summed)
    del variance
    np.fill_diagonal(z, 0)
    z[(z > -MIN_PAIR_Z) & (z < MIN_PAIR_Z)] = 0
    hit = np.flatnonzero(z.any(axis=1))
    if not len(hit):
        return top[hit], np.empty((0, FACTORS))
    value, vector = np.linalg.eigh(z[np.ix_(hit, hit)].astype("f8"))
    value, vector = value[::-1][:FACTORS], vector[:, ::-1][:, :FACTORS]
    found = np.zeros((len(hit), FACTORS))
    found[:, :len(value)] = vector * np.sqrt(np.maximum(value, 0))
    return top[hit], PAIR_START * found / np.abs(found).max()


def fit(rows: list[np.ndarray], label: np.ndarray, seed: int = 5) -> Machine:
    """Fit on the terms of each text (distinct ones) and 0/1 labels."""
    once = list({(xxhash.xxh3_128_digest(r.tobytes()), y): i for i, (r, y) in enumerate(zip(rows, label.tolist()))}.values())
    sizes, label = np.array([len(rows[i]) for i in once], np.int64), label[once].astype("f8") if once else np.empty(0)
    n, toxic = len(once), int(label.sum())
    share = (toxic + 0.5) / (n + 1)
    empty = Machine(np.empty(0, np.int64), float(np.log(share / (1 - share))), np.empty(0), np.empty((0, FACTORS)))
    if not toxic or toxic == n:
        return empty

    # the terms of enough texts: equal ones stand together once all are sorted
    every = np.concatenate([rows[i] for i in once])
    every.sort()
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.empty(0, np.int64)
    keys = every[first[np.diff(np.append(first, len(every))) >= MIN_DOCS]]
    del every, first
    if not len(keys):
        return empty
    k = len(keys)
    owner, code = np.empty(sizes.sum(), "i4"), np.empty(sizes.sum(), "i4")
    end = 0
    for i, r in enumerate(once):
        at = np.minimum(np.searchsorted(keys, rows[r]), k - 1)
        at = at[keys[at] == rows[r]]
        owner[end:end + len(at)], code[end:end + len(at)] = i, at
        end += len(at)
    owner, code = owner[:end], code[:end]

    def narrowed(chosen, owner, code):
        new = np.full(int(code.max(initial=-1)) + 1, -1, "i4")
        new[chosen] = np.arange(len(chosen))
        kept = new[code] >= 0
        return owner[kept], new[code[kept]]

    w, w0 = sparse_weights(owner, code, label, k)
    paired, starts = pair_vectors(owner, code, label, probability(sums_by(owner, lambda part: w[code[part]], n) + w0), k)
    strength = np.abs(w)
    strength[paired] += strength.max() + 1
    chosen = np.sort(np.argsort(-strength, kind="stable")[:min(MAX_TERMS, np.count_nonzero(strength))])
    if not len(chosen):
        return empty
    owner, code = narrowed(chosen, owner, code)
    start = np.searchsorted(owner, np.arange(n + 1))
    rng = np.random.default_rng(seed)
    k = len(chosen)
    p = {"w0": np.array([w0]), "w": w[chosen], "v": rng.normal(0, 0.01, (k, FACTORS))}
    p["v"][np.searchsorted(chosen, paired)] += starts
    m, s = ({x: np.zeros_like(y) for x, y in p.items()} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(n), max(1, n // 256)):
            step += 1
            sizes = start[batch + 1] - start[batch]
            at = np.repeat(start[batch] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
            term, row = code[at], np.repeat(np.arange(len(batch)), sizes)
            v = p["v"][term]
            total = np.zeros((len(batch), FACTORS))
            np.add.at(total, row, v)
            squares = np.bincount(row, (v * v).sum(axis=1), len(batch))
            margin = p["w0"][0] + np.bincount(row, p["w"][term], len(batch)) + 0.5 * ((total * total).sum(axis=1) - squares)
            error = (probability(margin) - label[batch]) / len(batch)
            grad = {"w0": np.array([error.sum()]), "w": np.bincount(term, error[row], k) + 1e-5 * p["w"], "v": 1e-2 * p["v"]}
            np.add.at(grad["v"], term, error[row][:, None] * (total[row] - v))
            for x in p:
                m[x] = 0.9 * m[x] + 0.1 * grad[x]
                s[x] = 0.99 * s[x] + 0.01 * grad[x] ** 2
                p[x] = p[x] - 0.05 * (m[x] / (1 - 0.9 ** step)) / (np.sqrt(s[x] / (1 - 0.99 ** step)) + 1e-8)
    return Machine(keys[chosen], float(p["w0"][0]), p["w"], p["v"])


def train(docs: DataFrame, labels: DataFrame, modulus: int, remainder: int, sample: int = SAMPLE) -> Machine:
    """Fit on about ``sample`` labelled rows outside the held-out fold."""
    rows = training_rows(docs, labels, "toxic", modulus, remainder, sample)

    def hashed(batches):
        for batch in batches:
            for a, b in in_chunks([1] * len(batch), TEXTS):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).slice(a, b - a),
                     pa.array([sorted(terms(t)) for t in batch.column(1).slice(a, b - a).to_pylist()], pa.list_(pa.int64()))],
                    names=["label", "terms"])

    def fitted(batches):
        found, label = [], []
        for batch in batches:
            label += batch.column(0).to_pylist()
            flat, ends = batch.column(1).flatten().to_numpy(), batch.column(1).value_lengths().to_numpy().cumsum()
            found += np.split(flat, ends[:-1])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(found, np.array(label)))], pa.binary())], names=["machine"])

    made = stage(rows.mapInArrow(given_back(hashed), "label int, terms array<long>"), "toxicity-terms")
    # the sample is bounded; sorted so that the same rows give the same machine
    one = made.select("label", "terms").repartition(1).sortWithinPartitions("terms", "label")
    got = one.mapInArrow(given_back(fitted), "machine binary").first()
    return pickle.loads(got["machine"]) if got else fit([], np.empty(0))


def score_rows(docs: DataFrame, machine: Machine) -> DataFrame:
    """The rows of ``docs`` as they are (column ``row``) with the score (0 to 1) of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    place = [c.lower() for c in docs.columns].index("text")  # a batch holds each text once, in its row

    def run(batches):
        machine, cache = shared.value, {}
        known_rows = machine.rows.get
        for batch in batches:
            texts_ = pc.struct_field(batch.column(0), [place]).cast(pa.string()).fill_null("")
            for a, b in in_chunks(pc.binary_length(texts_).to_pylist(), CHUNK):
                if len(cache) > CACHE:
                    cache = {}
                made = []
                for text in texts_.slice(a, b - a).to_pylist():
                    here: set[int] = set()
                    for word in set(WORD.findall(text.lower())):
                        known = cache.get(word)
                        if known is None:
                            known = cache[word] = tuple(r for r in map(known_rows, word_terms(word)) if r is not None)
                        if known:
                            here.update(known)
                    made.append(machine.margin(sorted(here)) if here else machine.w0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(probability(np.array(made)), pa.float64())],
                    names=["row", "score"])

    return rows.mapInArrow(given_back(run), StructType([rows.schema["row"], StructField("score", DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, sample: int = SAMPLE,
             threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``threshold`` on)."""
    rows = score_rows(texts(docs), train(docs, labels, modulus, remainder, sample)).select("row.doc_id", "score")
    return rows.select(
        "doc_id", held_out(modulus, remainder).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
