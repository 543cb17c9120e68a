"""Held-out accuracy and odd rows of the quality and toxicity scores."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeflow.llm import quality_zstd, toxicity
from placeflow.llm.labelled import training_rows


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    import os
    big = os.path.join(os.path.dirname(sf_dir), "sf0.1")
    return spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")


def held_out_accuracy(scored, labels, label):
    rows = scored.where("held_out").join(labels, "doc_id").select(F.col(label).alias("y"), "predicted").collect()
    ones = [r["predicted"] for r in rows if r["y"]]
    zeros = [1 - r["predicted"] for r in rows if not r["y"]]
    return np.mean(ones), np.mean(zeros), len(rows)


def test_quality_on_rows_it_never_saw(tables):
    docs, labels = tables
    good, bad, n = held_out_accuracy(quality_zstd.quality(docs, labels), labels, "quality")
    assert n > 500 and good > 0.96 and bad > 0.8


def test_toxicity_on_rows_it_never_saw(tables):
    docs, labels = tables
    toxic, clean, n = held_out_accuracy(toxicity.toxicity(docs, labels), labels, "toxic")
    assert n > 500 and toxic > 0.85 and clean > 0.99


@pytest.mark.parametrize("score", [quality_zstd.quality, toxicity.toxicity])
def test_odd_rows(score, odd_docs, odd_rows, no_docs, spark, tables):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in (4, 4, 5, 6, 7, 8, 9)] + [(None, 1, 1), (10, None, None)],
                                   "doc_id long, quality int, toxic int")
    rows = score(odd_docs, labels).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (1, 2)}
    assert len(empty) == 1
    none = labels.where("doc_id < 0")
    assert {r["score"] for r in score(odd_docs, none).collect()} == {0.5}
    assert score(no_docs, labels).count() == 0
    one_class = labels.where("toxic = 1")
    assert len({r["score"] for r in score(odd_docs, one_class).collect()}) == 1


def test_training_leaves_the_held_out_fold_alone(tables):
    docs, labels = tables
    rows = training_rows(docs, labels, "toxic", 5, 0, 500).select("doc_id").collect()
    assert 300 < len(rows) < 700
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in rows)


def test_pairs_are_learnt():
    """Neither term alone says anything; both together do."""
    rng = np.random.default_rng(1)
    rows, label = [], []
    for _ in range(3000):
        a, b = rng.random(2) < 0.4
        terms = ["insult"] * int(a) + ["group"] * int(b) + [f"n{rng.integers(50)}" for _ in range(5)]
        rows.append(np.array(sorted({toxicity._hash(t) for t in terms})))
        label.append(int(a and b))
    machine = toxicity.fit(rows, np.array(label))

    def margin(*terms):
        return machine.margin([machine.rows[h] for h in map(toxicity._hash, terms) if h in machine.rows])

    assert margin("insult", "group") > 0 > max(margin("insult"), margin("group"), machine.w0)


@pytest.mark.parametrize("together", [True, False])
def test_words_harmless_alone(spark, together):
    """Neither word tells the classes apart: each stands in half of either. Toxic is both or neither,
    or just one of them; the machine learns it from texts with a vocabulary of their own."""
    rng = np.random.default_rng(4)
    docs, labels = [], []
    for i in range(1500):
        words = [f"w{rng.integers(3000)}" for _ in range(60)]
        a, b = rng.random(2) < 0.5
        docs.append((i, " ".join(words + ["alpha"] * int(a) + ["omega"] * int(b))))
        labels.append((i, int((a == b) == together)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    toxic, clean, n = held_out_accuracy(toxicity.toxicity(docs, labels), labels, "toxic")
    assert n > 200 and toxic > 0.97 and clean > 0.97


def test_margin_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(2)
    keys = np.arange(40)
    machine = toxicity.Machine(keys, 0.3, rng.normal(size=40), rng.normal(size=(40, toxicity.FACTORS)))
    for n in (0, 1, 2, 17, 40):
        rows = sorted(rng.permutation(40)[:n].tolist())
        plain = 0.3 + sum(machine.w[i] for i in rows)
        for x, i in enumerate(rows):
            for j in rows[:x]:
                plain += sum(machine.v[i][f] * machine.v[j][f] for f in range(toxicity.FACTORS))
        assert machine.margin(rows) == pytest.approx(plain)


def test_copies_of_a_text_count_once():
    rng = np.random.default_rng(6)
    rows = [np.array(sorted({toxicity._hash(f"n{rng.integers(200)}") for _ in range(8)} | ({toxicity._hash("bad")} if i % 5 == 0 else set())))
            for i in range(600)]
    label = np.array([int(i % 5 == 0) for i in range(600)])
    one, many = toxicity.fit(rows, label), toxicity.fit(rows + rows[:1] * 2000, np.append(label, label[:1].repeat(2000)))
    assert one.rows == many.rows and np.allclose(sorted(one.w), sorted(many.w), atol=0.5)


def test_calibration_is_increasing():
    d = np.array([0.1, 0.2, 0.3, 0.4, 0.5, 0.6])
    edges, shares = quality_zstd.calibrate(d, np.array([0, 1, 0, 0, 1, 1.0]))
    assert edges == sorted(edges) and shares == sorted(shares)


def test_fit_holds_few_copies_of_the_terms(monkeypatch):
    """The fit runs beside a grown JVM: it must not hold many arrays as long as all terms."""
    import tracemalloc
    for name, value in (("LASSO_STEPS", 3), ("EPOCHS", 1), ("PAIR_TERMS", 16)):
        monkeypatch.setattr(toxicity, name, value)
    rng = np.random.default_rng(8)
    known = rng.integers(1 << 60, size=20_000)
    rows = [np.sort(known[rng.permutation(20_000)[:1500]]) for _ in range(2000)]
    label = (rng.random(2000) < 0.3).astype(int)
    tracemalloc.start()
    try:
        toxicity.fit(rows, label)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 3 * sum(r.nbytes for r in rows)


def test_rows_pass_the_score_as_they_are(spark, odd_docs):
    """The text is read out of the row, wherever it stands and whatever its name's case."""
    machine = toxicity.fit([], np.empty(0))
    docs = odd_docs.withColumnRenamed("text", "Text").select("words", "Text", "doc_id")
    got = toxicity.score_rows(docs, machine).select("row.*", "score").collect()
    assert sorted(map(repr, (tuple(r)[:-1] for r in got))) == sorted(map(repr, map(tuple, docs.collect())))
    assert {r["score"] for r in got} == {0.5}
