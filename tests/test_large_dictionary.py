"""Tags from dictionaries too large to be compiled into the plan, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from placeflow.functions.fuzzy import partial_ratio
from placeflow.operators import tagging

CJK = [chr(0x4E00 + i) for i in range(1500)]


def _words(rng, n):
    out = set()
    while len(out) < n:
        size = rng.choice([1, 2, 3, 4, 4, 5, 6, 8])
        w = "".join(rng.choice(CJK[:120] if rng.random() < .6 else CJK) for _ in range(size))
        out.add(w + rng.choice(["", "", " 店", " shop", " a", "aa"]))
    return sorted(out)


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(8)
    texts = _words(rng, 5000)
    names = [rng.choice(texts) for _ in range(12)]
    names += ["".join(c for c in rng.choice(texts) if rng.random() > .15) + rng.choice(["", "x", "館"]) for _ in range(12)]
    names += _words(rng, 10) + ["a", "\n", "店" * 30, " shop shop", "".join(CJK[:60])]
    names = sorted({n for n in names if n})
    scores = {(n, t): partial_ratio(n, t) for n in names for t in texts}
    syn = spark.createDataFrame([(f"t{i}", t, t.split()) for i, t in enumerate(texts)], "tag string, alias_text string, aliases array<string>")
    return names, texts, scores, syn.repartition(4)


@pytest.mark.parametrize("threshold, most", [(50, 0.6), (80, 0.1), (95, 0.06)])
def test_similar_pairs_of_a_large_dictionary(spark, data, threshold, most):
    names, texts, scores, syn = data
    df = spark.createDataFrame([(n,) for n in names], "lname string")
    got = {(r.lname, r.tag) for r in tagging.fuzzy_tags(df, syn, float(threshold)).collect()}
    assert got == {(n, f"t{i}") for n in names for i, t in enumerate(texts) if scores[n, t] >= threshold}
    met = tagging.similar_candidates(df, syn.select("alias_text"), float(threshold)).count()
    assert len(got) <= met < most * len(names) * len(texts)


@pytest.mark.parametrize("at_once", [100_000, 900])
def test_aliases_in_whole_texts(spark, sf_dir, monkeypatch, at_once):
    monkeypatch.setattr(tagging, "ALIASES_AT_ONCE", at_once)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60)
    texts = [r.text.lower() for r in docs.collect()]
    rng = random.Random(1)
    aliases = sorted({t[i:i + rng.randint(3, 25)] for t in texts for i in (rng.randrange(max(1, len(t) - 3)) for _ in range(200))})
    aliases = ([a for a in aliases if a] + [f"nowhere {i}" for i in range(10_000)])[:10_000]
    syn = spark.createDataFrame([(f"g{i % 700}", a, [a]) for i, a in enumerate(aliases)], "tag string, alias_text string, aliases array<string>")
    names = spark.createDataFrame([(t,) for t in sorted(set(texts))], "lname string")
    got = {(r.lname, r.tag) for r in tagging.exact_tags_by_join(names, syn).collect()}
    assert got == {(t, f"g{i % 700}") for t in set(texts) for i, a in enumerate(aliases) if a in t}


def test_odd_dictionaries(spark):
    names = spark.createDataFrame([("ab",), ("b\x00c",)], "lname string")
    syn = spark.createDataFrame([("t", "", [""]), ("u", "b", ["b", None, "b"]), (None, "ab", ["ab"])], "tag string, alias_text string, aliases array<string>")
    assert {tuple(r) for r in tagging.exact_tags_by_join(names, syn).collect()} == {("ab", "u"), ("b\x00c", "u")}
    assert tagging.exact_tags_by_join(names, syn.where(F.lit(False))).count() == 0
    assert tagging.fuzzy_tags(names, syn.where(F.lit(False))).count() == 0


@pytest.mark.parametrize("at_once", [100_000, 150])
def test_texts_stay_where_they_are(spark, monkeypatch, at_once):
    monkeypatch.setattr(tagging, "ALIASES_AT_ONCE", at_once)
    aliases = [f"w{i:03d}x" for i in range(400)]
    syn = spark.createDataFrame([(f"t{i % 90:02d}", a, [a, None, ""]) for i, a in enumerate(aliases)], "tag string, alias_text string, aliases array<string>")
    texts = [None, "", "none", *([" ".join(aliases[:200]).upper()] * 3), *(f"{a} {b}" for a, b in zip(aliases, aliases[7:]))]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    tagged = tagging.synonym_tags(df, syn, name="text", out="tags", fuzzy=False)
    got = {r.id: r.tags for r in tagged.collect()}
    assert got == {i: ",".join(sorted({f"t{k % 90:02d}" for k, a in enumerate(aliases) if a in (t or "").lower()})) for i, t in enumerate(texts)}
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan  # no text is repeated for each of its tags
    if at_once > len(aliases):
        assert "Join" not in plan and "Aggregate" not in plan
