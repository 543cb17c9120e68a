"""Benchmark decontamination against every alignment."""

import itertools
import random

import numpy as np
import pytest

from placeflow.llm import decontam
from tests.llm.conftest import SCHEMA, sentence


def plain(text, items, overlap=13, similarity=0.8, min_tokens=5):
    """Ids of all items some stretch of which the text has, by sliding every item along."""
    words, found = decontam.tokens(text or ""), set()
    span = max(m[-1] for m in decontam.MASKS) + 1
    for item, content in items:
        t = decontam.tokens(content or "")
        if len(t) < min_tokens:
            continue
        size = min(overlap, len(t))
        need = similarity * size if len(t) >= span else size
        for d in range(-len(t) + 1, len(words)):
            equal = [0 <= d + i < len(words) and words[d + i] == t[i] for i in range(len(t))]
            if any(sum(equal[i:i + size]) >= need for i in range(len(t) - size + 1)):
                found.add(item)
                break
    return found


def test_masks_meet_every_stretch_with_two_substitutions():
    for wrong in itertools.combinations(range(13), 2):
        assert any(not set(wrong) & {o + a for a in m} for m in decontam.MASKS for o in range(13 - m[-1]))


@pytest.mark.parametrize("n", [9, 10, 11, 12])
def test_masks_meet_every_short_item(n):
    for wrong in itertools.combinations(range(n), int(n * 0.2 + 1e-9)):
        item = list(range(1, n + 1))
        index = decontam.Index([(1, " ".join(map(str, item)))], 13, 0.8, 5)
        ids = np.array([0, 0, *(0 if i in wrong else x for i, x in enumerate(item)), 0])
        assert index.match(ids) == {0: n - len(wrong)}, wrong


def test_short_items_equal_every_alignment(spark):
    rng = random.Random(19)
    items = [(i, sentence(rng, 9 + i % 4, 500)) for i in range(40)]
    rows = []
    for d in range(300):
        words, t = sentence(rng, rng.randint(0, 40), 500).split(), rng.choice(items)[1].split()
        for at in rng.sample(range(len(t)), rng.randint(0, 3)):
            t[at] = "other"
        at = rng.randint(0, len(words))
        rows.append((d, " ".join(words[:at] + t + words[at:]), "en", "s", 0))
    got = decontam.contamination(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert [r["doc_id"] for r in got if set(r["items"]) != plain(rows[r["doc_id"]][1], items)] == []


def cases():
    rng = random.Random(11)
    items = [(i, sentence(rng, rng.choice([3, 6, 8, 20, 35]), 500)) for i in range(25)]
    items += [(100, items[3][1]), (101, "of the and of the and of the and of the and in")]
    rows = []
    for d in range(150):
        words = sentence(rng, rng.randint(0, 60), 500).split()
        if d % 2:
            t = rng.choice(items)[1].split()
            a = rng.randrange(max(1, len(t) - 12))
            t = t[a:a + rng.randint(8, 20)]
            for _ in range(rng.randint(0, 4)):
                t[rng.randrange(len(t))] = "other"
            at = rng.randint(0, len(words))
            words[at:at] = t
        text = " ".join(words)
        rows.append((d, text.upper().replace(" ", ", ") if d % 3 == 0 else text, "en", "s", 0))
    return rows, items


@pytest.mark.parametrize("block_chars", [4_000_000, 300])
def test_equals_every_alignment(spark, block_chars):
    rows, items = cases()
    got = decontam.contamination(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string"),
                                 block_chars=block_chars).collect()
    missed = [r["doc_id"] for r in got if set(r["items"]) != plain(rows[r["doc_id"]][1], items)]
    assert not missed and len(got) == len(rows)
    assert all(r["contaminated"] == bool(r["items"]) and r["n_items"] == len(r["items"]) for r in got)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    bench = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, odd_rows[3][1], "x"), (3, odd_rows[3][1], "x"),
                                   (4, "the same line again", "x")], "item_id long, text string, row string")
    rows = decontam.contamination(odd_docs, bench).collect()
    assert len(rows) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[5]["items"] == [3] and by_id[5]["n_items"] == 2 and not by_id[8]["contaminated"] and not by_id[1]["contaminated"]
    assert decontam.contamination(no_docs, bench).count() == 0
    assert not any(r["contaminated"] for r in decontam.contamination(odd_docs, bench.limit(0)).collect())
    kept = decontam.contaminated_rows(odd_docs, bench).select("row.*")
    assert kept.columns == odd_docs.columns
