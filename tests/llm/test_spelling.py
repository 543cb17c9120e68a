"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from placeflow.llm import spelling as S


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, factor=10, shortest=7, every=31, least=2):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            if doc_id is not None and (h := zlib.crc32(f"{doc_id}:{run}".encode())) % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= shortest and n >= least}
    form, out = {}, []
    for w, n in words.items():
        near = [x for x in words if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = (best if best and words[best] >= factor * n else None, len(near))
    for w, n in words.items():
        root = w
        while form[root][0]:
            root = form[root][0]
        f = form[w][0]
        out.append((w, f, root, n, form[w][1], words[f] if f else None))
    return sorted(out)


def typos(seed, n):
    rng = random.Random(seed)
    bases = ["".join(rng.choice("abeéÿ") for _ in range(rng.randint(6, 10))) for _ in range(25)] + ["aaaaaaaa", "aaaaaaab"]
    words = []
    for _ in range(n):
        w = rng.choice(bases[:6] if rng.random() < .7 else bases)
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            i, c = rng.randrange(len(w)), rng.choice("abeéÿ")
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]])
        words.append(w.upper() if rng.random() < .1 else w)
    return [(i, rng.choice([" ", "-", "1"]).join(words[i * 20:(i + 1) * 20])) for i in range(n // 20)]


@pytest.mark.parametrize("size", [200_000, 30])
def test_equals_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(S, "RANGE", size)  # many ranges: nodes at their borders
    rows = typos(size, 3000) + [(None, "nullable nullable nulable"), (9, None), (10, ""), (11, "x" * 5000 + " " + "x" * 5000)]
    rows += [(50 + i, "frequent" * 1) for i in range(120)] + [(i, "frequents frequentz") for i in range(300, 306)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, S.variants(docs).collect()), key=lambda r: r[0])
    want = brute(rows)
    assert got == want
    assert any(r[1] for r in want)


def test_chains_end_at_their_root(spark):
    """Each word ten times as often as the one before: roots are several steps away."""
    chain = ["aaaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb"]
    rows = [(None, " ".join([w] * (2 * 10 ** i))) for i, w in enumerate(chain)]
    got = {r["word"]: r["root"] for r in S.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict.fromkeys(chain, chain[-1])


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    got = sorted(map(tuple, S.variants(odd_docs).collect()), key=lambda r: r[0])
    assert got == brute([(r[0], r[1]) for r in odd_rows])
    assert S.variants(no_docs).count() == 0


def test_nodes_number_beginnings():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(300)})
    cut = words[150]
    border = {p: -1 - i for i, p in enumerate([""] + [cut[:i] for i in range(1, len(cut) + 1)])}
    known = {}
    for some, first in ((words[:150], 0), (words[150:], 10_000)):
        for word, path in zip(some, S.number_nodes(some, first, border)):
            for end, node in enumerate(path):
                assert known.setdefault(word[:end], node) == node
    assert len(set(known.values())) == len(known)
