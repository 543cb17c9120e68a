"""Quality rules against a plain version."""

import math
import re
import unicodedata
from collections import Counter, defaultdict

from placeflow.llm import quality_rules as qr

KINDS = {"Ll": "lower", "Lu": "upper", "Nd": "digit"}


def char_class(c):
    if c in "\x20\t\n\x0b\x0c\r":
        return "space"
    kind = unicodedata.category(c)
    if kind in KINDS:
        return KINDS[kind]
    if c in "#*$%&|<>":
        return "symbol"
    return "punct" if kind[0] == "P" else "other"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def base(text):
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(5)}
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed)


def distance(p, q):
    total = sum((a * math.log2(2 * a / (a + b)) if a else 0) + (b * math.log2(2 * b / (a + b)) if b else 0) for a, b in zip(p, q))
    return math.sqrt(max(0, total / 2))


def shares(x):
    return [v / sum(x) for v in x] if sum(x) else [0.0] * len(x)


def plain(rows, min_share=0.001, max_char=0.3, max_word=0.9, min_chars=200, min_words=100, min_reference=10_000):
    names = [*qr.CLASSES, "other"]
    counts, chars = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang in rows:
        for ref in (lang or "", "*"):
            counts[ref].update(words(text or ""))
            chars[ref].update(map(char_class, text or ""))
    common = {}
    for ref, c in counts.items():
        total = sum(c.values())
        if total >= min_reference or ref == "*":
            common[ref] = (sorted(w for w, n in c.items() if n >= total * min_share), c, total)
    out = []
    for doc_id, text, lang in rows:
        text = text or ""
        ref = lang if lang in common else "*"
        b = base(text)
        cd = wd = None
        limit = 1
        if len(text) >= min_chars:
            own = Counter(map(char_class, text))
            cd = distance(shares([own[n] for n in names]), shares([chars[ref][n] for n in names]))
        if b[0] >= min_words:
            own, (some, c, total) = Counter(words(text)), common[ref]
            mine, theirs = [own[w] for w in some], [c[w] for w in some]
            wd = distance(shares([*mine, b[0] - sum(mine)]), shares([*theirs, total - sum(theirs)]))
            limit = max_word * distance([*[0] * len(some), 1], shares([*theirs, total - sum(theirs)]))
        kept = not b[5] and (cd or 0) <= max_char and (wd or 0) <= limit
        out.append((doc_id, *b, kept, cd, wd))
    return out


def same(got, want):
    assert len(got) == len(want)
    key = lambda r: tuple((x is None, x) for x in r[:7])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert a[:8] == b[:8]
        for x, y in zip(a[8:], b[8:]):
            assert (x is None) == (y is None) and (x is None or abs(x - y) < 1e-4)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = plain([(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()])
    same(qr.quality_rules(docs).collect(), want)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    want = plain([(r[0], r[1], r[2]) for r in odd_rows])
    same(qr.quality_rules(odd_docs).collect(), want)
    assert qr.quality_rules(no_docs).count() == 0


def test_clean_documents_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = qr.quality_rules(docs).join(labels, "doc_id").select("quality", "kept", "base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] and not r["base_failed"]]
    bad = [r["kept"] for r in rows if not r["quality"]]
    assert all(good) and sum(bad) < 0.25 * len(bad)


def test_no_python_on_executors(odd_docs):
    plan = qr.quality_rules(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_salad_and_wrong_languages_go(spark, sf_dir):
    """Random letters always fail; most texts under another language's label do. Expectations of
    their own, none from the operator's constants."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(11)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    good = {r["doc_id"]: r for r in docs.join(spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1"), "doc_id").collect()
            if len(words(r["text"] or "")) >= 100}
    langs = sorted({r["lang"] for r in good.values()})
    salad = [(-i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(rng.choice((100, 200, 900)))),
              langs[i % len(langs)]) for i in range(1, 41)]
    moved = [(10**9 + k, r["text"], langs[(langs.index(r["lang"]) + 1) % len(langs)]) for k, r in list(sorted(good.items()))[:60]]
    all_docs = docs.unionByName(spark.createDataFrame(salad + moved, "doc_id long, text string, lang string"))
    kept = {r["doc_id"]: r["kept"] for r in qr.quality_rules(all_docs).select("doc_id", "kept").collect()}
    assert not any(kept[d] for d, _, _ in salad)
    assert sum(kept[d] for d, _, _ in moved) <= 0.25 * len(moved)


def test_many_languages(spark):
    """More languages than have references of their own: the smaller ones use that of all."""
    rows = [(i, f"w{i % 7} same words here and there " * 25, f"l{i:03d}") for i in range(300)]
    got = qr.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string"), min_reference=1, max_languages=5).collect()
    assert len(got) == 300 and all(r["word_distance"] is not None for r in got)
