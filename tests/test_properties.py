"""Property tests: written examples and laws of the cleaners on random strings; results
unchanged under repartitioning; unique keys."""

import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from placeflow.functions.text import dedupe_key, normalize_phone, normalize_place_text

ALPHABET = list("0123456789０１２３４５６٠١٢#＃- ()（）　abcＡ臺台之至一二三四段縣市鄉鎮區村里北中山路號\n\r é")


strings = st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=14)), min_size=150, max_size=250)

PLACES = [
    (None, ""), ("", ""), ("　 ", ""), ("臺北市大安區和平東路三段", "和平東路3段"), ("新竹縣竹北市光明村五號", "五號"),
    ("五段之四段", "五段-四段"), ("甲至乙", "甲-乙"), ("Ａ１ｂ", "A1b"), ("a\nb", "a\nb"), ("縣市區村里", "村里"),
    ("高雄市", ""), ("市高雄", "市高雄"), ("臺臺臺", "台台台"), ("北中山路一段二段", "北中山路1段2段"),
]
PHONES = [
    (None, ""), ("", ""), ("02-1234-5678", "0212345678"), ("０２（１２）", "0212"), ("12＃3#4", "12#3#4"), ("#5 a", "#5a"),
    ("a#b", "#b"), ("١٢", "١٢"), ("1　2 3", "123"), ("tel", ""),
]


def test_cleaners_on_written_examples(spark):
    got = spark.createDataFrame(PLACES, "x string, y string").select("y", normalize_place_text("x").alias("z")).collect()
    assert [r.z for r in got] == [r.y for r in got]
    got = spark.createDataFrame(PHONES, "x string, y string").select("y", normalize_phone("x").alias("z")).collect()
    assert [r.z for r in got] == [r.y for r in got]


@settings(max_examples=4, deadline=None)
@given(strings)
def test_cleaner_properties(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    rows = df.select("i", normalize_place_text("x").alias("p"), normalize_phone("x").alias("ph")).collect()
    for r in rows:
        source = unicodedata.normalize("NFKC", values[r.i] or "")
        assert not set(r.p) & set(" \u3000臺至之"), values[r.i]  # spaces and rewritten characters are gone
        assert "一段" not in r.p and "二段" not in r.p and "三段" not in r.p
        head, mark, tail = r.ph.partition("#")
        assert all(unicodedata.category(c) == "Nd" for c in head)  # digits only in front of an extension
        assert (mark == "#") == ("#" in source)
        if mark:
            assert tail == source.partition("#")[2].replace(" ", "").replace("\u3000", "")
    # a leading district goes, whatever follows; text without any mark of a place stays whole
    more = spark.createDataFrame([(f"甲乙區{i}",) for i in range(20)], "x string").select(normalize_place_text("x").alias("p")).collect()
    assert [r.p for r in more] == [str(i) for i in range(20)]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=10), min_size=50, max_size=120))
def test_phone_cleaner_is_idempotent(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    once = df.select(normalize_phone("x").alias("y"))
    twice = once.select(normalize_phone("y").alias("z"), "y")
    assert all(r.y == r.z for r in twice.collect())


def test_dedupe_unchanged_under_repartitioning_and_keys_unique(spark, sf_dir):
    q = entry.queries()["dedupe_first"]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = q(spark, sf_dir)
        rows_a = sorted(tuple(r) for r in a.collect())
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        rows_b = sorted(tuple(r) for r in q(spark, sf_dir).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert rows_a == rows_b
    keyed = a.withColumn("k", dedupe_key("phone", "address"))
    assert keyed.groupBy("city_code", "zip_code", "ind_code", "k").count().filter(F.col("count") > 1).count() == 0


def test_nfkc_is_that_of_the_standard_library(spark):
    """All code points that the standard library's Unicode version knows, alone and between
    others, and random strings of letters, marks and compatibility forms."""
    import random
    import unicodedata

    from placeflow.functions.text import nfkc

    known = [chr(c) for c in range(1, 0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    rng = random.Random(7)
    marks = [c for c in known if unicodedata.combining(c)] + [chr(c) for c in (0x3099, 0x309A, 0xFF9E, 0xFF9F, 0x1161, 0x11A8)]
    forms = [c for c in known if unicodedata.normalize("NFKC", c) != c]
    plain = [c for c in known if c.isalpha()][:3000] + [chr(c) for c in range(0xFF66, 0xFF9E)] + [chr(c) for c in range(0x1100, 0x1113)]
    texts = known + [f"a{c}́" for c in known]
    texts += ["".join(rng.choice(rng.choice((marks, forms, plain))) for _ in range(rng.randint(1, 12))) for _ in range(50_000)]
    got = spark.createDataFrame(list(enumerate(texts)) + [(-1, None), (-2, "")], "i int, s string").select("i", nfkc("s").alias("n"))
    assert "Python" not in got._jdf.queryExecution().toString() and "Arrow" not in got._jdf.queryExecution().toString()
    for r in got.collect():
        assert r.n == ({-1: None, -2: ""}[r.i] if r.i < 0 else unicodedata.normalize("NFKC", texts[r.i])), r.i
