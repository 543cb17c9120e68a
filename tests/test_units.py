"""Hand-written edge rows and brute-force checks for the operators."""

import tempfile
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from placeflow import dims
from placeflow.functions import text as tx
from placeflow.functions.fuzzy import partial_ratio
from placeflow.operators import tagging
from placeflow.operators.dedupe import keep_first, upsert_latest
from placeflow.sources import geo_cache


def _one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("y")).first().y


@pytest.mark.parametrize("raw,expected", [
    ("新北市市民大道", "民大道"),
    ("台北市士林區中山北路二段", "中山北路2段"),
    ("士林夜市點心", "點心"),
    (None, ""),
    ("臺北市大安區仁愛路四段 1之2號", "仁愛路四段1-2號"),
    ("ＳＴＡＲ　咖啡", "STAR咖啡"),
])
def test_place_text(spark, raw, expected):
    assert _one(spark, tx.normalize_place_text(F.col("x")), raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("（０２）2542-2266＃12 轉 3", "0225422266#12轉3"),
    ("٠٢-12", "٠٢12"),
    (None, ""),
    ("02 2542 2266", "0225422266"),
])
def test_phone(spark, raw, expected):
    assert _one(spark, tx.normalize_phone(F.col("x")), raw) == expected


def test_dedupe_key_and_full_address(spark):
    df = spark.createDataFrame([("0225422266#12", "A1", "台北市X", "士林區", "台北市")], "p string, a string, fa string, d string, c string")
    r = df.select(tx.dedupe_key("p", "a").alias("k"), tx.full_address("fa", "d", "c").alias("f")).first()
    assert r.k == "022542226612_A1"
    assert r.f == "台北市士林區台北市X"


def test_temp_id_and_coercion(spark):
    df = spark.createDataFrame([("001", "111", "0009", 123456), ("001", "111", "0009", 7)], "c string, z string, i string, n bigint")
    assert [r.t for r in df.select(tx.temp_id("c", "z", "i", "n").alias("t")).collect()] == ["001_111_0009_123456", "001_111_0009_00007"]
    vals = ["1.0d", "1f", "1_000", "NaN", "inf", "", " 25.0 ", "1e3", "abc", "-.5"]
    got = [r.v for r in spark.createDataFrame([(v,) for v in vals], "x string").select(tx.to_double_strict("x").alias("v")).collect()]
    assert got == [None, None, None, None, None, None, 25.0, 1000.0, None, -0.5]


def test_nfkc_matches_stdlib(spark):
    samples = ["ä", "Ｓ２　", "ﬁ", "①", "é", "plain", None, "ｶﾞ"]
    got = [r.y for r in spark.createDataFrame([(s,) for s in samples], "x string").select(tx.nfkc("x").alias("y")).collect()]
    assert got == [None if s is None else unicodedata.normalize("NFKC", s) for s in samples]


def _lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b):
            cur.append(prev[j] + 1 if ca == cb else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def _brute_partial(a, b):
    if not a and not b:
        return 100.0
    if not a or not b:
        return 0.0

    def one(s, t):
        m, n = len(s), len(t)
        wins = [t[:i] for i in range(1, m)] + [t[i:i + m] for i in range(0, n - m + 1)] + [t[i:] for i in range(n - m + 1, n)]
        return max((1.0 - (m + len(w) - 2 * _lcs_dp(s, w)) / (m + len(w))) * 100.0 for w in wins)

    s, t = (a, b) if len(a) <= len(b) else (b, a)
    best = one(s, t)
    if best != 100.0 and len(a) == len(b):
        best = max(best, one(t, s))
    return best


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcde咖啡", max_size=9), st.text(alphabet="abcde咖啡", max_size=14))
def test_partial_ratio_brute_force(a, b):
    assert partial_ratio(a, b) == pytest.approx(_brute_partial(a, b), abs=1e-9)


def test_partial_ratio_known_values():
    assert partial_ratio("松林舍咖啡12", "松林社咖啡") == pytest.approx(80.0)
    assert partial_ratio("this is a test", "this is a test!") == 100.0
    assert partial_ratio("", "") == 100.0 and partial_ratio("a", "") == 0.0


# tags of the fixture's names by hand: its seven stems end in a number that changes nothing
TAGS = {
    "藍燈LAMP": "bluelamp", "松林舍咖啡": "coffee,pinewood", "台三葉草": "clovershop", "台灣三葉草": "clovershop",
    "石橋館": "stonebridge", "點心": "snack", "山海-家": "home", "望海大酒店": "hotel",
}


def test_fuzzy_tags_of_the_fixture(spark, sf_dir):
    import __spark_entry__ as e
    rows = e.queries()["synonym_tags_fuzzy"](spark, sf_dir).collect()
    assert rows and {r.name.rstrip("0123456789") for r in rows} <= set(TAGS)
    for r in rows:
        assert r.hidden_tags == TAGS[r.name.rstrip("0123456789")], r
    assert any("pinewood" in r.hidden_tags for r in rows), "fuzzy-only tag never reached"


def test_fuzzy_tags_long_and_empty_names(spark):
    rows = [(1, "松林舍咖啡館旗艦店", "coffee,pinewood"), (2, "", ""), (3, None, ""), (4, "Lamp 咖啡 家", "bluelamp,coffee,home")]
    df = spark.createDataFrame(rows, "seq bigint, name string, want string")
    assert all(r.hidden_tags == r.want for r in tagging.synonym_tags(df, dims.synonyms(spark)).collect())


@pytest.mark.parametrize("threshold", [30, 45, 80, 100])
@pytest.mark.parametrize("method", ["projection", "join"])
def test_similarity_at_any_threshold(spark, threshold, method):
    """Against the window-by-window similarity above, which shares no code with the library."""
    import random
    rng = random.Random(threshold)
    names = ["".join(rng.choice("abcdefgh咖啡") for _ in range(rng.randint(1, 12))) for _ in range(60)] + ["abcdeqwrty"]
    texts = ["abcdefghij"] + ["".join(rng.choice("abcdefgh咖啡") for _ in range(rng.randint(2, 9))) for _ in range(11)]
    syn = spark.createDataFrame([(f"t{i:02d}", t, ["no alias"]) for i, t in enumerate(texts)], "tag string, alias_text string, aliases array<string>")
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.hidden_tags for r in tagging.synonym_tags(df, syn, threshold=threshold, method=method).collect()}
    for n in names:
        assert got[n] == ",".join(f"t{i:02d}" for i, t in enumerate(texts) if _brute_partial(n, t) >= threshold), n


def test_keep_first_and_last(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), (None, 5, "n1"), (None, 3, "n2"), ("b", 1, "z")]
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(3)
    first = {r.k: r.v for r in keep_first(df, ["k"], ["o"]).collect()}
    last = {r.k: r.v for r in keep_first(df, ["k"], ["o"], last=True).collect()}
    assert first == {"a": "y", None: "n2", "b": "z"}
    assert last == {"a": "x", None: "n1", "b": "z"}


def test_upsert_latest(spark):
    old = spark.createDataFrame([("k1", 1.0, 1.0, 0, 1), ("k2", 2.0, 2.0, 0, 2)], geo_cache.CACHE_SCHEMA)
    new = spark.createDataFrame([("k1", 9.0, 9.0, 1, 0)], geo_cache.CACHE_SCHEMA)
    got = {r.full_address_key: r.lat for r in upsert_latest(old, new, "full_address_key").collect()}
    assert got == {"k1": 9.0, "k2": 2.0}


def test_versioned_geo_cache(spark):
    root = tempfile.mkdtemp(prefix="geo-cache-")
    assert geo_cache.read_geo_cache(spark, root).count() == 0
    v0 = geo_cache.write_geo_cache(spark, root, spark.createDataFrame([("a", 1.0, 1.0), ("b", 2.0, 2.0)], "full_address_key string, lat double, lng double"))
    v1 = geo_cache.write_geo_cache(spark, root, spark.createDataFrame([("a", 5.0, 5.0)], "full_address_key string, lat double, lng double"))
    assert (v0, v1) == (0, 1)
    got = {r.full_address_key: r.lat for r in geo_cache.read_geo_cache(spark, root).collect()}
    assert got == {"a": 5.0, "b": 2.0}


def test_geo_cache_survives_unfinished_version(spark):
    import os

    root = tempfile.mkdtemp(prefix="geo-cache-")
    schema = "full_address_key string, lat double, lng double"
    geo_cache.write_geo_cache(spark, root, spark.createDataFrame([("a", 1.0, 1.0)], schema))
    os.makedirs(os.path.join(root, "v=1"))  # a writer died here: no _SUCCESS
    assert geo_cache.committed_versions(spark, root) == [0]
    v = geo_cache.write_geo_cache(spark, root, spark.createDataFrame([("b", 2.0, 2.0)], schema))
    assert v == 2
    got = {r.full_address_key: r.lat for r in geo_cache.read_geo_cache(spark, root).collect()}
    assert got == {"a": 1.0, "b": 2.0}
    assert geo_cache.compact(spark, root) == 3
    assert {r.full_address_key: r.lat for r in geo_cache.read_geo_cache(spark, root).collect()} == got
    geo_cache.write_geo_cache(spark, root, spark.createDataFrame([("a", 7.0, 7.0), ("a", 8.0, 8.0)], schema))
    assert {r.full_address_key: r.lat for r in geo_cache.read_geo_cache(spark, root).collect()} == {"a": 8.0, "b": 2.0}


def test_geo_cache_writers_at_the_same_time(spark):
    from concurrent.futures import ThreadPoolExecutor

    root = tempfile.mkdtemp(prefix="geo-cache-")
    schema = "full_address_key string, lat double, lng double"
    frames = [spark.createDataFrame([(f"k{i}", float(i), 0.0), ("all", float(i), 0.0)], schema) for i in range(6)]
    with ThreadPoolExecutor(6) as pool:
        versions = list(pool.map(lambda df: geo_cache.write_geo_cache(spark, root, df), frames))
    assert sorted(versions) == sorted(set(versions)) and len(versions) == 6
    got = {r.full_address_key: r.lat for r in geo_cache.read_geo_cache(spark, root).collect()}
    assert got == {**{f"k{i}": float(i) for i in range(6)}, "all": float(versions.index(max(versions)))}


def test_unreadable_cache_is_an_error_and_the_plan_runs_once(spark):
    import os

    root = tempfile.mkdtemp(prefix="geo-cache-")
    os.makedirs(f"{root}/v=0")
    for name, body in (("_SUCCESS", b""), ("part-0.parquet", b"not parquet")):
        with open(f"{root}/v=0/{name}", "wb") as f:
            f.write(body)
    with pytest.raises(Exception):
        geo_cache.read_geo_cache(spark, root).collect()


def test_replies_with_quotes():
    from placeflow.sources.delimited import accepted, has_rows, records

    text = 'ID|b\n1|"x|y"|c\n\n   \n2|"two\nlines"|say ""no""\n3|"a ""q"""\n4|"open|c\n'
    got = records(text)
    assert [r["fields"] for r in got[:3]] == [["1", "x|y", "c"], ["2", "two\nlines", 'say ""no""'], ["3", 'a "q"']]
    assert [r["closed"] for r in got] == [True, True, True, False] and got[3]["line"] == '4|"open|c'
    assert not accepted(got[3], 12) and accepted(got[0], 3) and accepted(got[0], 2) is False
    assert has_rows("Here:\n```csv\nID |a\n1|b\n```") and not has_rows("sorry, no table") and not has_rows("ID|a\n")
    assert not has_rows("") and records("") == []


def test_resolve_with_function_single_and_bulk(spark):
    from placeflow.operators import geocode

    pending = spark.createDataFrame([("a",), ("b",), ("boom",)], "full_address_key string")

    def single():
        def f(k):
            if k == "boom":
                raise RuntimeError("service error")
            return None if k == "b" else (1.0, 2.0)
        return f

    def bulk():
        return lambda keys: [None if k == "b" else (1.0, 2.0) for k in keys]

    def short():
        return lambda keys: [(1.0, 2.0)] * (len(keys) + 1)

    one = {r.full_address_key: (r.lat, r.error) for r in geocode.resolve_with_function(pending, single).collect()}
    many = {r.full_address_key: (r.lat, r.error) for r in geocode.resolve_with_function(pending, bulk, bulk=True).collect()}
    bad = geocode.resolve_with_function(pending.coalesce(1), short, bulk=True).collect()
    assert one == {"a": (1.0, None), "b": (None, None), "boom": (None, "RuntimeError: service error")}
    assert many == {"a": (1.0, None), "b": (None, None), "boom": (1.0, None)}
    assert {r.error for r in bad} == {"4 answers for 3 keys"} and all(r.lat is None for r in bad)
    assert [r.full_address_key for r in geocode.usable(geocode.resolve_with_function(pending, single)).collect()] == ["a"]


def test_tag_methods_agree(spark, sf_dir):
    from placeflow.plans import queries

    mc = queries._merchant_clean(spark, sf_dir)
    syn = dims.synonyms(spark)
    for fuzzy in (False, True):
        a = {r.seq: r.hidden_tags for r in tagging.synonym_tags(mc, syn, fuzzy=fuzzy, method="projection").select("seq", "hidden_tags").collect()}
        b = {r.seq: r.hidden_tags for r in tagging.synonym_tags(mc, syn, fuzzy=fuzzy, method="join").select("seq", "hidden_tags").collect()}
        assert a == b and any(a.values())
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.col("text").alias("name"))
    a = {r.doc_id: r.hidden_tags for r in tagging.synonym_tags(docs, syn, fuzzy=False, method="projection").select("doc_id", "hidden_tags").collect()}
    b = {r.doc_id: r.hidden_tags for r in tagging.synonym_tags(docs, syn, fuzzy=False, method="join").select("doc_id", "hidden_tags").collect()}
    assert a == b


def test_repeated_codes_have_one_name(spark, monkeypatch):
    from placeflow.operators import lookup

    df = spark.createDataFrame([("a",), ("b",)], "code string")
    rows = [("a", "first"), ("a", "last"), ("b", "only")]
    for limit in (10_000, 0):
        monkeypatch.setattr(lookup, "MAX_LITERAL_ROWS", limit)
        assert sorted(r.n for r in lookup.lookup_name(df, "code", rows, "n").collect()) == ["last", "only"]
    table = spark.createDataFrame(rows, dims.CODE_SCHEMA)
    assert sorted(r.n for r in lookup.lookup_name(df, "code", table, "n").collect()) == ["last", "only"]
    assert [r.n for r in lookup.lookup_name(df, "code", [], "n").collect()] == ["a", "b"]
    assert dims.dim_city(spark, []).count() == 0


def test_large_code_table_falls_back_to_join(spark):
    from placeflow.operators import lookup

    rows = [(f"{i:06d}", f"name{i}") for i in range(lookup.MAX_LITERAL_ROWS + 5)]
    df = spark.createDataFrame([("000007",), ("999999",), (None,)], "code string")
    got = [r.n for r in lookup.lookup_name(df, "code", rows, "n").orderBy("code").collect()]
    assert sorted(got, key=str) == sorted([None, "name7", "999999"], key=str)
