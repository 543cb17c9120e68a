"""Runs that end halfway: what the model and the resolver answered is never asked again."""

import os
import tempfile
import uuid
from collections import Counter
from functools import partial

import pytest
from pyspark.sql import functions as F

from placeflow import fixtures as fx
from placeflow.operators import enrich, geocode
from placeflow.plans import pipeline
from placeflow.sources import journal

SMALL = "/root/testdata/sf0.001"
REPLY = "ID|name\nx|y"


def note(folder, what):
    with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
        f.write(what)


def notes(folder):
    return Counter(open(f"{folder}/{n}").read() for n in os.listdir(folder))


def noted_client(folder, end=None, after=0):
    """Answers every prompt and writes it down; after some calls in all it ends the run."""
    def call(prompt):
        if end and len(os.listdir(folder)) >= after:
            end()
        note(folder, prompt)
        return REPLY
    return call


def stop():
    raise journal.StopAsking("quota used up")


def leave():
    raise SystemExit("asked to leave")


def prompts(spark, n):
    rows = [("001", "111", f"{i % 3:04d}", i, f"prompt {i}") for i in range(n)]
    return enrich.with_fingerprint(spark.createDataFrame(rows, "city_code string, zip_code string, ind_code string, chunk_no bigint, prompt string"))


@pytest.mark.parametrize("end", [stop, leave])
def test_a_stopped_run_loses_no_answer(spark, end):
    root, seen = tempfile.mkdtemp(prefix="journal-"), tempfile.mkdtemp(prefix="seen-")
    todo = prompts(spark, 40)
    with pytest.raises(journal.AskingStopped):
        enrich.ask_model(todo, partial(noted_client, seen, end, 11), f"{root}/calls", partitions=4, per_round=16)
    first = notes(seen)
    assert 11 <= sum(first.values()) < 40
    known = enrich.read_calls(spark, f"{root}/calls")
    assert known.where("answered").count() == len(first)
    asked = enrich.ask_model(todo, partial(noted_client, seen), f"{root}/calls", partitions=4, per_round=16)
    assert asked.count() == 40 - len(first)
    assert notes(seen) == Counter(r.prompt for r in todo.collect())  # each exactly once over both runs
    assert enrich.ask_model(todo, partial(noted_client, seen), f"{root}/calls").count() == 0
    got = enrich.saved_calls(todo, f"{root}/calls").collect()
    assert len(got) == 40 and all(r.response == REPLY and r.attempts == 1 and r.error is None for r in got)


def test_a_killed_run_loses_one_round_at_most(spark):
    root, seen = tempfile.mkdtemp(prefix="journal-"), tempfile.mkdtemp(prefix="seen-")
    todo = prompts(spark, 40)
    with pytest.raises(Exception):
        enrich.ask_model(todo, partial(noted_client, seen, partial(os._exit, 1), 25), f"{root}/calls", partitions=2, per_round=8)
    kept = enrich.read_calls(spark, f"{root}/calls").where("answered").count()
    assert 0 < kept <= 25
    enrich.ask_model(todo, partial(noted_client, seen), f"{root}/calls", partitions=2, per_round=8)
    twice = [p for p, n in notes(seen).items() if n > 1]
    assert len(notes(seen)) == 40 and len(twice) <= 25 - kept


def test_failures_are_asked_again_up_to_the_limit(spark):
    root = tempfile.mkdtemp(prefix="journal-")
    todo = prompts(spark, 6)

    def client():
        return lambda prompt: REPLY if prompt.endswith(("0", "2", "4")) else "no table"

    asked = [enrich.ask_model(todo, client, f"{root}/calls", max_attempts=7).count() for _ in range(5)]
    assert asked == [6, 3, 3, 0, 0]  # three tries a run
    got = {r.chunk_no: (r.attempts, r.error) for r in enrich.saved_calls(todo, f"{root}/calls").collect()}
    assert got == {i: (1, None) if i % 2 == 0 else (9, "reply without rows") for i in range(6)}


def test_a_changed_prompt_is_another_chunk(spark):
    root, seen = tempfile.mkdtemp(prefix="journal-"), tempfile.mkdtemp(prefix="seen-")
    todo = prompts(spark, 3)
    enrich.ask_model(todo, partial(noted_client, seen), f"{root}/calls")
    new = enrich.with_fingerprint(todo.drop("fingerprint").withColumn("prompt", F.when(F.col("chunk_no") == 1, "other").otherwise(F.col("prompt"))))
    assert [r.chunk_no for r in enrich.ask_model(new, partial(noted_client, seen), f"{root}/calls").collect()] == [1]


def test_resolver_answers_survive_a_stop(spark):
    root, seen = tempfile.mkdtemp(prefix="journal-"), tempfile.mkdtemp(prefix="seen-")
    pending = spark.createDataFrame([(f"k{i:02d}",) for i in range(30)], "full_address_key string")

    def resolver(end=None):
        def find(key):
            if end and len(os.listdir(seen)) >= 9:
                end()
            note(seen, key)
            if key == "k03":
                raise ValueError("busy")
            return None if key == "k04" else (1.0, 2.0)
        return find

    with pytest.raises(journal.AskingStopped):
        geocode.resolve_with_journal(pending, partial(resolver, stop), root, partitions=3, per_round=10)
    got = {r.full_address_key: r for r in geocode.resolve_with_journal(pending, resolver, root, partitions=3, per_round=10).collect()}
    assert len(got) == 30 and got["k04"].lat is None and got["k04"].error is None and got["k03"].error == "ValueError: busy"
    assert {k for k, n in notes(seen).items() if n > 1} <= {"k03"} and len(notes(seen)) == 30
    geocode.resolve_with_journal(pending, resolver, root, max_attempts=2)
    geocode.resolve_with_journal(pending, resolver, root, max_attempts=2)
    assert notes(seen)["k03"] == 2 and notes(seen)["k04"] == 1


def test_empty_and_foreign_folders(spark):
    root = tempfile.mkdtemp(prefix="journal-")
    assert enrich.ask_model(prompts(spark, 1).limit(0), partial(noted_client, root), f"{root}/calls").count() == 0
    assert enrich.read_calls(spark, f"{root}/calls").count() == 0
    os.makedirs(f"{root}/calls/city_code=001")
    with pytest.raises(ValueError, match="not a journal"):
        enrich.read_calls(spark, f"{root}/calls")


def test_the_whole_job_goes_on_where_it_stopped(spark):
    out, seen, keys = (tempfile.mkdtemp(prefix=p) for p in ("job-", "seen-", "keys-"))
    raw = fx.merchant_raw(spark, SMALL)
    pages = fx.bind(spark, fx.LISTING_PAGES, merchant_raw=raw, last_page=fx.bind(spark, fx.LISTING_LAST_PAGE, merchant_raw=raw))

    def resolver():
        def find(key):
            note(keys, key)
            return 1.0, 2.0
        return find

    def client(end, bad):
        good = noted_client(seen, end, 5)

        def call(prompt):
            if bad and "_00000," in prompt and len(prompt) % 2:
                return "no table"
            return good(prompt)
        return call

    args = (spark, pages, f"{out}/data", f"{out}/cache")
    with pytest.raises(journal.AskingStopped):
        pipeline.run(*args, partial(client, stop, False), resolver=resolver, per_round=7)
    assert not os.path.exists(f"{out}/data/final")
    pipeline.run(*args, partial(client, None, True), resolver=resolver, per_round=1000)
    failed = spark.read.parquet(f"{out}/data/ledger").where("n_rows = 0").count()
    assert set(notes(seen).values()) == set(notes(keys).values()) == {1}
    before = spark.read.parquet(f"{out}/data/ledger").agg(F.sum("n_rows")).first()[0]
    # the next run asks again for the chunks without a reply, finished batches included, and for nothing else
    pipeline.run(*args, partial(client, None, False), resolver=resolver)
    ledger = spark.read.parquet(f"{out}/data/ledger").collect()
    assert all(r.n_rows == 1 and r.error is None for r in ledger)
    assert set(notes(seen).values()) == set(notes(keys).values()) == {1} and len(notes(seen)) == len(ledger) == before + failed
    final = pipeline.fragments.read_batches(spark, f"{out}/data/final", pipeline.FINAL_SCHEMA)
    assert failed > 0 and final.count() == len(ledger)
