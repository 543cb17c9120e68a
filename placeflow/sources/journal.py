"""Answers of outside services, written as they come, so that a lost run asks nothing twice.

A journal is a folder of Parquet tables ``run=<run>-<round>`` that are only ever added. A row is
the outcome of asking for one key: the service's answer or an error, the number of tries
(``attempts``) and when its round began (``asked_at``). What to ask is fixed first and asked in
rounds of about ``per_round`` keys, each round one job of many tasks; a run that dies loses the
answers of its current round at most. A service that wants to end the run (quota used up, say)
raises ``StopAsking``: nothing is asked after it, the answers so far are kept, and the run
ends with ``AskingStopped`` once they are written.

Every row is true by itself, so a round of which only some files were committed is read like any
other. Nothing is collected: the state of the keys is one aggregation over the journal.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.session import materialize, scratch_dir
from placeflow.sources.versions import hadoop

PER_ROUND = 100_000
MAX_ATTEMPTS = 9  # tries of one key over all runs
STOPPED = "stopped: "


class StopAsking(Exception):
    """Raised by a client or resolver to end the run."""


class AskingStopped(RuntimeError):
    """The service ended the run; what it answered is in the journal."""


def ends_run(e: BaseException) -> bool:
    return isinstance(e, (StopAsking, KeyboardInterrupt, SystemExit))


def read_journal(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All rows of the journal with ``asked_at`` and ``run``; none if there is no journal."""
    fs, path, _ = hadoop(spark, root)
    names = [st.getPath().getName() for st in fs.listStatus(path)] if fs.exists(path) else []
    other = [n for n in names if not n.startswith(("run=", "_", "."))]
    if other:
        raise ValueError(f"{root} is not a journal: it holds {other[0]}")
    schema = f"{schema}, asked_at timestamp, run string"
    if not any(n.startswith("run=") for n in names):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(f"{root}/run=*")


def state(journal: DataFrame, key: Sequence[str], values: Sequence[str], answered: Column) -> DataFrame:
    """One row per key: ``values`` of its first answer or, without one, of its last failure;
    ``answered`` and the ``attempts`` of all rounds."""
    row, when = F.struct(*values), F.struct("asked_at", "run")
    seen = journal.withColumn("_ok", F.coalesce(answered, F.lit(False))).groupBy(*key).agg(
        F.min_by(F.when(F.col("_ok"), row), F.when(F.col("_ok"), when)).alias("_first"),
        F.max_by(row, when).alias("_last"), F.max("_ok").alias("answered"), F.sum("attempts").cast("int").alias("attempts"))
    got = F.coalesce("_first", "_last")
    return seen.select(*key, *[got[v].alias(v) for v in values], "answered", "attempts")


def still_open(todo: DataFrame, known: DataFrame, key: Sequence[str], max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """The rows of ``todo`` whose key has no answer yet and tries left."""
    closed = known.where(F.col("answered") | (F.col("attempts") >= max_attempts)).select(*key)
    return todo.join(closed, list(key), "left_anti")


def ask_in_rounds(todo: DataFrame, key: Sequence[str], ask: Callable[[DataFrame], DataFrame], root: str,
                  per_round: int = PER_ROUND) -> None:
    """Add ``ask(rows)`` of every row of ``todo`` (one for each key) to the journal, a round at a time.

    ``ask`` returns one row per key with ``attempts`` and ``error``; an error that begins with
    ``STOPPED`` ends the run after its round."""
    spark = todo.sparkSession
    todo = materialize(todo)  # what is asked does not change while answers arrive
    n = todo.count()
    rounds = -(-n // per_round)
    if rounds > 1:
        folder = scratch_dir(spark, "rounds")
        numbered = todo.withColumn("_round", F.pmod(F.xxhash64(*key), F.lit(rounds)).cast("int"))
        numbered.repartition("_round").write.partitionBy("_round").parquet(folder)
        todo = spark.read.schema(numbered.schema).parquet(folder)
    run = uuid.uuid4().hex
    for i in range(rounds):
        rows = todo.where(F.col("_round") == i).drop("_round") if rounds > 1 else todo
        now = datetime.datetime.now(datetime.timezone.utc).isoformat()
        answers = ask(rows).withColumn("asked_at", F.lit(now).cast("timestamp"))
        answers.write.parquet(f"{root}/run={run}-{i:05d}")
        told = (spark.read.schema(answers.schema).parquet(f"{root}/run={run}-{i:05d}")
                .where(F.startswith("error", F.lit(STOPPED))).select("error").head())
        if told:
            raise AskingStopped(f"{told['error'][len(STOPPED):]} (round {i + 1} of {rounds}; its answers are kept in {root})")
