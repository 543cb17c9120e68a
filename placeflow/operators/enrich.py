"""Batching rows for an external text-enrichment step, and calling it.

* ``index_within``: zero-based position of a row inside its batch, in page
  order. A window over a whole batch would put a hot batch in one task, so the
  index is built from per-page counts: a bounded hierarchical running sum over
  the page-count table (``prefix.exclusive_prefix_sum``) gives each page its
  offset, and ``row_number`` runs only inside one page (bounded by the
  source's page size).
* chunks of 30 rows -> one CSV text each (``listagg`` inside a bounded group).
* ``call_enrichment``: the user's client runs in ``mapInPandas``, made once
  per partition, up to 3 tries per chunk; failures stay in the output with
  their error instead of vanishing.
* ``ask_model``: the same through a journal, so that a chunk whose reply is known
  is never sent again and one without a reply is sent again by the next run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeflow.functions.text import temp_id
from placeflow.operators.prefix import exclusive_prefix_sum, null_safe_join
from placeflow.session import materialize
from placeflow.sources import journal
from placeflow.sources.delimited import has_rows

CHUNK_SIZE = 30
BATCH = ["city_code", "zip_code", "ind_code"]

# ---- fixed values: the enrichment input columns and their CSV header names ----
INPUT_COLUMNS = ["temp_id", "city", "district", "name", "industry", "phone", "address", "lat", "lng", "hidden_tags"]
INPUT_HEADER = ["temp_id", "縣市", "行政區", "特店名稱", "行業別", "電話", "地址", "lat", "lng", "hidden_tags"]

# ---- fixed values: the 12 reply fields as the header names them ----
REPLY_FIELDS_ZH = "ID|店名|縣市|行政區|地址(不含樓層)|樓層|緯度|經度|電話|評論|星級數|價格區間"
# ---- our prompt wording ----
PROMPT_HEAD = (
    "Clean, de-duplicate and complete the merchant rows below. Reply with a '|'-separated table only, "
    "no prose and no code fences, header first, columns in this order:\n" + REPLY_FIELDS_ZH + "\n"
    "ID is the input temp_id. Leave a field empty when it cannot be verified.\n"
)
PROMPT_VARIANTS = {
    "0009": "Rating as x/5. Price: lowest weekday room rate, digits only. Review: 80-100 characters.\n",
    "0008": "Rating as x/5. Price: spend per person, digits only. Review: an 80-100 character food summary.\n",
}
PROMPT_DEFAULT_VARIANT = "Rating as x/5. Price: a price band (budget, mid, high). Review: an 80-100 character summary.\n"
PROMPT_INPUT_HEADER = "\n# Input\n"


def index_within(df: DataFrame, group_cols: Sequence[str], block_col: str, order_within: Sequence[str], out: str = "idx") -> DataFrame:
    """0-based position inside ``group_cols`` ordered by (block_col, *order_within)."""
    group_cols = list(group_cols)
    counts = df.groupBy(*group_cols, block_col).agg(F.count(F.lit(1)).alias("_n"))
    offsets = exclusive_prefix_sum(counts, group_cols, block_col, "_n", "_off").drop("_n")
    j = null_safe_join(df, offsets, [*group_cols, block_col])
    inside = Window.partitionBy(*group_cols, block_col).orderBy(*order_within)
    return j.withColumn(out, (F.col("_off") + F.row_number().over(inside) - 1).cast("bigint")).drop("_off")


def enrichment_batches(rows: DataFrame, block_col: str = "page_no", order_within: Sequence[str] = ("seq",), chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """Add ``idx``, ``chunk_no`` (30 rows per chunk) and ``temp_id``."""
    out = index_within(rows, BATCH, block_col, order_within)
    return out.withColumn("chunk_no", F.floor(F.col("idx") / chunk_size).cast("bigint")).withColumn(
        "temp_id", temp_id("city_code", "zip_code", "ind_code", "idx")
    )


def csv_field(c: Column) -> Column:
    """One CSV field the way pandas writes it: '' for missing, quoted when needed."""
    s = c.cast("string")
    quoted = F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(s.isNull(), F.lit("")).when(s.rlike('[,"\r\n]'), quoted).otherwise(s)


def csv_line(cols: Sequence[str]) -> Column:
    return F.concat_ws(",", *[csv_field(F.col(c)) for c in cols])


def chunk_texts(batches: DataFrame, cols: Sequence[str] = INPUT_COLUMNS, header: Sequence[str] = INPUT_HEADER) -> DataFrame:
    """One CSV text (header + rows in index order + final newline) per (batch, chunk).

    Groups are at most ``CHUNK_SIZE`` rows, so the ordered aggregation is bounded.
    """
    lines = batches.select(*BATCH, "chunk_no", "idx", csv_line(cols).alias("_line"))
    agg = F.expr("listagg(_line, '\\n') WITHIN GROUP (ORDER BY idx)")
    return lines.groupBy(*BATCH, "chunk_no").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.concat(F.lit(",".join(header) + "\n"), agg, F.lit("\n")).alias("csv_text"),
    )


def prompt_text(ind_code: Column, csv_text: Column) -> Column:
    variant = F.lit(PROMPT_DEFAULT_VARIANT)
    for code, text in PROMPT_VARIANTS.items():
        variant = F.when(ind_code == code, F.lit(text)).otherwise(variant)
    return F.concat(F.lit(PROMPT_HEAD), variant, F.lit(PROMPT_INPUT_HEADER), csv_text)


def enrichment_prompts(batches: DataFrame) -> DataFrame:
    chunks = chunk_texts(batches)
    return chunks.select(*BATCH, "chunk_no", "n_rows", prompt_text(F.col("ind_code"), F.col("csv_text")).alias("prompt"))


CALL_SCHEMA = "city_code string, zip_code string, ind_code string, chunk_no bigint, response string, attempts int, error string"


def call_enrichment(prompts: DataFrame, make_client: Callable[[], Callable[[str], str]], max_tries: int = 3,
                    usable: Callable[[str], bool] = has_rows, partitions: int | None = None) -> DataFrame:
    """Send each prompt to ``make_client()``'s function; keep the reply, tries and error.

    A reply that is not ``usable`` (by default: no acceptable record in it) counts as a
    failed try, as an exception does. After ``max_tries`` the chunk keeps
    ``response = NULL`` and the last error. Calls run in ``partitions`` tasks at once.
    Write the result before using it twice: every evaluation calls the client again. After
    ``journal.StopAsking`` a task calls no more: its other chunks have no attempts. A column
    ``fingerprint`` of the prompts is handed on.
    """
    carried = ["fingerprint"] if "fingerprint" in prompts.columns else []

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call, stopped = make_client(), None
        for pdf in it:
            out = []
            for r in pdf.itertuples(index=False):
                reply, err, tries = None, stopped, 0
                for tries in range(1, 0 if stopped else max_tries + 1):
                    try:
                        text = call(r.prompt) or ""
                        if usable(text):
                            reply, err = text, None
                            break
                        err = "reply without rows" if text.strip() else "empty reply"
                    except BaseException as e:  # the client owns its own back-off
                        err = f"{type(e).__name__}: {e}"
                        if journal.ends_run(e):
                            err = stopped = journal.STOPPED + err
                            tries -= 1  # the service refused: no try of this chunk
                            break
                        if not isinstance(e, Exception):
                            raise
                out.append((r.city_code, r.zip_code, r.ind_code, r.chunk_no, reply, tries, err, *[getattr(r, c) for c in carried]))
            yield pd.DataFrame(out, columns=["city_code", "zip_code", "ind_code", "chunk_no", "response", "attempts", "error", *carried])

    todo = prompts.select(*BATCH, "chunk_no", *carried, "prompt")
    schema = ", ".join([CALL_SCHEMA, *[f"{c} string" for c in carried]])
    return (todo.repartition(partitions) if partitions else todo).mapInPandas(run, schema)


def with_fingerprint(prompts: DataFrame) -> DataFrame:
    """Add ``fingerprint``: the identity of a chunk and of all that is said about it."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in [*BATCH, "chunk_no", "prompt"]]
    return prompts.withColumn("fingerprint", F.sha2(F.concat_ws("\n", *parts), 256))


def read_calls(spark: SparkSession, root: str) -> DataFrame:
    """The state of every chunk in the journal: fingerprint, response, error, answered, attempts."""
    calls = journal.read_journal(spark, root, f"{CALL_SCHEMA}, fingerprint string")
    return journal.state(calls, ["fingerprint"], [*BATCH, "chunk_no", "response", "error"], F.col("response").isNotNull())


def ask_model(prompts: DataFrame, make_client: Callable[[], Callable[[str], str]], root: str, max_tries: int = 3,
              max_attempts: int = journal.MAX_ATTEMPTS, partitions: int | None = None, per_round: int = journal.PER_ROUND) -> DataFrame:
    """Ask for every chunk of ``prompts`` (with fingerprints) that the journal at ``root`` has no
    reply for and tries left; returns the chunks that were asked."""
    spark = prompts.sparkSession
    todo = materialize(journal.still_open(prompts, read_calls(spark, root), ["fingerprint"], max_attempts))
    n_tasks = partitions or spark.sparkContext.defaultParallelism
    journal.ask_in_rounds(todo, ["fingerprint"], lambda rows: call_enrichment(rows, make_client, max_tries, partitions=n_tasks),
                          root, per_round)
    return todo


def saved_calls(chunks: DataFrame, root: str) -> DataFrame:
    """``chunks`` (BATCH, chunk_no, fingerprint) with what the journal knows of each."""
    known = read_calls(chunks.sparkSession, root).select("fingerprint", "response", "attempts", "error")
    return chunks.select(*BATCH, "chunk_no", "fingerprint").join(known, "fingerprint", "left").select(
        *BATCH, "chunk_no", "response", F.coalesce("attempts", F.lit(0)).alias("attempts"), "error")


def enrichment_ledger(calls: DataFrame, rows: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row per chunk: attempts, accepted rows, rejected records and the last error."""
    key = [*BATCH, "chunk_no"]
    n_rows = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    n_bad = rejects.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rejects"))
    out = calls.select(*key, "attempts", "error").join(n_rows, key, "left").join(n_bad, key, "left")
    return out.select(*key, "attempts", F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                      F.coalesce("n_rejects", F.lit(0)).alias("n_rejects"), "error")
