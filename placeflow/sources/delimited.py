"""Replies as '|'-delimited tables -> rows of named string fields, plus rejects.

Per reply: fences removed and whitespace trimmed, text kept from the first ``ID |`` header
on. Records follow the usual CSV quoting: a field that starts with a double quote may hold
separators, newlines and doubled quotes, and loses its quotes; a quote elsewhere is text.
Empty lines and lines of blank space are skipped; the first record is the header and
dropped. Every field stays a string (no type guessing per chunk). A record with 12 fields,
or 13 with an empty last one, is accepted; shorter ones are padded with NULL; longer ones,
and one whose quote never closes, go to the rejects. Work per reply, in Arrow batches: no
shuffle.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from placeflow.functions.text import FENCE_TOKENS, clean_response

# ---- fixed values: reply field names, in order ----
REPLY_FIELDS = ["id", "name", "city", "district", "address", "floor", "lat", "lng", "phone", "review_summary", "rating", "price_level"]

# ---- fixed values: texts pandas reads as missing by default ----
NA_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
            "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


RECORD = T.ArrayType(T.StructType([T.StructField("line_no", T.LongType()), T.StructField("line", T.StringType()),
                                   T.StructField("fields", T.ArrayType(T.StringType())), T.StructField("closed", T.BooleanType())]))
_END = "\x00end of reply"


def records(text: str, sep: str = "|") -> list[dict]:
    """Records of a cleaned reply after its header; ``closed`` is false for an open quote."""
    csv.field_size_limit(1 << 30)
    lines = list(io.StringIO(text, newline=""))
    if lines and not lines[-1].endswith(("\n", "\r")):
        lines[-1] += "\n"
    out, done = [], 0
    reader = csv.reader([*lines, _END], delimiter=sep)
    for fields in reader:
        line, done = "".join([*lines, _END][done:reader.line_num]).rstrip("\r\n"), reader.line_num
        if fields == [_END]:
            break
        if not fields or len(fields) == 1 and not fields[0].strip():
            continue
        closed = not line.endswith(_END)
        out.append({"line": line if closed else line.removesuffix(_END).rstrip("\r\n"), "fields": fields, "closed": closed})
    return [{"line_no": i, **r} for i, r in enumerate(out[1:])]


def accepted(record: dict, n: int) -> bool:
    size = len(record["fields"])
    return record["closed"] and (size <= n or size == n + 1 and record["fields"][n] == "")


def has_rows(reply: str) -> bool:
    """Whether a raw reply holds at least one acceptable record."""
    for token in FENCE_TOKENS:
        reply = reply.replace(token, "")
    text = reply.strip()
    found = re.search(r"ID\s*\|.*", text, re.DOTALL)
    return any(accepted(r, len(REPLY_FIELDS)) for r in records(found[0] if found else text))


def read_delimited(df: DataFrame, key_cols: Sequence[str], text_col: str = "response", names: Sequence[str] = REPLY_FIELDS, sep: str = "|") -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejects). Rows: key_cols, line_no, one string per name."""
    n = len(names)

    @arrow_udf(RECORD)
    def split(texts: pa.Array) -> pa.Array:
        return pa.array([records(t or "", sep) for t in texts.to_pylist()], type=pa.list_(pa.struct([
            ("line_no", pa.int64()), ("line", pa.string()), ("fields", pa.list_(pa.string())), ("closed", pa.bool_())])))

    found = df.select(*key_cols, F.explode(split(clean_response(text_col))).alias("_r")).select(
        *key_cols, "_r.line_no", "_r.line", F.col("_r.fields").alias("_f"), F.col("_r.closed").alias("_closed"))
    staged = found.withColumn("n_fields", F.size("_f"))
    ok = F.col("_closed") & ((F.col("n_fields") <= n) | ((F.col("n_fields") == n + 1) & (F.get("_f", n) == "")))
    na = F.array(*[F.lit(x) for x in NA_TEXTS])
    fields = []
    for i, name in enumerate(names):
        v = F.get(F.col("_f"), i)
        fields.append(F.when(F.array_contains(na, v), F.lit(None).cast("string")).otherwise(v).alias(name))
    rows = staged.filter(ok).select(*key_cols, "line_no", *fields)
    rejects = staged.filter(~ok).select(*key_cols, "line_no", "n_fields", "line")
    return rows, rejects
