"""First-wins / last-wins de-duplication and upserts.

A window ``row_number() = 1`` would send every row of a key to one task, so a
key holding a third of the data would sit in one task. Here the winner is an
aggregate instead: ``min`` (or ``max``) of a struct whose leading fields are the
order columns and whose last field is the whole row. Spark computes it with a
partial aggregate before the shuffle, so each map task ships at most one row per
key, however hot the key. Ties on the order columns are broken by the row
content, so the result is deterministic even without a total order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeflow.functions.text import dedupe_key


def _order_fields(order: Sequence[str | Column]) -> list[Column]:
    out = []
    for i, o in enumerate(order):
        c = F.col(o) if isinstance(o, str) else o
        out.append(c.alias(f"_o{i}"))
    return out


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], last: bool = False) -> DataFrame:
    """One row per ``keys``: the first (``last=False``) or last row by ``order``.

    NULL keys form one group (as in pandas ``drop_duplicates``). NULL order
    values sort first.
    """
    keys = list(keys)
    # plain order columns travel once, as order fields; the rest rides in _row
    order_names = {o: i for i, o in enumerate(order) if isinstance(o, str)}
    payload = [c for c in df.columns if c not in keys and c not in order_names]
    pick = F.struct(*_order_fields(order), F.struct(*[F.col(c) for c in payload]).alias("_row"))
    agg = (F.max if last else F.min)(pick).alias("_pick")
    out = df.groupBy(*keys).agg(agg)
    cols = {k: F.col(k) for k in keys}
    cols.update({c: F.col(f"_pick._row.{c}").alias(c) for c in payload})
    cols.update({o: F.col(f"_pick._o{i}").alias(o) for o, i in order_names.items() if o not in keys})
    return out.select(*[cols[c] for c in df.columns])


def dedupe_merchants(
    df: DataFrame,
    batch_cols: Sequence[str] = ("city_code", "zip_code", "ind_code"),
    phone: str = "phone",
    address: str = "address",
    order: Sequence[str] = ("page_no", "seq"),
) -> DataFrame:
    """Per batch, keep the first row (page order) of each digits(phone)+'_'+address key."""
    keyed = df.withColumn("_dedup_key", dedupe_key(phone, address))
    return keep_first(keyed, [*batch_cols, "_dedup_key"], order).drop("_dedup_key")


def upsert_latest(old: DataFrame, new: DataFrame, key: str, order: Sequence[str] = ("gen", "seq")) -> DataFrame:
    """Append ``new`` to ``old`` and keep the last version of each key."""
    both = old.unionByName(new, allowMissingColumns=True)
    return keep_first(both, [key], order, last=True)
