"""Best-window similarity (the "partial ratio" of fuzzy string matching).

For the shorter string ``s`` (length m) and the longer ``t``, every window of
``t`` of length m, plus the shorter prefixes and suffixes of ``t``, is compared
with ``s`` by normalised indel similarity ``1 - (m + |w| - 2*LCS)/(m + |w|)``;
the best one, times 100, is the score. Equal lengths try both directions. Both
empty -> 100, one empty -> 0. A window whose boundary character does not occur
in ``s`` is skipped: a neighbouring window scores at least as well.

LCS uses the bit-parallel recurrence (one big-int step per character).
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf


def _lcs(pm: dict, mask: int, m: int, w: str) -> int:
    v = mask
    for ch in w:
        u = v & pm.get(ch, 0)
        v = ((v + u) | (v - u)) & mask
    return m - bin(v).count("1")


def _score(m: int, wl: int, lcs: int) -> float:
    lensum = m + wl
    return (1.0 - (lensum - 2 * lcs) / lensum) * 100.0


def _best_window(s: str, t: str) -> float:
    m, n = len(s), len(t)
    pm: dict = {}
    for i, ch in enumerate(s):
        pm[ch] = pm.get(ch, 0) | (1 << i)
    mask = (1 << m) - 1
    best = 0.0
    for i in range(1, m):  # prefixes shorter than s
        if t[i - 1] in pm:
            best = max(best, _score(m, i, _lcs(pm, mask, m, t[:i])))
            if best == 100.0:
                return best
    for i in range(0, n - m + 1):  # full-length windows
        if t[i + m - 1] in pm:
            best = max(best, _score(m, m, _lcs(pm, mask, m, t[i:i + m])))
            if best == 100.0:
                return best
    for i in range(n - m + 1, n):  # suffixes shorter than s
        if t[i] in pm:
            best = max(best, _score(m, n - i, _lcs(pm, mask, m, t[i:])))
    return best


def partial_ratio(a: str | None, b: str | None) -> float:
    a = a or ""
    b = b or ""
    if not a and not b:
        return 100.0
    if not a or not b:
        return 0.0
    if len(a) <= len(b):
        best = _best_window(a, b)
    else:
        best = _best_window(b, a)
    if best != 100.0 and len(a) == len(b):
        best = max(best, _best_window(b, a))
    return best


@arrow_udf(T.DoubleType())
def partial_ratio_udf(a: pa.Array, b: pa.Array) -> pa.Array:
    """Arrow-batched ``partial_ratio`` over two string columns."""
    return pa.array([partial_ratio(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], type=pa.float64())


def similar_udf(threshold: float):
    """Arrow-batched function: whether two texts score ``threshold`` or more; only those that
    share enough characters for it are scored."""
    t = min(threshold, 100.0) / 100

    @arrow_udf(T.BooleanType())
    def similar(a: pa.Array, b: pa.Array) -> pa.Array:
        counted: dict[str, Counter] = {}
        out = []
        for x, y in zip(a.to_pylist(), b.to_pylist()):
            for z in (x, y):
                if z not in counted:
                    counted[z] = Counter(z)
            shared = sum((counted[x] & counted[y]).values())
            enough = shared * (2 - t) + 1e-9 >= min(len(x), len(y)) * t
            out.append(enough and partial_ratio(x, y) >= threshold)
        return pa.array(out, type=pa.bool_())

    return similar


def similar_tags_udf(dictionary: list[tuple[str, str]], threshold: float):
    """Arrow-batched function: name -> tags whose alias text scores ``threshold`` or more.

    The dictionary travels in the closure; its characters are counted once, and a pair is
    scored only when it shares enough of them (see ``operators.tagging``)."""
    t = min(threshold, 100.0) / 100
    counted = [(tag, text, Counter(text)) for tag, text in dictionary]

    @arrow_udf(T.ArrayType(T.StringType()))
    def similar(names: pa.Array) -> pa.Array:
        out = []
        for name in names.to_pylist():
            have = Counter(name or "")
            hits = []
            for tag, text, need in counted:
                shared = sum(min(n, have[c]) for c, n in need.items())
                enough = shared * (2 - t) + 1e-9 >= min(len(name or ""), len(text)) * t
                if enough and partial_ratio(name, text) >= threshold:
                    hits.append(tag)
            out.append(hits)
        return pa.array(out, type=pa.list_(pa.string()))

    return similar
