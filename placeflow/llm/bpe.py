"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A pre-token of n bytes has n leaves; leaf i holds rank(symbol i, next live symbol) * n + i,
or NONE where that pair has no merge. A node holds the smaller of its children, so the root
names the lowest rank and, among equals, the leftmost place. A merge rewrites three leaves
(the place itself, its live left neighbour, the swallowed right one) and their paths to the
root, and the loop ends when the root is NONE. Pre-tokens of one size class are merged side
by side as the rows of one array; long ones walk one tree alone.

Defined results: null text counts as empty; an empty text has no ids and decodes to the empty
text; special tokens written inside a text become their ids; a null doc_id stays null; repeated
rows each return a row; extra columns are ignored.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow.llm.common import in_chunks, texts

# fixed values: the pre-token pattern of byte-level BPE vocabularies
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
NONE = np.iinfo(np.int64).max
SIDE_BY_SIDE = 128  # size classes up to this many bytes share an array
CELLS = 1 << 20  # leaves per array
CACHE = 300_000  # pre-tokens a worker remembers; a larger vocabulary is merged again, not lost
CHUNK = 1 << 20  # characters of text held as pre-tokens at once


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file: bytes that
    print as themselves in Latin-1, all others in turn from 256 on."""
    shown = [33 <= b <= 126 or 161 <= b <= 172 or b >= 174 for b in range(256)]
    spare = iter(range(256, 512))
    return [chr(b) if shown[b] else chr(next(spare)) for b in range(256)]


@dataclass
class Tables:
    """What encoding and decoding need of a vocabulary; bounded by the vocabulary file."""
    first: np.ndarray  # id of each byte
    pairs: np.ndarray  # left << 32 | right of each merge, ascending
    ranks: np.ndarray
    merged: np.ndarray  # id made by the merge of each rank
    pieces: list[bytes]  # bytes of each id
    special: dict[str, int]

    @classmethod
    def read(cls, path: str) -> Tables:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        symbols = byte_symbols()
        back = {c: b for b, c in enumerate(symbols)}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pieces = [b""] * (1 + max([*vocab.values(), *special.values()]))
        for token, i in vocab.items():
            pieces[i] = bytes(back[c] for c in token)
        for token, i in special.items():
            pieces[i] = token.encode()
        return cls(np.array([vocab[c] for c in symbols], np.int64), keys[order], order.astype(np.int64),
                   np.array([vocab[a + b] for a, b in merges], np.int64), pieces, special)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it has no merge or a side is missing (negative)."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)


def merge_rows(sym: np.ndarray, t: Tables) -> np.ndarray:
    """Merge every row of ``sym`` (ids, -1 after the end; a power of two wide) to its end."""
    rows, n = sym.shape
    tree = np.full((rows, 2 * n), NONE, np.int64)
    places = np.arange(n - 1)
    rank = t.rank(sym[:, :-1], sym[:, 1:])
    tree[:, n:2 * n - 1] = np.where(rank == NONE, NONE, rank * n + places)
    level = n // 2
    while level:
        tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
        level //= 2
    after = np.tile(np.arange(1, n + 1), (rows, 1))
    before = np.tile(np.arange(-1, n - 1), (rows, 1))

    def leaf(row, place, value):
        tree[row, n + place] = value
        node = (n + place) >> 1
        while node[0]:  # all leaves are equally deep
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
            node = node >> 1

    def symbol(row, place):
        there = (place >= 0) & (place < n)
        return np.where(there, sym[row, np.where(there, place, 0)], -1)

    live = np.flatnonzero(tree[:, 1] != NONE)
    while len(live):
        rank, place = np.divmod(tree[live, 1], n)
        gone = after[live, place]
        right = after[live, gone]
        left = before[live, place]
        sym[live, place] = made = t.merged[rank]
        sym[live, gone] = -1
        after[live, place] = right
        inside = right < n
        before[live[inside], right[inside]] = place[inside]
        leaf(live, gone, NONE)
        rank = t.rank(made, symbol(live, right))
        leaf(live, place, np.where(rank == NONE, NONE, rank * n + place))
        inside = left >= 0
        if inside.any():
            row, at = live[inside], left[inside]
            rank = t.rank(sym[row, at], made[inside])
            leaf(row, at, np.where(rank == NONE, NONE, rank * n + at))
        live = live[tree[live, 1] != NONE]
    return sym


def merge_one(ids: list[int], t: Tables, known: dict) -> list[int]:
    """The same on a single tree, for a pre-token of any length."""
    n = 1 << max(1, (len(ids) - 1).bit_length())
    sym, after, before = ids + [-1] * (n - len(ids)), list(range(1, n + 1)), list(range(-1, n - 1))
    last = len(ids)

    def value(i, j):
        rank = known.get((sym[i], sym[j])) if j < last else None
        return NONE if rank is None else rank * n + i

    tree = [NONE] * n + [value(i, i + 1) if i + 1 < last else NONE for i in range(n)]
    for i in range(n - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])
    while tree[1] != NONE:
        rank, i = divmod(tree[1], n)
        j = after[i]
        sym[i], sym[j] = int(t.merged[rank]), -1
        after[i] = after[j]
        if after[i] < last:
            before[after[i]] = i
        changed = [(j, NONE), (i, value(i, after[i]))]
        if before[i] >= 0:
            changed.append((before[i], value(before[i], i)))
        for place, new in changed:
            node = n + place
            tree[node] = new
            while node > 1:
                node >>= 1
                tree[node] = min(tree[2 * node], tree[2 * node + 1])
    return [s for s in sym if s >= 0]


class Encoder:
    """Text to ids; remembers the ids of a bounded number of pre-tokens."""

    def __init__(self, tables: Tables):
        self.t = tables
        self.known = dict(zip(((int(k) >> 32, int(k) & 0xFFFFFFFF) for k in tables.pairs), tables.ranks.tolist()))
        self.pattern = regex.compile(PATTERN)
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(tables.special, key=len, reverse=True))) + ")") \
            if tables.special else None
        self.cache: dict[str, bytes] = {}

    def pre_tokens(self, text: str) -> list[str]:
        """The pre-tokens of a text; special tokens stand alone."""
        if self.special is None or not self.special.search(text):
            return self.pattern.findall(text)
        out = []
        for i, part in enumerate(self.special.split(text)):
            out += [part] if i % 2 else self.pattern.findall(part)
        return out

    def learn(self, tokens: set[str]) -> None:
        """Add the ids (little-endian 32-bit) of new pre-tokens to the cache."""
        if len(self.cache) + len(tokens) > CACHE:
            self.cache.clear()
        cache, t = self.cache, self.t
        classes: dict[int, list[tuple[str, bytes]]] = {}
        for token in tokens:
            if token in t.special:
                cache[token] = np.uint32(t.special[token]).astype("<u4").tobytes()
                continue
            raw = token.encode("utf-8", "surrogatepass")
            size = 1 << max(1, (len(raw) - 1).bit_length())
            if size > SIDE_BY_SIDE:
                ids = merge_one(t.first[np.frombuffer(raw, np.uint8)].tolist(), t, self.known)
                cache[token] = np.array(ids, "<u4").tobytes()
            else:
                classes.setdefault(size, []).append((token, raw))
        for size, members in classes.items():
            step = max(1, CELLS // size)
            for a in range(0, len(members), step):
                some = members[a:a + step]
                lengths = np.array([len(raw) for _, raw in some])
                there = np.arange(size) < lengths[:, None]
                sym = np.full((len(some), size), -1, np.int64)
                sym[there] = t.first[np.frombuffer(b"".join([raw for _, raw in some]), np.uint8)]
                sym = merge_rows(sym, t)
                kept = sym >= 0
                flat = sym[kept].astype("<u4").tobytes()
                ends = (kept.sum(axis=1).cumsum() * 4).tolist()
                at = 0
                for (token, _), end in zip(some, ends):
                    cache[token] = flat[at:end]
                    at = end

    def encode(self, some: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.pre_tokens(x) for x in some]
        new: set[str] = set()
        for tokens in split:
            new.update(tokens)
        new.difference_update(self.cache)
        if new:
            if len(self.cache) + len(new) > CACHE:  # what this chunk needs is learnt whole
                new = set().union(*split)
            self.learn(new)
        return [b"".join(map(self.cache.__getitem__, tokens)) for tokens in split]


def decode_ids(ids: bytes, pieces: list[bytes]) -> str:
    """Text of the ids; bytes that are no UTF-8 become replacement characters."""
    return b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_ENCODERS: dict[int, Encoder] = {}  # of this worker, kept from task to task


def _encoder(shared) -> Encoder:
    key = getattr(shared, "_jbroadcast", None) or id(shared.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value)
    return _ENCODERS[key]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit), decoded (text of these ids).

    The vocabulary tables are broadcast: their size is that of the file at ``path``, which
    only the driver reads. Rows are independent, so there is no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(Tables.read(path))

    def run(batches):
        coder = _encoder(shared)
        for batch in batches:
            sizes = [len(s) for s in batch.column(1).cast(pa.binary()).to_pylist()] if len(batch) else []
            for a, b in in_chunks(sizes, CHUNK):
                ids = coder.encode(batch.column(1).slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(ids, pa.binary()),
                     pa.array([decode_ids(x, coder.t.pieces) for x in ids], pa.string())],
                    names=["doc_id", "ids", "decoded"])

    return texts(docs).mapInArrow(run, "doc_id long, ids binary, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded text."""
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
