"""BPE and token counts against the public libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from placeflow.llm import bpe, token_counts

ALPHABET = "ab  \n\t'stvé中文字١２ ﷽ \x1c\x1f\x85\xa0 ​!?<|endoftext|>012😀\x00ßñ▁"


def random_texts(n=1500):
    rng = random.Random(1)
    some = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return some + ["a" * 5000, " " * 3000, "<|endoftext|><|endoftext|> x<|endoftext|>", "it's we'll 'S  ",
                   "aaaaabaaabaab" * 300, "\n" * 50, "", "▁", " ▁ ▁▁a", "\n ", " \n"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def test_ids_and_decoding_equal_the_library(library):
    coder = bpe.Encoder(bpe.Tables.read(P.path("byte_bpe_50k.json")))
    texts = random_texts()
    for text, ids, ref in zip(texts, coder.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == ref.ids, text
        assert bpe.decode_ids(ids, coder.t.pieces) == library.decode(ref.ids, skip_special_tokens=False)


def test_side_by_side_and_single_tree_agree():
    t = bpe.Tables.read(P.path("byte_bpe_50k.json"))
    coder = bpe.Encoder(t)
    rng = random.Random(2)
    for _ in range(200):
        raw = bytes(rng.choice(b"abcdeth ing") for _ in range(rng.randint(1, 64)))
        size = 1 << max(1, (len(raw) - 1).bit_length())
        sym = np.full((1, size), -1, np.int64)
        sym[0, :len(raw)] = t.first[np.frombuffer(raw, np.uint8)]
        row = bpe.merge_rows(sym, t)[0]
        assert row[row >= 0].tolist() == bpe.merge_one(t.first[np.frombuffer(raw, np.uint8)].tolist(), t, coder.known)


def test_small_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 5)
    coder = bpe.Encoder(bpe.Tables.read(P.path("byte_bpe_50k.json")))
    for text in random_texts(50):
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_encode_rows(spark, odd_docs, odd_rows, no_docs, library):
    rows = bpe.digests(bpe.encode(odd_docs, P.path("byte_bpe_50k.json"))).collect()
    want = []
    for doc_id, text, *_ in odd_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert bpe.encode(no_docs, P.path("byte_bpe_50k.json")).count() == 0


def test_pieces_of_pre_tokens_add_up(pieces):
    counter = token_counts.PieceCounter(open(P.path("piece_bpe_32k.model"), "rb").read())
    for text in random_texts():
        assert sum(counter.count(token_counts.pre_tokens(text))) == len(pieces.encode(text)), repr(text)


@pytest.mark.parametrize("head", [0, 3, 1 << 18])
def test_token_counts(odd_docs, odd_rows, no_docs, pieces, head):
    got = token_counts.token_counts(odd_docs, P.path("piece_bpe_32k.model"), head=head).collect()
    want = [(d, len((t or "").encode()), len(pieces.encode(t or ""))) for d, t, *_ in odd_rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_counts.token_counts(no_docs, P.path("piece_bpe_32k.model")).count() == 0


def test_token_counts_of_documents(small_docs, pieces):
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(small_docs, P.path("piece_bpe_32k.model"), head=500).collect()}
    assert got == {r["doc_id"]: len(pieces.encode(r["text"])) for r in small_docs.collect()}
