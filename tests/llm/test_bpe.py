"""BPE against an existing implementation."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from broadsheet.llm import bpe

PARTS = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "a", "b", "é", "ñ", "1", "2", "'s", "'ll", "'", ".", "!!"]
PARTS += ["漢字", "😀", "\x00", "​", "the", " the", "\r\n", "Ⅷ", "²"]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def other(ranks):
    table = bpe.parse_ranks(ranks)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def texts(n=2000):
    source = random.Random(1)
    out = ["".join(source.choice(PARTS) for _ in range(source.randrange(30))) for _ in range(n)]
    return [*out, "a" * 5000, "ab" * 3000, " " * 700 + "x", "", "'" * 200, "é" * 900]


def test_same_ids(ranks, other):
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.parse_ranks(ranks)), public_tokenizers.PATTERN)
    for text, ids in zip(texts(), encoder.encode(texts())):
        assert np.frombuffer(ids, np.int32).tolist() == other.encode_ordinary(text)


def test_one_tree_and_many_agree(ranks):
    vocabulary = bpe.Vocabulary(bpe.parse_ranks(ranks))
    source = random.Random(2)
    pieces = [bytes(source.choice(b"etaoin shrdlu\xc3\xa9") for _ in range(source.randrange(1, 60))) for _ in range(300)]
    assert bpe.merge_many(pieces, vocabulary) == [bpe.merge_one(p, vocabulary) for p in pieces]


def test_memory_is_bounded(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.parse_ranks(ranks)), public_tokenizers.PATTERN)
    for i in range(50):
        encoder.encode([f"word{i} other{i} the same"])
    assert len(encoder.known_words.young) + len(encoder.known_words.old) < 60


def test_frames(spark, ranks, other):
    rows = [(i, t, "x") for i, t in enumerate(texts(50))] + [(None, "null id", "x"), (7, None, "x"), (7, "again", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    both = bpe.encode(docs, ranks, public_tokenizers.PATTERN, with_decoded=True)
    want = sorted(((d, other.encode_ordinary(t or ""), (t or "").encode()) for d, t, _ in rows), key=str)
    for frame in (bpe.decode(coded, ranks), both):
        got = sorted(((r.doc_id, r.token_ids, bytes(r.decoded)) for r in frame.collect()), key=str)
        assert got == want
    assert bpe.encode(docs.limit(0), ranks, public_tokenizers.PATTERN).count() == 0
    assert bpe.decode(spark.sql("SELECT 1L AS doc_id, CAST(NULL AS array<int>) AS token_ids"), ranks).first().decoded is None
