"""Edit-aware counts against counting the edited text anew."""

import random
import time

import public_tokenizers
import pytest
import tiktoken

from broadsheet.llm import bpe, token_counts

PARTS = [" ", "  ", "\n", "\t", "　", "a", "é", "1", "'s", "'ll", "'", "'l", ".", "!!", "漢字", "😀", " the", " word", "\r\n"]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def count(ranks):
    table = bpe.parse_ranks(ranks)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return lambda text: len(own.encode_ordinary(text))


def test_random_edits(ranks, count):
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.parse_ranks(ranks)), public_tokenizers.PATTERN)
    source = random.Random(3)
    some = lambda n: "".join(source.choice(PARTS) for _ in range(source.randrange(n)))
    for turn in range(120):
        text = some(1500 if turn % 3 == 0 else 60)
        tree = token_counts.TokenTree(text, encoder)
        for _ in range(12):
            start = source.randrange(len(text) + 1)
            stop = min(len(text), start + source.choice([0, 1, 2, 5, 40]))
            new = some(source.choice([1, 2, 4, 9, 700]))
            text = text[:start] + new + text[stop:]
            tree.edit(start, stop, new)
            assert tree.text == text and tree.total == count(text)
            assert tree.pieces()[:, 0].tolist() == [len(p) for p in encoder.pieces(text)]


def test_only_the_region_is_encoded(ranks):
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.parse_ranks(ranks)), public_tokenizers.PATTERN)
    tree = token_counts.TokenTree(" word" * 20000, encoder)
    tree.encoded = 0
    tree.edit(50000, 50003, "other")
    assert tree.encoded < 10


def test_many_edits_of_a_long_text(ranks, count):
    """Every edit works on some leaves; a run of letters over many leaves is one pre-token again."""
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.parse_ranks(ranks)), public_tokenizers.PATTERN)
    text = "a@b.c " * 4000
    tree, begin = token_counts.TokenTree(text, encoder), time.time()
    for at in range(6 * 3999, -1, -6):
        tree.edit(at, at + 5, "[EMAIL]")
    assert tree.text == "[EMAIL] " * 4000 and tree.total == count(tree.text) and time.time() - begin < 20
    tree = token_counts.TokenTree("x " * 3000, encoder)
    for at in range(2 * 2999 + 1, 0, -2):
        tree.edit(at, at + 1, "")
    assert tree.text == "x" * 3000 and len(tree.pieces()) == 1 and tree.total == count(tree.text)


def test_frames(spark, ranks, count):
    docs = spark.createDataFrame(
        [(1, "one two three", "x"), (2, None, "x"), (3, "", "x"), (4, "no edits", "x"), (None, "no id", "x")],
        "doc_id long, text string, edits string",
    )
    edits = spark.createDataFrame(
        [(1, 1, 0, 3, "1"), (1, 2, 2, 5, None), (1, 3, 90, 99, " end"), (2, 1, 0, 0, "new"), (9, 1, 0, 0, "none")],
        "doc_id long, seq int, start int, stop int, replacement string",
    )
    edited = token_counts.with_edits(docs, edits)
    first = token_counts.count_edited(edited, ranks, public_tokenizers.PATTERN, with_pieces=True)
    got = {r.doc_id: (r.text, r.n_tokens, r.n_before, r.n_edits) for r in first.collect()}
    want = {1: ("1  three end", "one two three", 3), 2: ("new", "", 1), 3: ("", "", 0), 4: ("no edits",) * 2 + (0,), None: ("no id",) * 2 + (0,)}
    assert got == {d: (after, count(after), count(before), n) for d, (after, before, n) in want.items()}
    again = first.selectExpr("doc_id", "text", "piece_chars", "piece_tokens", "array(struct(0, 0, 'x')) AS edits")
    for r in token_counts.count_edited(again, ranks, public_tokenizers.PATTERN).collect():
        assert r.n_tokens == count(r.text) and r.text.startswith("x")
    assert token_counts.count_edited(again.limit(0), ranks, public_tokenizers.PATTERN).count() == 0
