"""Substring dedup against all windows."""

import random

import pytest

from broadsheet.llm import substring

SCHEMA = "doc_id long, text string"


def expected(rows, window):
    split = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, words in split:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first[key] = min(d, first.get(key, d))
    out = []
    for d, words in split:
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < d:
                gone.update(range(i, i + window))
        out.append((d, len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    return sorted(out)


def planted(seed, n, spread):
    """Texts of few words with passages of any length that several of them share at any place."""
    source = random.Random(seed)
    passages = [[f"p{k}_{i}" for i in range(source.randrange(8, 40))] for k in range(6)]
    rows = []
    for i in range(n):
        words = [f"w{source.randrange(1000)}" for _ in range(source.randrange(30))]
        for _ in range(source.randrange(3)):
            passage = source.choice(passages)
            start = source.randrange(len(passage))
            at = source.randrange(len(words) + 1)
            words[at:at] = passage[start : start + source.randrange(40)]
        rows.append((i * spread, " ".join(words)))
    return rows


EDGE = [(2, None), (4, ""), (6, "  "), (8, "a b c"), (8, "a " * 30), (8, "a " * 30), (1000, "a " * 14), (1001, "a\x1ca " * 20)]


@pytest.mark.parametrize("rows", [planted(2, 60, 300) + EDGE, []])
def test_matches_all_windows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in substring.remove_repeats(docs).collect())
    assert got == expected(rows, substring.WINDOW)


def test_other_window_and_columns(spark):
    rows = planted(4, 50, 100)
    docs = spark.createDataFrame([(*r, 1, "b") for r in rows], SCHEMA + ", chunk int, body string")
    got = sorted(tuple(r) for r in substring.remove_repeats(docs, window=8).collect())
    assert got == expected(rows, 8)


def test_rows_without_id_come_last(spark):
    text = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(None, text), (5, text), (None, text + " more")], SCHEMA)
    got = sorted(((r.doc_id, r.n_removed) for r in substring.remove_repeats(docs).collect()), key=str)
    assert got == [(5, 0), (None, 20), (None, 20)]


@pytest.mark.parametrize("window", range(2, 20))
def test_every_window_holds_a_whole_block(window):
    size = substring.anchor_size(window)
    for start in range(size):
        assert any(start <= block and block + size <= start + window for block in range(0, window + size, size))
