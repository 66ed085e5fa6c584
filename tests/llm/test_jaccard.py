"""N-gram Jaccard join against all pairs."""

import random

import pytest

from broadsheet.llm import jaccard
from broadsheet.llm.components import components

SCHEMA = "doc_id long, text string"


def shingles(text):
    words = (text or "").encode().lower().split()
    size = min(jaccard.SHINGLE, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (doc_id, _), g in zip(rows, group):
        least[g] = min(doc_id, least.get(g, doc_id))
    return sorted((d, len(s), least[g]) for (d, _), s, g in zip(rows, sets, group))


def near_copies(seed, n, words=60):
    """Texts that differ from a few originals in a few words, so that many pairs are near the limit."""
    source = random.Random(seed)
    originals = [[f"w{source.randrange(400)}" for _ in range(words)] for _ in range(4)]
    rows = []
    for i in range(n):
        text = list(originals[i % 4])
        for _ in range(source.randrange(5)):
            text[source.randrange(len(text))] = f"x{source.randrange(50)}"
        rows.append((i * 37, " ".join(text[source.randrange(3) :])))
    return rows


EDGE = [
    (5, None), (6, ""), (7, " \t\n "), (8, "one two"), (9, "ONE  two"), (10, "two one"), (11, "one"),
    (12, "a b c d e f g h"), (12, "a b c d e f g h"), (13, "A B C D E F G H"), (14, "é b c d e"), (15, "É b c d e"),
]


@pytest.mark.parametrize("rows", [near_copies(2, 60) + EDGE, []])
def test_matches_all_pairs(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(tuple(r) for r in jaccard.link_documents(docs).collect()) == expected(rows)


def test_pools_larger_than_a_tile(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    rows = near_copies(3, 150, 40)
    assert sorted(tuple(r) for r in jaccard.link_documents(spark.createDataFrame(rows, SCHEMA)).collect()) == expected(rows)


def test_rows_without_id_far_chunks_and_other_columns(spark):
    rows = [(None, "a b c d e f", 1, "x"), (3 << 40, "a b c d e f", 1, "x"), (None, "z y x w v u t", 1, "x")]
    docs = spark.createDataFrame(rows, SCHEMA + ", chunk long, body string")
    got = sorted((tuple(r) for r in jaccard.link_documents(docs).collect()), key=str)
    assert got == [(3 << 40, 2, 3 << 40), (None, 2, 3 << 40), (None, 3, None)]


def test_keep_one(spark):
    rows = near_copies(5, 40) + EDGE
    docs = spark.createDataFrame([(*r, "kept") for r in rows], SCHEMA + ", component_id string")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    want = sorted({(d, c) for d, _, c in expected(rows) if d == c})
    assert sorted((r.doc_id, r.doc_id) for r in kept.collect()) == want


def test_bitmaps_bound_the_overlap():
    import numpy as np

    source = np.random.default_rng(1)
    sets = [np.unique(source.integers(0, 500, 80, dtype=np.uint64)) for _ in range(30)]
    maps = jaccard.bitmaps(sets, 256)
    for i in range(30):
        for j in range(30):
            both = len(np.intersect1d(sets[i], sets[j]))
            assert len(sets[i]) - int(np.bitwise_count(maps[i] & ~maps[j]).sum()) >= both


def test_components(spark):
    source = random.Random(0)
    edges = [(source.randrange(60), source.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)]
    label = {n: n for e in edges for n in e}
    for _ in range(100):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: c for n, c in label.items() if any(a != b and n in (a, b) for a, b in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
