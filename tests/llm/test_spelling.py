"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from broadsheet.llm import queries, spelling
from conftest import TESTDATA


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(counts, ratio=10):
    by_size = {}
    for w in counts:
        by_size.setdefault(len(w), []).append(w)
    near = {w: [] for w in counts}
    for size, words in by_size.items():
        for i, a in enumerate(words):
            for b in words[i + 1 :] + by_size.get(size + 1, []):
                if (a[: size // 2] == b[: size // 2] or a[size - size // 2 :] == b[len(b) - size // 2 :]) and one_edit(a, b):
                    near[a].append(b)
                    near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def variants(seed, n, letters, size):
    """Words and their edits, and edits of those, with very different counts."""
    source = random.Random(seed)
    counts = {}
    for _ in range(n):
        word = [source.choice(letters) for _ in range(source.randrange(1, size))]
        for step in range(5):
            counts["".join(word)] = int(10 ** source.uniform(0, 5 - step))
            at, kind = source.randrange(len(word) + 1), source.randrange(3)
            word[at : at + (kind > 0)] = [source.choice(letters)] if kind < 2 else []
            word = word or ["q"]
    return counts


@pytest.mark.parametrize("letters,size,large", [("ab", 9, 20), ("abcé😀", 12, 5), ("abcdefgh", 7, 512), ("a", 40, 2)])
def test_all_pairs(spark, monkeypatch, letters, size, large):
    """Blocks that are cut again and again, and tiles that a block crosses."""
    monkeypatch.setattr(spelling, "LARGE_BLOCK", large)
    monkeypatch.setattr(spelling, "TILE", 7)
    counts = variants(len(letters), 120, letters, size)
    words = spark.createDataFrame([(w, n, 1) for w, n in counts.items()], "word string, n long, head int")
    assert found(spelling.group_variants(words)) == expected(counts)


def test_tiles_within_tasks():
    counts = variants(3, 300, "abcd", 8)
    words = sorted(counts)
    tiles = spelling.Tiles(words, [(len(w), 0, 0, 2**31 - 1, "") for w in words])
    pairs = [tuple(sorted((tiles.words[a], tiles.words[b]))) for i, j in tiles.pairs() for a, b in zip(i, j)]
    want = {tuple(sorted((a, b))) for a in words for b in words if len(a) == len(b) and a < b and one_edit(a, b)}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want and tiles.n_tiles > 2


def test_edges(spark):
    long = "x" * 40000
    rows = [("", 5), (None, 5), ("word", None), (long, 1), (long + "y", 20), ("ab", 3), ("ab", 4), ("abc", 70), ("b\0", 1), ("b", 10)]
    words = spark.createDataFrame(rows, "word string, n long")
    assert found(spelling.group_variants(words)) == expected({long: 1, long + "y": 20, "ab": 7, "abc": 70, "b\0": 1, "b": 10})
    assert found(spelling.group_variants(words.limit(0))) == []


def test_one_prefix_holds_many(spark):
    """A third of all words begin alike; blocks stay small and every pair is found."""
    source = random.Random(1)
    counts = {"prefix" + "".join(source.choice("abcde") for _ in range(6)): source.randrange(1, 200) for _ in range(1500)}
    counts |= {"".join(source.choice("abcdefghij") for _ in range(12)): 3 for _ in range(3000)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(spelling.group_variants(words)) == expected(counts)


def counted(docs):
    counts = Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{d}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


@pytest.mark.skipif(not TESTDATA.exists(), reason="test data not present")
def test_query(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").select("doc_id", "text")
    want = expected(counted([tuple(r) for r in docs.collect()]))
    got = queries.queries()["op11_spelling_variants"](spark, str(TESTDATA))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"] and found(got) == want
    assert sum(w[1] is not None for w in want) > 5


def test_letter_runs(spark):
    docs = spark.createDataFrame([(1, "Ünder ABC-abÉ ×÷ x1y"), (2, None), (3, "")], "doc_id long, text string")
    got = [tuple(r) for r in spelling.letter_runs(docs).collect()]
    assert got == [(1, w) for w in ("Ünder", "abc", "abÉ", "×÷", "x", "y")]
    cut = docs.limit(1).select(spelling.without_letter(F.lit("aéb"), F.lit(1)), spelling.without_letter(F.lit("a"), F.lit(0)))
    assert tuple(cut.first()) == ("ab", "")
