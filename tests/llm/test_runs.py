"""Periodic runs against their definition."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from broadsheet.llm import queries, runs
from conftest import TESTDATA


def smallest_period(words):
    fail = [0] * (len(words) + 1)
    k = 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = fail[k]
        k += words[i] == words[k]
        fail[i + 1] = k
    return len(words) - fail[len(words)]


def plain_runs(words, least=24, times=3):
    out = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q) and smallest_period(words[i : j + q]) == q:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed, n):
    """Words of small alphabets with planted runs, runs of runs, and runs that touch."""
    source = random.Random(seed)
    out = []
    for _ in range(n):
        words = []
        for _ in range(source.randrange(6)):
            block = [source.choice("abc")[: source.randrange(2) or 1] for _ in range(source.randrange(1, 12))]
            if source.random() < 0.4:
                block = block * source.randrange(1, 6) + [source.choice("abx")]
            words += (block * source.randrange(1, 9))[: source.randrange(1, 90)]
            words += [str(source.randrange(50)) for _ in range(source.choice([0, 0, 5]))]
        out.append(words)
    return out


@pytest.mark.parametrize("least,times", [(24, 3), (6, 3), (10, 4)])
def test_definition(least, times):
    for words in texts(least, 400):
        assert runs.runs_of(words, least, times) == plain_runs(words, least, times), words


def test_no_window_twice_means_no_run():
    import numpy as np

    from broadsheet.llm.windows import word_hashes

    for words in texts(7, 300):
        if len(words) >= 24 and not runs.has_repeats(word_hashes([w.encode() for w in words]), runs.least_prefix(24, 3)):
            assert not plain_runs(words)
    assert not runs.has_repeats(np.arange(3, dtype=np.uint64), 16)


def test_rows(spark):
    rows = [(i, " ".join(w)) for i, w in enumerate(texts(3, 60))]
    rows += [(1000, None), (1001, ""), (1002, " \n\t "), (None, "a " * 30), (1, "a " * 30), (1003, "é\x1cb c " * 9), (1004, "w " * 200000)]
    docs = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, text string, runs int, collapsed string")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.find_runs(docs).collect()), key=str)
    want = []
    for d, t in rows:
        words = [w.decode() for w in (t or "").encode().split()]
        found = [(0, 200000, 1)] if d == 1004 else plain_runs(words)
        want.append((d, len(words), found, plain_collapse(words, found)))
    assert got == sorted(want, key=str)
    assert runs.find_runs(docs.limit(0)).count() == 0


def test_very_long_text():
    words = [f"w{i % 1000}" for i in range(100000)] + ["x"] + ["a", "b"] * 50000
    assert runs.runs_of(words) == [(0, 100000, 1000), (100001, 100000, 2)]


def test_longest(spark):
    some = [[(0, 30, 10), (2, 33, 11), (40, 24, 2)], [(0, 30, 10), (50, 90, 30)], []]
    df = spark.createDataFrame([(s,) for s in some], "runs array<struct<start:long,length:long,period:long>>")
    got = [r[0] and tuple(r[0]) for r in df.select(runs.longest(F.col("runs"))).collect()]
    assert got == [(40, 24, 2), (0, 30, 10), None]


def planted(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


@pytest.mark.skipif(not TESTDATA.exists(), reason="test data not present")
def test_query(spark, tmp_path):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").select("doc_id", "text").collect()
    docs = [tuple(r) for r in docs if len(r.text or "") < 6000] + [(i, t) for i in range(10**6, 10**6 + 40) for t in (None, "", "a b")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for d, t in docs:
        words = planted(d, t)
        found = plain_runs(words)
        top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        milli = 1000 * top[1] // top[2] if found else None
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
        want.append((d, len(found), *top, milli, sha(lines), sha(plain_collapse(words, found))))
    got = [tuple(r) for r in queries.queries()["op12_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(w[1] > 0 for w in want) > 10
