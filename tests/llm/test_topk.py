"""Exact top k against all inner products."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import queries, topk
from conftest import TESTDATA

SCHEMA = "vec_id long, embedding array<long>"


def expected(vectors, queries, k):
    out = []
    for q, v in queries:
        scored = [
            (-sum(a * b for a, b in zip(v, w)), c)
            for c, w in vectors
            if c is not None and c != q and w is not None and None not in w
        ]
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("top", [3, 10**4, 10**8])
def test_all_inner_products(spark, top, monkeypatch):
    """Small shards, tiles and blocks, ties, few and many distinct scores; sums of 24, 53 and 62 bits."""
    source = random.Random(top)
    vectors = [(i * 3, [source.randint(-top, top) for _ in range(5)]) for i in range(300)]
    vectors += [(9, [1] * 5), (9, [1] * 5), (10**12, []), (-4, [top]), (-5, None), (None, [1] * 5), (-6, [1, None])]
    monkeypatch.setattr(topk, "PACK_BYTES", 1000)
    monkeypatch.setattr(topk, "LIST_ENTRIES", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 16)
    df = spark.createDataFrame([(*v, "x") for v in vectors], SCHEMA + ", at string").repartition(5)
    asked = [v for v in vectors if v[0] is not None and v[0] % 2 == 0 and v[1] is not None and None not in v[1]]
    got = topk.search(df, df.filter("vec_id % 2 = 0"), 7)
    assert found(got) == expected(vectors, asked, 7)


def test_few_and_none(spark):
    df = spark.createDataFrame([(1, [2]), (2, [3]), (3, [-1])], SCHEMA)
    assert found(topk.search(df, df, 5)) == expected([(1, [2]), (2, [3]), (3, [-1])], [(1, [2]), (2, [3]), (3, [-1])], 5)
    assert found(topk.search(df.limit(1), df.limit(1), 5)) == []
    assert found(topk.search(df.limit(0), df, 5)) == found(topk.search(df, df.limit(0), 5)) == []


def test_equal_vectors_give_the_smallest_ids(spark):
    df = spark.range(20000).select(F.col("id").alias("vec_id"), F.array(F.lit(1), F.lit(2)).cast("array<long>").alias("embedding"))
    got = found(topk.search(df, df.filter("vec_id % 5000 = 0"), 3))
    assert got == [(q, r + 1, c, 5) for q in range(0, 20000, 5000) for r, c in enumerate([x for x in range(4) if x != q][:3])]


def test_scores_beyond_long():
    left = np.array([[2**62, 2**62], [-(2**62), 1]])
    assert topk.products(left, left, 2.0**126).tolist() == [[2**63 - 1, -(2**63 - 1)], [-(2**63 - 1), 2**63 - 1]]


def test_whole(spark):
    rows = [([0.5, -0.001],), ([float("nan")],), ([float("inf")],), ([None],), (None,), ([],), ([1e300],)]
    df = spark.createDataFrame(rows, "v array<double>").select(topk.whole(F.col("v"), 256).alias("w"))
    assert [r.w for r in df.collect()] == [[128, -1], None, None, None, None, [], None]


@pytest.mark.skipif(not TESTDATA.exists(), reason="test data not present")
def test_query(spark):
    rows = spark.read.parquet(f"{TESTDATA}/embeddings.parquet").collect()
    vectors = [(r.vec_id, np.floor(256 * np.array(r.embedding, np.float64)).astype(int).tolist()) for r in rows]
    got = found(queries.queries()["op13_exact_topk"](spark, str(TESTDATA)))
    assert got == expected(vectors, [v for v in vectors if v[0] % 50 == 0], 5)
