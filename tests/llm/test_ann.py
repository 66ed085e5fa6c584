"""Nearest neighbours against all inner products."""

import numpy as np
import pytest

from broadsheet.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def brute(vectors, query, k):
    scores = {i: float(np.dot(np.array(v, float), np.array(vectors[query], float))) for i, v in vectors.items() if i != query}
    return sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]


def make(n, seed=1):
    source = np.random.default_rng(seed)
    centres = source.normal(size=(12, 16))
    values = np.where(np.arange(n)[:, None] % 3 == 0, source.normal(size=(n, 16)), centres[np.arange(n) % 12] + source.normal(0, 0.05, (n, 16)))
    return {i: [float(x) for x in np.float32(v * source.uniform(0.5, 2))] for i, v in enumerate(values)}


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "BUCKET_NODES", 400)
    monkeypatch.setattr(ann, "ROUNDS", 3)
    vectors = make(1500)
    frame = spark.createDataFrame(list(vectors.items()), SCHEMA)
    rows = ann.nearest(frame, frame.filter("vec_id % 50 = 0"), 10).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {i for i in vectors if i % 50 == 0}
    hits = 0
    for query, found in got.items():
        want = brute(vectors, query, 10)
        hits += len({i for i, _ in want} & {i for i, _ in found})
        assert len(found) == 10 and found == sorted(found, key=lambda x: (-x[1], x[0]))
        for i, score in found:
            assert score == pytest.approx(float(np.dot(np.array(vectors[i]), np.array(vectors[query]))), abs=1e-9)
    assert hits >= 0.95 * 10 * len(got)


def test_equal_vectors_and_what_takes_no_part(spark):
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(300, [0.0, 1.0]), (301, [-1.0, 0.0])]
    rows += [(400, None), (401, [0.0, 0.0]), (402, [float("nan"), 1.0]), (403, [float("inf"), 1.0]), (404, [None, 1.0]), (405, [1.0])]
    rows += [(None, [1.0, 1.0])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", score string")
    got = {}
    for r in ann.nearest(frame, frame.filter("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert set(got) == {i for i in range(0, 301, 20)}
    for query, found in got.items():
        want = [i for i, _ in brute({i: v for i, v in rows[:302]}, query, 20)]
        assert [i for _, i in sorted(found)] == want


def test_few_rows(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 1.0]), (2, [0.5, 0.0])], SCHEMA)
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in ann.nearest(few, few.filter("vec_id = 0"), 20).collect())
    assert got == [(0, 1, 1), (0, 2, 2)]
    assert ann.nearest(few.limit(0), few, 20).count() == 0


@pytest.mark.parametrize("factor", [1e4, 1e7])
def test_few_very_long_vectors(spark, monkeypatch, factor):
    """A few vectors that are much longer than the rest cost the others nothing, and are found."""
    monkeypatch.setattr(ann, "BUCKET_NODES", 400)
    monkeypatch.setattr(ann, "ROUNDS", 3)
    vectors = make(1500)
    for i in (3, 700, 701, 1203):
        vectors[i] = [x * factor for x in vectors[i]]
    frame = spark.createDataFrame(list(vectors.items()), SCHEMA)
    got = {}
    for r in ann.nearest(frame, frame.filter("vec_id % 50 = 0"), 10).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    wanted = {q: {i for i, _ in brute(vectors, q, 10)} for q in vectors if q % 50 == 0}
    assert sum(len(got[q] & want) for q, want in wanted.items()) >= 0.95 * 10 * len(wanted)
    long = {3, 700, 701, 1203}
    assert all(got[q] >= want & long for q, want in wanted.items())


def test_recall_of_the_query(spark):
    """The registered query at its own settings, against all inner products."""
    from broadsheet.llm import queries

    sf = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").toArrow()
    ids, values = table["vec_id"].to_numpy(), np.array(table["embedding"].to_pylist(), float)
    got = {}
    for r in queries.op1_nearest_neighbours(spark, sf).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for query, found in got.items():
        scores = values @ values[ids == query][0]
        order = [int(i) for i in ids[np.lexsort((ids, -scores))] if i != query][:20]
        hits += len(found & set(order))
    assert hits >= 0.95 * 20 * len(got)
