"""Toxicity on held-out rows, and the counterfactual penalty."""

import numpy as np
import pytest

from broadsheet.llm import toxicity as T
from conftest import TESTDATA


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(str(TESTDATA.parent / "sf0.1/documents.parquet")).repartition(8)
    labels = spark.read.parquet(str(TESTDATA.parent / "sf0.1/labels.parquet"))
    model = T.train(docs, labels)
    held = labels.filter(T.held_out(labels.doc_id))
    rows = T.score(docs.join(held, "doc_id"), model).join(held, "doc_id").select("score", "toxic").toPandas()
    predicted, toxic = rows.score >= T.THRESHOLD, rows.toxic == 1
    assert (predicted & toxic).sum() >= 0.9 * toxic.sum()
    assert (predicted & toxic).sum() >= 0.95 * predicted.sum()


def test_penalty_evens_out_identities():
    """One identity stands in toxic rows by chance of the data; swapped forms take its weight away."""
    source = np.random.default_rng(1)
    own, others, labels = [], [], []
    for _ in range(600):
        toxic = source.random() < 0.5
        group = 0 if source.random() < (0.9 if toxic else 0.1) else 1
        bad = [2] if toxic and source.random() < 0.8 else []
        row = lambda g, bad=bad: np.array([g, *bad], np.int32).tobytes()
        own.append(row(group))
        others.append([row(1 - group)])
        labels.append(float(toxic))
    gap = {}
    for penalty in (0.0, 10.0):
        _, weights = T.fit_weights(np.array(labels), own, others, 3, penalty)
        gap[penalty] = weights[0] - weights[1]
        assert weights[2] > 1
    assert gap[0.0] > 1 and abs(gap[10.0]) < 0.2 * gap[0.0]


def test_counterfactual_pairs_of_the_given_tables(spark):
    """Every labelled row gives pairs; on held-out rows the penalty takes most of the score's change."""
    docs = spark.read.parquet(str(TESTDATA.parent / "sf0.1/documents.parquet")).repartition(8)
    labels = spark.read.parquet(str(TESTDATA.parent / "sf0.1/labels.parquet"))
    held = docs.join(labels.filter(T.held_out(labels.doc_id)), "doc_id").select("text", "toxic").collect()
    change, recall = {}, {}
    for penalty in (0.0, T.PENALTY):
        scorer = T._Scorer(T.train(docs, labels, penalty=penalty))
        linear = lambda t, s=scorer: np.log((p := s.score(t)) / (1 - p))
        forms = [T.counterparts(r.text or "") for r in held]
        assert all(len(f) > 1 for f in forms)
        change[penalty] = np.mean([abs(linear(f[0]) - linear(o)) for f in forms for o in f[1:]])
        caught = [scorer.score(r.text) >= T.THRESHOLD for r in held if r.toxic]
        recall[penalty] = np.mean(caught)
    assert 0 < change[0.0] and change[T.PENALTY] < 0.5 * change[0.0], change
    assert recall[T.PENALTY] >= 0.9, recall


def test_naming():
    assert T.naming("Women here") == "Women here" and len(T.naming("").split()) == 1
    named = T.naming("nothing of the kind")
    assert named != "nothing of the kind" and T.naming(named) == named
    assert all(T._named.search(c) and c != named for c in T.counterparts(named)[1:])


def test_swapped():
    assert T.swapped("Women and muslims, not humans.", 1) == "Men and jews, not humans."


def test_edge_rows(spark):
    rows = [(i, "you idiot" if i % 2 else "fine text", "x") for i in range(200)] + [(None, None, "x"), (900, "", "x"), (900, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(1, None), (None, 1), (5000, 1)], "doc_id long, toxic int")
    model = T.train(docs, labels)
    scores = {r.doc_id: r.score for r in T.score(docs, model).collect()}
    assert len(scores) == 202 and all(0 <= s <= 1 for s in scores.values())
    assert scores[1] > 0.9 and scores[0] < 0.1
    kept = T.reject(docs, model)
    assert kept.columns == docs.columns and 0 in {r.doc_id for r in kept.collect()} and 1 not in {r.doc_id for r in kept.collect()}
    for none in (labels.limit(0), labels.filter("toxic = 1")):
        assert len(T.train(docs, none).features) == 0
    assert T.score(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("text", ["veju vejua vejub", "", None, "a" * 100_000])
def test_scorer_sees_the_features(text):
    found = T.features(text)
    model = T.Model(0.5, found, np.full(len(found), 0.01))
    assert T._Scorer(model).score(text) == pytest.approx(1 / (1 + np.exp(-(0.5 + 0.01 * len(found)))))


def test_words_are_hashed_once_for_many_texts(monkeypatch):
    """New words with a known beginning hash themselves only; small caches change no feature."""
    calls = []
    plain = T._hashed
    monkeypatch.setattr(T, "_hashed", lambda part: calls.append(part) or plain(part))
    for cache in (T._features, T._starts, T._repeats):
        cache.clear()
    texts = [f"beginning{i} beginningless" for i in range(50)]
    kept = [T.features(t).tolist() for t in texts]
    assert len(calls) == 51 + 3
    monkeypatch.setattr(T._features, "most", 1)
    monkeypatch.setattr(T._starts, "most", 1)
    monkeypatch.setattr(T._repeats, "most", 1)
    assert [T.features(t).tolist() for t in texts] == kept
