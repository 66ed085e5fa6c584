"""Chunking, embedding and the searches, against brute force."""

import math
import re
from collections import Counter, defaultdict
from datetime import datetime

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from broadsheet.functions import text as X
from broadsheet.operators import chunks as C
from broadsheet.operators import search as R
from broadsheet.plans import retrieval
from broadsheet.schemas import CHUNK_DOCUMENTS
from broadsheet.sources import tables as S
from conftest import TESTDATA

ARTICLE = (
    "row_id string, url string, date_published timestamp, date_modified timestamp, "
    "title string, author string, tags array<string>, content array<string>"
)


def articles(spark, *contents):
    rows = [(f"r{i}", f"u{i}", None, None, "t", "a", ["x"], c) for i, c in enumerate(contents)]
    return spark.createDataFrame(rows, ARTICLE)


relaxed = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
words = st.text(alphabet="ab \n\té漢", max_size=40)


@relaxed
@given(st.lists(words, max_size=4), st.integers(1, 7), st.data())
def test_chunks_by_brute_force(spark, content, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    text = " ".join(content)
    tokens = re.findall(r"[ \t\n\f\r]*[^ \t\n\f\r]+", text)
    wanted = ["".join(tokens[i : i + size]) for i in range(0, len(tokens), size - overlap)]
    got = C.chunk_tokens(articles(spark, content), size, overlap).orderBy("chunk_no").collect()
    assert [r.chunk for r in got] == wanted
    assert [r.chunk_no for r in got] == list(range(len(wanted)))
    if overlap == 0:
        assert "".join(r.chunk for r in got) == text.rstrip(" \t\n\f\r")


def test_chunk_sizes(spark):
    df = articles(spark, [" ".join(map(str, range(801)))], [], None)
    got = C.chunk_tokens(df).orderBy("chunk_no").collect()
    assert [len(r.chunk.split()) for r in got] == [400, 400, 101]
    # The last window may hold nothing but overlap.
    assert len(C.chunk_tokens(articles(spark, [" ".join("x" * 360)])).collect()) == 2
    for size, overlap in ((0, 0), (5, 5), (5, -1)):
        with pytest.raises(ValueError):
            C.chunk_tokens(df, size, overlap)


def test_chunks_of_an_encoder(spark):
    class Bytes(C.Codec):  # local, so that it travels to the workers by value
        def encode(self, text):
            return list(text.encode("utf-8"))

        def decode(self, ids):
            return bytes(ids).decode("utf-8", errors="replace")

    df = articles(spark, ["abcdefghij"], ["漢字"], [], None)
    got = C.chunk_encoded(df, Bytes, 4, 1).orderBy("row_id", "chunk_no").collect()
    assert [r.chunk for r in got if r.row_id == "r0"] == ["abcd", "defg", "ghij", "j"]
    # More ids than characters: the bound is the number of ids, so nothing is lost.
    assert len([r for r in got if r.row_id == "r1"]) == 2
    assert {r.row_id for r in got} == {"r0", "r1"}


def test_skip_reasons(spark):
    df = articles(spark, ["a"], [], None, ["", "  "], [" 　\x1f\x0b"], ["​"])
    usable, skipped = C.skip_blank(df)
    assert {r.row_id for r in usable.collect()} == {"r0", "r5"}
    assert {r.row_id: r.skip_reason for r in skipped.collect()} == {
        "r1": "missing", "r2": "missing", "r3": "blank", "r4": "blank",
    }


def test_ingest_and_report(spark):
    df = articles(spark, ["one two"], ["three"], [], [" "])
    empty = spark.createDataFrame([], CHUNK_DOCUMENTS)
    merged, report = retrieval.ingest(df, empty, C.hashing_embedder(8), 8)
    assert report.first().asDict() == dict(fetched=4, processed=2, failed=0, skipped=2, chunks=2, unaccounted=0)
    assert [f.name for f in merged.schema] == CHUNK_DOCUMENTS.fieldNames()
    again, _ = retrieval.ingest(df, merged, C.hashing_embedder(8), 8)
    assert {r.id for r in again.collect()} == {"r0_0", "r1_0"} and again.count() == 2
    assert {r.row_id for r in C.distinct_row_ids(merged).collect()} == {"r0", "r1"}
    assert C.distinct_row_id_count(merged, approximate=True).first().n_articles == 2
    failed = df.filter("row_id = 'r1'")
    _, skipped = C.skip_blank(df)
    part = merged.filter("id = 'r0_0'")
    assert C.ingest_report(df, part, skipped, failed).first().failed == 1
    assert [r.row_id for r in C.unaccounted_ids(df, part, skipped).collect()] == ["r1"]


def test_bad_metadata_is_left_out(spark):
    rows = [("1", '{"row_id": "a"}'), ("2", "{broken"), ("3", '{"row_id": ""}'), ("4", "{}"), ("5", None)]
    df = spark.createDataFrame(rows, "id string, metadata string")
    assert [r.row_id for r in C.distinct_row_ids(df).collect()] == ["a"]


def test_upsert_documents(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "1")], "id string, content string")
    new = spark.createDataFrame([("b", "2"), ("c", "2"), ("c", "2")], "id string, content string")
    got = C.upsert_documents(old, new)
    assert sorted(map(tuple, got.collect())) == [("a", "1"), ("b", "2"), ("c", "2")]


def test_wrong_vector_shape_fails(spark):
    with pytest.raises(Exception, match="expected vectors of shape"):
        C.embed_chunks(spark.createDataFrame([("a",)], "content string"), C.hashing_embedder(4), 5).collect()


@pytest.fixture
def picky():
    """Refuses every batch that holds a text with an x; a y gives a vector that is not finite."""

    def embed(texts):
        if any("x" in t for t in texts):
            raise RuntimeError(f"no {len(texts)}")
        return [[float("nan") if "y" in t else len(t), 1.0] for t in texts]

    return embed


@pytest.mark.parametrize("texts", [[], ["x"], ["a", "x"], ["x"] * 5, ["a", "by", "cx", None, "", "d"] * 7])
def test_failing_texts_stand_alone(spark, picky, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, content string").coalesce(1)
    rows = C.embed_apart(df.withColumn("failure", F.lit("old")), picky, 2).orderBy("id").collect()
    assert len(rows) == len(texts)
    for row, text in zip(rows, (t or "" for t in texts)):
        if "x" in text:
            assert row.dense_vector is None and row.failure == "RuntimeError: no 1"
        elif "y" in text:
            assert row.dense_vector is None and "finite" in row.failure
        else:
            assert row.dense_vector == [len(text), 1.0] and row.failure is None


def test_bad_texts_cost_few_calls(picky):
    calls = []

    def embed(texts):
        calls.append(len(texts))
        return picky(texts)

    vectors, reasons = C._embed_parts(["a"] * 300 + ["x"] + ["a"] * 211, embed, 2)
    assert sum(r is not None for r in reasons) == 1 and len(calls) == 1 + 2 * 9


def test_wrong_shape_is_not_set_apart(spark, picky):
    with pytest.raises(Exception, match="expected vectors of shape"):
        C.embed_apart(spark.createDataFrame([("a",)], "content string"), picky, 3).collect()


def test_failed_articles_are_reported_and_kept_apart(spark, picky, tmp_path):
    df = articles(spark, ["one two"], ["three x"], [" "], ["four"])
    df = df.withColumn("date_modified", F.lit("2024-01-05 00:00:00").cast("timestamp"))
    path, apart = str(tmp_path / "c"), str(tmp_path / "q")
    window = datetime(2024, 1, 1), datetime(2024, 1, 31)
    first = retrieval.load_collection(spark, df, path, picky, 2, *window, quarantine_path=apart).first()
    assert first.asDict() == dict(fetched=4, processed=2, failed=1, skipped=1, chunks=2, unaccounted=0)
    held = S.load_table(spark, apart, C.QUARANTINE).collect()
    assert [(r.id, r.row_id, r.content, r.failure) for r in held] == [("r1_0", "r1", "three x", "RuntimeError: no 1")]
    mended = retrieval.load_collection(spark, df, path, lambda t: [[1.0, 1.0]] * len(t), 2, *window, quarantine_path=apart)
    assert mended.first().failed == 0 and S.load_table(spark, path, CHUNK_DOCUMENTS).count() == 3
    assert S.load_table(spark, apart, C.QUARANTINE).count() == 0


# --- dense ---


def vectors(spark, array, name):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(array)]
    return spark.createDataFrame(rows, f"{name} bigint, dense_vector array<float>")


def exact(docs, queries, k):
    def unit(a):
        n = np.linalg.norm(a, axis=1, keepdims=True)
        return a / np.where(n == 0, 1, n)

    scores = np.round(unit(queries.astype(np.float64)) @ unit(docs.astype(np.float64)).T, 6)
    return {
        (q, int(d), rank + 1)
        for q in range(len(queries))
        for rank, d in enumerate(np.lexsort((np.arange(len(docs)), -scores[q]))[:k])
    }


@pytest.fixture(scope="module")
def space():
    rng = np.random.default_rng(3)
    docs = rng.standard_normal((900, 16)).astype(np.float32)
    docs[300:600] = docs[0]  # a third are copies of one
    docs[5] = 0
    return docs, np.vstack([docs[0], rng.standard_normal((11, 16)), np.zeros((1, 16))]).astype(np.float32)


def triples(df):
    return {(r.query_id, r.id, r.rank) for r in df.collect()}


@pytest.mark.parametrize("max_broadcast", [4096, 0])
def test_dense_topk_is_exact(spark, space, max_broadcast, monkeypatch):
    monkeypatch.setattr(R, "TILE_ROWS", 100)
    docs, queries = space
    df = vectors(spark, docs, "id").repartition(5)
    got = R.dense_topk(df, vectors(spark, queries, "query_id"), 7, 16, max_broadcast=max_broadcast)
    assert triples(got) == exact(docs, queries, 7)


def test_other_dimensions_are_left_out(spark):
    df = spark.createDataFrame([("a", [1.0]), ("b", [1.0, 0.0]), ("c", None)], "id string, dense_vector array<float>")
    asked = spark.createDataFrame([("q", [1.0, 1.0])], "query_id string, dense_vector array<float>")
    assert [(r.id, r.score) for r in R.dense_topk(df, asked, 5, 2).collect()] == [("b", 0.707107)]


def test_lsh_recall(spark, space):
    docs, queries = space
    df, asked = vectors(spark, docs, "id").repartition(5), vectors(spark, queries[:12], "query_id")
    index = R.lsh_index(df, 16, tables=24, bits=4)
    found = R.dense_topk_lsh(index, asked, 10, 16, tables=24, bits=4)
    wanted = R.dense_topk(df, asked, 10, 16)
    assert R.recall(found, wanted).first().recall >= 0.9
    # What it finds is scored exactly.
    exact_scores = {(r.query_id, r.id): r.score for r in R.dense_topk(df, asked, 900, 16).collect()}
    assert all(exact_scores[(r.query_id, r.id)] == r.score for r in found.collect())


# --- lexical ---

TEXTS = ["the cat sat", "The dog, the cat!", "", "a dog", "éa ÉA the", "the the the the"] * 30 + ["rare cat"]
ASKED = ["the cat", "cat cat dog", "éa", "missing", "", "rare the"]


def bm25(texts, asked, k):
    docs = [re.findall(r"[^\W_]+", t.lower()) for t in texts]
    n, mean = len(docs), sum(map(len, docs)) / len(docs)
    df = Counter(t for d in docs for t in set(d))
    out = {}
    for q, text in enumerate(asked):
        scores = defaultdict(float)
        for term in re.findall(r"[^\W_]+", text.lower()):
            if term in df:
                idf = math.log(1 + (n - df[term] + 0.5) / (df[term] + 0.5))
                for i, d in enumerate(docs):
                    tf = d.count(term)
                    if tf:
                        scores[i] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
        best = sorted(((round(s, 6), i) for i, s in scores.items()), key=lambda x: (-x[0], x[1]))[:k]
        out |= {(q, i, r + 1): s for r, (s, i) in enumerate(best)}
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, content string").repartition(4)
    asked = spark.createDataFrame(list(enumerate(ASKED)), "query_id bigint, text string")
    return texts, asked


@pytest.mark.parametrize("way", ["block", "small join", "large join", "scan", "large scan"])
def test_bm25_by_brute_force(spark, corpus, way, monkeypatch):
    if way in ("small join", "large scan"):
        monkeypatch.setattr(R, "BLOCK_CELLS", 0)
    if way.endswith("scan"):
        hits = R.bm25_scan(*corpus, 4)
    else:
        hits = R.bm25_topk(R.bm25_index(corpus[0]), corpus[1], 4, max_broadcast=0 if way == "large join" else 1000)
    got = {(r.query_id, r.id, r.rank): r.score for r in hits.collect()}
    assert got == pytest.approx(bm25(TEXTS, ASKED, 4), abs=2e-6)


def test_scan_without_hits(spark, corpus):
    nothing = spark.createDataFrame([(1, "zzz"), (2, "")], "query_id bigint, text string")
    assert R.bm25_scan(corpus[0], nothing).count() == 0
    assert R.bm25_scan(corpus[0], nothing.filter("query_id = 2")).count() == 0
    assert R.bm25_scan(corpus[0].limit(0), corpus[1]).count() == 0
    assert R.bm25_topk(R.bm25_index(corpus[0]), nothing).count() == 0


def test_stored_index(spark, corpus, tmp_path):
    retrieval.publish_index(spark, corpus[0], "stored_test", str(tmp_path), buckets=3)
    hits = R.bm25_topk(R.load_bm25_index(spark, "stored_test"), corpus[1], 4)
    assert {(r.query_id, r.id, r.rank) for r in hits.collect()} == set(bm25(TEXTS, ASKED, 4))


def test_buckets_of_a_stored_index_follow_the_texts(spark, corpus, tmp_path, monkeypatch):
    monkeypatch.setattr(retrieval, "BUCKET_TEXT", 20)
    assert retrieval.buckets_for(corpus[0], 3) > 3
    retrieval.publish_index(spark, corpus[0], "grown_test", str(tmp_path), buckets=3)
    made = spark.sql("DESCRIBE EXTENDED grown_test_postings").filter("col_name = 'Num Buckets'").first()["data_type"]
    assert int(made) == retrieval.buckets_for(corpus[0], 3)
    hits = R.bm25_topk(R.load_bm25_index(spark, "grown_test"), corpus[1], 4)
    assert {(r.query_id, r.id, r.rank) for r in hits.collect()} == set(bm25(TEXTS, ASKED, 4))


def test_postings_are_not_shuffled(spark, corpus):
    plan = R.bm25_index(corpus[0]).postings._jdf.queryExecution().executedPlan().toString()
    # One exchange spreads the texts (the fixture's own aside); none moves terms.
    assert "hashpartitioning(term" not in plan and plan.count("REPARTITION_BY_COL") == 1
    assert plan.count("regexp_extract_all") == 1


def ranked(spark, rows):
    return spark.createDataFrame(rows, "query_id bigint, id string, rank int")


def test_rrf(spark):
    one = ranked(spark, [(1, "a", 1), (1, "b", 2), (2, "a", 1)])
    two = ranked(spark, [(1, "b", 1), (1, "c", 2)])
    got = [tuple(r) for r in R.rrf_fuse([one, two]).orderBy("query_id", "rank").collect()]
    assert got == [
        (1, "b", round(1 / 102 + 1 / 101, 9), 1),
        (1, "a", round(1 / 101, 9), 2),
        (1, "c", round(1 / 102, 9), 3),
        (2, "a", round(1 / 101, 9), 1),
    ]
    assert set(map(tuple, R.rrf_fuse([two, one]).collect())) == set(got)
    heavy = R.rrf_fuse([one, two], weights=[1.0, 0.0]).filter("query_id = 1 AND rank = 1").first()
    assert heavy.id == "a"


def test_search_modes(spark, corpus):
    texts, asked = corpus
    embed = C.hashing_embedder(32)
    documents = C.embed_chunks(texts, embed, 32).withColumn("metadata", F.struct(F.col("id").cast("string").alias("url")))
    questions = C.embed_chunks(asked, embed, 32, content_col="text")
    index = R.bm25_index(texts)
    for mode in (R.KEYWORD, R.CONTEXTUAL, R.HYBRID):
        hits = R.search_mode(mode, documents, index, questions, dimension=32)
        unindexed = R.search_mode(mode, documents, None, questions, dimension=32)
        assert set(hits.collect()) == set(unindexed.collect())
        assert hits.columns == ["query_id", "id", "score", "rank"]
        per_query = Counter(r.query_id for r in hits.collect())
        assert max(per_query.values()) == 5
        assert R.attach_documents(hits, documents).count() == sum(per_query.values())
    with pytest.raises(ValueError):
        R.search_mode("other", documents, index, questions)


def test_first_hit_per_url(spark):
    meta = "metadata struct<url:string,author:string,date_published:string,tags:array<string>>"
    rows = [(1, f"u{n}_{c}", rank, (f"u{n}", "a", "d", ["x"])) for rank, (n, c) in enumerate([(1, 0), (2, 0), (1, 1), (3, 0)], 1)]
    df = spark.createDataFrame(rows, f"query_id bigint, id string, rank int, {meta}")
    got = R.dedup_hits_by_url(df).orderBy("rank").collect()
    assert [(r.rank, r.url) for r in got] == [(1, "u1"), (2, "u2"), (4, "u3")]


def test_tokens_give_the_text_back(spark):
    df = spark.createDataFrame([(" a  b\n\tc d e ",), ("",)], "t string")
    joined = df.select(F.array_join(X.tokenize(F.col("t")), "")).collect()
    assert [r[0] for r in joined] == [" a  b\n\tc d e", ""]


def test_lexical_forms_agree_on_repeated_ids_and_missing_texts(spark):
    rows = [(1, "red fox"), (1, "red hen"), (2, "red red dog"), (3, None), (4, "blue fox"), (4, "blue fox"), (5, "")]
    docs = spark.createDataFrame(rows, "id long, content string")
    asked = spark.createDataFrame([(1, "red fox"), (2, "blue blue hen")], "query_id long, text string")
    once = spark.createDataFrame(
        [(1, "red fox red hen"), (2, "red red dog"), (3, ""), (4, "blue fox blue fox"), (5, "")], "id long, content string"
    )
    rank = lambda hits: sorted((r.query_id, r["rank"], r.id, r.score) for r in hits.collect())
    want = rank(R.bm25_topk(R.bm25_index(once), asked, 5))
    assert want
    assert rank(R.bm25_topk(R.bm25_index(docs), asked, 5)) == want
    assert rank(R.bm25_topk(R.bm25_index(docs), asked, 5, max_broadcast=0)) == want
    assert rank(R.bm25_scan(docs, asked, 5)) == want


def test_lsh_answers_do_not_depend_on_the_number_of_queries(spark, space, monkeypatch):
    df, asked = vectors(spark, space[0], "id"), vectors(spark, space[1][:12], "query_id")
    index = R.lsh_index(df, 16, tables=4, bits=4)
    hits = lambda: sorted(map(tuple, R.dense_topk_lsh(index, asked, 5, 16, tables=4, bits=4).collect()))
    whole = hits()
    monkeypatch.setattr(R, "MAX_BROADCAST_QUERIES", 2)
    assert hits() == whole


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_lsh_recall_of_the_registered_queries(spark, scale):
    path = TESTDATA.parent / scale
    if not path.exists():
        pytest.skip("test data not present")
    assert E.queries()["dense_recall"](spark, str(path)).first().recall >= 0.9
    hits = Counter(r.query_id for r in E.queries()["dense_topk_lsh"](spark, str(path)).collect())
    assert hits and set(hits.values()) == {10}


def test_lsh_fills_up_to_k_whatever_the_partitions(spark, space):
    docs, queries = space
    asked = vectors(spark, queries, "query_id")
    few = vectors(spark, docs[:8], "id")
    assert triples(R.dense_topk_lsh(R.lsh_index(few, 16), asked, 10, 16)) == exact(docs[:8], queries, 10)
    answers = []
    for parts in (1, 7):
        index = R.lsh_index(vectors(spark, docs, "id").repartition(parts), 16)
        found = triples(R.dense_topk_lsh(index, asked, 10, 16))
        assert len(found) == 10 * len(queries)
        answers.append(found)
    assert answers[0] == answers[1]
    # A query of zeros scores nought everywhere: the smallest ids, as in the exact search.
    zero = len(queries) - 1
    assert {t for t in answers[0] if t[0] == zero} == {t for t in exact(docs, queries, 10) if t[0] == zero}
