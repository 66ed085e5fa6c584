"""Registered queries against plain versions, and the pipeline stage by stage."""

import hashlib

import pytest
import tiktoken
import public_tokenizers

import corpus_pipeline
from broadsheet.llm import bpe, decontaminate, pii, queries, toxicity
from conftest import TESTDATA
from test_jaccard import expected as jaccard_expected
from test_pii import base

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="test data not present")
SF = str(TESTDATA)


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def tokens():
    ranks = bpe.parse_ranks(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def digests(text, tokens):
    ids = tokens(text)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_names():
    found = queries.queries()
    assert [sum(name.startswith(f"op{n}_") for name in found) for n in range(1, 14)] == [1] * 13 and "pipeline" in found


def test_bpe(spark, docs, tokens):
    rows = queries.queries()["op3_byte_bpe"](spark, SF).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == {d: digests(t or "", tokens) for d, t in docs.items()}


def test_pii(spark, docs):
    rows = queries.queries()["op5_pii"](spark, SF).collect()
    want = {d: hashlib.sha256(base(t).encode()).hexdigest() for d, t in docs.items()}
    assert {r.doc_id: r.base_sha256 for r in rows} == want


def test_token_counts(spark, docs, tokens):
    """Every column against the edits made on plain strings."""
    spans = {r.doc_id: r.pii for r in pii.find(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    rows = queries.queries()["op8_token_counts"](spark, SF).collect()
    got = {r.doc_id: (r.n_before, r.n_tokens, r.n_edits, r.text_sha256) for r in rows}
    want = {}
    for d, t in docs.items():
        text = t or ""
        for s in reversed(spans[d]):
            text = text[: s.start] + f"[{s.kind.upper()}]" + text[s.end :]
        middle = min(len(t or "") // 2, len(text))
        text = text[:middle] + "\n[edited]\n" + text[middle:]
        want[d] = (len(tokens(t or "")), len(tokens(text)), len(spans[d]) + 1, hashlib.sha256(text.encode()).hexdigest())
    assert got == want and all(0 < r.n_encoded <= r.n_before + 40 * r.n_edits for r in rows)


def test_decontamination(spark, docs):
    """Exact occurrences of whole items are all found."""
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in queries.queries()["op7_decontamination"](spark, SF).collect()}
    want = {(d, i) for d, t in docs.items() for i, item in items.items() if " ".join(item.split()) in " ".join((t or "").split())}
    assert want <= got and want


def test_pipeline(spark, docs, tokens):
    """Every stage against a plain version on what the stage before kept."""
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    current = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = current.columns, dict(docs)
    stages = dict(corpus_pipeline.STAGES)
    rows = stages["toxicity"](spark, current, SF)
    model = toxicity.train(current, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.score(current, model).collect()}
    assert rows.columns == columns
    kept = {d: t for d, t in kept.items() if scores[d] < toxicity.THRESHOLD}
    assert {r.doc_id: r.text for r in rows.collect()} == kept

    rows = stages["ngram_jaccard_join"](spark, rows, SF)
    kept = {d: kept[d] for d, _, c in jaccard_expected(list(kept.items())) if d == c}
    assert rows.columns == columns and {r.doc_id: r.text for r in rows.collect()} == kept

    rows = stages["decontamination"](spark, rows, SF)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    held = decontaminate.Items([i.item_id for i in items], [i.text.encode() for i in items])
    kept = {d: t for d, t in kept.items() if not held.matches((t or "").encode())}
    assert rows.columns == columns and {r.doc_id: r.text for r in rows.collect()} == kept

    spans = {r.doc_id: r.pii for r in pii.find(rows).collect()}
    rows = stages["pii"](spark, rows, SF)
    redacted = {}
    for d, t in kept.items():
        out, at = "", 0
        for s in spans[d]:
            if s.start >= at:
                out += t[at : s.start] + f"[{s.kind.upper()}]"
            at = max(at, s.end)
        redacted[d] = out + t[at:]
    assert rows.columns == columns and {r.doc_id: r.text for r in rows.collect()} == redacted
    assert all(r.n_chars == len(redacted[r.doc_id]) for r in rows.collect())

    want = {d: digests(t, tokens) for d, t in redacted.items()}
    assert {r.doc_id: tuple(r)[1:] for r in stages["byte_bpe"](spark, rows, SF).collect()} == want
    assert {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.run(spark, SF).collect()} == want
