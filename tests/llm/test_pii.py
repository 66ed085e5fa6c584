"""Personal data against plain patterns."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from broadsheet.llm import pii

PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    doubled = (int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
    return sum(doubled) % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 10 <= len(digits) <= 15


def base(text):
    found = [
        (m.start(), order, m.end(), kind)
        for order, (kind, pattern) in enumerate(PLAIN)
        for m in re.finditer(pattern, text or "")
        if holds(kind, m.group())
    ]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def texts():
    source = random.Random(5)
    parts = ["a@b.c", "x.y+z@mail-1.example.org", "@", ".", "1.2.3.4", "255.255.255.255", "256.1.1.1", "001.2.3.4.5", " ", "-", "+"]
    parts += ["+1 (212) 555-0100", "+44 20 7946 0958", "4111 1111 1111 1111", "4111111111111112", "5500-0000-0000-0004", "7", "0"]
    parts += ["😀", "é", "\n", "word", "(", ")", "_", "%"]
    out = ["".join(source.choice(parts) for _ in range(source.randrange(25))) for _ in range(400)]
    return [*out, None, "", "9" * 3000, "1." * 2000, "a" * 30000 + "@", "a@b" + ".c" * 5000, "a@b.c " * 300, "+1" * 500]


def test_base_spans(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, pii string, _pii_email int")
    only = F.filter("pii", lambda s: s["order"] < pii.BASE)
    found = pii.find(docs).select("doc_id", pii.as_text(only).alias("spans"))
    assert {r.doc_id: r.spans for r in found.collect()} == {d: base(t) for d, t in rows}
    assert pii.find(docs.limit(0)).count() == 0


@pytest.mark.parametrize(
    "text,spans",
    [
        ("pay to DE89370400440532013000 now", "iban:7:29"),
        ("pay to DE89370400440532013001 now", ""),
        ("token = " + "ab" * 20, "secret:8:48"),
        ("noise " + "ab" * 20, ""),
        ("é😀 mail a@b.c", "email:8:13"),
    ],
)
def test_checks_and_context(spark, text, spans):
    docs = spark.createDataFrame([(text,)], "text string")
    assert pii.find(docs).select(pii.as_text("pii")).first()[0] == spans


def test_context_raises_the_score(spark):
    docs = spark.createDataFrame([("card 4111111111111111",), ("this 4111111111111111",)], "text string")
    near, far = (r[0] for r in pii.find(docs).selectExpr("pii[0].score").collect())
    assert near > far


def test_redact(spark):
    rows = [("mail a@b.c or +1 212 555 0100!", "k"), (None, "k"), ("", "k"), ("nothing", "k"), ("+4111111111111111 é", "k")]
    docs = spark.createDataFrame(rows, "text string, pii string")
    done = pii.redact(docs)
    assert done.columns == docs.columns
    assert [r.text for r in done.collect()] == ["mail [EMAIL] or [PHONE]!", None, "", "nothing", "+[CARD] é"]
    assert {r.pii for r in done.collect()} == {"k"}


def test_many_matches_in_one_text(spark):
    """Time grows with the matches, not with their square; columns named like helpers stay."""
    texts = ["a@b.c " * 5000, "1.2.3.4 x@y.z " * 30000]
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, _ip_gap string")
    pii.find(docs.limit(0)).collect()
    begin = time.time()
    found = pii.find(docs).select("doc_id", pii.as_text("pii").alias("spans"), "_ip_gap").collect()
    assert {r.doc_id: r.spans for r in found} == {i: base(t) for i, t in enumerate(texts)} and found[0]._ip_gap == "k"
    done = pii.redact(docs)
    assert [r.text for r in done.collect()] == ["[EMAIL] " * 5000, "[IP] [EMAIL] " * 30000] and done.columns == docs.columns
    assert time.time() - begin < 30


def test_values_of_spans(spark):
    """Kind, order, value and score of every span agree with its place in the text."""
    rows = [(i, t) for i, t in enumerate(texts()) if t and len(t) < 500]
    for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert [(s.start, s.order) for s in r.pii] == sorted((s.start, s.order) for s in r.pii)
        for s in r.pii:
            kind = pii.KINDS[s.order]
            assert (s.kind, s.value) == (kind.name, r.text[s.start : s.end]) and kind.least <= s.score <= 1.0
            around = r.text[max(0, s.start - pii.CONTEXT_CHARS) : s.start], r.text[s.end : s.end + pii.CONTEXT_CHARS]
            if not any(re.search(kind.context, a, re.I) for a in around):
                assert s.score == kind.score


def test_no_python(spark):
    plan = pii.find(spark.createDataFrame([("a",)], "text string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowEvalPython", "Python")
