from itertools import product
from urllib.parse import urljoin

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from broadsheet.functions import urls as U

BASES = [
    "https://blog.example.com/c1/post-5/",
    "https://blog.example.com/c1/post-5",
    "https://blog.example.com",
    "https://blog.example.com/",
    "http://m.example.net/en/25?page=2&ref=x",
    "https://h.example.org/a/b/c/d#top",
    "https://h.example.org/a/../b/./c",
]
LINKS = [
    "/about", "about", "./about", "../about", "../../about", "../../../../about", ".", "..", "./", "../",
    "#top", "?q=1", "?q=1#x", "", "//cdn.example.org/lib.js", "https://else.example.org/x",
    "mailto:me@example.org", "a//b", "/a//b", "/a/./b/../c", "a/.", "a/..", "(https://ext.example.org/b)",
    "page?x=/../y", "x#/../y", "http://plain.example.org", "/", "tel:123", "..a/b", "a/b/../../../c", "/..",
]


def resolved(spark, pairs):
    df = spark.createDataFrame(pairs, "base string, link string")
    rows = df.select("base", "link", U.resolve_url(F.col("base"), F.col("link")).alias("t")).collect()
    return {(r.base, r.link): r.t for r in rows}


def test_resolve_url_agrees_with_the_standard_library(spark):
    pairs = list(product(BASES, LINKS))
    wrong = {p: (t, urljoin(*p)) for p, t in resolved(spark, pairs).items() if t != urljoin(*p)}
    assert wrong == {}


segment = st.sampled_from(["a", "b.html", "..", ".", "c d", ""])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.booleans(), st.lists(segment, min_size=1, max_size=5)), min_size=20, max_size=40))
def test_resolve_url_on_generated_paths(spark, drawn):
    base = "https://h.example.org/x/y/z"
    links = {("/" if rooted else "") + "/".join(parts) for rooted, parts in drawn}
    # Two leading slashes name a host; an empty host is not a link anyone writes.
    pairs = [(base, link) for link in sorted(links) if not link.startswith("//")]
    assert resolved(spark, pairs) == {p: urljoin(*p) for p in pairs}


def test_resolve_url_with_missing_sides(spark):
    found = resolved(spark, [(None, "/a"), ("https://h.example.org/x", None), ("", "b")])
    assert found[(None, "/a")] == "/a"
    assert found[("https://h.example.org/x", None)] == "https://h.example.org/x"
    assert found[("", "b")] == "b"


def test_url_parts(spark):
    rows = [("https://blog.example.com/articles/my-post/",), ("https://blog.example.com",), ("plain",)]
    df = spark.createDataFrame(rows, "url string")
    url = F.col("url")
    found = df.select(U.url_domain(url), U.url_category(url), U.url_title(url)).collect()
    assert [tuple(r) for r in found] == [
        ("https://blog.example.com", "articles", "my-post"),
        ("https://blog.example.com", "", ""),
        ("plain//", "", ""),
    ]
