import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import extract as B
from broadsheet.schemas import RAW


def page(graph=None, body="", tags="clocks,sea", script=None):
    text = script if script is not None else json.dumps({"@graph": graph})
    head = (
        f'<script type="application/ld+json" class="rank-math-schema">{text}</script>'
        if script is not None or graph is not None
        else ""
    )
    line = f'<div class="entry-category-header default-max-width">{tags}</div>' if tags is not None else ""
    return f"<html>{head}{line}{body}</html>"


ESSAY = {
    "@type": "WebPage",
    "url": "https://journal.example.net/notes/tidal-clocks/",
    "name": "How tidal clocks keep time",
    "datePublished": "2019-11-30T23:45:00-02:00",
    "dateModified": "2021-07-04T06:30:15+00:00",
}
INES = {"@type": "Person", "name": "Ines Calder"}
BODY = (
    '<main><div class="entry-content"><p>The harbour <a href="../gauge">gauge</a> came first.</p>'
    '<section><p>Then <a href="https://sea.example.org/tables?y=1890#t">printed tables</a>,</p>'
    "<div><p>and at last <b>brass</b> wheels.</p></div></section></div></main>"
)


def extract(spark, *pages, **options):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "page_id bigint, html string")
    return B.extract_articles(df.coalesce(1), **options).collect()


def test_article_page(spark):
    row = extract(spark, page([INES, ESSAY], BODY, tags="clocks, sea ,history"))[0]
    assert (row.url, row.title, row.author) == (ESSAY["url"], ESSAY["name"], "Ines Calder")
    assert [t.strip() for t in row.tags] == ["clocks", "sea", "history"]
    links = [("gauge", "../gauge"), ("printed tables", "https://sea.example.org/tables?y=1890#t")]
    assert [tuple(a) for a in row.content_links] == links
    text = " ".join(" ".join(row.content).split())
    assert "brass" in text and "printed tables" in text
    # Stamps are kept in UTC, whatever zone they came in.
    assert row.date_published == datetime(2019, 12, 1, 1, 45)
    assert row.date_modified == datetime(2021, 7, 4, 6, 30, 15) and (row.year, row.month) == (2021, 7)


def test_schema_is_the_declared_one(spark):
    df = spark.createDataFrame([("<p>x</p>",)], "html string")
    found = B.extract_articles(df)
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in RAW]


def test_page_without_anything(spark):
    row = extract(spark, "<html><p>text</p></html>")[0]
    assert (row.url, row.title, row.author, row.date_modified, row.year) == (None,) * 5
    assert (row.tags, row.content_links, row.content) == ([], [], [])


def test_metadata_traps(spark):
    second = dict(ESSAY, name="later")
    rows = extract(
        spark,
        page([ESSAY, second, INES]),
        page([ESSAY, INES, {"@type": "Person", "name": "Eve"}]),
        page([ESSAY, {"@type": "Person", "name": {"text": "Ann"}}]),
        page([dict(ESSAY, **{"@type": ["WebPage"]}), INES]),
        page([dict(ESSAY, dateModified="2024-02-01T00:30:00+02:00"), INES]),
        page(script="{not json"),
        page([], tags=""),
        page(script='{"other": 1}'),
    )
    assert rows[0].title == "later"
    assert rows[1].author == "Eve"
    assert rows[2].author == "Ann"
    assert rows[3].url is None and rows[3].author == "Ines Calder"
    # The month is the one of the stamp's own offset, the instant is in UTC.
    assert rows[4].month == 2 and rows[4].date_modified == datetime(2024, 1, 31, 22, 30)
    assert rows[5].url is None and rows[5].author is None
    assert rows[6].tags == [""]
    assert rows[7].url is None


def test_native_metadata_agrees_with_the_parsed_one(spark):
    pages = [
        page([ESSAY, INES], BODY),
        "<p>none</p>",
        page(script="{broken"),
        page([ESSAY, {"@type": "Person", "name": {"text": "Ann"}}]),
        '<script class="x rank-math-schema" type="application/ld+json">'
        + json.dumps({"@graph": [ESSAY]})
        + "</script>",
    ]
    df = spark.createDataFrame([(p,) for p in pages], "html string").coalesce(1)
    native = B.parse_iso_timestamps(B.jsonld_metadata(df))
    columns = ["url", "title", "author", "date_published", "date_modified", "year", "month"]
    assert native.select(*columns).collect() == B.extract_articles(df).select(*columns).collect()


def test_body_traps(spark):
    body = (
        '<div class="wide entry-content"><p>One <b>two</b><p>three &amp; four</p><br>'
        '<a href="">  spaced <i>out</i> </a><a>no link</a><a href>bare</a>'
        "<script>var x = 1;</script><ul><li>item</ul> tail</div><p>outside</p>"
    )
    row = extract(spark, page([ESSAY], body))[0]
    assert [tuple(a) for a in row.content_links] == [("spacedout", ""), ("bare", "")]
    # An unclosed paragraph holds what follows it; nested text repeats.
    assert row.content[1] == "two" and row.content[2] == "three & four"
    assert row.content[0].startswith("One two") and row.content[0].endswith("tail")
    assert "var x = 1;" in row.content and "var x" not in row.content[0]
    assert "outside" not in row.content
    leaf = extract(spark, page([ESSAY], body), paragraph_mode="leaf")[0].content
    assert leaf == ["two", "three & four", "out", "no link", "bare", "var x = 1;", "item"]


def test_single_columns_agree_with_the_article(spark):
    df = spark.createDataFrame([(page([ESSAY, INES], BODY),), ("<p/>",)], "html string").coalesce(1)
    article = B.extract_articles(df).select("tags", "content_links", "content").collect()
    alone = B.extract_paragraphs(B.extract_links(B.extract_tags(df))).drop("html").collect()
    assert alone == article
    with pytest.raises(ValueError):
        B.extract_paragraphs(df, mode="some")


def test_flat_links_agree_with_elements(spark):
    html = '<a href="/a">A</a><p>x <a href="/b?c=1">b b</a></p><a href=""></a>'
    df = spark.createDataFrame([(html,)], "html string")
    assert B.extract_flat_links(df).collect() == B.extract_links(df, body_class=None).collect()


def test_sitemap_locs(spark):
    xml = """<?xml version="1.0" encoding="UTF-8"?>
      <sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">
        <sitemap><loc>https://maps.example.net/sitemap-1.xml</loc></sitemap>
        <!-- <loc>https://blog.example.com/hidden</loc> -->
        <sitemap><loc>https://maps.example.net/list?part=2&amp;b=&lt;2&amp;gt;</loc></sitemap>
        <x:loc><![CDATA[https://blog.example.com/raw?a&b]]></x:loc><locale>no</locale>
      </sitemapindex>"""
    df = spark.createDataFrame([(xml,), ("<broken><loc>u</loc>",), (None,)], "xml string")
    assert [r.url for r in B.sitemap_locs(df.coalesce(1)).collect()] == [
        "https://maps.example.net/sitemap-1.xml",
        "https://maps.example.net/list?part=2&b=<2&gt;",
        "https://blog.example.com/raw?a&b",
        "u",
    ]


def test_sitemap_table(spark):
    html = """<table id="other"><tr><td><a href="no">x</a></td><td>2020-01-01</td></tr></table>
      <table id="sitemap"><tr><th>URL</th></tr>
      <tr><td><a href="/u1">u1</a></td><td>4</td><td> 2024-01-02 03:04 +00:00 </td></tr>
      <tr><td><a href="/u2">u2</a></td><td>4</td></tr>
      <tr><td>text</td><td>2024-01-02</td></tr>
      <tr><td><a href="/u3">u3</a></td><td>2024-05-06 07:08:09 +02:00</td></tr></table>"""
    df = spark.createDataFrame([(html,), ("<p>none</p>",)], "html string")
    assert sorted(map(tuple, B.sitemap_table_rows(df).collect())) == [
        ("/u1", datetime(2024, 1, 2, 3, 4)),
        ("/u3", datetime(2024, 5, 6, 5, 8, 9)),
    ]


def test_iso_stamps(spark):
    texts = ["2024-02-03T10:09:08Z", "2024-02-03T10:09Z", "2024-02-03T10:09:08.5+01:00", "2024-02-03", "soon", None]
    df = spark.createDataFrame([(t, t) for t in texts], "date_published string, date_modified string")
    found = B.parse_iso_timestamps(df.coalesce(1)).collect()
    assert [r.date_modified for r in found] == [
        datetime(2024, 2, 3, 10, 9, 8),
        datetime(2024, 2, 3, 10, 9),
        datetime(2024, 2, 3, 9, 9, 8, 500000),
        datetime(2024, 2, 3),
        None,
        None,
    ]
    assert [r.year for r in found] == [2024] * 4 + [None] * 2


def test_exclude_urls(spark):
    urls = ["https://b.example/articles/", "https://b.example/x.png", "https://b.example/ajpg", "https://b.example/y/"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r.url for r in B.exclude_urls(df, urls[0]).collect()] == [urls[3]]


def test_pages_are_parsed_once(spark):
    df = spark.createDataFrame([("<p/>",)], "html string")
    plan = B.extract_articles(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
    assert plan.count("from_json") == 1


def test_free_forms_of_stamps(spark):
    iso, (named, month_name, spaced, month, day, packed) = B.ISO_FORM, B.STAMP_FORMS
    cases = [
        ("2024-01-02 10:20 +00:00", "2024-01-02 10:20:00", iso),
        (" 2024-01-02T10:20:30+02:00 ", "2024-01-02 08:20:30", iso),
        ("2-Jan-2024 10:20", "2024-01-02 10:20:00", named),
        ("Tue, 02-Jan-2024 10:20:30 GMT", "2024-01-02 10:20:30", named),
        ("jan-2-2024", "2024-01-02 00:00:00", month_name),
        ("Tuesday 2 Jan 2024 10:20:30 -0500", "2024-01-02 15:20:30", spaced),
        ("01-02-2024 10:20", "2024-01-02 10:20:00", month),
        ("13-02-2024", "2024-02-13 00:00:00", day),
        ("20240102T102030-0500", "2024-01-02 15:20:30", packed),
        ("30-02-2024", None, None),
        ("-", None, None),
        ("", None, None),
        (None, None, None),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, s string")
    got = df.select("i", B.parse_stamp(F.col("s")).alias("r")).select(
        "i", F.date_format("r.parsed", "yyyy-MM-dd HH:mm:ss").alias("t"), "r.form"
    )
    for row in got.collect():
        assert (row.t, row.form) == cases[row.i][1:], cases[row.i]
