"""Article versions, pages and sitemaps derived from a table of documents.

The given tables hold texts, not blog posts. These adapters give every document the shape of
an article version, two versions per url, so that all operators can run over whole tables.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import NON_BLANK
from ..schemas import BRONZE

# One link form for each remainder of the document id by eight.
LINK_FORMS = (
    "https://ext.example.org/a",
    "/about",
    "#top",
    "mailto:me@example.org",
    "see-mail",
    "(https://ext.example.org/b)",
    "https://ext.example.org/c) tail",
    "",
)


def posts(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the bronze columns; documents 2n and 2n+1 are versions of one url."""
    doc = F.col("doc_id")
    slug = F.expr("doc_id div 2")
    published = F.timestamp_add("DAY", (((slug * 37) % 60) * 45).cast("int"), F.lit("2021-01-01").cast("timestamp"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(NON_BLANK))
    form = F.element_at(F.array(*[F.lit(f) for f in LINK_FORMS]), (doc % 8 + 1).cast("int"))
    link = F.struct(
        F.concat(F.lit("see "), (doc % 8).cast("string")).alias("text"), form.alias("link")
    )
    return documents.select(
        "doc_id",
        F.concat(
            F.lit("https://blog.example.com/c"),
            (slug % 4).cast("string"),
            F.lit("/post-"),
            slug.cast("string"),
            F.lit("/"),
        ).alias("url"),
        F.substring_index("text", "\n", 1).alias("title"),
        published.alias("date_published"),
        F.timestamp_add("HOUR", (doc % 97).cast("int"), published).alias("date_modified"),
        F.col("source").alias("author"),
        F.array("lang", F.concat(F.lit("t"), (doc % 7).cast("string"))).alias("tags"),
        F.array(link).alias("content_links"),
        lines.alias("content"),
    )


def bronze_posts(documents: DataFrame) -> DataFrame:
    return posts(documents).select(*BRONZE.fieldNames())


def _escaped(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def post_pages(articles: DataFrame) -> DataFrame:
    """``(page_id, html)``: each post as the page it would be published on."""
    iso = "yyyy-MM-dd'T'HH:mm:ssXXX"
    nodes = F.array(
        F.struct(
            F.lit("WebPage").alias("@type"),
            "url",
            F.col("title").alias("name"),
            F.date_format("date_published", iso).alias("datePublished"),
            F.date_format("date_modified", iso).alias("dateModified"),
        ),
        F.struct(
            F.lit("Person").alias("@type"),
            F.lit(None).cast("string").alias("url"),
            F.col("author").alias("name"),
            F.lit(None).cast("string").alias("datePublished"),
            F.lit(None).cast("string").alias("dateModified"),
        ),
    )
    metadata = F.replace(F.to_json(F.struct(nodes.alias("@graph"))), F.lit("<"), F.lit("\\u003c"))
    lines = F.array_join(
        F.transform("content", lambda p: F.concat(F.lit("<p>"), _escaped(p), F.lit("</p>"))), ""
    )
    links = F.array_join(
        F.transform(
            "content_links",
            lambda a: F.concat(
                F.lit('<a href="'), _escaped(a["link"]), F.lit('">'), _escaped(a["text"]), F.lit("</a>")
            ),
        ),
        "",
    )
    html = F.concat(
        F.lit('<html><head><script type="application/ld+json" class="rank-math-schema">'),
        metadata,
        F.lit('</script></head><body><div class="entry-category-header default-max-width">'),
        _escaped(F.array_join("tags", ",")),
        F.lit('</div><div class="entry-content">'),
        lines,
        links,
        F.lit("</div></body></html>"),
    )
    return articles.select(F.col("doc_id").alias("page_id"), html.alias("html"))


# A sitemap document lists at most so many urls.
SITEMAP_SIZE = 1000


def sitemap_documents(rows: DataFrame, id_col: str, url_col: str = "url") -> DataFrame:
    """``xml``: urls written as sitemap documents; ids bound the size of each."""
    entry = F.concat(F.lit("<url><loc>"), _escaped(F.col(url_col)), F.lit("</loc></url>"))
    return (
        rows.groupBy(F.floor(F.col(id_col) / SITEMAP_SIZE).alias("part"))
        .agg(F.array_join(F.collect_list(entry), "\n").alias("entries"))
        .select(
            F.concat(
                F.lit('<?xml version="1.0"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'),
                "entries",
                F.lit("</urlset>"),
            ).alias("xml")
        )
    )


def mixed_stamps() -> Column:
    """The modification stamp as different sites write it, by the id of the document."""
    stamp = F.col("date_modified")
    forms = [
        F.date_format(stamp, "yyyy-MM-dd HH:mm XXX"),
        F.date_format(stamp, "d-MMM-yyyy HH:mm"),
        F.date_format(stamp, "MM-dd-yyyy HH:mm:ss"),
        F.date_format(stamp, "E, dd-MMM-yyyy HH:mm:ss 'GMT'"),
        F.date_format(stamp, "yyyyMMdd'T'HHmmss'-0500'"),
        F.lit("mid-morning"),
        F.date_format(stamp, "yyyy-MM-dd"),
    ]
    return F.element_at(F.array(*forms), (F.col("doc_id") % len(forms) + 1).cast("int"))


def sitemap_tables(articles: DataFrame, stamp: Column | None = None) -> DataFrame:
    """``html``: urls and stamps written as sitemap tables; ids bound the size of each."""
    written = F.date_format("date_modified", "yyyy-MM-dd HH:mm XXX") if stamp is None else stamp
    row = F.concat(
        F.lit('<tr><td><a href="'),
        _escaped(F.col("url")),
        F.lit('">'),
        _escaped(F.col("url")),
        F.lit("</a></td><td>3</td><td> "),
        written,
        F.lit(" </td></tr>"),
    )
    return (
        articles.groupBy(F.floor(F.col("doc_id") / SITEMAP_SIZE).alias("part"))
        .agg(F.array_join(F.collect_list(row), "").alias("rows"))
        .select(
            F.concat(
                F.lit('<html><table id="sitemap"><thead><tr><th>URL</th></tr></thead><tbody>'),
                "rows",
                F.lit("</tbody></table></html>"),
            ).alias("html")
        )
    )


def length_probe(targets: pd.Series) -> pd.Series:
    """Stands in for requests: the outcome follows from the length of the target."""
    return (targets.str.len() % 5).map({0: "error", 1: "timeout"}).fillna("ok")
