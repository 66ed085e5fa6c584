"""Page HTML and sitemaps to columns.

HTML structure is read in Arrow batches by the helper in ``functions.html``; JSON, stamps and
sitemap XML stay in Spark expressions. Every operator here is narrow: no shuffle.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.text import iso_text
from ..schemas import RAW

_LINKS = pa.list_(pa.struct([("text", pa.string()), ("link", pa.string())]))
_LINKS_DDL = "array<struct<text:string,link:string>>"
_STRINGS = pa.list_(pa.string())

_METADATA_SCRIPT = (
    r"(?is)<script\b"
    r"(?=[^>]*\btype\s*=\s*[\"']application/ld\+json[\"'])"
    r"(?=[^>]*\bclass\s*=\s*[\"'](?:[^\"']*\s)?rank-math-schema(?:\s[^\"']*)?[\"'])"
    r"[^>]*>(.*?)</script\s*>"
)
_GRAPH = (
    "`@graph` array<struct<`@type` string, url string, name string, "
    "datePublished string, dateModified string>>"
)


def _per_page(read, arrow_type, ddl: str):
    """Column function applying ``read`` to the parsed pages of an Arrow batch."""

    def batch(pages: pa.Array) -> pa.Array:
        return pa.array(
            [None if p is None else read(H.Page(p)) for p in pages.to_pylist()], arrow_type
        )

    return F.arrow_udf(batch, ddl)


def extract_tags(df: DataFrame, html_col: str = "html") -> DataFrame:
    """Adds ``tags``: the comma-separated names of the category header."""
    return df.withColumn("tags", _per_page(H.tag_names, _STRINGS, "array<string>")(html_col))


def extract_links(
    df: DataFrame, html_col: str = "html", body_class: str | None = H.BODY_CLASS
) -> DataFrame:
    """Adds ``content_links``: text and href of the anchors of the article body, in order.

    ``body_class=None`` takes the anchors of the whole page.
    """

    def read(page):
        return H.anchors(page, H.body_elements(page, body_class))

    return df.withColumn("content_links", _per_page(read, _LINKS, _LINKS_DDL)(html_col))


def extract_flat_links(df: DataFrame, html_col: str = "html") -> DataFrame:
    """Adds ``content_links`` for pages whose anchors hold plain text and a quoted href.

    Stays in the JVM: two regular expressions over the whole page, no Python. Entities are
    left as they are.
    """
    anchor = r'<a href="([^"]*)">([^<]*)</a>'
    texts = F.regexp_extract_all(F.col(html_col), F.lit(anchor), F.lit(2))
    links = F.regexp_extract_all(F.col(html_col), F.lit(anchor), F.lit(1))
    pairs = F.zip_with(texts, links, lambda t, u: F.struct(t.alias("text"), u.alias("link")))
    return df.withColumn("content_links", pairs)


def extract_paragraphs(df: DataFrame, html_col: str = "html", mode: str = "all") -> DataFrame:
    """Adds ``content``: texts of the elements of the article body.

    ``mode="all"`` takes every element, so nested text repeats; ``"leaf"`` only innermost ones.
    """
    if mode not in ("all", "leaf"):
        raise ValueError(f"mode is 'all' or 'leaf', got {mode!r}")

    def read(page):
        return H.paragraphs(page, H.body_elements(page), leaf=mode == "leaf")

    return df.withColumn("content", _per_page(read, _STRINGS, "array<string>")(html_col))


def _with_metadata(df: DataFrame, text: Column) -> DataFrame:
    """Adds the article metadata held in the JSON ``text`` of the metadata script."""
    # The nodes get a projection of their own, so the JSON is parsed once per page.
    nodes = F.from_json(text, _GRAPH)["@graph"]

    def last(kind: str) -> Column:
        return F.try_element_at(F.filter("_nodes", lambda n: n["@type"] == kind), F.lit(-1))

    with_nodes = df.withColumn("_nodes", nodes).withColumns(
        {"_page": last("WebPage"), "_person": last("Person")["name"]}
    )
    person = F.col("_person")
    # An author given as an object comes through as JSON text.
    is_object = person.rlike(r"^\s*\{")
    return with_nodes.withColumns(
        {
            "url": F.col("_page.url"),
            "title": F.col("_page.name"),
            "date_published": F.col("_page.datePublished"),
            "date_modified": F.col("_page.dateModified"),
            "author": F.when(is_object, F.get_json_object(person, "$.text")).otherwise(
                person
            ),
        }
    ).drop("_nodes", "_page", "_person")


def jsonld_metadata(df: DataFrame, html_col: str = "html") -> DataFrame:
    """Adds url, title, both dates (as text) and author from the page's metadata script.

    The last node of each kind wins; a page without the script or with broken JSON gets NULLs.
    """
    found = F.regexp_extract(F.col(html_col), _METADATA_SCRIPT, 1)
    return _with_metadata(df, F.when(found != "", found))


def parse_iso_timestamps(df: DataFrame) -> DataFrame:
    """Replaces ISO-8601 texts by instants and adds year and month of the modified stamp.

    Year and month are those of the stamp's own offset. Unreadable texts become NULL.
    """
    published, modified = iso_text(F.col("date_published")), iso_text(F.col("date_modified"))
    wall_clock = modified.try_cast("timestamp_ntz")
    return df.withColumns(
        {
            "year": F.year(wall_clock),
            "month": F.month(wall_clock),
            "date_published": published.try_cast("timestamp"),
            "date_modified": modified.try_cast("timestamp"),
        }
    )


def extract_articles(
    pages: DataFrame, html_col: str = "html", paragraph_mode: str = "all"
) -> DataFrame:
    """One page row to one article row of the raw schema; each page is parsed once."""
    leaf = paragraph_mode == "leaf"

    def read(page):
        body = H.body_elements(page)
        return {
            "metadata": H.metadata_text(page),
            "tags": H.tag_names(page),
            "content_links": H.anchors(page, body),
            "content": H.paragraphs(page, body, leaf),
        }

    parts_type = pa.struct(
        [
            ("metadata", pa.string()),
            ("tags", _STRINGS),
            ("content_links", _LINKS),
            ("content", _STRINGS),
        ]
    )
    ddl = f"struct<metadata:string,tags:array<string>,content_links:{_LINKS_DDL},content:array<string>>"
    parsed = pages.select(_per_page(read, parts_type, ddl)(html_col).alias("parts"))
    fields = _with_metadata(parsed.select("parts.*"), F.col("metadata"))
    return parse_iso_timestamps(fields).select(*RAW.fieldNames())


def sitemap_locs(df: DataFrame, xml_col: str = "xml") -> DataFrame:
    """One row per ``<loc>`` text of the sitemap documents.

    A pattern instead of an XML parser, so a broken document cannot fail the job.
    """
    plain = F.regexp_replace(F.col(xml_col), r"(?s)<!--.*?-->", "")
    found = F.regexp_extract_all(
        plain, F.lit(r"(?s)<(?:\w+:)?loc(?:\s[^>]*)?>(.*?)</(?:\w+:)?loc\s*>"), F.lit(1)
    )
    text = F.col("loc")
    cdata = F.regexp_extract(text, r"(?s)^\s*<!\[CDATA\[(.*?)\]\]>\s*$", 1)
    unescaped = text
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        unescaped = F.replace(unescaped, F.lit(entity), F.lit(char))
    # The outer form: with the plain one Spark infers a test of the array, which would search
    # every document a second time.
    locs = df.select(F.explode_outer(found).alias("loc")).filter(F.col("loc").isNotNull())
    return locs.select(
        F.when(cdata != "", cdata).otherwise(unescaped).alias("url")
    )


# Forms of sitemap stamps beside ISO ones, tried in this order. Where a day may be
# a month the month stands first.
ISO_FORM = "iso"
STAMP_FORMS = (
    "d-MMM-yyyy[ HH:mm[:ss]][ xx]",
    "MMM-d-yyyy[ HH:mm[:ss]][ xx]",
    "d MMM yyyy[ HH:mm[:ss]][ xx]",
    "M-d-yyyy[ HH:mm[:ss]][ xx]",
    "d-M-yyyy[ HH:mm[:ss]][ xx]",
    "yyyyMMdd'T'HHmmss[xx]",
)


def parse_stamp(stamp: Column) -> Column:
    """``(parsed, form)`` of a free-form stamp by the first form that fits, else NULL.

    Names of weekdays in front are passed over; GMT, UTC and Z are the zone of a stamp without
    one. Expressions only, and a later form is tried only for texts no earlier one fits.
    """
    plain = F.regexp_replace(F.trim(stamp), r"(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*,? +", "")
    zoned = F.regexp_replace(plain, r"(?i) +(gmt|utc|z)$", " +0000")
    tried = [(iso_text(plain).try_cast("timestamp"), ISO_FORM)]
    tried += [(F.try_to_timestamp(zoned, F.lit(form)), form) for form in STAMP_FORMS]
    return F.coalesce(
        *[
            F.when(value.isNotNull(), F.struct(value.alias("parsed"), F.lit(form).alias("form")))
            for value, form in tried
        ]
    )


def sitemap_stamps(df: DataFrame, html_col: str = "html") -> DataFrame:
    """``(url, stamp, last_modified, form)`` of the sitemap tables.

    A cell with an anchor gives the url, a cell whose text has a dash the stamp; rows with
    fewer than two values drop out. ``form`` tells by which form the stamp was read; both it
    and ``last_modified`` are NULL for stamps no form fits.
    """
    rows_type = pa.list_(pa.struct([("links", _STRINGS), ("texts", _STRINGS)]))
    read = _per_page(
        H.table_cells, rows_type, "array<struct<links:array<string>,texts:array<string>>>"
    )
    rows = df.select(F.explode(read(html_col)).alias("row"))
    stamps = F.filter(F.col("row.texts"), lambda t: t.contains("-"))
    cells = rows.select(
        F.try_element_at("row.links", F.lit(1)).alias("url"),
        F.try_element_at(stamps, F.lit(1)).alias("stamp"),
    ).filter(F.col("url").isNotNull() & F.col("stamp").isNotNull())
    return cells.withColumn("_read", parse_stamp(F.col("stamp"))).select(
        "url", "stamp", F.col("_read.parsed").alias("last_modified"), F.col("_read.form").alias("form")
    )


def sitemap_table_rows(df: DataFrame, html_col: str = "html") -> DataFrame:
    """``(url, last_modified)`` of the sitemap tables, with NULL for stamps no form fits."""
    return sitemap_stamps(df, html_col).select("url", "last_modified")


def rejected_stamps(df: DataFrame, html_col: str = "html") -> DataFrame:
    """``(url, stamp)`` of the rows whose stamp no form fits."""
    return sitemap_stamps(df, html_col).filter(F.col("form").isNull()).select("url", "stamp")


# Endings of urls that are not articles.
IMAGE_SUFFIXES = ("png", "jpeg", "jpg")


def exclude_urls(
    df: DataFrame, root: str, suffixes: tuple[str, ...] = IMAGE_SUFFIXES, url_col: str = "url"
) -> DataFrame:
    """Drops the listing page itself and image urls; the endings need no dot."""
    url = F.col(url_col)
    unwanted = url == root
    for suffix in suffixes:
        unwanted = unwanted | url.endswith(suffix)
    return df.filter(~unwanted)
