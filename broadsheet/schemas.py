"""Fixed layer schemas. Every table of the pipeline has one declared here."""

from __future__ import annotations

from pyspark.sql import types as T

LINK = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("link", T.StringType())]
)

_ARTICLE_FIELDS = [
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("date_published", T.TimestampType()),
    T.StructField("date_modified", T.TimestampType()),
    T.StructField("author", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("content_links", T.ArrayType(LINK)),
    T.StructField("content", T.ArrayType(T.StringType())),
]
_MONTH_FIELDS = [
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
]

RAW = T.StructType(_ARTICLE_FIELDS + _MONTH_FIELDS)
BRONZE = T.StructType(_ARTICLE_FIELDS)

SITEMAP_URLS = T.StructType(
    [T.StructField("url", T.StringType()), T.StructField("last_modified", T.TimestampType())]
)

SILVER = T.StructType(
    [
        T.StructField("row_id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("url_title", T.StringType()),
        T.StructField("date_published", T.TimestampType()),
        T.StructField("date_modified", T.TimestampType()),
        T.StructField("days_between_published_modified", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("content_links", T.ArrayType(LINK)),
        T.StructField("content", T.ArrayType(T.StringType())),
        T.StructField("content_paragraphs", T.LongType()),
        T.StructField("total_content_words", T.LongType()),
        *_MONTH_FIELDS,
    ]
)

SILVER_LINKS = T.StructType(
    [
        T.StructField("row_id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("alias", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("date_modified", T.TimestampType()),
    ]
)

GOLD = T.StructType(
    [
        T.StructField(f.name, T.StringType()) if f.name == "content_links" else f
        for f in SILVER.fields
    ]
)

GOLD_LINKS = T.StructType(
    [
        T.StructField("row_id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("link_status", T.StringType()),
        T.StructField("date_modified", T.TimestampType()),
    ]
)

# Bookkeeping of the stored pipeline: article months a run touched, sitemap months loaded.
TOUCHED = T.StructType([T.StructField("url", T.StringType()), *_MONTH_FIELDS])
PROGRESS = T.StructType(
    [
        *_MONTH_FIELDS,
        T.StructField("n_urls", T.LongType()),
        T.StructField("n_found", T.LongType()),
        T.StructField("digest", T.LongType()),
    ]
)

AUTHORS = T.StructType([T.StructField("author", T.StringType())])

CHUNK_METADATA = T.StructType(
    [
        T.StructField("row_id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("date_published", T.StringType()),
        T.StructField("date_modified", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)

CHUNK_DOCUMENTS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("dense_vector", T.ArrayType(T.FloatType())),
        T.StructField("metadata", CHUNK_METADATA),
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("row_id", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("failure", T.StringType()),
        T.StructField("date_modified", T.TimestampType()),
    ]
)

# Declared text limits of the gold tables and of the search store, and
# the embedding size.
GOLD_LIMITS = {
    "url": 255,
    "domain": 255,
    "category": 255,
    "url_title": 255,
    "title": 255,
    "author": 255,
}
GOLD_LINK_LIMITS = {"link_status": 100}
DOCUMENT_LIMITS = {"id": 128, "content": 65535, "metadata": 65535}
VECTOR_DIMENSION = 1536
