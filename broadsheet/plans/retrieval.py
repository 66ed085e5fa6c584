"""Gold articles to the stored search collection."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import year_month
from ..functions.windows import filter_window
from ..operators import chunks as C
from ..operators.search import bm25_index, save_bm25_index
from ..schemas import CHUNK_DOCUMENTS
from ..session import stage
from ..sources.tables import replace_stored_window, save_table, stored_months_of

#: Bytes of text whose terms share a bucket of the lexical index: one task sorts and scores them.
BUCKET_TEXT = 16 << 20


def ingest(
    gold: DataFrame,
    collection: DataFrame,
    embed: C.Embed,
    dimension: int,
    start: datetime | None = None,
    end: datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The collection after the articles of the window were upserted, and the run's report.

    The new documents are written once before use, so each text is embedded once. Articles with
    a chunk that ``embed`` refuses are counted as failed; what the collection holds of them stays.
    """
    articles = gold if start is None else filter_window(gold, "date_modified", start, end)
    whole, quarantine, skipped = _embedded(articles, embed, dimension)
    report = C.ingest_report(articles, whole, skipped, quarantine)
    merged = C.upsert_documents(collection, whole.select(*collection.columns))
    return merged, report


def _embedded(articles: DataFrame, embed: C.Embed, dimension: int):
    """Documents of whole articles, failing chunks and skipped articles."""
    usable, skipped = C.skip_blank(articles)
    documents = C.build_chunk_documents(C.chunk_tokens(usable))
    embedded = stage(C.embed_apart(documents, embed, dimension), "embedded")
    whole, quarantine = C.set_failed_apart(embedded)
    return whole.select(*CHUNK_DOCUMENTS.fieldNames()), quarantine, skipped


def load_collection(
    spark: SparkSession,
    gold: DataFrame,
    path: str,
    embed: C.Embed,
    dimension: int,
    start: datetime,
    end: datetime,
    quarantine_path: str | None = None,
) -> DataFrame:
    """Upserts the articles of the window into the stored collection; returns the report.

    Documents lie by month of their article, whose stamp is part of their id, so a document
    and its replacement share a month: only the months of the window are rewritten. The chunks
    that could not be embedded replace those of the window in the quarantine, if it has a path;
    a run over the same window after the cause is gone empties it.
    """
    articles = filter_window(gold, "date_modified", start, end)
    embedded, quarantine, skipped = _embedded(articles, embed, dimension)
    month_of = F.to_timestamp("metadata.date_modified")
    dated = embedded.withColumns(year_month(month_of))
    stored = stored_months_of(spark, path, CHUNK_DOCUMENTS, dated)
    merged = stage(C.upsert_documents(stored, embedded), "collection")
    save_table(merged.withColumns(year_month(month_of)), path, mode="overwrite")
    if quarantine_path is not None:
        replace_stored_window(quarantine, quarantine_path, start, end)
    return C.ingest_report(articles, embedded, skipped, quarantine)


def buckets_for(documents: DataFrame, least: int, text_col: str = "content") -> int:
    """Buckets of an index whose tasks hold the terms of ``BUCKET_TEXT`` bytes of text each, ``least`` or more."""
    size = documents.agg(F.coalesce(F.sum(F.octet_length(text_col).cast("bigint")), F.lit(0))).first()[0]
    return max(least, -(-size // BUCKET_TEXT))


def publish_index(
    spark: SparkSession, documents: DataFrame, name: str, path: str, buckets: int = 200
) -> None:
    """Stores the lexical index of a collection under a catalog name, in ``buckets`` or, of large ones, more."""
    buckets = buckets_for(documents, buckets)
    save_bm25_index(bm25_index(documents, partitions=buckets), name, path, buckets)
