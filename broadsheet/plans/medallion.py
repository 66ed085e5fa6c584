"""The batch pipeline over stored tables: pages to raw, bronze, silver and gold.

Each step reads and writes only the months it touches and can be run again.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ..operators import links as L
from ..operators.extract import exclude_urls, extract_articles
from ..operators.silver import explode_links, new_silver_articles
from ..operators.upsert import new_versions
from ..schemas import BRONZE, GOLD, GOLD_LINKS, SILVER, SILVER_LINKS, SITEMAP_URLS
from ..session import broadcast_if_small, stage
from ..sources import tables as S
from ..streaming.ingest import append_new_versions


class Layout(NamedTuple):
    """Paths of the stored tables."""

    sitemap: str
    raw: str
    bronze: str
    silver: str
    silver_links: str
    gold: str
    gold_links: str
    touched: str
    progress: str

    @classmethod
    def under(cls, base: str) -> Layout:
        return cls(*(f"{base}/{name}" for name in cls._fields))


def store_sitemap(incoming: DataFrame, layout: Layout) -> None:
    """Appends the sitemap urls whose version is not stored yet."""
    spark = incoming.sparkSession
    stored = S.stored_months_of(
        spark, layout.sitemap, SITEMAP_URLS, incoming, ts_col="last_modified"
    )
    fresh = new_versions(stored, incoming, "url", "last_modified")
    S.save_table(fresh, layout.sitemap, ts_col="last_modified")


def select_pages(pages: DataFrame, urls: DataFrame, listing_url: str) -> DataFrame:
    """Fetched pages of the wanted urls, each once; the listing page and images drop out."""
    wanted = exclude_urls(urls.select("url"), listing_url).distinct()
    return pages.join(broadcast_if_small(wanted), "url", "left_semi")


def load_raw(pages: DataFrame, layout: Layout) -> None:
    S.write_raw(extract_articles(pages), layout.raw)


def load_bronze(spark: SparkSession, layout: Layout, year=None, month=None) -> None:
    """Appends versions of the raw dataset, or of one year or month of it, to bronze."""
    append_new_versions(S.read_raw(spark, layout.raw, year, month), layout.bronze)


def load_silver(spark: SparkSession, layout: Layout, start: datetime, end: datetime) -> None:
    """Rebuilds the window of silver articles, then that of silver links."""
    bronze = S.load_window(spark, layout.bronze, BRONZE, start, end)
    S.replace_stored_window(new_silver_articles(bronze, start, end), layout.silver, start, end)
    silver = S.load_window(spark, layout.silver, SILVER, start, end)
    S.replace_stored_window(explode_links(silver, start, end), layout.silver_links, start, end)


def load_gold(spark: SparkSession, layout: Layout, start: datetime, end: datetime) -> None:
    silver = S.load_window(spark, layout.silver, SILVER, start, end)
    S.replace_stored_window(L.as_gold(silver).select(*GOLD.fieldNames()), layout.gold, start, end)


def load_gold_links(
    spark: SparkSession,
    layout: Layout,
    start: datetime,
    end: datetime,
    probe: L.Probe,
    parallelism: int = 200,
) -> None:
    """Audits the links of the window.

    Outcomes are written once before use: a probe may answer differently when a lost task
    runs again, and asking twice is slow.
    """
    links = S.load_window(spark, layout.silver_links, SILVER_LINKS, start, end)
    classified = L.classify_link(links)
    outcomes = stage(L.probe_targets(classified, probe, parallelism), "outcomes")
    audited = L.link_status(classified, outcomes).select(*GOLD_LINKS.fieldNames())
    S.replace_stored_window(audited, layout.gold_links, start, end)
