"""Pages to the raw dataset by the months in which the sitemap says they changed.

A progress table holds one row per load of a month: how many urls it asked for, how many had a
page, and a digest of its urls and stamps. A month is left out while its digest is that of a
load that found every page, so a run that was ended goes on where it was, new or changed urls
bring their month back, and a month with pages still missing is asked for again.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import year_month
from ..operators.extract import exclude_urls
from ..schemas import PROGRESS, SITEMAP_URLS
from ..session import broadcast_if_small
from ..sources import tables as S
from .medallion import Layout, load_raw, select_pages

# Months loaded by one pass over the pages. More are fewer passes, fewer lose less of an ended run.
MONTHS_AT_ONCE = 12


def wanted_urls(
    spark: SparkSession, layout: Layout, start: datetime, end: datetime, listing_url: str
) -> DataFrame:
    """``(url, last_modified, year, month)`` of the window's articles; folders are pruned."""
    stored = S.load_window(spark, layout.sitemap, SITEMAP_URLS, start, end, "last_modified")
    return exclude_urls(stored, listing_url).withColumns(year_month(F.col("last_modified")))


def month_states(wanted: DataFrame) -> DataFrame:
    """Per month the urls and a digest of its urls and stamps, whatever their order."""
    versions = wanted.select("url", "last_modified", *S.MONTH).distinct()
    return versions.groupBy(*S.MONTH).agg(
        F.count_distinct("url").alias("n_urls"),
        F.bit_xor(F.xxhash64("url", "last_modified")).alias("digest"),
    )


def open_months(states: DataFrame, progress: DataFrame) -> DataFrame:
    """Months that no complete load of their present urls is noted for."""
    complete = progress.filter(F.col("n_found") == F.col("n_urls"))
    return states.join(complete.select(*S.MONTH, "n_urls", "digest"), [*S.MONTH, "n_urls", "digest"], "left_anti")


def _of_months(df: DataFrame, months: Iterable[tuple[int, int]]) -> DataFrame:
    return df.filter((F.col("year") * 12 + F.col("month")).isin([y * 12 + m for y, m in months]))


def load_open_months(
    spark: SparkSession,
    pages: DataFrame,
    layout: Layout,
    start: datetime,
    end: datetime,
    listing_url: str,
    months_at_once: int = MONTHS_AT_ONCE,
) -> list[tuple[int, int]]:
    """Loads the pages of the window's open months into the raw dataset; returns those months.

    The pages of several months are found by one join, so pages are read once per group of
    ``months_at_once`` months. Progress is noted after a group was written. Only the list of
    months, at most one row per month of the calendar, comes to the driver.
    """
    if months_at_once < 1:
        raise ValueError(f"months_at_once is 1 or more, got {months_at_once}")
    wanted = wanted_urls(spark, layout, start, end, listing_url)
    progress = S.load_table(spark, layout.progress, PROGRESS)
    states = month_states(wanted)
    months = sorted((r.year, r.month) for r in open_months(states, progress).collect())
    for first in range(0, len(months), months_at_once):
        group = months[first : first + months_at_once]
        asked = _of_months(wanted, group)
        load_raw(select_pages(pages, asked, listing_url), layout)
        _note(_of_months(states, group), _found(asked, pages), layout)
    return months


def _found(asked: DataFrame, pages: DataFrame) -> DataFrame:
    """Per month how many of its urls have a page; only the urls of the pages are read.

    The urls asked for stand in front, so that one which very many pages share stays one row.
    """
    urls = asked.select("url").distinct()
    fetched = pages.select("url").join(broadcast_if_small(urls), "url", "left_semi").distinct()
    return (
        asked.select("url", *S.MONTH)
        .distinct()
        .join(fetched, "url")
        .groupBy(*S.MONTH)
        .agg(F.count(F.lit(1)).alias("n_found"))
    )


def _note(states: DataFrame, found: DataFrame, layout: Layout) -> None:
    rows = states.join(found, S.MONTH, "left").fillna(0, ["n_found"])
    # A row per month: one file, not one per month folder.
    rows.select(*PROGRESS.fieldNames()).coalesce(1).write.mode("append").parquet(layout.progress)
