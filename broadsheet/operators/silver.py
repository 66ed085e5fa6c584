"""Bronze versions to silver articles and links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import urls as U
from ..functions.windows import filter_window
from ..schemas import SILVER, SILVER_LINKS
from .upsert import latest_in_window, latest_version, replace_window


def derive_articles(versions: DataFrame) -> DataFrame:
    """The silver columns of article versions; one projection, no shuffle."""
    url, modified, content = F.col("url"), F.col("date_modified"), F.col("content")
    return versions.withColumns(
        {
            "row_id": X.row_id(url, modified),
            "domain": U.url_domain(url),
            "category": U.url_category(url),
            "url_title": U.url_title(url),
            "days_between_published_modified": X.days_between(F.col("date_published"), modified),
            "content_paragraphs": X.paragraph_count(content),
            "total_content_words": X.word_count(content),
            **X.year_month(modified),
        }
    ).select(*SILVER.fieldNames())


def new_silver_articles(bronze: DataFrame, start, end) -> DataFrame:
    """Silver rows of one window: the newest version per url inside it, with its columns."""
    # Bronze holds each version once, so ties need no look at the texts.
    narrow = ["date_published", "author"]
    return derive_articles(latest_in_window(bronze, start, end, tie_columns=narrow))


def newest_per_month(bronze: DataFrame) -> DataFrame:
    """Silver rows of the newest version per url and month of modification.

    The same rows as ``new_silver_articles`` gives month by month, in one pass. Versions
    without a stamp lie in no month and give none.
    """
    dated = bronze.filter(F.col("date_modified").isNotNull())
    months = X.year_month(F.col("date_modified"))
    keyed = dated.withColumn("_key", F.struct("url", months["year"], months["month"]))
    return derive_articles(
        latest_version(keyed, "_key", tie_columns=["date_published", "author"])
    )


def build_silver_articles(bronze: DataFrame, silver: DataFrame, start, end) -> DataFrame:
    """The silver table after its window was rebuilt from bronze."""
    return replace_window(silver, new_silver_articles(bronze, start, end), start, end)


def explode_links(silver: DataFrame, start, end) -> DataFrame:
    """One row per link of the articles inside the window; articles without links give none."""
    inside = filter_window(silver, "date_modified", start, end)
    # The position keeps ids apart when an article repeats a link.
    links = inside.select(
        "url", "date_modified", F.posexplode("content_links").alias("position", "found")
    )
    return links.select(
        X.row_id(F.col("url"), F.col("date_modified"), F.col("position")).alias("row_id"),
        "url",
        F.col("found.text").alias("alias"),
        F.col("found.link").alias("link"),
        "date_modified",
    ).select(*SILVER_LINKS.fieldNames())


def build_silver_links(silver: DataFrame, links: DataFrame, start, end) -> DataFrame:
    return replace_window(links, explode_links(silver, start, end), start, end)
