"""Questions a publishing dashboard asks of the gold articles and the sitemap urls."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.windows import filter_window


def _n(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def total_articles(gold: DataFrame) -> DataFrame:
    return gold.agg(_n("total"))


def recent_articles_count(gold: DataFrame, today: date, days: int = 180) -> DataFrame:
    """Articles published since ``days`` before the first of the current month."""
    since = F.date_sub(F.trunc(F.lit(today), "MM"), days).cast("timestamp")
    return gold.filter(F.col("date_published") >= since).agg(_n("n_recent"))


def top_authors(gold: DataFrame, n: int = 10) -> DataFrame:
    """The authors with most articles, then by name; a NULL author sorts last."""
    return (
        gold.groupBy("author")
        .agg(_n("article_count"))
        .orderBy(F.desc("article_count"), F.col("author").asc_nulls_last())
        .limit(n)
    )


def top_author(gold: DataFrame) -> DataFrame:
    """One row with the most frequent author, ``N/A`` for articles without one."""
    return top_authors(gold, 1).select(
        F.when(F.coalesce("author", F.lit("")) == "", "N/A").otherwise(F.col("author")).alias("author"),
        "article_count",
    )


def _exploded_tags(gold: DataFrame) -> DataFrame:
    return gold.select(F.explode("tags").alias("tag"))


def top_tag(gold: DataFrame) -> DataFrame:
    return (
        _exploded_tags(gold)
        .groupBy("tag")
        .agg(_n("tag_count"))
        .orderBy(F.desc("tag_count"), F.col("tag").asc_nulls_last())
        .limit(1)
    )


def overview_metrics(gold: DataFrame, today: date) -> DataFrame:
    """The four headline figures as one row."""
    return gold.agg(
        _n("total_articles"),
        F.count_if(
            F.col("date_published") >= F.date_sub(F.trunc(F.lit(today), "MM"), 180).cast("timestamp")
        ).alias("last_six_months"),
    ).select(
        "total_articles",
        "last_six_months",
        top_author(gold).select("author").scalar().alias("top_author"),
        top_tag(gold).select("tag").scalar().alias("top_tag"),
    )


def authors(gold: DataFrame) -> DataFrame:
    return gold.select("author").distinct().orderBy(F.col("author").asc_nulls_last())


def tags(gold: DataFrame, distinct: bool = True) -> DataFrame:
    """Tags of all articles; ``distinct=False`` keeps one row per article and tag."""
    found = _exploded_tags(gold)
    return found.distinct().orderBy(F.col("tag").asc_nulls_last()) if distinct else found


def monthly_trend(gold: DataFrame, start: date, end: date) -> DataFrame:
    """Articles per month of publication, from the start of one day to the end of another."""
    first = datetime(start.year, start.month, start.day)
    last = datetime(end.year, end.month, end.day, 23, 59, 59)
    published = F.col("date_published")
    return (
        filter_window(gold, "date_published", first, last)
        .groupBy(
            F.year(published).cast("bigint").alias("year"),
            F.month(published).cast("bigint").alias("month"),
        )
        .agg(_n("n_articles"))
        .orderBy("year", "month")
    )


def fill_month_gaps(trend: DataFrame) -> DataFrame:
    """Every month between the first and the last one; months without articles have NULL.

    The calendar comes from the minimum and maximum alone, so no global window is needed.
    """
    month = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1))
    dated = trend.select(month.alias("_month"), "n_articles")
    calendar = dated.agg(F.min("_month").alias("first"), F.max("_month").alias("last")).select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 month"))).alias("_month")
    )
    return (
        calendar.join(dated, "_month", "left")
        .select(
            F.year("_month").cast("bigint").alias("year"),
            F.month("_month").cast("bigint").alias("month"),
            F.date_format("_month", "yyyy-MM").alias("year_month"),
            "n_articles",
        )
        .orderBy("year_month")
    )


def article_filter(
    selected_authors: list[str] | None, selected_tags: list[str] | None, how: str = "and"
) -> Column | None:
    """Predicate for chosen authors (any of them) and tags (all of them).

    No choice, or one that includes ``All``, leaves that side out. With both sides chosen
    ``how`` joins them; with one side it alone decides. None means no restriction.
    """
    if how.lower() not in ("and", "or"):
        raise ValueError(f"how is 'and' or 'or', got {how!r}")
    by_author = by_tags = None
    if selected_authors and "All" not in selected_authors:
        by_author = F.col("author").isin(*selected_authors)
    if selected_tags and "All" not in selected_tags:
        by_tags = F.lit(True)
        for tag in selected_tags:
            # NULL members would make the test NULL instead of false.
            by_tags = by_tags & F.coalesce(F.array_contains("tags", tag), F.lit(False))
    if by_author is None or by_tags is None:
        return by_tags if by_author is None else by_author
    return by_author & by_tags if how.lower() == "and" else by_author | by_tags


def filter_articles(
    gold: DataFrame,
    selected_authors: list[str] | None = None,
    selected_tags: list[str] | None = None,
    how: str = "and",
    n: int | None = 10,
) -> DataFrame:
    """The ``n`` most recently published articles of a selection, or all; unknown dates come first."""
    predicate = article_filter(selected_authors, selected_tags, how)
    chosen = gold if predicate is None else gold.filter(predicate)
    columns = ["title", "author", "tags", "date_published", "date_modified"]
    if n is None:
        return chosen.select(columns)
    return (
        chosen.select("url", *columns)
        .orderBy(F.col("date_published").desc_nulls_first(), F.desc("date_modified"), "url")
        .limit(n)
        .select(columns)
    )


def modified_distribution(urls: DataFrame, column: str = "last_modified") -> DataFrame:
    """Rows per month of modification, the fullest month first."""
    stamp = F.col(column)
    return (
        urls.groupBy(
            F.year(stamp).cast("bigint").alias("year"),
            F.month(stamp).cast("bigint").alias("month"),
        )
        .agg(_n("n_urls"))
        .orderBy(F.desc("n_urls"), "year", "month")
    )


def urls_for_month(
    urls: DataFrame, year: int, month: int, column: str = "last_modified"
) -> DataFrame:
    """Rows of one month, as a half-open range so that the scan can skip row groups."""
    first = date(year, month, 1)
    after = date(year + month // 12, month % 12 + 1, 1)
    stamp = F.col(column)
    return urls.filter(
        (stamp >= F.lit(str(first)).cast("timestamp"))
        & (stamp < F.lit(str(after)).cast("timestamp"))
    )


def row_counts(
    df: DataFrame, start=None, end=None, ts_col: str = "date_modified"
) -> DataFrame:
    """Number of rows, within a window if one is given."""
    return (df if start is None else filter_window(df, ts_col, start, end)).agg(_n("n_rows"))


def sample_rows(df: DataFrame, k: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """``k`` rows to look at; without an order any rows may come."""
    return (df.orderBy(*order_by) if order_by else df).limit(k)
