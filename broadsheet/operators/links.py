"""Gold publication and the link audit."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.urls import resolve_url
from ..functions.windows import filter_window
from ..schemas import GOLD, GOLD_LIMITS, GOLD_LINKS
from .upsert import replace_window

# Link status labels.
EXTERNAL_WORKING, EXTERNAL_BROKEN = "external_working", "external_broken"
INTERNAL_WORKING, INTERNAL_BROKEN = "internal_working", "internal_broken"
MAIL_LINK, PARSE_ERROR = "mail_link", "parse_error"
TIMEOUT_STATUS = "timeout 30 sec"


def links_as_json(links: Column) -> Column:
    """Array of links as JSON text; NULL stays NULL, NULL members are kept."""
    return F.to_json(links, {"ignoreNullFields": "false"})


def as_gold(silver: DataFrame) -> DataFrame:
    return silver.withColumn("content_links", links_as_json(F.col("content_links"))).select(
        *GOLD.fieldNames()
    )


def publish_gold(silver: DataFrame, gold: DataFrame, start, end) -> DataFrame:
    """The gold table after the window was replaced by the silver rows inside it."""
    inside = filter_window(silver, "date_modified", start, end)
    return replace_window(gold, as_gold(inside), start, end)


def check_limits(
    df: DataFrame,
    limits: dict[str, int] | None = None,
    id_col: str = "row_id",
    vector_col: str | None = None,
    dimension: int | None = None,
) -> DataFrame:
    """``(id, column, size, allowed)`` for values a fixed-width store would refuse.

    One pass: each row yields its violations as an array that is then flattened.
    """
    limits = GOLD_LIMITS if limits is None else limits

    def length(c: str) -> Column:
        """Characters of a text, or of the JSON text a struct is stored as."""
        nested = isinstance(df.schema[c].dataType, T.StructType)
        return F.char_length(F.to_json(c) if nested else F.col(c))

    found = [
        F.when(
            length(c) > n,
            F.struct(
                F.lit(c).alias("column"),
                length(c).cast("bigint").alias("size"),
                F.lit(n).cast("bigint").alias("allowed"),
            ),
        )
        for c, n in limits.items()
    ]
    if vector_col is not None:
        size = F.array_size(vector_col).cast("bigint")
        found.append(
            F.when(
                size != dimension,
                F.struct(
                    F.lit(vector_col).alias("column"),
                    size.alias("size"),
                    F.lit(dimension).cast("bigint").alias("allowed"),
                ),
            )
        )
    violations = F.array_compact(F.array(*found))
    return df.select(F.col(id_col).alias("id"), F.explode(violations).alias("v")).select(
        "id", "v.column", "v.size", "v.allowed"
    )


def author_snapshot(silver: DataFrame) -> DataFrame:
    """Sorted distinct authors, rebuilt on every run."""
    return silver.select("author").distinct().orderBy(F.col("author").asc_nulls_last())


def classify_link(
    links: DataFrame, url_col: str = "url", link_col: str = "link"
) -> DataFrame:
    """Adds ``kind`` and ``target``; only links with a target need a probe.

    ``same_site`` tells whether the target lies on the page's own host.
    """
    url, link = F.col(url_col), F.col(link_col)
    absolute = r"^(https?://[^)]+)"
    has_http, has_mail = link.contains("http"), link.contains("mail")
    external, internal = F.lit("external"), F.lit("internal")
    kind = (
        F.when(link.isNull(), PARSE_ERROR)
        .when(has_http & link.rlike(absolute), external)
        .when(has_http, internal)
        .when(has_mail & link.rlike(r"^mailto:[^)]+"), MAIL_LINK)
        .when(has_mail, F.lit(None).cast("string"))
        .when(link.startswith("#"), INTERNAL_WORKING)
        .otherwise(internal)
    )
    # A host with one square bracket alone cannot be joined.
    host_text = F.regexp_extract(link, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    unreadable = host_text.contains("[") != host_text.contains("]")
    kind = F.when((kind == internal) & unreadable, PARSE_ERROR).otherwise(kind)
    with_kind = links.withColumn("kind", kind)
    target = F.when(F.col("kind") == external, F.regexp_extract(link, absolute, 1)).when(
        F.col("kind") == internal, resolve_url(url, link)
    )
    host = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
    with_target = with_kind.withColumn("target", target)
    same = F.regexp_extract("target", host, 1) == F.regexp_extract(url, host, 1)
    return with_target.withColumn("same_site", same)


Probe = Callable[[pd.Series], pd.Series]


def probe_targets(classified: DataFrame, probe: Probe, parallelism: int = 200) -> DataFrame:
    """``(target, outcome)`` of every distinct target; outcomes are ok, error or timeout.

    ``probe`` maps a batch of targets to outcomes and brings its own client. Each target is
    probed once, however many links point to it, and tasks get even shares of the targets.
    """

    def run(batches):
        for batch in batches:
            yield pd.DataFrame({"target": batch["target"], "outcome": probe(batch["target"])})

    targets = classified.filter(F.col("target").isNotNull()).select("target").distinct()
    return targets.repartition(parallelism, "target").mapInPandas(
        run, "target string, outcome string"
    )


def link_status(classified: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Classified links with ``link_status``.

    Outcomes hold one row per target. No broadcast hint: they grow with the links, so Spark
    broadcasts them only below its size limit, and AQE splits a target many links share.
    A timeout hides the kind. An empty link is labelled external although its target is the
    page itself.
    """
    joined = classified.join(outcomes, "target", "left")
    labelled_external = (F.col("kind") == "external") | (F.col("link") == "")
    probed = (
        F.when(F.col("outcome") == "timeout", TIMEOUT_STATUS)
        .when(F.col("outcome") == "ok", F.when(labelled_external, EXTERNAL_WORKING).otherwise(INTERNAL_WORKING))
        .when(F.col("outcome") == "error", F.when(labelled_external, EXTERNAL_BROKEN).otherwise(INTERNAL_BROKEN))
    )
    status = F.when(F.col("target").isNull(), F.col("kind")).otherwise(probed)
    return joined.withColumn("link_status", status)


def audit_links(
    silver_links: DataFrame, start, end, probe: Probe, parallelism: int = 200
) -> DataFrame:
    """Gold link rows of one window: classify, probe the distinct targets, label."""
    classified = classify_link(filter_window(silver_links, "date_modified", start, end))
    return link_status(classified, probe_targets(classified, probe, parallelism)).select(
        *GOLD_LINKS.fieldNames()
    )


def publish_gold_links(gold_links: DataFrame, new: DataFrame, start, end) -> DataFrame:
    """The gold link table after its window was replaced by audited links."""
    return replace_window(gold_links, new.select(*GOLD_LINKS.fieldNames()), start, end)


def link_status_counts(gold_links: DataFrame) -> DataFrame:
    """Links per status, most frequent first."""
    return (
        gold_links.groupBy("link_status")
        .agg(F.count(F.lit(1)).alias("n_links"))
        .orderBy(F.desc("n_links"), "link_status")
    )
