"""Layers that follow what a run changed, from bronze to audited links.

A run notes the (url, month) keys of the versions it brings. Silver, gold and both link tables
are then worked out for these keys alone: no other article is derived again, no other link is
probed again, and only the folders of touched months are rewritten. Silver holds the newest
version per url and month, as if every month had been loaded as a window of its own.

A run that was ended is repeated under its name and gives the same tables: its keys are stored
before bronze grows, and every later step replaces the rows of its keys.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import year_month
from ..operators import links as L
from ..operators.silver import explode_links, newest_per_month
from ..operators.upsert import new_versions
from ..schemas import BRONZE, GOLD, GOLD_LINKS, RAW, SILVER, SILVER_LINKS, TOUCHED
from ..session import broadcast_if_small, stage
from ..sources import tables as S
from .medallion import Layout

# Bounds of every stamp, for steps that work on windows.
_ALWAYS = datetime(1, 1, 1), datetime(9999, 12, 31, 23, 59, 59)


def _of_keys(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows whose (url, month) is among the keys (``left_semi``) or is not (``left_anti``)."""
    months = year_month(F.col("date_modified"))
    asked = keys.select(
        F.col("url").alias("_url"), F.col("year").alias("_year"), F.col("month").alias("_month")
    )
    same = (
        F.col("url").eqNullSafe(F.col("_url"))
        & (months["year"] == F.col("_year"))
        & (months["month"] == F.col("_month"))
    )
    return df.join(asked, same, how)


def note_changes(batch: DataFrame, layout: Layout, run: str) -> DataFrame:
    """Appends the unseen versions of a batch to bronze; returns all keys the run touched.

    Versions without a stamp are appended but touch no month. Under a name used before, the
    keys of the earlier attempt come back as well.
    """
    spark = batch.sparkSession
    incoming = batch.select(*BRONZE.fieldNames())
    stored = S.stored_months_of(spark, layout.bronze, BRONZE, incoming)
    fresh = stage(new_versions(stored, incoming), "fresh")
    keys = fresh.filter(F.col("date_modified").isNotNull()).select(
        "url", *[c.alias(n) for n, c in year_month(F.col("date_modified")).items()]
    )
    keys.distinct().select(
        F.lit(run).alias("run"), *TOUCHED.fieldNames()
    ).write.mode("append").partitionBy("run").parquet(layout.touched)
    S.save_table(fresh, layout.bronze)
    return touched_keys(spark, layout, run)


def touched_keys(spark: SparkSession, layout: Layout, run: str) -> DataFrame:
    """The (url, year, month) keys a run touched; only its folder is read."""
    if not S.path_exists(spark, layout.touched):
        return S.empty_like(spark, TOUCHED)
    stored = spark.read.schema(T.StructType(TOUCHED.fields + [T.StructField("run", T.StringType())]))
    return (
        stored.parquet(layout.touched)
        .filter(F.col("run") == run)
        .select(*TOUCHED.fieldNames())
        .distinct()
    )


def replace_keys(
    new: DataFrame, keys: DataFrame, months: list[tuple], path: str, schema: T.StructType
) -> None:
    """Puts ``new`` in place of the stored rows of ``keys``, which lie in ``months``.

    Only these months are read and written; their other rows are written as they were. A month
    left without rows, as when a new version takes the last link away, loses its folder.
    """
    spark = new.sparkSession
    kept = _of_keys(S.stored_in_months(spark, path, schema, months), keys, "left_anti")
    result = stage(S.with_months(kept.unionByName(new.select(*schema.fieldNames()))), "changed")
    # One row per month at most.
    filled = {tuple(r) for r in result.select(*S.MONTH).distinct().collect()}
    for year, month in set(months) - filled:
        S.drop_month(spark, path, year, month)
    S.save_table(result, path, mode="overwrite")


def load_changes(
    batch: DataFrame, layout: Layout, run: str, probe: L.Probe, parallelism: int = 200
) -> DataFrame:
    """Brings a batch of article versions through all layers; returns the keys it touched.

    An empty batch, or one whose versions are all stored, touches nothing and writes nothing
    above bronze. Rows without url are one article per month, as in the window loads.
    """
    spark = batch.sparkSession
    keys = note_changes(batch, layout, run)
    # One row per month of the calendar at most.
    months = [tuple(r) for r in keys.select(*S.MONTH).distinct().collect()]
    if not months:
        return keys
    asked = broadcast_if_small(keys)
    bronze = S.stored_in_months(spark, layout.bronze, BRONZE, months)
    articles = stage(newest_per_month(_of_keys(bronze, asked, "left_semi")), "articles")
    classified = L.classify_link(explode_links(articles, *_ALWAYS))
    # Written before use: a probe may answer differently when a lost task runs again.
    outcomes = stage(L.probe_targets(classified, probe, parallelism), "outcomes")
    audited = L.link_status(classified, outcomes)
    for new, path, schema in (
        (articles, layout.silver, SILVER),
        (explode_links(articles, *_ALWAYS), layout.silver_links, SILVER_LINKS),
        (L.as_gold(articles), layout.gold, GOLD),
        (audited, layout.gold_links, GOLD_LINKS),
    ):
        replace_keys(new, asked, months, path, schema)
    return keys


def follow_raw(
    spark: SparkSession,
    layout: Layout,
    checkpoint: str,
    probe: L.Probe,
    max_files_per_trigger: int = 1000,
    parallelism: int = 200,
) -> StreamingQuery:
    """Brings raw files not seen yet through all layers in bounded batches, then stops.

    A batch that is done again has the name it had, so its keys are known although bronze
    holds its versions already. A checkpoint begun anew only makes a batch touch more keys.
    """

    def load(batch: DataFrame, number: int) -> None:
        load_changes(batch, layout, f"batch-{number}", probe, parallelism)

    return (
        spark.readStream.schema(RAW)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(layout.raw)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
