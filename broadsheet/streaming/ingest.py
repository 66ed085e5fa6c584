"""Incremental bronze loading from the raw directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import new_versions
from ..schemas import BRONZE, RAW
from ..sources.tables import save_table, stored_months_of


def append_new_versions(batch: DataFrame, bronze_path: str) -> None:
    """Appends the versions of one batch that bronze does not hold yet.

    The comparison reads only months the batch touches. Doing a batch again appends
    nothing, which makes the stream safe to restart at any point.
    """
    incoming = batch.select(*BRONZE.fieldNames())
    stored = stored_months_of(batch.sparkSession, bronze_path, BRONZE, incoming)
    save_table(new_versions(stored, incoming), bronze_path)


def ingest_stream(
    spark: SparkSession,
    raw_base: str,
    bronze_path: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Loads the raw files not seen yet into bronze, then stops.

    The stream keeps file offsets only; what is a duplicate is decided against the table.
    """
    reader = spark.readStream.schema(RAW)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (
        reader.parquet(raw_base)
        .writeStream.foreachBatch(lambda batch, _: append_new_versions(batch, bronze_path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
