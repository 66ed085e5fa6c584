"""Readers and writers of the layer tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import year_month
from ..functions.windows import filter_window, in_window, months_in
from ..operators.upsert import new_versions, replace_window
from ..schemas import BRONZE, RAW
from ..session import stage

MONTH = ["year", "month"]


def spread_scan(scan: DataFrame) -> DataFrame:
    """A plain file scan, redistributed only if it has fewer splits than there are cores.

    A few files of one row group each would leave most cores idle. Large datasets have more
    splits than cores and stay as they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages: ``page_id``, ``url``, ``html``."""
    schema = "page_id bigint, url string, html string"
    return spread_scan(spark.read.schema(schema).parquet(path))


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def apply_schema(df: DataFrame, schema: T.StructType = RAW) -> DataFrame:
    """The declared columns in the declared types; missing ones become NULL."""
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def apply_raw_schema(df: DataFrame) -> DataFrame:
    return apply_schema(df, RAW)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_raw(spark: SparkSession, base: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """Article columns of the raw dataset; year and month select partitions."""
    raw = spark.read.schema(RAW).parquet(base)
    if year is not None:
        raw = raw.filter(F.col("year") == year)
    if month is not None:
        raw = raw.filter(F.col("month") == month)
    return raw.select(*BRONZE.fieldNames())


def load_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table in its declared schema, or an empty one if it does not exist yet."""
    if not path_exists(spark, path):
        return empty_like(spark, schema)
    return _stored(spark, path, schema).select(*schema.fieldNames())


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table with its partition columns."""
    stored = T.StructType(list(schema.fields))
    for name in MONTH:
        if name not in stored.fieldNames():
            stored = stored.add(name, T.IntegerType())
    return spark.read.schema(stored).parquet(path)


def load_window(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    start: datetime,
    end: datetime,
    ts_col: str = "date_modified",
) -> DataFrame:
    """The rows of a stored table inside a window; only the folders of its months are read."""
    if not path_exists(spark, path):
        return empty_like(spark, schema)
    inside = _stored(spark, path, schema).filter(_in_months(months_in(start, end)))
    return filter_window(inside, ts_col, start, end).select(*schema.fieldNames())


def with_months(df: DataFrame, ts_col: str = "date_modified") -> DataFrame:
    if set(MONTH) <= set(df.columns):
        return df
    return df.withColumns(year_month(F.col(ts_col)))


def save_table(
    df: DataFrame, path: str, ts_col: str = "date_modified", mode: str = "append"
) -> None:
    """Writes by year and month of ``ts_col``.

    The rebalance step gathers small months into few files and splits a month that holds a
    large share of the rows, by its size.
    """
    balanced = with_months(df, ts_col).hint("rebalance", *MONTH)
    writer = balanced.write.mode(mode).partitionBy(*MONTH)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_raw(articles: DataFrame, base: str) -> None:
    """Stores article records by year and month of modification; a rerun replaces them.

    Records with the same url and stamp are replaced, all others of the touched months stay.
    Both inputs of the new months are written to the shared folder first, since a dataset
    cannot be read while its files are being replaced.
    """
    spark = articles.sparkSession
    incoming = new_versions(empty_like(spark, RAW), apply_raw_schema(articles))
    if not path_exists(spark, base):
        save_table(incoming, base)
        return
    incoming = stage(incoming, "raw-incoming")
    stored = stored_months_of(spark, base, RAW, incoming)
    kept = stage(new_versions(incoming, stored), "raw-kept")
    save_table(incoming.unionByName(kept), base, mode="overwrite")


def stored_months_of(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    incoming: DataFrame,
    ts_col: str = "date_modified",
) -> DataFrame:
    """The stored rows of those months that ``incoming`` touches.

    The distinct months come to the driver, at most one row per month of the calendar, and
    go back as a partition filter. Rows without a stamp have a partition of their own.
    """
    if not path_exists(spark, path):
        return empty_like(spark, schema)
    touched = with_months(incoming, ts_col).select(*MONTH).distinct().collect()
    return stored_in_months(spark, path, schema, [tuple(r) for r in touched])


def stored_in_months(
    spark: SparkSession, path: str, schema: T.StructType, months: list[tuple]
) -> DataFrame:
    """The stored rows of the (year, month) pairs; a pair with NULL means rows without a stamp."""
    if not path_exists(spark, path):
        return empty_like(spark, schema)
    fields = [f for f in schema.fields if f.name not in MONTH]
    stored = spark.read.schema(
        T.StructType(fields + [T.StructField(name, T.IntegerType()) for name in MONTH])
    ).parquet(path)
    dated = [year * 12 + month for year, month in months if year is not None and month is not None]
    wanted = (F.col("year") * 12 + F.col("month")).isin(dated)
    if len(dated) < len(months):
        wanted = wanted | F.col("year").isNull() | F.col("month").isNull()
    return stored.filter(wanted).select(*schema.fieldNames())


def _in_months(months: list[tuple[int, int]]) -> Column:
    """Partition filter for a run of months, by year and month alone."""
    first, last = months[0], months[-1]
    index = F.col("year") * 12 + F.col("month")
    return index.between(first[0] * 12 + first[1], last[0] * 12 + last[1])


def replace_stored_window(
    new: DataFrame,
    path: str,
    start: datetime,
    end: datetime,
    ts_col: str = "date_modified",
) -> None:
    """Deletes the window from a stored table and appends the rows of ``new`` inside it.

    Only the months the window touches are read and rewritten. Stored rows that stay in them are written
    first, since a table cannot be read while its files are replaced; ``new`` only if it reads the table too.
    """
    spark = new.sparkSession
    months = months_in(start, end)
    inside = with_months(new.filter(in_window(F.col(ts_col), start, end)), ts_col)
    if not path_exists(spark, path):
        save_table(inside, path, ts_col)
        return
    whole = spark.read.schema(inside.schema).parquet(path)
    if not set(inside.inputFiles()).isdisjoint(whole.inputFiles()):
        inside = stage(inside, "window")
    stored = whole.filter(_in_months(months))
    kept = stage(replace_window(stored, inside.limit(0), start, end, ts_col), "kept")
    result = replace_window(kept, inside, start, end, ts_col)
    # One row per month at most: all stamps lie in the months of the window. No text is read for it.
    filled = {tuple(r) for r in result.select(*MONTH).distinct().collect()}
    save_table(result, path, ts_col, mode="overwrite")
    for year, month in months:
        if (year, month) not in filled:
            drop_month(spark, path, year, month)


def drop_month(spark: SparkSession, path: str, year: int, month: int) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/year={year}/month={month}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_articles_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; arrays and structs are written as JSON text."""
    flat = [
        F.to_json(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    written = df.select(*flat).write.option("header", True).option("escape", '"')
    # Without these the writer trims values.
    for side in ("Leading", "Trailing"):
        written = written.option(f"ignore{side}WhiteSpace", False)
    written.csv(path)
