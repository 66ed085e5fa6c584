"""Written tables in the shared folder, which cut the lineage and outlive executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from broadsheet.session import scratch_path


class Scratch:
    """Tables of one run of an operator, so that those no longer read can go."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.base = spark, scratch_path(spark, label)
        self.paths: dict[int, str] = {}

    def write(self, df: DataFrame) -> DataFrame:
        """``df`` read back from a table that holds it."""
        path = f"{self.base}/{len(self.paths)}"
        df.write.option("compression", "zstd").parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[len(self.paths)] = path
        back._scratch_path = path
        return back

    def drop(self, table: DataFrame) -> None:
        """Delete a table that :meth:`write` returned and nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(table._scratch_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
