"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    # Stored stamps carry no zone, so every session has to read them in the same one.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A third of all rows may share one url, target or term: let AQE split that partition.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Texts and pages are long; small Arrow batches keep Python workers within memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    # Every layer stores texts again, so files are packed tighter than by default.
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(app_name: str = "broadsheet", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the operators assume; keyword arguments use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Make a session started elsewhere fit: the settings above, and this package on the workers."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    context = spark.sparkContext
    if not getattr(context, "_has_broadsheet", False):
        package = Path(__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="broadsheet-code-")) / "broadsheet.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        context._has_broadsheet = True
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    created = tempfile.mkdtemp(prefix="broadsheet-")
    spark.conf.set("spark.checkpoint.dir", created)
    return created


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits(df: DataFrame, max_rows: int, max_bytes: int = 64 << 20) -> bool:
    """Whether ``df`` is proven to hold at most so many rows and serialised bytes.

    Reads at most ``max_rows + 1`` rows, so the check itself stays small.
    """
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    rows, size = (
        df.limit(max_rows + 1)
        .agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0)))
        .first()
    )
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Broadcast hint only behind a check of the size; otherwise the join shuffles."""
    return F.broadcast(df) if fits(df, max_rows) else df
