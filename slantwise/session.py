"""Session settings, the shared work folder, and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A table may be broadcast when it is known to hold at most this many rows.
BROADCAST_ROWS = 200_000

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Temporary folder of a local session that names none, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app_name: str = "slantwise", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on; cluster settings win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a fresh temporary
    folder; on a cluster the setting is required.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder shared by the cluster")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL_FOLDERS[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """New, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def local_folder(spark: SparkSession, path: str) -> str | None:
    """The plain name of a path of the local file system, as every executor sees it; None for other file systems."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() != "file":
        return None
    return place.toUri().getPath()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: one evaluation, cut lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` when it is proven small, otherwise leave the join to Spark.

    ``rows`` is a bound known by construction (a vocabulary cap, a class list).
    Without one the table is counted, reading no more than ``limit + 1`` rows.
    """
    if rows is None:
        rows = df.limit(limit + 1).count()
    return F.broadcast(df) if rows <= limit else df


def spread(df: DataFrame) -> DataFrame:
    """Give a scan at least one partition per core.

    A table of many files already has more splits than cores and is returned
    unchanged; only a table too small to be split is redistributed.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)
