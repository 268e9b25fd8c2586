"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession

_LOCAL_BASE: dict[str, str] = {}
_CLEANED: set[str] = set()


def build_session(app_name: str = "kerbcast", master: str | None = None, **conf) -> SparkSession:
    """A session with UTC time, adaptive execution and skew handling switched on.

    Nothing here fixes the cluster size: shuffle partitions are left to the caller and to adaptive
    coalescing, which merges small partitions after each shuffle.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **{k.replace("__", "."): str(v) for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workspace(spark: SparkSession) -> str:
    """Folder for tables this application writes, inside the one named by ``spark.checkpoint.dir``.

    That folder is shared between the machines of a cluster, so a written table outlives an executor.
    Only a local session may fall back to a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    app = spark.sparkContext.applicationId
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        if app not in _LOCAL_BASE:
            _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="kerbcast-")
        base = _LOCAL_BASE[app]
    folder = f"{base.rstrip('/')}/kerbcast-{app}"
    if folder not in _CLEANED:
        _CLEANED.add(folder)
        atexit.register(removed, spark, folder)
    return folder


def removed(spark: SparkSession, folder: str) -> None:
    """Delete a folder of this application, when the program ends or nothing reads it any more; without a running JVM it stays."""
    with suppress(Exception):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """An unused path under the workspace."""
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and is computed a single time."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
