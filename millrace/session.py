"""Session settings and the shared scratch folder.

``spark.checkpoint.dir`` names the folder every executor can reach. Small
intermediate tables are written there, so they outlive a lost executor and the
planner knows their true size when it chooses between broadcast and shuffle.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split at run time even where an aggregation on the same
    # key follows the join and an extra shuffle is the price.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_session_folders: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Set what the jobs rely on, where the session has not set it itself."""
    chosen = spark.conf.getAll
    for key, value in RUNTIME_SETTINGS.items():
        if key not in chosen:
            spark.conf.set(key, value)
    return spark


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Delete an existing path when the application's JVM ends, as frames may read it until then."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.deleteOnExit(hadoop_path)


def scratch_root(spark: SparkSession) -> str:
    """A folder of this application below the shared folder; a temporary one in local mode only.

    ``spark.checkpoint.dir`` has to be reachable from all executors, be it through a shared
    mount or another file system; a path alone does not tell. The folder goes with the
    application.
    """
    context = spark.sparkContext
    app = context.applicationId
    if app in _session_folders:
        return _session_folders[app]
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="millrace-")
        delete_at_end(spark, configured)
    root = f"{configured.rstrip('/')}/millrace-{app}-{uuid.uuid4().hex[:8]}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(root)
    hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()).mkdirs(hadoop_path)
    delete_at_end(spark, root)
    _session_folders[app] = root
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Used for aggregated tables (one row per group or per histogram cell) and between stages.
    Spark compares the size of the written files with
    ``spark.sql.autoBroadcastJoinThreshold``: a small table is broadcast, a
    larger one takes part in a shuffled join.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
