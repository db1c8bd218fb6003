"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_ZONE = "UTC"
LOCAL_ZONE = "Europe/Tallinn"

# Bytes of rows that go to a Python worker at a time, unless the session has set its own bound.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_local_dirs: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC; hour buckets are UTC instants everywhere."""
    if spark.conf.get("spark.sql.session.timeZone") != SESSION_ZONE:
        spark.conf.set("spark.sql.session.timeZone", SESSION_ZONE)
    return spark


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by their bytes too: 10,000 rows of long texts are far more than a worker needs at once."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors all reach.

    Taken from ``spark.checkpoint.dir``. Only a local session may fall back to
    a temporary folder, because there the driver is the only machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="hearth-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, one tree per application."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/hearth/{app}/{label}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Delete this application's scratch tree, once nothing reads from it any more."""
    tree = f"{shared_dir(spark)}/hearth/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(tree)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
