"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators were planned with.  None of them is needed for right
# results; a cluster may override each one.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins whose build partitions are this small need no sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(cpus: int | str = "*", app: str = "quadspark", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the given one."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    local = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    for key, value in {**DEFAULTS, **local, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a temporary folder; a
    cluster session is refused, because a machine-local folder would not
    survive the loss of an executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    local = tempfile.mkdtemp(prefix="quadspark-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Send the package to the executors' Python, once per Spark context."""
    context = spark.sparkContext
    if not getattr(context, "_quadspark_shipped", False):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/quadspark", "zip", root, "quadspark"))
        context._quadspark_shipped = True
