"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# Settings the operators are planned for; all can change in a running session.
PLANNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition also where an aggregate or join above then needs an exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the planning settings to a session made elsewhere."""
    for key, value in PLANNING.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "lateparcel", **overrides: str) -> SparkSession:
    """Return a session with timestamps read as UTC and the planning settings.

    AQE re-plans joins from measured sizes and cuts hot join partitions into pieces, and the
    number of shuffle partitions is only an upper bound that it coalesces.
    """
    settings = {
        **PLANNING,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # call sites for error messages cost several round trips per column expression
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({key: str(value) for key, value in overrides.items()})
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach: the checkpoint folder named by the cluster.

    Only a local master may fall back to a temporary folder of the machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="lateparcel-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(frame):
    """Reliable checkpoint of ``frame`` in the shared folder; survives the loss of executors."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)
