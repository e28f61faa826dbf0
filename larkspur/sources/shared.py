"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the context's checkpoint folder.

    Where neither is set and all runs on this machine (a local master), a temporary folder; elsewhere an error.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="larkspur-"))
        found = context.getCheckpointDir()
    return found


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new place in the shared folder, below the folder of this application."""
    return f"{shared_dir(spark)}/larkspur/{spark.sparkContext.applicationId}/{kind}/{uuid.uuid4().hex}"
