"""Where intermediate tables and stream checkpoints go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a temporary folder, since there
    driver and executors are one process. A cluster without the setting is an error,
    because a folder on one machine would lose the data with that machine.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="kelda-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder nobody has used before."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
