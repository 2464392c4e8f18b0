"""Where jobs may put checkpoints and tables of their own: a folder all executors share."""

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Without the setting it is the folder the program has set for checkpoints.
    Only a local session, where driver and executors are one process, gets a
    temporary folder if there is neither.
    """
    context = spark.sparkContext
    named = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="matchlive-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
