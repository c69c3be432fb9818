"""Where iterative operators cut the lineage: tables written to the shared folder that the cluster names."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> None:
    """Makes sure that checkpoints have the folder of spark.checkpoint.dir; one of this machine's own in local mode only, where none is set."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    if named is None and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if named is None:
        named = tempfile.mkdtemp(prefix="cellweave-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    context.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """The rows as written to the shared folder: nothing before them is computed again, whichever executor is lost."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own, not made yet, in the shared folder."""
    shared_folder(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"
