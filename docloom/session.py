"""Session helpers: settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Of a repeated key in a JSON object the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names.

    Where none is set, a local master gets a folder of this machine, deleted at the end;
    on any other master its executors would each write to their own disk, so that is
    an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master.split("[")[0] != "local":
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        folder = os.path.join(tempfile.gettempdir(), f"docloom-{uuid.uuid4().hex}")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder, so lost executors lose nothing."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()
