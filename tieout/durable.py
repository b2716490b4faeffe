"""Cutting lineage in a place that outlives an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names; one of our own only where none is set, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named is None and context.getCheckpointDir() is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tieout-checkpoint-"))
    elif named is not None and context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def materialise(frame: DataFrame) -> DataFrame:
    """The frame computed once and kept in the checkpoint folder."""
    checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint folder, for a job that must write tables."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4()}"
