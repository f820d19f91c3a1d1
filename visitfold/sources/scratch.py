"""Folders for tables that a run writes and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, or else below the warehouse.

    Both are places that the cluster configures for all its machines. Nothing here deletes
    the folders: a job may still be reading them, and the cluster's owner sets how long
    checkpoints are kept.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    shared = shared or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
