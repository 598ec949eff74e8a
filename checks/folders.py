"""Folders that the checks write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL: dict[str, str] = {}


def run_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``; a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    context = spark.sparkContext
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
        folder = _LOCAL.get(context.applicationId) or tempfile.mkdtemp(prefix="gondola-")
        _LOCAL[context.applicationId] = folder
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"
