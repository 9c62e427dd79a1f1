"""Folders that the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN: dict[str, str] = {}


def fresh_folder(spark: SparkSession, tag: str) -> str:
    """A new name under ``spark.checkpoint.dir``; a folder of one's own only where that is unset and the master is local (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = tempfile.mkdtemp(prefix="sigspark-")
        base = _OWN[app]
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"
