"""Paths of the storage zones, and where scratch data may go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from tidemark.model import ZONES


def zone(base: str, name: str) -> str:
    if name not in ZONES:
        raise ValueError(f"unknown zone {name!r}")
    return f"{base.rstrip('/')}/{name}"


def scratch(spark: SparkSession) -> str:
    """A new folder under the shared one the session names.

    A local folder serves where the session names none and driver and executors are
    one machine; elsewhere executors would write to disks that nobody else sees.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir has to name a shared folder on {master!r}")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    return f"{shared.rstrip('/')}/tidemark-{uuid.uuid4()}"
