"""Session defaults and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "cellstride", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings this package expects; ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local-mode session, where driver and
    executors are one process, may fall back to a folder of its own.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not shared:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="cellstride-")
        spark.conf.set("spark.checkpoint.dir", shared)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared)
    return shared


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")
