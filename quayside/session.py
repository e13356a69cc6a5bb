"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# All times are zone-less UTC values, so the session zone must not shift them.
# The skew-join settings let a join survive one key with a third of the rows.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "quayside", master: str | None = None, **settings: str) -> SparkSession:
    """A session for scripts and tests; a cluster passes its own session to ``configure``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster session
    without it is refused, because executors do not share a local disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="quayside-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
