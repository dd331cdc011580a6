"""Session set-up and the shared folder that jobs may write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job needs for right results (UTC), for surviving skew (adaptive execution) or for bounded memory.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where the step after it then has to shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rows go to Python in batches of bounded bytes: 10,000 long texts at once would not fit a worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def build_session(app_name: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Create a session. Object-store credentials and endpoints are passed through ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**REQUIRED_CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_required_conf(spark: SparkSession) -> SparkSession:
    """Apply :data:`REQUIRED_CONF` to a session somebody else built."""
    for name, value in REQUIRED_CONF.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Every executor must see the folder, so a machine-local one is used only when the whole
    session runs on one machine (``local[...]``) and names no shared folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="tidemark-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
