"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Naive timestamps are UTC throughout, so the session must agree.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "cindergrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on; ``conf`` adds or overrides."""
    # Plans are built by library code: do not record a Python call site per column.
    conf = {"spark.python.sql.dataFrameDebugging.enabled": "false", **conf}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def adopt(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"session time zone must be UTC, not {zone}; see cindergrid.session.adopt")


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder the cluster shares (``spark.checkpoint.dir``).

    Only a local session may fall back to a temporary folder; elsewhere executors would
    not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="cindergrid-")
    return f"{base.rstrip('/')}/cindergrid/{label}-{uuid.uuid4().hex}"
