"""Session settings and the folder for intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def recommended_conf(cores: int) -> dict[str, str]:
    """Settings for a reconciliation session with that many cores.

    Shuffles only ever carry summaries, so AQE starts from one partition for each
    core (8 at least) and coalesces; skew handling serves the inner joins of the catalog.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(max(8, cores)),
        "spark.sql.session.timeZone": "UTC",
        # Recording the Python call site of every column costs a third of the time
        # it takes to build a plan over many tables.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that all executors can reach.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``.  Only a
    local session without that setting falls back to this machine's own.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
        return tempfile.mkdtemp(prefix="tallymatch-")
    return f"{base.rstrip('/')}/tallymatch-{uuid.uuid4().hex}"
