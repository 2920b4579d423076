"""Session settings used by the tests, the bench and stand-alone jobs.

The library itself never builds a session: every operator takes DataFrames, so
it runs with whatever settings the cluster gives.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins on member or provider keys meet hot keys; let AQE split them even
    # where that costs a further exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sessions are merged before the shuffle, so a hot member ships sessions, not rows.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str | int = "*", app: str = "adjudica", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench."""
    parts = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(parts))
    )
    # Stored tables of a local session go to a folder of its own, which ends with the process.
    folder = tempfile.mkdtemp(prefix="adjudica-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    builder = builder.config("spark.checkpoint.dir", f"file://{folder}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder for stored tables: the shared ``spark.checkpoint.dir``, else the session's warehouse folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/adjudica-stored"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
