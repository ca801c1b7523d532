"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SQL_SETTINGS = {
    # dates and load times are compared in UTC everywhere
    "spark.sql.session.timeZone": "UTC",
    # a repeated feed column keeps its last value
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # top-n per key is limited map-side up to the largest page
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    # rewriting a table touches only the partitions present in the new rows
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "pricemart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the warehouse settings; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the warehouse SQL settings to a session somebody else built."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local run that names none takes a folder of its own; on a cluster that is an error, as executors
    could not read a folder of the driver.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if named is None and current is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="pricemart-")
    if current is None:
        spark.sparkContext.setCheckpointDir(named)
    return named or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
