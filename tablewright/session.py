"""Session settings the operators rely on, and the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# ANSI mode stays on (Spark's default). Shuffle partitions are left to adaptive execution and to
# the cluster: a fixed small number would be wrong on either side.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def session_builder(app_name: str = "tablewright") -> SparkSession.Builder:
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_folder(spark: SparkSession, label: str) -> str:
    """A path for one run's files that every executor can reach; nothing exists there yet.

    It lies below ``spark.checkpoint.dir``, or below the session's warehouse where that is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tablewright/{label}-{uuid.uuid4().hex}"
