"""Session settings the jobs rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: Only what the library needs; cluster sizing belongs to the deployment.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # file size aimed at by rebalanced writes; smaller shuffles still spread over all cores
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.parquet.mergeSchema": "false",
}


def session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Event times are UTC; every date/hour derivation below depends on it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's checkpoint folder.

    Tables written here must be readable by every executor, so the location comes from
    ``spark.checkpoint.dir``. Where that is unset, as in tests, the warehouse folder
    serves, which executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/adlumen/{purpose}-{uuid.uuid4().hex}"
