"""Session settings and the shared folder for data a job writes on the side."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "loadlake", **conf: str) -> SparkSession:
    """A UTC session with adaptive execution and streaming state off the heap; ``conf`` overrides any setting."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone; every stored timestamp is UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder all executors can reach.

    It lies under ``spark.checkpoint.dir``. Only a local master may go without
    that setting; the warehouse takes its place then.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
