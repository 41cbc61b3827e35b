"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Partition counts and broadcast limits stay the cluster's own: adaptive execution merges small
# shuffle partitions and splits skewed join partitions from the sizes it measures.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed join partitions even where a later step by the same key then shuffles once more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
}


def build_session(app_name: str = "paywatch", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def use_checkpoint_dir(spark: SparkSession) -> bool:
    """Point the context at the shared folder the cluster names; False if there is none.

    A local session, which has no other machine to share with, gets a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and context.master.startswith("local"):
            folder = tempfile.mkdtemp(prefix="paywatch-checkpoint-")
        if folder is None:
            return False
        context.setCheckpointDir(folder)
    return True


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store a result several branches read, so its plan runs once and survives lost executors.

    It is a Parquet table in the shared folder: every branch reads only the columns it needs. Rows have no order.
    """
    path = f"{storage_dir(df.sparkSession)}/stored-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def storage_dir(spark: SparkSession) -> str:
    """Folder for what a job stores: the context's checkpoint folder."""
    if not use_checkpoint_dir(spark):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return spark.sparkContext.getCheckpointDir()
