"""Transaction tables on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paywatch.sources.schema import LABEL, NON_FEATURES, TXN_SCHEMA


def read_txns(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Transactions with the fixed schema; the CSV scan does not look at the data to find types."""
    reader = spark.read.schema(TXN_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def write_txns(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":  # the default format drops microseconds
        writer = writer.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    writer.format(fmt).save(path)


def save_splits(df: DataFrame, path: str, label: str = LABEL, mode: str = "errorifexists") -> None:
    """All splits in one pass as folders ``split=train|val|test``: features and the label."""
    drop = [c for c in NON_FEATURES if c != label]
    df.drop(*drop).write.mode(mode).partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One split; only its folder is read."""
    return spark.read.parquet(path).filter(F.col("split") == name).drop("split")


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Evaluation report, a handful of rows, as one CSV file."""
    report.coalesce(1).write.mode(mode).option("header", True).csv(path)
