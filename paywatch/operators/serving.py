"""Queries over the alert table.

``alerts`` carries batch_id, total_batch_txns and pipeline_detected_at. Batch filters are written as
comparisons of batch_id with a scalar, which prunes an alert table partitioned by batch_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywatch.functions.columns import mix32
from paywatch.sources.schema import HISTORY_BATCHES, SYSTEM_COLUMNS, TOP_LOCATIONS

# The status words of the summary.
NO_ALERTS, SOME_ALERTS = "empty", "success"


def latest_alert(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(F.desc("pipeline_detected_at"), "transaction_id").limit(1)


def latest_batch(alerts: DataFrame) -> DataFrame:
    """Every alert of the newest batch that has any."""
    newest = alerts.agg(F.max("batch_id").alias("b")).scalar()
    return alerts.filter(F.col("batch_id") == newest)


def latest_summary(alerts: DataFrame) -> DataFrame:
    """One row about the newest batch; status "empty" when there is no alert at all."""
    n = F.count(F.lit(1))
    return latest_batch(alerts).agg(
        F.when(n == 0, NO_ALERTS).otherwise(SOME_ALERTS).alias("status"),
        F.coalesce(F.max("batch_id"), F.lit(0)).alias("batch_id"),
        n.alias("fraud_count"),
        F.coalesce(F.max("total_batch_txns"), F.lit(0)).alias("total_txns"),
        F.max("pipeline_detected_at").alias("detected_at"),
    )


def last_batches(alerts: DataFrame, n: int = HISTORY_BATCHES) -> DataFrame:
    """One row per batch for the newest n batches with alerts."""
    return (
        alerts.groupBy("batch_id").agg(
            F.max("total_batch_txns").alias("total_txns"),
            F.max("pipeline_detected_at").alias("detected_at"),
            F.count(F.lit(1)).alias("fraud_count"),
        )
        .orderBy(F.desc("batch_id")).limit(n)
    )


def last_batch_rows(alerts: DataFrame, n: int = HISTORY_BATCHES) -> DataFrame:
    """Every alert of the newest n batches, as rows."""
    oldest = last_batches(alerts, n).agg(F.min("batch_id").alias("b")).scalar()
    return alerts.filter(F.col("batch_id") >= oldest)


def last_batches_nested(alerts: DataFrame, n: int = HISTORY_BATCHES, chunks: int = 1) -> DataFrame:
    """The newest n batches with their alerts as arrays, one row per batch as in a document store.

    Where batches are too large for one array, use ``last_batch_rows``, or ask for several ``chunks``:
    then every batch, whatever its size, is spread by id hash over rows numbered 0 to chunks - 1; a
    number that no alert falls to has no row.
    """
    sizes = last_batches(alerts, n).select("batch_id", "total_txns", "detected_at")
    rows = alerts.join(F.broadcast(sizes), "batch_id")  # at most n rows
    keep = [c for c in alerts.columns]
    return (
        rows.withColumn("chunk", F.pmod(mix32(F.col("transaction_id")), F.lit(chunks)))
        .groupBy("batch_id", "chunk")
        .agg(
            F.max("total_txns").alias("total_txns"),
            F.max("detected_at").alias("detected_at"),
            F.collect_list(F.struct(*keep)).alias("frauds"),
        )
    )


def strip_store_id(nested: DataFrame, store_id: str = "_id", array: str = "frauds") -> DataFrame:
    """Remove the store's own id from every nested element."""
    if store_id not in nested.schema[array].dataType.elementType.fieldNames():
        return nested
    return nested.withColumn(array, F.transform(array, lambda x: x.dropFields(store_id)))


def chronological(history: DataFrame) -> DataFrame:
    """Oldest batch first; ``position`` counts from 1."""
    order = Window.orderBy("batch_id")  # history is a handful of batches
    return history.withColumn("position", F.row_number().over(order)).orderBy("position")


def device_counts(alerts: DataFrame) -> DataFrame:
    return latest_batch(alerts).groupBy(F.col("device_type").alias("name")).agg(F.count(F.lit(1)).alias("value"))


def top_locations(alerts: DataFrame, n: int = TOP_LOCATIONS) -> DataFrame:
    return (
        latest_batch(alerts).groupBy(F.col("location").alias("name")).agg(F.count(F.lit(1)).alias("frauds"))
        .orderBy(F.desc("frauds"), "name").limit(n)
    )


def history_lines(history: DataFrame) -> DataFrame:
    """Batch, transactions and alerts of ``last_batches``."""
    return history.select("batch_id", F.col("total_txns").alias("transactions"), F.col("fraud_count").alias("frauds"))


def detail_table(alerts: DataFrame, store_id: str = "_id") -> DataFrame:
    """Text table: system columns hidden, upper-case headers, numbers at two decimals."""
    fields = [f for f in alerts.schema if f.name not in (*SYSTEM_COLUMNS, store_id)]
    return alerts.select(*[
        (F.round(f.name, 2).try_cast("decimal(38,2)").cast("string") if isinstance(f.dataType, T.NumericType)
         else F.col(f.name).cast("string")).alias(f.name.upper())
        for f in fields
    ])
