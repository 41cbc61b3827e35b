"""Per-batch metrics, running totals and alert lists.

A batch may hold any share of the rows: batches are only reduced by partial aggregation or a
pre-shuffle top-k, never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paywatch.functions.columns import ratio, whole_part
from paywatch.operators.project import is_canary
from paywatch.operators.slices import running_totals
from paywatch.sources.schema import ALERT_LIST_ROWS, BATCH_ALERTS, CANARY_PERIOD

BATCHES_PER_SLICE = 10_000


def batch_meta(txns: DataFrame, ts: str = "timestamp") -> DataFrame:
    """One row per batch: rows in it and its single detection time."""
    return txns.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("total_batch_txns"), F.max(ts).alias("pipeline_detected_at")
    )


def with_batch_meta(alerts: DataFrame, txns: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Alerts with detection time, batch id and batch size."""
    return alerts.join(batch_meta(txns, ts), "batch_id", "left")


def top_by_amount(txns: DataFrame, k: int = BATCH_ALERTS, amount: str = "amount") -> DataFrame:
    """The k largest rows of every batch; each map task sends at most k rows per batch."""
    order = Window.partitionBy("batch_id").orderBy(F.desc(amount), "transaction_id")
    return txns.withColumn("alert_rank", F.row_number().over(order)).filter(F.col("alert_rank") <= k)


def alert_struct() -> Column:
    return F.struct(
        F.coalesce("transaction_id", F.lit(0)).cast("long").cast("string").alias("id"),
        F.col("fraud_score").alias("score"),
        F.coalesce("location", F.lit("Unknown")).alias("location"),
    )


def batch_alerts(txns: DataFrame, k: int = BATCH_ALERTS) -> DataFrame:
    """Per batch an array of its k alert structs, largest amount first."""
    top = top_by_amount(txns, k).select("batch_id", "alert_rank", alert_struct().alias("alert"))
    return top.groupBy("batch_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("alert_rank", "alert"))), lambda x: x["alert"]).alias("alerts")
    )


def batch_counts(txns: DataFrame, pred: str = "pred", label: str = "is_fraud") -> DataFrame:
    """Per batch: rows, predicted positives, actual positives, missed positives."""
    return txns.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("batch_size"),
        F.count_if(F.col(pred) == 1).alias("detected"),
        F.count_if(F.col(label) == 1).alias("actual"),
        F.count_if((F.col(pred) == 0) & (F.col(label) == 1)).alias("missed"),
    )


def batch_metrics(txns: DataFrame, k: int = BATCH_ALERTS) -> DataFrame:
    """The metric record of every batch, alerts nested."""
    return batch_counts(txns).join(batch_alerts(txns, k), "batch_id", "left")


def running_batch_totals(counts: DataFrame) -> DataFrame:
    """Totals up to and including every batch."""
    sliced = counts.withColumn("_slice", whole_part(F.col("batch_id"), BATCHES_PER_SLICE))
    sums = {"total": "batch_size", "detected_total": "detected", "actual_total": "actual", "missed_total": "missed"}
    return running_totals(
        sliced, "_slice", [F.col("batch_id")], {n: F.col(c) for n, c in sums.items()}
    ).select("batch_id", *sums)


def latest_alerts(txns: DataFrame, n: int = ALERT_LIST_ROWS, k: int = BATCH_ALERTS) -> DataFrame:
    """The newest n entries of the alert list: batches newest first, k per batch.

    Every batch has at least one row, so the newest n batches hold them: only these are ranked.
    """
    newest = txns.select("batch_id").distinct().orderBy(F.desc_nulls_last("batch_id")).limit(n).agg(F.min("batch_id").alias("b")).scalar()
    return (
        top_by_amount(txns.filter(F.col("batch_id") >= newest), k)
        .orderBy(F.desc("batch_id"), "alert_rank").limit(n)
    )


def snapshot(txns: DataFrame, n: int = ALERT_LIST_ROWS) -> DataFrame:
    """One row: totals over all batches and the newest n alerts as an array."""
    totals = txns.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("pred") == 1).alias("detected"),
        F.count_if(F.col("is_fraud") == 1).alias("actual"),
        F.count_if((F.col("pred") == 0) & (F.col("is_fraud") == 1)).alias("missed"),
    )
    entry = F.struct((-F.col("batch_id")).alias("newest"), "alert_rank", alert_struct().alias("alert"))
    newest = latest_alerts(txns, n).agg(
        F.transform(F.sort_array(F.collect_list(entry)), lambda x: x["alert"]).alias("alerts")
    )
    return totals.withColumn("alerts", newest.scalar())


def alerts_per_batch(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("batch_id").agg(F.count(F.lit(1)).alias("alert_count"))


def alerts_per_window(alerts: DataFrame, width: str = "1 hour", lateness: str = "1 hour",
                      ts: str = "timestamp") -> DataFrame:
    """Alert count per tumbling event-time window; on a stream, rows later than ``lateness`` are dropped."""
    source = alerts.withWatermark(ts, lateness) if alerts.isStreaming else alerts
    return source.groupBy(F.window(ts, width).alias("_w")).agg(F.count(F.lit(1)).alias("alert_count")).select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "alert_count"
    )


def canary_recall(df: DataFrame, pred: str = "pred", period: int = CANARY_PERIOD) -> DataFrame:
    """How many injected rows there are and which share was flagged."""
    return df.filter(is_canary(period=period)).agg(
        F.count(F.lit(1)).alias("canaries"),
        F.count_if(F.col(pred) == 1).alias("flagged"),
        ratio(F.count_if(F.col(pred) == 1), F.count(F.lit(1))).alias("recall"),
    )
