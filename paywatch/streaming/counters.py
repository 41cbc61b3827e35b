"""Counters of a run: rows, alerts and rate of every micro-batch, taken while it is worked on, without a job of their own."""

from __future__ import annotations

from collections.abc import Callable
from threading import Event

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from paywatch.sources.schema import RUN_COUNTERS

SCHEMA = "batch_id long, rows long, alerts long, seconds double, rows_per_second double"


def observed(df: DataFrame, is_alert: Column) -> DataFrame:
    """The same rows; what passes is counted on the way."""
    return df.observe(RUN_COUNTERS, F.count(F.lit(1)).alias("rows"), F.count_if(is_alert).alias("alerts"))


class CounterTable(StreamingQueryListener):
    """Writes the counters that the micro-batches of watched queries report, one row each, as a table.

    A micro-batch that is repeated after a failure replaces its row. Progress arrives some time after the batch itself;
    ``settle`` waits until everything a stopped query reported has been written.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: dict[str, Event] = {}
        spark.streams.addListener(self)

    def watch(self, start: Callable[[], StreamingQuery]) -> StreamingQuery:
        """Start a query whose progress is to be counted."""
        query = start()
        self.ended.setdefault(str(query.runId), Event())
        return query

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), Event())

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(RUN_COUNTERS)
        if counts is None or not counts["rows"]:
            return
        seconds = progress.batchDuration / 1000.0
        row = (progress.batchId, counts["rows"], counts["alerts"], seconds, counts["rows"] / seconds if seconds else 0.0)
        self.spark.createDataFrame([row], SCHEMA).drop("batch_id").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch_id={progress.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), Event()).set()

    def settle(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        if not self.ended.setdefault(str(query.runId), Event()).wait(seconds):
            raise TimeoutError("the query has not reported its end")

    def close(self) -> None:
        self.spark.streams.removeListener(self)


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, rows, alerts, seconds, rows_per_second) of every micro-batch that had rows."""
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)
    return rows.select(F.col("batch_id").cast("long").alias("batch_id"), "rows", "alerts", "seconds", "rows_per_second")


def run_totals(counters: DataFrame) -> DataFrame:
    """One row: rows and alerts of the run so far, and the rate over the time its micro-batches took."""
    spent = F.sum("seconds")
    return counters.agg(
        F.count(F.lit(1)).alias("batches"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("alerts"), F.lit(0)).alias("alerts"),
        F.when(spent > 0, F.sum("rows") / spent).alias("rows_per_second"),
    )
