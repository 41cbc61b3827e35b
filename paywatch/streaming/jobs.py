"""Stream scoring and per-batch metrics.

Decoding and scoring are one distributed plan on the streaming DataFrame; only the sink runs per
micro-batch. A sink writes each batch to its own ``batch_id=`` folder and overwrites it, so a batch
repeated after a failure leaves no duplicate. Errors are raised, so a failed batch is retried.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from paywatch.operators.batches import batch_metrics
from paywatch.operators.models import RiskModels, apply_model
from paywatch.operators.project import fill_zero, over_threshold, rule_hit
from paywatch.sources.messages import checked, decode, quarantine, readable, typed
from paywatch.sources.schema import CATEGORICAL, MESSAGE_SCHEMA, NARROW_SCHEMA, RULE_AMOUNT, TRIGGER
from paywatch.streaming.counters import observed


@dataclass(frozen=True)
class RunPaths:
    """Folders of one run. A new ``run_id`` starts with an empty store and no old checkpoint."""

    base: str
    run_id: str

    def of(self, name: str) -> str:
        return f"{self.base}/{self.run_id}/{name}"

    def checkpoint(self, name: str) -> str:
        return self.of(f"_checkpoints/{name}")


def transactions(raw: DataFrame) -> DataFrame:
    """Messages as typed transactions; numbers missing from a message become 0, unreadable ones disqualify it."""
    return typed(fill_zero(readable(decode(raw, checked(MESSAGE_SCHEMA)))))


def narrow_transactions(raw: DataFrame) -> DataFrame:
    """Only the columns the metrics need. The label is read as a float and cast."""
    return typed(readable(decode(raw, checked(NARROW_SCHEMA))))


def once(rows: DataFrame, within: str, key: str = "transaction_id") -> DataFrame:
    """Rows of a stream without repetitions: of several with one id the first, if the others come within the delay.

    A producer that sends at least once repeats messages. Ids are kept in state until the watermark, ``within`` behind
    the newest time seen, has passed the first one's time; state is bounded by the rows of that span. A row without
    a time cannot be placed in it and passes.
    """
    timed = rows.filter("timestamp is not null").withWatermark("timestamp", within).dropDuplicatesWithinWatermark([key])
    return timed.unionByName(rows.filter("timestamp is null"))


def start(
    writer: DataStreamWriter, checkpoint: str, trigger: str | None = TRIGGER, name: str | None = None
) -> StreamingQuery:
    """Start with a checkpoint; ``trigger=None`` works off what is there and stops."""
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    timed = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return timed.start()


def alert_sink(path: str, threshold: float) -> Callable[[DataFrame, int], None]:
    """Per micro-batch: rows above the threshold with batch id, batch size and one detection time."""

    def write(scored: DataFrame, batch_id: int) -> None:
        # One pass over the batch: it is scored and counted while the few alerts are found.
        seen = Observation()
        counted = scored.observe(seen, F.count(F.lit(1)).alias("rows"))
        alerts = over_threshold(counted, threshold).persist()
        try:
            if alerts.count():
                alerts.withColumns({
                    "pipeline_detected_at": F.lit(datetime.now(timezone.utc)),
                    "total_batch_txns": F.lit(seen.get["rows"]).cast("long"),
                }).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            alerts.unpersist()

    return write


def score_stream(
    raw: DataFrame, models: RiskModels, paths: RunPaths, trigger: str | None = TRIGGER, same_within: str | None = None
) -> StreamingQuery:
    """Messages in, alert table out. Rows and alerts are observed, see ``counters``.

    ``same_within`` is how late the same message may come again and still be scored once, see ``once``.
    """
    rows = transactions(raw)
    if same_within is not None:
        rows = once(rows, same_within)
    scored = observed(models.score(rows), F.col("fraud_score") > models.threshold)
    writer = scored.writeStream.foreachBatch(alert_sink(paths.of("alerts"), models.threshold))
    return start(writer, paths.checkpoint("alerts"), trigger)


def quarantine_stream(raw: DataFrame, paths: RunPaths, trigger: str | None = TRIGGER) -> StreamingQuery:
    """Messages that do not decode, as text."""
    writer = quarantine(raw).writeStream.format("parquet").option("path", paths.of("quarantine"))
    return start(writer, paths.checkpoint("quarantine"), trigger)


def load_models(spark: SparkSession, path: str | None) -> RiskModels | None:
    """Saved models, or None where there are none and the amount rule has to do."""
    if path is None:
        return None
    try:
        return RiskModels.load(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def with_prediction(df: DataFrame, models: RiskModels | None, limit: float = RULE_AMOUNT) -> DataFrame:
    """Add fraud_score and pred, from the models or, without any, from the amount rule (no score)."""
    if models is not None:
        scored = models.score(df)
        return scored.withColumn("pred", (F.col("fraud_score") > F.lit(models.threshold)).cast("int"))
    return df.withColumns({
        "fraud_score": F.lit(None).cast("double"),
        "pred": F.coalesce(rule_hit(limit=limit).cast("int"), F.lit(0)),
    })


def with_forest_prediction(df: DataFrame, models: RiskModels) -> DataFrame:
    """Add the forest's score and hard prediction to rows that lack some of its features: these count as 0."""
    lacking = {c: F.lit("0" if c in CATEGORICAL else 0) for c in models.features if c not in df.columns}
    scored = apply_model(models.vectors(df.withColumns(lacking)), models.forest, "forest")
    return scored.select(*df.columns, F.col("forest_score").alias("fraud_score"), F.col("forest_pred").alias("pred"))


def metrics_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Per micro-batch one metric record: size, detected, actual, missed and its top alerts."""

    def write(predicted: DataFrame, batch_id: int) -> None:
        rows = predicted.withColumn("batch_id", F.lit(batch_id).cast("long")).persist()  # counted and ranked, scored once
        try:
            if not rows.isEmpty():
                batch_metrics(rows).drop("batch_id").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    return write


def metrics_stream(
    raw: DataFrame, models: RiskModels | None, paths: RunPaths, trigger: str | None = TRIGGER, narrow: bool = False
) -> StreamingQuery:
    """Messages in, metric records out.

    The models need all columns; ``narrow`` messages are predicted by the forest alone, with the features they lack
    as 0. Without models the rule decides, which needs few columns.
    """
    rows = transactions(raw) if models is not None and not narrow else narrow_transactions(raw)
    predicted = with_forest_prediction(rows, models) if models is not None and narrow else with_prediction(rows, models)
    writer = predicted.writeStream.foreachBatch(metrics_sink(paths.of("metrics")))
    return start(writer, paths.checkpoint("metrics"), trigger)


def totals(predicted: DataFrame) -> DataFrame:
    """Running totals as one row; on a stream, to be written in complete mode."""
    return predicted.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("pred") == 1).alias("detected"),
        F.count_if(F.col("is_fraud") == 1).alias("actual"),
        F.count_if((F.col("pred") == 0) & (F.col("is_fraud") == 1)).alias("missed"),
    )


def totals_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Keep the newest totals, one row, under the number of the micro-batch that produced them."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The alert or metric table of a run. ``schema`` gives the columns of a store still empty."""
    try:
        return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("long"))
    except AnalysisException as error:
        if schema is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def run_counters(query: StreamingQuery) -> list[Mapping[str, object]]:
    """Rows and rates of the recent micro-batches."""
    return [
        {"batch_id": p["batchId"], "rows": p["numInputRows"], "rows_per_second": p["processedRowsPerSecond"]}
        for p in query.recentProgress
    ]
