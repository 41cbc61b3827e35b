"""Consecutive ids on a stream: every micro-batch continues where the one before it ended, also after a failure."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paywatch.operators.project import inject_canaries
from paywatch.operators.sampling import surrogate_ids
from paywatch.sources.schema import FIRST_REPLAY_ID, TRIGGER
from paywatch.streaming.jobs import RunPaths, start

RECORD = "first_id long, rows long, batch_id long"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(first_id, rows, batch_id): where the ids of every finished micro-batch begin and how many they are."""
    try:
        return spark.read.schema(RECORD).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RECORD)


def first_id(spark: SparkSession, path: str, batch_id: int, base: int) -> int:
    """The first id of a micro-batch: the same again if it is repeated, else the one after the batch before it."""
    before = read_records(spark, path).filter(F.col("batch_id") < batch_id)
    row = before.agg(F.max_by(F.col("first_id") + F.col("rows"), "batch_id").alias("next")).first()
    return base if row["next"] is None else row["next"]


def replay_sink(path: str, records: str, base: int = FIRST_REPLAY_ID, canaries: bool = True) -> Callable[[DataFrame, int], None]:
    """Number the rows of a micro-batch in replay order, overwrite every period's last one with a canary, store them.

    A batch holds the same rows whenever it is repeated, and its first id depends on the finished batches before
    it alone, so a repeated batch gets the same ids. Its record is written last: a batch that fails between the two
    is simply done again.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        begin = first_id(spark, records, batch_id, base)
        kept = rows.persist()
        try:
            numbered = surrogate_ids(kept, begin)
            seen = Observation()
            out = (inject_canaries(numbered) if canaries else numbered).observe(seen, F.count(F.lit(1)).alias("rows"))
            out.write.mode("overwrite").parquet(f"{path}/micro_batch={batch_id}")
            if seen.get["rows"]:
                record = spark.createDataFrame([(begin, seen.get["rows"])], "first_id long, rows long")
                record.coalesce(1).write.mode("overwrite").parquet(f"{records}/batch_id={batch_id}")
        finally:
            kept.unpersist()

    return write


def replay_stream(rows: DataFrame, paths: RunPaths, trigger: str | None = TRIGGER, base: int = FIRST_REPLAY_ID) -> StreamingQuery:
    """Transactions in, transactions with new consecutive ids and canaries out."""
    sink = replay_sink(paths.of("replayed"), paths.of("replay_records"), base)
    return start(rows.writeStream.foreachBatch(sink), paths.checkpoint("replay"), trigger)


def read_replayed(spark: SparkSession, paths: RunPaths) -> DataFrame:
    return spark.read.parquet(paths.of("replayed")).drop("micro_batch")
