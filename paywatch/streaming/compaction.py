"""An alert store of few large files: closed micro-batches are rewritten by ranges and readers are moved over at once."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paywatch.sources import published
from paywatch.streaming.jobs import RunPaths

FILE_ROWS = 1_000_000


def _fresh(spark: SparkSession, paths: RunPaths, upto: int | None) -> DataFrame | None:
    """The alerts of micro-batches not yet compacted, None where there is no folder."""
    try:
        rows = spark.read.parquet(paths.of("alerts"))
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    rows = rows.withColumn("batch_id", F.col("batch_id").cast("long"))
    return rows if upto is None else rows.filter(F.col("batch_id") > upto)


def read_alerts(spark: SparkSession, paths: RunPaths, schema: str | None = None) -> DataFrame:
    """All alerts of a run, from compacted ranges and from the micro-batches after them, every alert once.

    Ranges are sorted by batch_id, so a filter on it skips files and row groups. ``schema`` gives the columns of a
    store that is still empty.
    """
    _, parts, upto = published.current(spark, paths.of("alerts_compact"))
    fresh = _fresh(spark, paths, upto)
    if not parts:
        if fresh is None and schema is not None:
            return spark.createDataFrame([], schema)
        return fresh if fresh is not None else spark.read.parquet(paths.of("alerts"))
    old = spark.read.parquet(*parts)
    return old if fresh is None else old.unionByName(fresh, allowMissingColumns=True)


def compact_alerts(spark: SparkSession, paths: RunPaths, file_rows: int = FILE_ROWS) -> int | None:
    """Rewrite the closed micro-batches after the last compaction as one range; the last batch it holds, None if none.

    A micro-batch may be repeated until a later one is stored, so the newest is left alone. The range is written to a
    new folder first; readers are pointed at it last, and from then on no longer look at the batches it holds. A job
    that fails in between leaves the store as it was. The folders of these batches stay until ``drop_compacted``.
    """
    base = paths.of("alerts_compact")
    _, parts, upto = published.current(spark, base)
    fresh = _fresh(spark, paths, upto)
    newest = None if fresh is None else fresh.agg(F.max("batch_id").alias("b")).first()["b"]
    if newest is None:
        return None
    closed = fresh.filter(F.col("batch_id") < newest)
    found = closed.agg(F.count(F.lit(1)).alias("n"), F.max("batch_id").alias("last")).first()
    if not found["n"]:
        return None
    part = published.new_part(base)
    files = found["n"] // file_rows + 1
    closed.repartitionByRange(files, "batch_id", "transaction_id").sortWithinPartitions("batch_id", "transaction_id").write.parquet(part)
    published.publish(spark, base, [*parts, part], found["last"])
    return found["last"]


def drop_compacted(spark: SparkSession, paths: RunPaths) -> int:
    """Delete the folders of micro-batches that compacted ranges hold; how many there were.

    To be run when queries that were planned before the last compaction have ended.
    """
    upto = published.current(spark, paths.of("alerts_compact"))[2]
    fresh = _fresh(spark, paths, None)
    if upto is None or fresh is None:
        return 0
    folders = fresh.filter(F.col("batch_id") <= upto).select("batch_id").distinct().toArrow().column("batch_id").to_pylist()
    for batch in folders:
        published.drop_folder(spark, f"{paths.of('alerts')}/batch_id={batch}")
    return len(folders)
