"""What the text operators share: their input columns, staged tables, Arrow helpers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paywatch.session import storage_dir

# Rows of a few longs: about 64 MB.
BROADCAST_ROWS = 1_000_000
# An Arrow batch of texts; the executor and its Python worker each hold some of them for every task.
BATCH_BYTES = 1 << 22
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, *keep: str) -> DataFrame:
    """Id and text alone, whatever else the table has; a null text is an empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def training_bucket(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a missing id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{storage_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Store a table several steps read as Parquet in the shared folder and read it back."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame) -> DataFrame:
    """A table of a few numbers a row, broadcast up to BROADCAST_ROWS; beyond, its join shuffles."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def small_batches(spark: SparkSession) -> None:
    """Batches on their way to Python and back end at BATCH_BYTES, however long the texts are, not at a number of rows alone."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def handed_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; what Arrow has kept of earlier ones goes back to the system, since workers outlive their tasks."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def utf8(column: pa.Array) -> list[bytes]:
    """A string column's values as bytes."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def runs_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of one key at a time, from batches sorted by that key."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *((values[1:] != values[:-1]).nonzero()[0] + 1).tolist(), len(values)]
        for begin, end in zip(cuts, cuts[1:]):
            if held and values[begin] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            last = values[begin]
    if held:
        yield pa.Table.from_batches(held)
