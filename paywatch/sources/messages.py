"""JSON messages: decoding, encoding and the stream sources and sinks that carry them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywatch.sources.schema import MESSAGE_SCHEMA, TXN_COLUMNS, TXN_SCHEMA

UNREADABLE = "_unreadable"
KAFKA_OFFSETS_PER_TRIGGER = 1_000_000


def decode(
    raw: DataFrame, schema: T.StructType = MESSAGE_SCHEMA, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Message bytes to columns: one per schema field, everything else in the message is ignored.

    A generator unpacks the record, so that a later filter on a field does not parse the message again.
    """
    record = F.from_json(F.col(value).cast("string"), schema, {"columnNameOfCorruptRecord": UNREADABLE})
    return raw.select(*keep, F.inline(F.array(record)))


def typed(df: DataFrame) -> DataFrame:
    """Decoded doubles and strings to the types of the transaction record."""
    have = set(df.columns)
    return df.select(*[
        (F.try_to_timestamp(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name).cast(f.dataType))
        .alias(f.name)
        for f in TXN_SCHEMA if f.name in have
    ])


def checked(schema: T.StructType) -> T.StructType:
    """The schema with a field that keeps the text of a message with unreadable fields, for ``readable``."""
    return T.StructType([*schema, T.StructField(UNREADABLE, T.StringType())])


def _is_readable(df: DataFrame, key: str) -> Column:
    known = F.col(key).isNotNull()
    return known & F.col(UNREADABLE).isNull() if UNREADABLE in df.columns else known


def readable(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Messages that decoded: they have an id and, decoded with ``checked``, no field that is there but unreadable."""
    return df.filter(_is_readable(df, key)).drop(UNREADABLE)


def quarantine(
    raw: DataFrame, schema: T.StructType = MESSAGE_SCHEMA, value: str = "value", key: str = "transaction_id"
) -> DataFrame:
    """Text of the messages that ``readable`` leaves out."""
    text = raw.select(F.col(value).cast("string").alias("message"))
    parsed = decode(text.withColumn("_text", F.col("message")), checked(schema), "_text", keep=["message"])
    return parsed.filter(~_is_readable(parsed, key)).select("message")


def encode(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One JSON object per row, whole numbers with all their digits, timestamps to the microsecond."""
    texts = df
    times = [f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    if times:
        texts = texts.withColumns({c: F.col(c).cast("string") for c in times})
    return texts.select(*keep, F.to_json(F.struct(*df.columns)).alias(value))


def message_stream(
    spark: SparkSession,
    source: str = "kafka",
    *,
    servers: str | None = None,
    topic: str | None = None,
    path: str | None = None,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = KAFKA_OFFSETS_PER_TRIGGER,
    max_files_per_trigger: int = 1,
) -> DataFrame:
    """Stream with a ``value`` column from a topic, or from a folder of JSON-lines files.

    The per-trigger limits bound a micro-batch, also when a long backlog is caught up.
    """
    if source == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
        )
        if max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        return reader.load()
    if source == "files":
        return spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(path)
    raise ValueError(f"unknown source {source!r}")


def publish(
    df: DataFrame, sink: str = "kafka", *, servers: str | None = None, topic: str | None = None,
    path: str | None = None, mode: str = "append",
) -> None:
    """Write transactions as messages, to a topic or as JSON-lines files."""
    messages = encode(df.select(*[c for c in TXN_COLUMNS if c in df.columns]))
    if sink == "kafka":
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    elif sink == "files":
        messages.write.mode(mode).text(path)
    else:
        raise ValueError(f"unknown sink {sink!r}")
