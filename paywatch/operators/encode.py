"""Category dictionaries as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywatch.operators.slices import range_slices, running_totals, small_side
from paywatch.session import cut_lineage

VALUES_PER_SLICE = 100_000


def label_dictionary(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in ascending order numbered from 0: columns value, code."""
    values = cut_lineage(df.filter(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct())
    sliced = range_slices(values, "value", VALUES_PER_SLICE)
    ranked = running_totals(sliced, "_slice", [F.col("value")], {"_rank": F.lit(1)})
    return ranked.select("value", (F.col("_rank") - 1).cast("int").alias("code"))


def encode(df: DataFrame, column: str, dictionary: DataFrame, unknown: int = 0, output: str | None = None) -> DataFrame:
    """Replace a value by its code; a value outside the dictionary gets ``unknown``."""
    codes = small_side(dictionary.select(F.col("value").alias("_value"), F.col("code").alias("_code")))
    joined = df.join(codes, F.col(column) == F.col("_value"), "left")
    return joined.withColumn(output or column, F.coalesce("_code", F.lit(unknown))).drop("_value", "_code")
