"""Heavy hitters: the few keys with very many rows, found by a sketch instead of a full count.

A sketch is one small value per task, merged without a shuffle by key. It can be stored with every load and combined,
so the heavy keys of all history are known without reading history again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paywatch.session import cut_lineage

# A key with more than about 3 / TRACKED of all rows is surely found; a sketch holds a few MB.
TRACKED = 100_000
# Rows of one key that one task works off without trouble.
HOT_ROWS = 1_000_000
SKETCH = "sketch"


def key_sketch(df: DataFrame, key: str = "user_id", tracked: int = TRACKED) -> DataFrame:
    """One row with a sketch of how often keys occur; rows without a key are not counted."""
    return df.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("_key")).agg(
        F.expr(f"approx_top_k_accumulate(_key, {tracked})").alias(SKETCH), F.count(F.lit(1)).alias("rows")
    )


def store_sketch(df: DataFrame, path: str, load: str, key: str = "user_id", tracked: int = TRACKED) -> None:
    """Store the sketch of a load; storing a load again replaces it."""
    key_sketch(df, key, tracked).write.mode("overwrite").parquet(f"{path}/load={load}")


def stored_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(SKETCH, "rows")


def heavy_keys(sketches: DataFrame, key: str = "user_id", hot_rows: int = HOT_ROWS, tracked: int = TRACKED) -> DataFrame:
    """Keys with more than ``hot_rows`` rows over all sketches together: at most ``tracked`` rows, stored.

    Counts are estimates. Which keys are named decides where rows are worked on, never a result.
    """
    # Grouped, since a task without a row cannot combine anything.
    merged = sketches.filter("rows > 0").groupBy(F.lit(0).alias("_all")).agg(F.expr(f"approx_top_k_combine({SKETCH}, {tracked})").alias(SKETCH))
    found = merged.select(F.inline(F.expr(f"approx_top_k_estimate({SKETCH}, {tracked})")))
    return cut_lineage(found.filter(F.col("count") > hot_rows).select(F.col("item").alias(key)))


def heavy_users(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The users of a table that have more than ``hot_rows`` rows, for ``user_features``; None if there is none.

    A table of no more rows than that has none, which the files' own counts tell. Otherwise one column is read once.
    """
    if df.count() <= hot_rows:
        return None
    found = heavy_keys(key_sketch(df), hot_rows=hot_rows)
    return None if found.isEmpty() else found
