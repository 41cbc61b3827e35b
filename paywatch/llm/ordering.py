"""Places in an order, of tables where one group may hold a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paywatch.llm.common import sized, stage

SLICE_ROWS = 200_000


def dealt(df: DataFrame, order: Sequence[str], name: str, slice_rows: int | None = None) -> DataFrame:
    """The rows of a stored table dealt into ranges of `order`, with the range's number as `slice`, and stored.

    The last columns of `order` must tell rows apart, or equal rows stay in one range.
    """
    ranges = df.count() // (slice_rows or SLICE_ROWS) + 1
    return stage(df.repartitionByRange(ranges, *order).withColumn("slice", F.spark_partition_id()), name)


def placed(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Add `pos`, a row's place in its group counted from 0, and `total`, the rows of the group.

    `rows` come from `dealt(df, [group, *order])`. Windows run inside a slice; what earlier slices hold of a group is
    added from one row per group and slice, needed only for groups that go over a border: at most two rows a slice.
    """
    inside = Window.partitionBy(group, "slice")
    counts = rows.groupBy(group, "slice").agg(F.count(F.lit(1)).alias("n"))
    all_ = Window.partitionBy(group)
    upto = all_.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    spans = counts.select(
        F.col(group).alias("of_group"),
        F.col("slice").alias("of_slice"),
        F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"),
        F.sum("n").over(all_).alias("of_total"),
        F.count(F.lit(1)).over(all_).alias("slices"),
    ).where("slices > 1").drop("slices")
    here = F.col(group).eqNullSafe(F.col("of_group")) & (F.col("slice") == F.col("of_slice"))
    local = rows.withColumns({
        "pos": F.row_number().over(inside.orderBy(*order)).cast("long") - 1,
        "total": F.count(F.lit(1)).over(inside),
    })
    return local.join(sized(spans), here, "left").withColumns({
        "pos": F.col("pos") + F.coalesce("before", F.lit(0)),
        "total": F.coalesce("of_total", "total"),
    }).drop("of_group", "of_slice", "before", "of_total", "slice")
