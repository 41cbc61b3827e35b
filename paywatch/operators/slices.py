"""Ordered work that survives hot keys.

A window over one key, or over no key, runs in one task. The operators here cut such a window into
slices that run side by side and add what earlier slices contribute from one pre-aggregated row per
slice. Slicing changes where rows are processed, never the result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paywatch.session import cut_lineage

MAX_HOT_KEYS = 100_000
MAX_BROADCAST_ROWS = 100_000
HASH_SLICE_SHIFT = 16  # 2**32 hashes in 2**16 slices


def hot_keys(df: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and more than 1/MAX_HOT_KEYS of the table.

    The second condition bounds the result below MAX_HOT_KEYS rows for any input, which is what
    makes it safe to broadcast.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total")).scalar()
    return counts.filter((F.col("_n") > hot_rows) & (F.col("_n") * MAX_HOT_KEYS > total)).select(key)


def mark_hot(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Add ``_hot``: whether the row's key is one of the hot keys (fewer than MAX_HOT_KEYS)."""
    keys = hot.select(F.col(key).alias("_hot_key"), F.lit(True).alias("_is_hot"))
    joined = df.join(F.broadcast(keys), F.col(key) == F.col("_hot_key"), "left")
    return joined.withColumn("_hot", F.coalesce("_is_hot", F.lit(False))).drop("_hot_key", "_is_hot")


def small_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A lookup table for a join: computed once, counted, and broadcast only if it is small.

    A larger one is joined by shuffle, where adaptive execution splits skewed partitions.
    """
    stored = cut_lineage(df)
    return F.broadcast(stored) if stored.limit(max_rows + 1).count() <= max_rows else stored


def running_totals(
    df: DataFrame,
    slice_by: str,
    order_by: Sequence[Column],
    sums: Mapping[str, Column],
) -> DataFrame:
    """Add inclusive running sums over the whole table, ordered by (slice_by, order_by).

    ``slice_by`` must be monotone in the order wanted, with far fewer values than rows: one row per
    slice is summed in a single task.
    """
    local = Window.partitionBy(slice_by).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy(slice_by).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    per_slice = df.groupBy(slice_by).agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()])
    carry = per_slice.select(
        slice_by, *[F.sum(f"_sum_{n}").over(earlier).alias(f"_before_{n}") for n in sums]
    )
    within = df.withColumns({f"_in_{n}": F.sum(c).over(local) for n, c in sums.items()})
    # A null slice sorts first and needs no carry, so the plain left join is complete.
    return (
        within.join(carry, slice_by, "left")
        .withColumns({n: F.coalesce(f"_in_{n}", zero) + F.coalesce(f"_before_{n}", zero) for n in sums})
        .drop(*[f"_{p}_{n}" for n in sums for p in ("in", "before")])
    )


def value_slices(df: DataFrame, column: str, slices: int, output: str = "_slice") -> DataFrame:
    """Add an order-preserving slice number with about equally many rows per slice.

    The quantile bounds (``slices`` numbers) are fixed when the plan is built, so every branch of
    the plan cuts at the same values.
    """
    if slices <= 1:
        return df.withColumn(output, F.lit(0.0))
    points = [i / slices for i in range(1, slices)]
    found = df.agg(F.percentile_approx(column, points, 10_000).alias("bounds")).first()["bounds"]
    bounds = sorted(set(found or []))
    if not bounds:
        return df.withColumn(output, F.lit(0.0))
    cut = Bucketizer(
        splits=[float("-inf"), *bounds, float("inf")], inputCol=column, outputCol=output, handleInvalid="keep"
    )
    return cut.transform(df)


def range_slices(df: DataFrame, column: str, rows_per_slice: int, output: str = "_slice") -> DataFrame:
    """Add the number of the range a value of any orderable type falls into, of about equally many rows each.

    Rows are dealt by sampled ranges and stored, so the numbers, which grow with the values, are fixed.
    """
    ranges = df.count() // rows_per_slice + 1
    return cut_lineage(df.repartitionByRange(ranges, column).withColumn(output, F.spark_partition_id()))


def hash_slice(h: Column) -> Column:
    return F.shiftrightunsigned(h, HASH_SLICE_SHIFT)


def hash_cuts(
    keyed: DataFrame, wanted: Callable[[Column, Column], Sequence[Column]]
) -> DataFrame:
    """Where the n-th row of each class lies in (hash, id) order, for several n at once.

    ``keyed`` has the columns _class, _hash and _id, with few classes. ``wanted(rows_of_class, class)``
    gives the counts, which are clamped to the class size. The result is one row holding a map from
    (class, number of the count) to struct(h, id), without an entry where the count is 0. Rows are
    never sorted as a whole: a histogram of 2**16 hash slices finds the slice of each cut, and only
    that slice is ranked.
    """
    size = Window.partitionBy("_class")
    upto = size.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    bucketed = keyed.withColumn("_bucket", hash_slice(F.col("_hash")))
    histogram = (
        bucketed.groupBy("_class", "_bucket").agg(F.count(F.lit(1)).alias("_k"))
        .withColumns({"_n": F.sum("_k").over(size), "_upto": F.sum("_k").over(upto)})
    )
    counts = F.array(*[
        F.greatest(F.lit(0).cast("long"), F.least(w.cast("long"), F.col("_n")))
        for w in wanted(F.col("_n"), F.col("_class"))
    ])
    edges = (
        histogram.select("*", F.posexplode(counts).alias("_cut", "_want"))
        .filter((F.col("_upto") - F.col("_k") < F.col("_want")) & (F.col("_want") <= F.col("_upto")))
        .groupBy("_class", "_bucket")
        .agg(F.collect_list(F.struct("_cut", (F.col("_want") - F.col("_upto") + F.col("_k")).alias("_left"))).alias("_v"))
    )
    here = F.try_element_at(_as_map(edges, "_class", "_bucket").scalar(), F.struct("_class", "_bucket"))
    at_edge = bucketed.select("*", F.inline(here).alias("_cut", "_left"))
    place = Window.partitionBy("_class", "_cut").orderBy("_hash", "_id")
    cuts = at_edge.withColumn("_rank", F.row_number().over(place)).filter("_rank = _left").withColumn(
        "_v", F.struct(F.col("_hash").alias("h"), F.col("_id").alias("id"))
    )
    return _as_map(cuts, "_class", "_cut")


def _as_map(df: DataFrame, *keys: str) -> DataFrame:
    """One row with a map from struct(keys) to ``_v``; as many entries as classes times cuts."""
    return df.agg(F.map_from_entries(F.collect_list(F.struct(F.struct(*keys), "_v"))).alias("_map"))


def cut_at(cuts: Column, cls: Column, number: int) -> Column:
    """struct(h, id) of cut ``number`` of a class, null if nothing is to be kept."""
    return F.try_element_at(cuts, F.struct(cls.alias("_class"), F.lit(number).alias("_cut")))
