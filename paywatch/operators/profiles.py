"""User profiles kept up to date: every load stores partial aggregates, a profile merges them.

History is read once, when it arrives. A merged profile equals ``features.user_profile`` over all loads together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paywatch.functions.columns import cents, micros
from paywatch.operators.features import HOUR

PARTS = "user_id long, kind string, value string, n long, n_cents long, cents long, n_amounts long, mean double, m2 double"
TOTAL, PLACE, DEVICE, ACTIVE_HOUR = "total", "location", "device", "hour"


def profile_parts(df: DataFrame) -> DataFrame:
    """Per user one row of sums, and one row with a count for each place, device and active hour.

    One scan and one partial aggregation: a user with very many rows sends as many rows per task as the user has
    places, devices and hours there. Rows without a user belong to no profile.
    """
    hour = F.floor(micros(F.col("timestamp")) / F.lit(HOUR * 1_000_000)).cast("string")
    facts = F.array(*(
        F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))
        for kind, value in ((TOTAL, F.lit(None)), (PLACE, F.col("location")), (DEVICE, F.col("device_type")), (ACTIVE_HOUR, hour))
    ))
    rows = df.filter(F.col("user_id").isNotNull()).select(F.col("user_id").cast("long").alias("user_id"), "amount", F.inline(facts))
    rows = rows.filter((F.col("kind") == TOTAL) | F.col("value").isNotNull())
    # Only the row of sums has amounts.
    amount = F.when(F.col("kind") == TOTAL, F.col("amount"))
    return rows.groupBy("user_id", "kind", "value").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(cents(amount)).alias("n_cents"),
        F.coalesce(F.sum(cents(amount)), F.lit(0)).alias("cents"),
        F.count(amount).alias("n_amounts"),
        F.avg(amount).alias("mean"),
        (F.var_pop(amount) * F.count(amount)).alias("m2"),
    )


def store_load(df: DataFrame, path: str, load: str) -> None:
    """Store the parts of a load; storing a load again replaces them."""
    profile_parts(df).write.mode("overwrite").parquet(f"{path}/load={load}")


def stored_parts(spark: SparkSession, path: str) -> DataFrame:
    """The parts of all loads stored under a folder."""
    return spark.read.schema(f"{PARTS}, load string").parquet(path)


def _joined_moments(parts: Column) -> Column:
    """(n, mean, m2) of several groups of numbers together, from those of each."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        far = b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + far * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + far * far * a["n"] * b["n"] / n).alias("m2"),
        )

    return F.aggregate(parts, start, add)


def merged_parts(parts: DataFrame) -> DataFrame:
    """Parts of several loads as those of one. An array of three numbers per load and user is held at most."""
    moments = F.struct(F.col("n_amounts").alias("n"), "mean", "m2")
    summed = parts.groupBy("user_id", "kind", "value").agg(
        *(F.sum(c).alias(c) for c in ("n", "n_cents", "cents")),
        F.array_sort(F.collect_list(F.when(F.col("n_amounts") > 0, moments))).alias("_moments"),
    ).withColumn("_all", _joined_moments(F.col("_moments")))
    some = F.col("_all.n") > 0
    return summed.select(
        "user_id", "kind", "value", "n", "n_cents", "cents", F.col("_all.n").alias("n_amounts"),
        F.when(some, F.col("_all.mean")).alias("mean"), F.when(some, F.col("_all.m2")).alias("m2"),
    )


def compact_loads(spark: SparkSession, path: str, loads: Sequence[str], target: str, load: str) -> None:
    """Write the parts of several loads as one load of another folder, which a reader is then pointed at."""
    chosen = stored_parts(spark, path).filter(F.col("load").isin(*loads)).drop("load")
    merged_parts(chosen).write.mode("overwrite").parquet(f"{target}/load={load}")


def profile_of(parts: DataFrame) -> DataFrame:
    """One row per user, with the columns and values of ``features.user_profile``, from parts of any number of loads."""
    kind = F.col("kind")
    total = lambda c: F.max(F.when(kind == TOTAL, F.col(c)))

    def most(which: str) -> Column:
        rank = F.when(kind == which, F.struct((-F.col("n")).alias("n"), "value"))
        return F.min(rank)["value"]

    hours = F.count_if(kind == ACTIVE_HOUR)
    rows = total("n")
    spread = F.when(total("n_amounts") > 1, F.sqrt(total("m2") / (total("n_amounts") - 1)))
    return merged_parts(parts).groupBy("user_id").agg(
        rows.alias("txn_count"),
        F.when(total("n_cents") > 0, total("cents") / (total("n_cents") * F.lit(100.0))).alias("avg_amount"),
        spread.alias("std_amount"),
        F.when(hours > 0, hours).alias("active_hours"),
        most(PLACE).alias("home_location"),
        most(DEVICE).alias("primary_device"),
        F.when(hours > 0, rows / hours).alias("txn_frequency"),
    )
