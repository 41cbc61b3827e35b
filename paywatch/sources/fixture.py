"""The provided tables read as transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paywatch.functions.columns import ratio, whole_part
from paywatch.operators.ensemble import ensemble
from paywatch.operators.features import id_noise, transaction_features
from paywatch.operators.heavy import HOT_ROWS, heavy_users

DAY = 86_400
BATCH_ROWS = 1000
LOCATIONS = 25
ALERT_THRESHOLD = 0.5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_as_txns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events + nation as raw transactions, before any derived feature."""
    return as_txns(table(spark, sf_dir, "events"), table(spark, sf_dir, "nation"))


def as_txns(events: DataFrame, nation: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    away = F.when(F.pmod(k, F.lit(20)) < 17, F.lit(0)).otherwise(k)
    txns = events.select(
        F.col("event_id").alias("transaction_id"),
        "user_id",
        k.alias("merchant_id"),
        F.col("value").alias("amount"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("device_type"),
        F.round(k / F.lit(99.0), 3).alias("merchant_risk_score"),
        whole_part(F.col("event_id"), BATCH_ROWS).alias("batch_id"),
        F.pmod(F.col("user_id") + away, F.lit(LOCATIONS)).alias("_nation"),
    )
    places = nation.select(F.col("n_nationkey").cast("long").alias("_nation"), F.col("n_name").alias("location"))
    return txns.join(places, "_nation", "left").drop("_nation")


def orders_as_txns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders + customer + nation as raw transactions: wide amounts, many equal timestamps."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_orderpriority").alias("device_type"),
        F.col("o_orderstatus").alias("status"),
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("_nation")
    )
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("_nation"), F.col("n_name").alias("location")
    )
    return orders.join(customer, "user_id", "left").join(nation, "_nation", "left").drop("_nation")


def hot_users(spark: SparkSession, sf_dir: str, hot_rows: int | None = None) -> DataFrame | None:
    """The users whose events are too many for one task, None if there are none."""
    return heavy_users(table(spark, sf_dir, "events").select("user_id"), hot_rows or HOT_ROWS)


def hot_customers(spark: SparkSession, sf_dir: str, hot_rows: int | None = None) -> DataFrame | None:
    """The same of orders."""
    return heavy_users(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id")), hot_rows or HOT_ROWS)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as the full transaction record, velocity over 24 hours, labelled by the rule."""
    return transaction_features(events_as_txns(spark, sf_dir), DAY, hot_users(spark, sf_dir), id_noise())


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """features with two stand-in model scores and their mean."""
    return with_scores(features(spark, sf_dir))


def with_scores(df: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    pair = df.withColumns({
        "score_a": F.col("risk_score") / F.lit(1.15),
        "score_b": ratio(F.col("amount"), F.col("amount") + F.col("user_avg")),
    })
    return (
        pair.withColumn("fraud_score", ensemble({"score_a": 0.5, "score_b": 0.5}))
        .withColumn("pred", (F.col("fraud_score") > F.lit(threshold)).cast("int"))
    )
