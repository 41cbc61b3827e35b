"""What the physical plans look like, and what operator code must not contain."""

import ast
import pathlib
import re

from pyspark.sql import functions as F

from paywatch.operators import batches, features, sampling, serving
from paywatch.sources import fixture
from tests.conftest import ROOT, SMALL

FORBIDDEN = {"toPandas", "crossJoin", "localCheckpoint", "toLocalIterator", "udf", "rdd", "collect"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_operators_stay_on_the_executors():
    for path in pathlib.Path(ROOT, "paywatch").rglob("*.py"):
        used = {n.attr for n in ast.walk(ast.parse(path.read_text())) if isinstance(n, ast.Attribute)}
        assert not used & FORBIDDEN, (path, used & FORBIDDEN)


def test_wide_rows_shuffle_once_for_user_features(spark):
    """All windows, and with hot users the join with the carry rows, reuse one exchange by (user, slice)."""
    txns = fixture.events_as_txns(spark, SMALL)
    plain = plan(features.user_features(txns))
    sliced = plan(features.user_features(txns, hot=features.hot_users(txns, 50)))
    for text in (plain, sliced.split("Union")[0]):
        assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
        assert re.search(r"Exchange hashpartitioning\(_user#\d+L, _slice#\d+L", text)
    assert "Union" in sliced and "Union" not in plain and "SortMergeJoin" not in plain
    assert "CartesianProduct" not in sliced and "BroadcastNestedLoopJoin" not in sliced


def test_unused_features_are_pruned(spark):
    text = plan(features.user_features(fixture.events_as_txns(spark, SMALL)).select("transaction_id", "user_avg"))
    assert "row_number()" not in text and "mode(" not in text and "last(" not in text


def test_scan_reads_only_needed_columns(spark):
    df = fixture.events_as_txns(spark, SMALL).select("transaction_id", "amount").filter("amount > 100")
    text = plan(df)
    assert "ReadSchema: struct<event_id:bigint,value:double" in text or "value:double" in text
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,100.0)]" in text
    assert "event_type" not in text


def test_top_k_is_taken_before_the_shuffle(spark):
    text = plan(batches.top_by_amount(fixture.events_as_txns(spark, SMALL)))
    assert re.search(r"WindowGroupLimit.*Partial", text)
    small = spark.range(10).select(
        F.col("id").alias("batch_id"), F.lit(1).alias("total_batch_txns"), F.lit(1).alias("pipeline_detected_at")
    )
    assert "TakeOrderedAndProject" in plan(serving.last_batches(small))


def test_samples_filter_without_moving_rows(spark):
    """The cut is a scalar; the sampled table itself has no exchange."""
    df = spark.read.parquet(f"{SMALL}/events.parquet").withColumnRenamed("event_id", "transaction_id")
    text = plan(sampling.sample_n(df, 100))
    main = text.split("Subquery")[0]
    assert "Exchange" not in main


def test_latest_batch_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "alerts")
    spark.range(100).select("id", (F.col("id") % 10).alias("batch_id")).write.partitionBy("batch_id").parquet(path)
    latest = serving.latest_batch(spark.read.parquet(path))
    assert latest.count() == 10
    assert re.search(r"PartitionFilters: \[.*batch_id.*[sS]ubquery", plan(latest))
