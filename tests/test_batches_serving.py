from datetime import datetime

import pytest
from pyspark.sql import functions as F

from paywatch.operators import batches, serving
from tests.conftest import as_dicts

COLUMNS = (
    "transaction_id long, batch_id long, amount double, fraud_score double, pred int, is_fraud int, "
    "location string, device_type string, timestamp timestamp"
)


def rows(spark, data):
    full = [(i, b, a, 0.5, p, y, l, d, datetime(2024, 1, 1, b)) for i, b, a, p, y, l, d in data]
    return spark.createDataFrame(full, COLUMNS)


@pytest.fixture
def table(spark):
    return rows(spark, [
        (1, 0, 10.0, 1, 1, "x", "ios"), (2, 0, 30.0, 0, 1, None, "web"), (3, 0, 30.0, 0, 0, "y", "ios"),
        (4, 1, 5.0, 1, 0, "x", "ios"), (5, 2, 7.0, 0, 0, "z", "web"), (6, 2, 8.0, 1, 1, "x", "web"),
    ])


def test_batch_metrics(table):
    got = {r["batch_id"]: r for r in as_dicts(batches.batch_metrics(table))}
    assert (got[0]["batch_size"], got[0]["detected"], got[0]["actual"], got[0]["missed"]) == (3, 1, 2, 1)
    assert got[0]["alerts"] == [
        {"id": "2", "score": 0.5, "location": "Unknown"}, {"id": "3", "score": 0.5, "location": "y"}
    ]
    assert [a["id"] for a in got[1]["alerts"]] == ["4"]


def test_running_totals_over_slices(spark):
    n = 25_000  # three slices of batches
    counts = spark.range(n).select(
        F.col("id").alias("batch_id"), F.lit(2).alias("batch_size"), F.lit(1).alias("detected"),
        F.lit(0).alias("actual"), F.lit(0).alias("missed"),
    )
    wrong = batches.running_batch_totals(counts).filter(
        (F.col("total") != 2 * (F.col("batch_id") + 1)) | (F.col("detected_total") != F.col("batch_id") + 1)
    )
    assert wrong.count() == 0
    assert batches.running_batch_totals(counts).count() == n


def test_latest_alerts_and_snapshot(table):
    newest = batches.latest_alerts(table, 3)
    assert [r.transaction_id for r in newest.collect()] == [6, 5, 4]
    (snap,) = as_dicts(batches.snapshot(table, 3))
    assert (snap["total"], snap["detected"], snap["actual"], snap["missed"]) == (6, 3, 3, 1)
    assert [a["id"] for a in snap["alerts"]] == ["6", "5", "4"]


def test_canary_recall(spark):
    df = spark.createDataFrame([(4999, 1), (9999, 0), (5000, 1)], "transaction_id long, pred int")
    assert tuple(batches.canary_recall(df).first()) == (2, 1, 0.5)
    assert tuple(batches.canary_recall(df.filter("transaction_id = 5000")).first()) == (0, 0, 0.0)


@pytest.fixture
def alerts(table):
    return batches.with_batch_meta(table.filter("pred = 1"), table)


def test_latest_batch_and_summary(alerts):
    assert {r.transaction_id for r in serving.latest_batch(alerts).collect()} == {6}
    assert serving.latest_alert(alerts).first().transaction_id == 6
    s = serving.latest_summary(alerts).first()
    assert (s.status, s.batch_id, s.fraud_count, s.total_txns) == ("success", 2, 1, 2)
    empty = serving.latest_summary(alerts.filter("false")).first()
    assert (empty.status, empty.fraud_count, empty.detected_at) == ("empty", 0, None)


def test_last_batches_orders(alerts):
    assert [r.batch_id for r in serving.last_batches(alerts, 2).collect()] == [2, 1]
    assert {r.batch_id for r in serving.last_batch_rows(alerts, 2).collect()} == {1, 2}
    assert [(r.position, r.batch_id) for r in serving.chronological(serving.last_batches(alerts, 2)).collect()] == [(1, 1), (2, 2)]


@pytest.mark.parametrize("rows", [900, 5000])
def test_shape_of_nested_batches_is_the_same_at_any_size(spark, rows):
    big = spark.range(rows).select(
        F.col("id").alias("transaction_id"), F.lit(3).cast("long").alias("batch_id"), F.hex("id").alias("_id"),
        F.lit(9000).cast("long").alias("total_batch_txns"), F.lit(datetime(2024, 1, 1)).alias("pipeline_detected_at"),
    )
    nested = serving.strip_store_id(serving.last_batches_nested(big))
    assert [(r.chunk, len(r.frauds)) for r in nested.collect()] == [(0, rows)]
    spread = serving.strip_store_id(serving.last_batches_nested(big, chunks=10))
    assert sorted(r.chunk for r in spread.collect()) == list(range(10))
    back = spread.select(F.inline("frauds"))
    assert "_id" not in back.columns and back.select("transaction_id").distinct().count() == rows
    assert tuple(serving.history_lines(serving.last_batches(big)).first()) == (3, 9000, rows)


def test_small_batch_is_one_array(alerts):
    nested = serving.last_batches_nested(alerts)
    assert nested.count() == 3 and {r.n for r in nested.select(F.size("frauds").alias("n")).collect()} == {1}


def test_breakdowns(spark, table):
    alerts = batches.with_batch_meta(table.filter("batch_id = 0"), table)
    assert {r.name: r.value for r in serving.device_counts(alerts).collect()} == {"ios": 2, "web": 1}
    assert [r.name for r in serving.top_locations(alerts, 2).collect()] == [None, "x"]


def test_detail_table(alerts):
    df = serving.detail_table(alerts.filter("batch_id = 0").select("transaction_id", "amount", "location", "batch_id"))
    assert df.columns == ["TRANSACTION_ID", "AMOUNT", "LOCATION"]
    assert tuple(df.first()) == ("1.00", "10.00", "x")
