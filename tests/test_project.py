from pyspark.sql import functions as F

from paywatch.operators import project
from tests.conftest import as_dicts


def test_fill_zero_leaves_strings(spark):
    df = spark.createDataFrame([(None, None, None)], "a double, b long, c string")
    assert as_dicts(project.fill_zero(df)) == [{"a": 0.0, "b": 0, "c": None}]


def test_align_orders_and_fills(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "b double, a double, extra double")
    got = project.align(df, ["a", "missing", "b"])
    assert got.columns == ["a", "missing", "b"] and tuple(got.first()) == (2.0, 0.0, 1.0)


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(0.5,), (0.500001,), (None,)], "fraud_score double")
    assert project.over_threshold(df, 0.5).count() == 1


def test_canaries_hit_the_row_before_the_multiple(spark):
    df = spark.range(200_000, 210_001).select(
        F.col("id").alias("transaction_id"), F.lit(5.0).alias("amount"), F.lit("ios").alias("device_type"),
        F.lit("x").alias("location"), F.lit(1).cast("long").alias("velocity"), F.lit(3.0).alias("amount_deviation"),
    )
    hit = project.inject_canaries(df).filter("amount <> 5")
    assert {r.transaction_id for r in hit.collect()} == {204_999, 209_999}
    row = hit.first()
    assert (row.amount, row.device_type, row.location, row.velocity) == (950000.0, "unknown", "foreign_ip", 150)
    assert row.amount_deviation == 3.0 and hit.schema == df.schema


def test_defaults_fill_and_add(spark):
    df = spark.createDataFrame([(None, None), (4, "x")], "transaction_id long, location string")
    got = as_dicts(project.with_defaults(df, {"transaction_id": 0, "location": "Unknown", "batch_id": 0}))
    assert got == [{"transaction_id": 0, "location": "Unknown", "batch_id": 0},
                   {"transaction_id": 4, "location": "x", "batch_id": 0}]


def test_alert_line_text(spark):
    df = spark.createDataFrame([(7.0, 0.12345, 1500.5)], "transaction_id double, fraud_score double, amount double")
    assert project.alert_line(df).first().line == "1500.50 in transaction 7, risk 0.123"


def test_public_columns_clamp_preview_rule(spark):
    df = spark.createDataFrame([("s", 1, 0.2, 9)], "_id string, transaction_id long, amount double, batch_id long")
    assert project.public_columns(df).columns == ["transaction_id", "amount"]
    assert df.select(project.clamp_low(F.col("amount"))).first()[0] == 1.0
    ids = spark.range(50).select((49 - F.col("id")).alias("transaction_id"))
    assert [r[0] for r in project.preview(ids, 3).collect()] == [0, 1, 2]
    amounts = spark.createDataFrame([(1000.0,), (1000.01,), (None,)], "amount double")
    assert tuple(project.rule_count(amounts).first()) == (3, 1)
