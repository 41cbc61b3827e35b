import pytest
from pyspark.sql import functions as F

from paywatch.operators import evaluate
from paywatch.sources import fixture, messages, schema, tables
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def typed(spark):
    df = fixture.features(spark, SMALL).select(schema.TXN_COLUMNS)
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_round_trip(spark, typed, tmp_path, fmt):
    path = str(tmp_path / fmt)
    tables.write_txns(typed, path, fmt)
    back = tables.read_txns(spark, path, fmt)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in schema.TXN_SCHEMA]
    assert back.exceptAll(typed).count() == 0 and back.count() == typed.count()


def test_messages_round_trip(spark, typed, tmp_path):
    messages.publish(typed, "files", path=str(tmp_path / "m"))
    raw = spark.read.text(str(tmp_path / "m"))
    assert '"is_fraud":0' in raw.filter("value like '%\"is_fraud\":0%'").first().value
    back = messages.typed(messages.decode(raw))
    assert back.exceptAll(typed).count() == 0 and back.count() == typed.count()
    narrow = messages.decode(raw, schema.NARROW_SCHEMA)
    assert narrow.columns == schema.NARROW_COLUMNS and narrow.filter("is_fraud is null").count() == 0


def test_malformed_messages_go_to_quarantine(spark):
    raw = spark.createDataFrame([('{"transaction_id": 5}',), ("nope",), (None,)], "value string")
    assert messages.readable(messages.decode(raw)).count() == 1
    assert {r.message for r in messages.quarantine(raw).collect()} == {"nope", None}


def test_ids_keep_all_digits_and_unreadable_fields_disqualify(spark):
    from paywatch.streaming import jobs

    raw = spark.createDataFrame([('{"transaction_id": 9007199254740993, "amount": 2}',), ('{"transaction_id": 7.0}',),
                                 ('{"transaction_id": 8, "amount": "abc"}',)], "value string")
    got = {r.transaction_id: r.amount for r in jobs.transactions(raw).collect()}
    assert got == {9007199254740993: 2.0, 7: 0.0}
    assert [r.message for r in messages.quarantine(raw).collect()] == ['{"transaction_id": 8, "amount": "abc"}']
    plan = jobs.transactions(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_odd_amounts_do_not_fail(spark):
    from paywatch.functions.columns import cents

    df = spark.createDataFrame([(1.25,), (float("nan"),), (1e300,), (None,)], "amount double")
    assert [r.c for r in df.select(cents(F.col("amount")).alias("c")).collect()] == [125, None, None, None]


def test_unknown_source_and_sink(spark, typed):
    with pytest.raises(ValueError):
        messages.message_stream(spark, "carrier pigeon")
    with pytest.raises(ValueError):
        messages.publish(typed, "carrier pigeon")


def test_splits_read_only_their_folder(spark, typed, tmp_path):
    from paywatch.operators.sampling import split_by_hash

    path = str(tmp_path / "s")
    tables.save_splits(split_by_hash(typed), path)
    parts = {n: tables.read_split(spark, path, n) for n in ("train", "val", "test")}
    assert sum(p.count() for p in parts.values()) == typed.count()
    assert set(parts["val"].columns) == {*schema.FEATURES, schema.LABEL}
    plan = parts["val"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_report_file(spark, tmp_path):
    df = spark.createDataFrame([(1, 1), (0, 0)], "is_fraud int, pred int")
    tables.write_report(evaluate.classification_report(df), str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).count() == 5


def test_schema_has_the_sixteen_features():
    assert len(schema.TXN_COLUMNS) == 20 and len(schema.FEATURES) == 16
