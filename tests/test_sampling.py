import random

import pytest
from pyspark.sql import functions as F

from paywatch.functions.columns import mix32
from paywatch.operators import encode, sampling


def labelled(spark, n, positives, first=0):
    return spark.range(first, first + n).select(
        F.col("id").alias("transaction_id"), (F.col("id") < first + positives).cast("int").alias("is_fraud")
    )


def python_mix(key, seed=0):
    mask = 0xFFFFFFFF
    x = ((key & mask) * 0x3C6EF35F + (key >> 32) * 0x1B873593 + (seed & mask) * 0x10DCD) % 4294967291
    x = (x ^ x >> 15) * 0x2C1B3C6D & mask
    return (x ^ x >> 13) * 0x297A2D39 & mask


def test_hash_is_stable_and_spreads(spark):
    keys = [0, 1, 2**31, 2**32, 2**40 + 5, 2**62]
    df = spark.createDataFrame([(k,) for k in keys], "k long").select("k", mix32(F.col("k"), 7).alias("h"))
    assert {r.k: r.h for r in df.collect()} == {k: python_mix(k, 7) for k in keys}
    for step in (1, 2**20, 2**32):  # ids that differ in any part spread over the slices
        slices = spark.range(4096).select((mix32(F.col("id") * step) / 2**28).cast("int").alias("s"))
        sizes = [r["count"] for r in slices.groupBy("s").count().collect()]
        assert len(sizes) == 16 and max(sizes) < 400


@pytest.mark.parametrize("n,positives", [(1000, 100), (1000, 30), (1000, 3), (100, 100), (10, 5), (0, 0)])
def test_cap_positives(spark, n, positives):
    df = labelled(spark, n, positives)
    got = sampling.cap_positives(df)
    by_class = {r.is_fraud: r["count"] for r in got.groupBy("is_fraud").count().collect()}
    assert by_class.get(1, 0) == min(positives, n * 3 // 100)
    assert by_class.get(0, 0) == n - positives
    order = sorted(range(positives), key=lambda i: (python_mix(i, 42), i))
    kept = {r.transaction_id for r in got.filter("is_fraud = 1").collect()}
    assert kept == set(order[: n * 3 // 100])


@pytest.mark.parametrize("n", [0, 1, 7, 500, 501])
def test_sample_n(spark, n):
    got = {r[0] for r in sampling.sample_n(spark.range(500).toDF("transaction_id"), n, seed=3).collect()}
    assert got == set(sorted(range(500), key=lambda i: (python_mix(i, 3), i))[:n])


def test_samples_differ_by_seed(spark):
    df = spark.range(500).toDF("transaction_id")
    draws = [frozenset(r[0] for r in sampling.sample_n(df, 50, seed=s).collect()) for s in range(3)]
    assert len(set(draws)) == 3


def test_shuffle_index_is_a_permutation_in_hash_order(spark):
    got = {r.row_index: r.transaction_id for r in sampling.shuffled(spark.range(777).toDF("transaction_id")).collect()}
    assert [got[i] for i in range(777)] == sorted(range(777), key=lambda i: (python_mix(i, 42), i))


def test_surrogate_ids_are_consecutive(spark):
    got = sampling.surrogate_ids(spark.range(300).toDF("transaction_id")).collect()
    assert sorted(r.transaction_id for r in got) == list(range(200_000, 200_300))
    assert sorted(r.source_id for r in got) == list(range(300))


def test_rows_without_id_are_kept(spark):
    df = spark.createDataFrame([(None,), (1,), (None,), (2,)], "transaction_id long")
    assert sorted(r.row_index for r in sampling.shuffled(df).collect()) == [0, 1, 2, 3]


@pytest.mark.parametrize("n,positives", [(1000, 37), (10, 1), (3, 0), (1, 1)])
def test_exact_split_is_complete_and_stratified(spark, n, positives):
    got = sampling.split_exact(labelled(spark, n, positives))
    assert got.count() == n and got.select("transaction_id").distinct().count() == n
    counts = {(r.is_fraud, r.split): r["count"] for r in got.groupBy("is_fraud", "split").count().collect()}
    for label, size in ((1, positives), (0, n - positives)):
        train = size * 70 // 100
        val = (size - train) * 15 // 30
        assert counts.get((label, "train"), 0) == train
        assert counts.get((label, "val"), 0) == val
        assert counts.get((label, "test"), 0) == size - train - val


def test_exact_split_keeps_unlabelled_rows(spark):
    df = spark.createDataFrame([(i, None if i % 2 else 1) for i in range(20)], "transaction_id long, is_fraud int")
    assert sampling.split_exact(df).count() == 20


def test_hash_split_shares_and_repeatability(spark):
    df = labelled(spark, 20_000, 1000)
    got = sampling.split_by_hash(df)
    share = {r.split: r["count"] / 20_000 for r in got.groupBy("split").count().collect()}
    assert share["train"] == pytest.approx(0.70, abs=0.02) and share["val"] == pytest.approx(0.15, abs=0.02)
    again = sampling.split_by_hash(df.repartition(7))
    assert got.exceptAll(again).count() == 0


def test_class_weights(spark):
    df = labelled(spark, 10, 2)
    got = {r.is_fraud: r for r in sampling.class_weights(df).collect()}
    assert got[1].weight == 10 / 4 and got[0].weight == 10 / 16 and got[1].scale_pos_weight == 4.0
    weighted = sampling.with_class_weight(df)
    assert weighted.agg(F.sum("weight")).first()[0] == pytest.approx(10.0)
    assert {r.weight for r in sampling.with_class_weight(df, balanced=False).collect()} == {1.0, 4.0}
    assert sampling.class_weights(labelled(spark, 4, 0)).count() == 2


def test_label_dictionary_and_unknowns(spark):
    names = ["b", "aa", "ab", "a", "zz", "é"]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(n,) for n in names * 3 + [None]], "v string")
    codes = encode.label_dictionary(df, "v")
    got = {r.value: r.code for r in codes.collect()}
    assert got == {n: i for i, n in enumerate(sorted(names))}
    probe = spark.createDataFrame([("b",), ("new",), (None,)], "v string")
    assert sorted(r.v for r in encode.encode(probe, "v", codes).collect()) == [0, 0, got["b"]]
    assert sorted(r.v for r in encode.encode(probe, "v", codes, unknown=-1).collect()) == [-1, -1, got["b"]]
