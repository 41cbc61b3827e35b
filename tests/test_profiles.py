"""Profiles merged from stored parts, and heavy users found by sketches."""

import random
import re

import pytest
from pyspark.sql import functions as F

from paywatch.operators import features, heavy, profiles
from paywatch.sources import fixture
from tests.conftest import SMALL
from tests.test_features import random_rows
from tests.test_plans import plan


def same(left, right):
    """Equal rows, spreads to twelve digits."""
    rounded = lambda df: sorted(
        (tuple(r[c] if c != "std_amount" or r[c] is None else f"{r[c]:.12g}" for c in sorted(df.columns)) for r in df.collect()), key=str
    )
    return sorted(left.columns) == sorted(right.columns) and rounded(left) == rounded(right)


def edge_rows():
    rnd = random.Random(5)
    rows = random_rows(300, 3, 12, 0.4)
    rows += [(1000 + i, 50 + i % 3, rnd.choice([None, i]), rnd.choice([None, 1e9, 3.333]), rnd.choice([None, "", "a"]), rnd.choice([None, "x"])) for i in range(30)]
    return rows + [(2000, None, 1, 5.0, "a", "x"), (2001, 99, None, None, None, None), (2002, 98, 7, 5.0, "a", "x")]


@pytest.mark.parametrize("loads", [1, 4])
def test_merged_loads_equal_one_scan(spark, txns, tmp_path, loads):
    rows = edge_rows()
    for n in range(loads):
        profiles.store_load(txns(rows[n::loads]), str(tmp_path / "p"), f"day{n}")
    merged = profiles.profile_of(profiles.stored_parts(spark, str(tmp_path / "p")))
    assert same(merged, features.user_profile(txns(rows)))


def test_a_load_stored_again_counts_once_and_loads_compact(spark, txns, tmp_path):
    rows = edge_rows()
    path, small = str(tmp_path / "p"), str(tmp_path / "c")
    for n in (0, 1, 1, 2):
        profiles.store_load(txns(rows[n::3]), path, f"day{n}")
    want = features.user_profile(txns(rows))
    assert same(profiles.profile_of(profiles.stored_parts(spark, path)), want)
    profiles.compact_loads(spark, path, ["day0", "day1"], small, "day0-day1")
    both = profiles.stored_parts(spark, small).unionByName(profiles.stored_parts(spark, path).filter("load = 'day2'"))
    assert both.count() < profiles.stored_parts(spark, path).count()
    assert same(profiles.profile_of(both), want)


def test_an_empty_load(spark, txns, tmp_path):
    profiles.store_load(txns([]), str(tmp_path / "p"), "none")
    assert profiles.profile_of(profiles.stored_parts(spark, str(tmp_path / "p"))).count() == 0


def test_parts_shuffle_once(spark, txns):
    text = plan(profiles.profile_parts(txns(edge_rows())))
    assert len(re.findall("Exchange hashpartitioning", text)) == 1


def test_sketches_of_loads_name_the_heavy_users(spark, txns, tmp_path):
    rows = random_rows(900, 4, 200, 0.3)
    for n in range(3):
        heavy.store_sketch(txns(rows[n::3]), str(tmp_path / "s"), str(n))
    heavy.store_sketch(txns([]), str(tmp_path / "s"), "empty")
    got = heavy.heavy_keys(heavy.stored_sketches(spark, str(tmp_path / "s")), hot_rows=100)
    assert [r.user_id for r in got.collect()] == [0]
    none = heavy.heavy_keys(heavy.key_sketch(txns([(1, None, 1, 1.0, "a", "x")])), hot_rows=0)
    assert none.count() == 0


def test_heavy_users_of_small_and_even_tables(txns):
    rows = random_rows(400, 4, 100, 0.4)
    assert heavy.heavy_users(txns(rows), 400) is None
    assert [r.user_id for r in heavy.heavy_users(txns(rows), 100).collect()] == [0]
    assert heavy.heavy_users(txns([r for r in rows if r[1]]), 100) is None


def test_features_are_sliced_by_default(spark, monkeypatch):
    """No parameter is given: the table's own sizes decide, and the result is the same."""
    columns = ["transaction_id", "user_avg", "prior_avg", "is_new_device", "previous_location", "time_since_last_txn", "velocity", "risk_score"]
    whole = fixture.features(spark, SMALL).select(columns)
    monkeypatch.setattr(fixture, "HOT_ROWS", 60)
    cut = fixture.features(spark, SMALL).select(columns)
    assert "Union" in plan(cut) and "Union" not in plan(whole)
    assert cut.exceptAll(whole).count() == 0 and cut.count() == whole.count()


def test_a_hot_user_is_no_single_task(spark, txns):
    """One user has a third of all rows over a month: they are dealt to many slices."""
    rnd = random.Random(1)
    rows = [(i, 0 if i % 3 == 0 else rnd.randrange(1, 400), rnd.randrange(30 * 1440), 1.0, "a", "x") for i in range(3000)]
    table = txns(rows)
    hot = heavy.heavy_users(table, 500)
    us = F.unix_micros("timestamp")
    marked = table.join(hot.withColumn("is_hot", F.lit(1)), "user_id", "left")
    slices = marked.groupBy("user_id", F.when(F.col("is_hot") == 1, F.floor(us / (3600 * 1_000_000 // 60))).otherwise(0).alias("s")).count()
    assert slices.agg(F.max("count")).first()[0] < 40 < 1000 == sum(r[1] == 0 for r in rows)
    got = features.user_features(table, hot=hot).select("transaction_id", "prior_avg", "velocity")
    assert got.exceptAll(features.user_features(table).select(got.columns)).count() == 0 and got.count() == 3000
