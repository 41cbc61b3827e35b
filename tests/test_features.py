import random

import pytest
from pyspark.sql import functions as F

from paywatch.operators import features
from tests.conftest import START, as_dicts

DAY = 86_400


def brute(rows, window_minutes):
    """Row-by-row features from (id, user, minute, amount, device, location) tuples."""
    by_user = {}
    for r in rows:
        by_user.setdefault(r[1], []).append(r)
    result = {}
    for own in by_user.values():
        own.sort(key=lambda r: (r[2], r[0]))
        places = [r[5] for r in own]
        home = min(set(places), key=lambda p: (-places.count(p), p))
        avg = sum(round(r[3] * 100) for r in own) / (len(own) * 100.0)
        for n, r in enumerate(own):
            before = own[:n]
            prev = before[-1][5] if before else home
            result[r[0]] = {
                "user_avg": avg,
                "prior_avg": sum(round(b[3] * 100) for b in before) / (n * 100.0) if n else None,
                "is_new_device": int(all(b[4] != r[4] for b in before)),
                "previous_location": prev,
                "location_change": int(prev != r[5]),
                "gap": (r[2] - before[-1][2]) if before else 0.0,
                "velocity": sum(1 for b in own if r[2] - window_minutes <= b[2] <= r[2]),
            }
    return result


def random_rows(n, seed, users, hot_share):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        user = 0 if rnd.random() < hot_share else rnd.randrange(1, users)
        rows.append((i, user, rnd.randrange(0, 4000) // 2, round(rnd.uniform(1, 900), 2),
                     rnd.choice("abc"), rnd.choice(["north", "south", "west"])))
    return rows


@pytest.mark.parametrize("hot_rows", [5, 60, 10_000])
@pytest.mark.parametrize("window", [3600, 6 * 3600])
def test_user_features_match_brute_force(txns, hot_rows, window):
    """A user with most of the rows, many equal times; sliced and unsliced must agree with the loop."""
    rows = random_rows(400, hot_rows + window, 12, 0.6)
    expected = brute(rows, window / 60)
    table = txns(rows)
    got = as_dicts(features.user_features(table, window, features.hot_users(table, hot_rows)))
    assert len(got) == len(rows)
    for r in got:
        want = expected[r["transaction_id"]]
        assert r["time_since_last_txn"] == pytest.approx(want.pop("gap"), abs=0.006)
        assert {k: r[k] for k in want} == want


def test_slices_are_used_for_hot_users(txns):
    from paywatch.operators.slices import hot_keys

    rows = random_rows(300, 1, 10, 0.6)
    assert [r.user_id for r in hot_keys(txns(rows), "user_id", 100).collect()] == [0]


@pytest.mark.parametrize("hot_rows", [0, 100])
def test_row_without_user_or_time_stands_alone(txns, hot_rows):
    rows = [(1, None, 0, 5.0, "a", "x"), (2, None, 1, 7.0, "a", "y"), (3, 4, 2, 1.0, "a", "x"),
            (4, 4, None, 9.0, "a", "z"), (5, 4, 3, 3.0, "a", "x")]
    table = txns(rows)
    got = {r["transaction_id"]: r for r in as_dicts(features.user_features(table, hot=features.hot_users(table, hot_rows)))}
    assert len(got) == 5 and got[4]["user_id"] == 4 and got[4]["user_avg"] == 9.0 and got[4]["velocity"] == 1
    assert got[5]["user_avg"] == 2.0 and got[5]["velocity"] == 2 and got[5]["previous_location"] == "x"
    assert got[2]["velocity"] == 1 and got[2]["user_avg"] == 7.0 and got[2]["time_since_last_txn"] == 0.0


def test_missing_values_keep_their_rows(txns):
    rows = [(1, 1, 0, None, None, None), (2, 1, 1, 4.0, None, "x"), (3, 1, 2, 6.0, "a", None)]
    for hot in (0, 100):
        table = txns(rows)
        got = {r["transaction_id"]: r for r in as_dicts(features.user_features(table, hot=features.hot_users(table, hot)))}
        assert len(got) == 3
        assert got[3]["user_avg"] == 5.0 and got[3]["prior_avg"] == 4.0 and got[2]["prior_avg"] is None
        assert [got[i]["is_new_device"] for i in (1, 2, 3)] == [1, 0, 1]
        assert [got[i]["velocity"] for i in (1, 2, 3)] == [1, 2, 3]
        assert got[3]["previous_location"] == "x" and got[2]["previous_location"] == "x"  # home, where the last row has none


@pytest.mark.parametrize("seed", range(3))
def test_slicing_changes_no_row(txns, seed):
    """Random rows with null and empty devices and places, and null users and times."""
    rnd = random.Random(seed)
    pick = lambda *xs: rnd.choice(xs)
    rows = [(i, pick(1, 1, 2, None), pick(None, *range(600)), pick(None, 3.0, 5.5), pick(None, "", "x"), pick(None, "", "n")) for i in range(150)]
    table = txns(rows)
    plain = {r["transaction_id"]: r for r in as_dicts(features.user_features(table))}
    sliced = {r["transaction_id"]: r for r in as_dicts(features.user_features(table, hot=features.hot_users(table, 0)))}
    assert sliced == plain and len(plain) == 150


def test_device_is_new_once_in_slices(txns):
    table = txns([(1, 1, 0, 1.0, None, "x"), (2, 1, 60, 1.0, "x", "x"), (3, 1, 120, 1.0, "", "x"), (4, 1, 180, 1.0, None, "x")])
    for hot in (None, features.hot_users(table, 0)):
        got = {r["transaction_id"]: r["is_new_device"] for r in as_dicts(features.user_features(table, hot=hot))}
        assert got == {1: 1, 2: 1, 3: 1, 4: 0}


def test_empty_table(txns):
    assert features.user_features(txns([])).count() == 0
    assert features.user_profile(txns([])).count() == 0


def test_window_must_divide():
    with pytest.raises(ValueError):
        features.user_features(None, window_seconds=1, slices_per_window=7)


def test_profile_ties_and_spread(txns):
    rows = [(1, 1, 0, 10.0, "b", "y"), (2, 1, 30, 20.0, "a", "x"), (3, 1, 60, 30.0, "c", "z")]
    (p,) = as_dicts(features.user_profile(txns(rows)))
    assert (p["home_location"], p["primary_device"]) == ("x", "a")
    assert p["avg_amount"] == 20.0 and p["std_amount"] == pytest.approx(10.0)
    assert p["active_hours"] == 2 and p["txn_frequency"] == 1.5


def test_hours_and_night(spark):
    df = spark.createDataFrame([(h,) for h in (0, 4, 5, 22, 23)], "h int").withColumn(
        "timestamp", F.lit(START) + F.make_interval(hours=F.col("h"))
    )
    got = df.select("h", features.hour_of_day().alias("hour"), features.is_night().alias("night"),
                    features.is_night(night_from=23).alias("late")).orderBy("h").collect()
    assert [r.hour for r in got] == [0, 4, 5, 22, 23]
    assert [r.night for r in got] == [1, 1, 0, 0, 0]
    assert [r.late for r in got] == [1, 1, 0, 0, 1]


def test_merchant_risk_smooths_and_falls_back(spark):
    train = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (2, 0)], "merchant_id long, is_fraud int")
    rows = spark.createDataFrame([(1,), (2,), (3,)], "merchant_id long")
    got = {r.merchant_id: r.merchant_risk_score for r in features.merchant_risk(rows, train).collect()}
    assert got == {1: round((1 + 5) / 22, 3), 2: round(5 / 22, 3), 3: 0.25}


def test_amount_tiers_borders(spark):
    df = spark.createDataFrame([(9.99,), (10.0,), (499.99,), (500.0,), (49999.0,), (50000.0,)], "amount double")
    got = [r.t for r in df.select(features.amount_tier().alias("t")).collect()]
    assert got == ["under 10", "10-500", "10-500", "500-5000", "5000-50000", "from 50000"]


def test_rule_score_and_label(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 4, 300.0, 100.0, 1.0), (0, 0, 0, 3, 100.0, 100.0, 0.0)],
        "high_amount_flag int, is_new_device int, location_change int, velocity long, amount double, "
        "user_avg double, merchant_risk_score double",
    )
    got = df.withColumn("risk_score", features.rule_score()).withColumn("y", features.rule_label()).collect()
    assert [round(r.risk_score, 9) for r in got] == [1.0, 0.0] and [r.y for r in got] == [1, 0]
