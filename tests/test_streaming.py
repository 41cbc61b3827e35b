"""Streams over JSON files must equal the batch operators."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from paywatch.operators import batches, features, models, project, sampling
from paywatch.sources import fixture, messages, schema
from paywatch.streaming import jobs, stateful
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("features") / "t")
    fixture.features(spark, SMALL).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def fitted(spark, labelled):
    split = sampling.split_by_hash(labelled)
    return models.fit_models(
        split.filter("split = 'train'"), split.filter("split = 'val'"), trees=5, rounds=3
    )


def publish(df, folder, parts=3):
    """One JSON-lines file per range of ids, in order."""
    rows = messages.encode(df.select(schema.TXN_COLUMNS), keep=["transaction_id"]).orderBy("transaction_id").collect()
    step = -(-len(rows) // parts)
    folder.mkdir(exist_ok=True)
    for n in range(parts):
        (folder / f"part{n}.json").write_text("\n".join(r["value"] for r in rows[n * step:(n + 1) * step]) + "\n")
    return str(folder)


def test_scoring_equals_batch_and_survives_restart(spark, labelled, fitted, tmp_path):
    source = publish(labelled, tmp_path / "in")
    (tmp_path / "in" / "bad.json").write_text("not json\n")
    paths = jobs.RunPaths(str(tmp_path / "out"), "run1")
    raw = messages.message_stream(spark, "files", path=source)

    def run():
        query = jobs.score_stream(raw, fitted, paths, trigger=None)
        query.awaitTermination()
        return query

    query = run()
    assert sum(c["rows"] for c in jobs.run_counters(query)) >= labelled.count()
    stored = jobs.read_batches(spark, paths.of("alerts"))
    expected = project.over_threshold(fitted.score(labelled), fitted.threshold)
    got = {(r.transaction_id, round(r.fraud_score, 9)) for r in stored.collect()}
    assert got == {(r.transaction_id, round(r.fraud_score, 9)) for r in expected.collect()}
    assert stored.count() == len(got) > 0
    per_batch = stored.groupBy("batch_id").agg(
        F.countDistinct("pipeline_detected_at").alias("times"), F.max("total_batch_txns").alias("n")
    ).collect()
    assert all(r.times == 1 for r in per_batch) and max(r.n for r in per_batch) <= 334

    run()  # nothing new: the checkpoint remembers
    assert jobs.read_batches(spark, paths.of("alerts")).count() == len(got)


def test_repeated_batch_overwrites_itself(spark, labelled, fitted, tmp_path):
    sink = jobs.alert_sink(str(tmp_path / "a"), fitted.threshold)
    scored = fitted.score(labelled)
    sink(scored, 7)
    first = jobs.read_batches(spark, str(tmp_path / "a")).count()
    sink(scored, 7)
    assert jobs.read_batches(spark, str(tmp_path / "a")).count() == first > 0
    sink(scored.limit(0), 8)
    assert not (tmp_path / "a" / "batch_id=8").exists()


def test_new_run_is_empty(spark, tmp_path):
    paths = jobs.RunPaths(str(tmp_path), "fresh")
    empty = jobs.read_batches(spark, paths.of("alerts"), "batch_id long, transaction_id long")
    assert empty.count() == 0


def test_metrics_by_rule_equal_batch(spark, labelled, tmp_path):
    big = labelled.withColumn("amount", F.col("amount") * 30)
    source = publish(big, tmp_path / "in", parts=4)
    paths = jobs.RunPaths(str(tmp_path / "out"), "r")
    raw = messages.message_stream(spark, "files", path=source)
    jobs.metrics_stream(raw, jobs.load_models(spark, str(tmp_path / "none")), paths, trigger=None).awaitTermination()
    records = jobs.read_batches(spark, paths.of("metrics")).orderBy("batch_id").collect()
    step = 250
    sliced = big.withColumn("batch_id", F.floor(F.col("transaction_id") / step))
    expected = batches.batch_metrics(jobs.with_prediction(sliced, None)).orderBy("batch_id").collect()
    pick = ("batch_size", "detected", "actual", "missed", "alerts")
    got = sorted(tuple(r[c] for c in pick) for r in records)
    assert got == sorted(tuple(r[c] for c in pick) for r in expected)
    assert sum(r["actual"] for r in records) > 0


def test_metrics_by_model(spark, labelled, fitted, tmp_path):
    fitted.save(str(tmp_path / "m"))
    loaded = jobs.load_models(spark, str(tmp_path / "m"))
    source = publish(labelled, tmp_path / "in", parts=2)
    paths = jobs.RunPaths(str(tmp_path / "out"), "r")
    raw = messages.message_stream(spark, "files", path=source)
    jobs.metrics_stream(raw, loaded, paths, trigger=None).awaitTermination()
    got = jobs.read_batches(spark, paths.of("metrics")).agg(F.sum("detected"), F.sum("batch_size")).first()
    expected = jobs.with_prediction(labelled, fitted).agg(F.sum("pred"), F.count(F.lit(1))).first()
    assert tuple(got) == tuple(expected)


def test_narrow_messages_by_the_forest(spark, labelled, fitted, tmp_path):
    """The metrics of narrow messages equal those of full ones whose other features are 0."""
    kept = set(schema.NARROW_COLUMNS)
    zeros = {c: F.lit("0" if c in schema.CATEGORICAL else 0).cast(labelled.schema[c].dataType) for c in fitted.features if c not in kept}
    expected = fitted.score(labelled.withColumns(zeros))
    got = jobs.with_forest_prediction(labelled.select(schema.NARROW_COLUMNS), fitted)
    assert got.columns == [*schema.NARROW_COLUMNS, "fraud_score", "pred"]
    assert got.select("transaction_id", "pred").exceptAll(expected.select("transaction_id", "forest_pred")).count() == 0
    paths = jobs.RunPaths(str(tmp_path / "out"), "r")
    raw = messages.message_stream(spark, "files", path=publish(labelled, tmp_path / "in", parts=2))
    jobs.metrics_stream(raw, fitted, paths, trigger=None, narrow=True).awaitTermination()
    seen = jobs.read_batches(spark, paths.of("metrics")).agg(F.sum("detected"), F.sum("batch_size")).first()
    assert tuple(seen) == tuple(expected.agg(F.sum("forest_pred"), F.count(F.lit(1))).first())


def test_running_totals_stream(spark, labelled, tmp_path):
    source = publish(labelled, tmp_path / "in")
    raw = messages.message_stream(spark, "files", path=source)
    predicted = jobs.with_prediction(jobs.transactions(raw), None)
    writer = jobs.totals(predicted).writeStream.outputMode("complete").format("memory")
    jobs.start(writer, str(tmp_path / "cp"), None, "totals_now").awaitTermination()
    expected = jobs.totals(jobs.with_prediction(labelled, None)).first()
    assert spark.table("totals_now").first() == expected


def test_windowed_alert_count_drops_late_rows(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    start = datetime(2024, 1, 1)

    def message(i, hours):
        return json.dumps({"transaction_id": float(i), "timestamp": str(start + timedelta(hours=hours))})

    (folder / "a.json").write_text("\n".join(message(i, h) for i, h in enumerate([0.1, 0.2, 1.5])))
    raw = messages.message_stream(spark, "files", path=str(folder))
    counted = batches.alerts_per_window(jobs.transactions(raw))

    def run():
        writer = counted.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "w"))
        jobs.start(writer, str(tmp_path / "cp"), None).awaitTermination()

    run()
    (folder / "b.json").write_text("\n".join([message(10, 0.9), message(11, 9)]))
    run()
    (folder / "c.json").write_text("\n".join([message(12, 0.5), message(13, 20)]))  # first one is too late
    run()
    rows = spark.read.parquet(str(tmp_path / "w")).orderBy("window_start").collect()
    assert [(r.window_start.hour, r.alert_count) for r in rows][:3] == [(0, 3), (1, 1), (9, 1)]


def test_quarantine_keeps_unreadable_messages(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"transaction_id": 1.0}\nbroken{\n{"amount": 3.0}\n')
    raw = messages.message_stream(spark, "files", path=str(folder))
    paths = jobs.RunPaths(str(tmp_path / "out"), "r")
    jobs.quarantine_stream(raw, paths, trigger=None).awaitTermination()
    kept = {r.message for r in spark.read.parquet(paths.of("quarantine")).collect()}
    assert kept == {"broken{", '{"amount": 3.0}'}


def test_stateful_features_equal_batch(spark, labelled, tmp_path):
    """Several files, rows out of order within the delay, a second run from the checkpoint."""
    day = fixture.DAY
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [
        (r.transaction_id, r.value)
        for r in messages.encode(labelled.select(schema.TXN_COLUMNS), keep=["transaction_id"])
        .orderBy("transaction_id").collect()
    ]
    rows = [v for _, v in sorted(rows, key=lambda r: r[0] // 8 * 8 - r[0] % 8)]  # swap neighbours
    flush = json.dumps({"transaction_id": -1.0, "user_id": -1.0, "timestamp": "2030-01-01 00:00:00"})
    out = str(tmp_path / "out")

    def run():
        raw = messages.message_stream(spark, "files", path=str(folder), max_files_per_trigger=1)
        result = stateful.stream_features(jobs.transactions(raw), "12 hours", day)
        writer = result.writeStream.outputMode("append").format("parquet").option("path", out)
        jobs.start(writer, str(tmp_path / "cp"), None).awaitTermination()

    for n in range(3):
        (folder / f"f{n}.json").write_text("\n".join(rows[n * 200:(n + 1) * 200]))
    run()
    (folder / "f3.json").write_text("\n".join(rows[600:]))
    run()
    (folder / "f4.json").write_text(flush)
    run()

    columns = ["transaction_id", "is_new_device", "time_since_last_txn", "velocity", "prior_avg"]
    base = fixture.events_as_txns(spark, SMALL)
    batch = features.user_features(base, day)
    got = spark.read.parquet(out)
    assert got.count() == batch.count()
    assert got.select(columns).exceptAll(batch.select(columns)).count() == 0
    moved = ["transaction_id", "previous_location", "location_change"]
    later = got.filter("previous_location is not null")
    assert later.select(moved).exceptAll(batch.select(moved)).count() == 0
    assert got.count() - later.count() == base.select("user_id").distinct().count()


def stream_of(spark, folder, parts, transform, out, mode="append"):
    """Deliver tables of transactions one after the other, each to a restarted query; the last progress of each."""
    progress = []
    for n, part in enumerate(parts):
        part.write.parquet(f"{folder}/in/{n}")
        raw = spark.readStream.schema(part.schema).parquet(f"{folder}/in/*")
        writer = transform(raw).writeStream.outputMode(mode).format("parquet").option("path", out)
        query = jobs.start(writer, f"{folder}/cp", None)
        query.awaitTermination()
        progress.append(query.recentProgress[-1])
    return progress


FLUSH = (None, -1, 10**8, 1.0, None, None)


@pytest.mark.parametrize("with_profile", [True, False])
def test_first_rows_have_the_home_location(spark, txns, tmp_path, with_profile):
    """Homes and averages from stored profiles; rows without user, time, amount or place; a last row without a place."""
    rows = [(1, 7, 0, 10.0, "a", "x"), (2, 7, 5, None, "a", None), (3, 7, 9, 20.0, "b", "y"), (4, 7, 11, 1.5, None, "y"),
            (5, 8, 1, 4.0, "a", None), (6, None, 3, 5.0, "a", "z"), (7, 8, None, 6.0, "a", "q"), (8, 8, 700, 7.0, "", "q")]
    base = txns(rows)
    profile = features.user_profile(base) if with_profile else None
    stream_of(spark, tmp_path, [base, txns([FLUSH])], lambda raw: stateful.stream_features(raw, "1 day", 3600, profile), str(tmp_path / "out"))
    shown = ["transaction_id", "prior_avg", "is_new_device", "time_since_last_txn", "velocity"]
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = features.user_features(base, 3600)
    if with_profile:
        shown += ["previous_location", "location_change"]
        assert got.filter("user_avg is null").count() == 0
        kept = got.filter("transaction_id != 7").select("transaction_id", "user_avg")
        known = {r.user_id: r.avg_amount for r in profile.collect()}
        assert {r.transaction_id: r.user_avg for r in kept.collect()} == {1: known[7], 2: known[7], 3: known[7], 4: known[7], 5: known[8], 6: 5.0, 8: known[8]}
    assert sorted(map(tuple, got.select(shown).collect())) == sorted(map(tuple, batch.select(shown).collect()))


def test_state_is_removed_after_its_time_to_live(spark, txns, tmp_path):
    """Users who stay away lose their state; inside the time to live all answers are those of an unlimited one."""
    hour = 60
    first = [(i, i, i % 50, 1.0 + i, "ab"[i % 2], "x") for i in range(40)]
    second = [(100 + i, i % 5, 5 * hour + i, 2.0, "ab"[i % 2], "y") for i in range(10)]
    third = [(200, 1, 9 * hour, 3.0, "a", "z"), (201, 39, 9 * hour, 3.0, "a", "z")]
    parts = [txns(p) for p in (first, second, third, [FLUSH])]
    ends = {}
    for name, ttl in (("short", 6 * 3600), ("none", None)):
        folder = tmp_path / name
        ends[name] = stream_of(spark, folder, parts, lambda raw: stateful.stream_features(raw, "10 minutes", 3600, None, ttl), str(folder / "out"))
    rows = {n: [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in ends[n]] for n in ends}
    assert rows["short"][2] < rows["none"][2] and rows["short"][3] <= 8 < rows["none"][3]
    got = {n: {r.transaction_id: r for r in spark.read.parquet(str(tmp_path / n / "out")).collect()} for n in ends}
    assert len(got["short"]) == len(got["none"]) == 52
    for i, row in got["short"].items():
        if i != 201:
            assert row == got["none"][i]
    # User 39 was away for more than six hours and starts anew; user 1 was not.
    assert got["short"][201].is_new_device == 1 and got["short"][201].prior_avg is None and got["short"][201].time_since_last_txn == 0.0
    assert got["none"][201].prior_avg == 40.0 and got["short"][200].is_new_device == 0
    with pytest.raises(ValueError):
        stateful.UserFeatures(3600, ttl_seconds=60)


def test_groups_of_users_hold_few_state_rows(spark, txns, tmp_path):
    """Users who share a group are worked off apart; state rows follow the groups, not the minutes or the users."""
    rows = [(None if i == 50 else i, i % 7, i * 5 + i % 3, None if i % 11 == 0 else 1.0 + i, [None, "", "a", "b"][i % 4], "xyz"[i % 3])
            for i in range(300)]
    parts = [txns(rows[:170]), txns(rows[170:]), txns([FLUSH])]
    ends = stream_of(spark, tmp_path, parts, lambda raw: stateful.stream_features(raw, "4 hours", 3600, None, groups=2), str(tmp_path / "out"))
    assert all(sum(o["numRowsTotal"] for o in p["stateOperators"]) <= 2 * 6 for p in ends)
    shown = ["user_id", "transaction_id", "prior_avg", "is_new_device", "time_since_last_txn", "velocity"]
    batch = features.user_features(txns(rows), 3600).select(shown)
    got = spark.read.parquet(str(tmp_path / "out")).select(shown)
    assert got.count() == 300 and got.exceptAll(batch).count() == batch.exceptAll(got).count() == 0
