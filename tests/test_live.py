"""The live view, counters, repeated messages and consecutive ids, over restarts and repeated micro-batches."""

import random

import pytest
from pyspark.sql import functions as F

from paywatch.operators import batches, project, sampling
from paywatch.sources import fixture
from paywatch.streaming import counters, jobs, live, replay
from tests.conftest import SMALL

SCORED = "batch_id long, transaction_id long, amount double, fraud_score double, location string, pred int, is_fraud int"


def deliver(spark, folder, parts, run):
    """Each part to a query that is started again from its checkpoint."""
    for n, part in enumerate(parts):
        part.write.parquet(f"{folder}/in/{n}")
        run(spark.readStream.schema(part.schema).parquet(f"{folder}/in/*")).awaitTermination()


def scored_rows(seed, n, n_batches):
    rnd = random.Random(seed)
    return [
        (rnd.choice([None, *range(n_batches)]), 2**60 + i, rnd.choice([5.0, 7.5, float(rnd.randrange(100))]),
         rnd.random(), rnd.choice(["x", None]), rnd.randrange(2), rnd.choice([0, 1, None]))
        for i in range(n)
    ]


def list_of(rows, n=10, k=2):
    """The newest entries of (batch, id, amount, ...) rows in plain Python."""
    out = []
    for b in sorted({r[0] for r in rows if r[0] is not None}, reverse=True):
        out += sorted((r for r in rows if r[0] == b), key=lambda r: (-r[2], r[1]))[:k]
    return [r[1] for r in out[:n]]


@pytest.mark.parametrize("n_batches,n", [(3, 10), (40, 10), (40, 3)])
def test_live_view_over_restarts(spark, tmp_path, n_batches, n):
    """Batches come in any order, cut by micro-batches; ids are beyond the whole numbers of a float."""
    rows = scored_rows(n_batches + n, 400, n_batches)
    parts = [spark.createDataFrame(rows[i::4], SCORED).repartition(3) for i in range(4)]
    paths = jobs.RunPaths(str(tmp_path / "out"), "r")
    deliver(spark, tmp_path, parts, lambda raw: live.live_stream(raw, paths, None, n))
    view = live.read_live(spark, paths).orderBy("position").collect()
    assert [r.transaction_id for r in view] == list_of(rows, n)
    assert [r.position for r in view] == list(range(1, len(view) + 1))
    whole = spark.createDataFrame(rows, SCORED)
    want = batches.snapshot(whole).first()
    assert all((r.total, r.detected, r.actual, r.missed) == want[:4] for r in view)
    if n == 10:
        assert [str(r.transaction_id) for r in view] == [a.id for a in want.alerts]


def test_live_view_without_a_numbered_batch(spark, tmp_path):
    paths = jobs.RunPaths(str(tmp_path / "out"), "r")
    rows = [(None, 1, 2.0, 0.5, "x", 1, 0), (None, 2, 2.0, 0.5, "x", 0, 1)]
    deliver(spark, tmp_path, [spark.createDataFrame(rows, SCORED)], lambda raw: live.live_stream(raw, paths, None))
    (row,) = live.read_live(spark, paths).collect()
    assert (row.total, row.detected, row.actual, row.missed, row.transaction_id) == (2, 1, 1, 1, None)


def test_candidates_are_enough(spark):
    """Reducing parts first and merging them gives the list of all rows."""
    import pandas as pd

    rows = scored_rows(9, 300, 30)
    frame = pd.DataFrame([(r[0] or 0, *r[1:5], int(r[0] is not None)) for r in rows], columns=[*live.ENTRY_COLUMNS, "is_entry"])
    merged = pd.concat([live.newest_entries(frame[i::7], 10, 2) for i in range(7)], ignore_index=True)
    assert len(merged) <= 7 * 20
    assert live.newest_entries(merged, 10, 2)["transaction_id"].tolist()[:10] == list_of(rows)


def test_counters_take_no_job_of_their_own(spark, tmp_path):
    rows = spark.createDataFrame(scored_rows(1, 200, 5), SCORED)
    parts = [rows.filter(F.col("transaction_id") % 3 == n) for n in range(3)] + [rows.limit(0)]
    paths = jobs.RunPaths(str(tmp_path / "out"), "r")
    table = counters.CounterTable(spark, paths.of("counters"))
    assert counters.read_counters(spark, paths.of("counters")).count() == 0
    queries = []

    def run(raw):
        seen = counters.observed(raw, F.col("fraud_score") > 0.5)
        writer = seen.writeStream.foreachBatch(jobs.alert_sink(paths.of("alerts"), 0.5))
        queries.append(table.watch(lambda: jobs.start(writer, paths.checkpoint("a"), None)))
        return queries[-1]

    try:
        deliver(spark, tmp_path, parts, run)
        for q in queries:
            table.settle(q)
    finally:
        table.close()
    found = counters.read_counters(spark, paths.of("counters")).orderBy("batch_id").collect()
    want = [(p.count(), p.filter("fraud_score > 0.5").count()) for p in parts[:3]]
    assert [(r.rows, r.alerts) for r in found] == want and all(r.rows_per_second > 0 for r in found)
    sizes = jobs.read_batches(spark, paths.of("alerts")).groupBy("batch_id").agg(F.max("total_batch_txns").alias("n")).orderBy("batch_id")
    assert [r.n for r in sizes.collect()] == [n for n, _ in want]
    total = counters.run_totals(counters.read_counters(spark, paths.of("counters"))).first()
    assert (total.batches, total.rows, total.alerts) == (3, 200, sum(a for _, a in want))


def test_repeated_messages_are_scored_once(spark, txns, tmp_path):
    """The same file again in the same run, in a later run, and inside one file; a row without a time passes."""
    first, second = [(i, 1, i, 9.0, "a", "x") for i in range(30)], [(i, 1, i, 9.0, "a", "x") for i in range(20, 50)]
    parts = [txns(first + first[:5]), txns(first), txns(second + [(99, 1, None, 9.0, "a", "x")])]

    def run(raw):
        kept = jobs.once(raw, "1 hour").withColumn("fraud_score", F.lit(0.9))
        return jobs.start(kept.writeStream.foreachBatch(jobs.alert_sink(str(tmp_path / "a"), 0.5)), str(tmp_path / "cp"), None)

    deliver(spark, tmp_path, parts, run)
    ids = [r.transaction_id for r in jobs.read_batches(spark, str(tmp_path / "a")).collect()]
    assert sorted(ids) == [*range(50), 99]


def test_ids_go_on_across_batches_and_a_repeated_one(spark, tmp_path):
    rows = fixture.features(spark, SMALL).limit(300).select("transaction_id", *project.CANARY_VALUES)
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    parts = [rows.filter(F.col("transaction_id") % 3 == n) for n in range(3)]
    paths = jobs.RunPaths(str(tmp_path / "out"), "r")
    deliver(spark, tmp_path, [parts[0], parts[0].limit(0), *parts[1:]], lambda raw: replay.replay_stream(raw, paths, None, 4_900))

    def state():
        got = replay.read_replayed(spark, paths)
        return {r.transaction_id: (r.source_id, r.amount) for r in got.collect()}

    before = state()
    assert sorted(before) == list(range(4_900, 5_200)) and len({s for s, _ in before.values()}) == 300
    assert before[4_999][1] == 950_000.0 and sum(a == 950_000.0 for _, a in before.values()) == 1
    for n, part in enumerate(parts):
        mine = sampling.surrogate_ids(part, 4_900 + sum(p.count() for p in parts[:n]))
        assert {r.transaction_id: r.source_id for r in mine.collect()}.items() <= {i: s for i, (s, _) in before.items()}.items()

    last = replay.read_records(spark, paths.of("replay_records")).orderBy(F.desc("batch_id")).first()
    replay.replay_sink(paths.of("replayed"), paths.of("replay_records"), 4_900)(parts[2], last.batch_id)
    assert state() == before


def test_a_batch_that_failed_before_its_record_is_done_again(spark, tmp_path):
    rows = spark.range(10).select(F.col("id").alias("transaction_id"), F.lit(1.0).alias("amount"))
    out, records = str(tmp_path / "o"), str(tmp_path / "r")
    replay.replay_sink(out, records, 100)(rows, 4)
    replay.replay_sink(out, str(tmp_path / "lost"), 100)(rows, 4)  # the same without its record
    assert replay.first_id(spark, records, 4, 100) == 100 and replay.first_id(spark, records, 5, 100) == 110
    replay.replay_sink(out, records, 100)(rows, 9)
    assert replay.first_id(spark, records, 10, 100) == 120
    assert sorted(r.transaction_id for r in spark.read.parquet(out).collect()) == list(range(100, 120))


def test_a_task_sends_few_rows_however_many_arrow_batches_it_reads():
    import pyarrow as pa

    rows = [(b, i, a) for i, (b, _, a, *_) in enumerate(scored_rows(3, 900, 40)) if b is not None]
    columns = {"view": 0, **dict.fromkeys(live.TOTALS, 1), "is_entry": 1}
    parts = [pa.Table.from_pylist([{**columns, "batch_id": b, "transaction_id": i, "amount": a, "fraud_score": 0.5, "location": "x"} for b, i, a in rows[n::30]])
             for n in range(30)]
    sent = pa.Table.from_batches(list(live.reduced(10, 2)(b for p in parts for b in p.to_batches()))).to_pandas()
    assert len(sent) <= 1 + 10 * 2
    assert sent[live.TOTALS].sum().tolist() == [len(rows)] * len(live.TOTALS)
    assert sent[sent["is_entry"] == 1]["transaction_id"].tolist()[:10] == list_of(rows)
