"""Readers see a store or a model whole while it is rewritten."""

import pytest
from pyspark.sql import functions as F

from paywatch.operators import models, sampling, serving
from paywatch.sources import fixture, published
from paywatch.streaming import compaction, jobs
from tests.conftest import SMALL


def store(spark, paths, batches):
    """Alert folders as the sink writes them; a batch's alerts depend on its number."""
    for b in batches:
        rows = spark.range(b % 4 + 1).select(
            (F.col("id") + 1000 * b).alias("transaction_id"), F.lit("web").alias("device_type"), F.lit("x").alias("location"),
            F.lit(100 + b).cast("long").alias("total_batch_txns"), F.lit(b).cast("timestamp").alias("pipeline_detected_at"))
        rows.write.mode("overwrite").parquet(f"{paths.of('alerts')}/batch_id={b}")


def views(alerts):
    return [sorted(map(tuple, q(alerts).collect())) for q in (serving.last_batches, serving.latest_summary, serving.top_locations, serving.latest_alert)] + [
        sorted((r.batch_id, r.transaction_id) for r in alerts.select("batch_id", "transaction_id").collect())]


def test_alerts_are_the_same_before_during_and_after(spark, tmp_path, monkeypatch):
    paths = jobs.RunPaths(str(tmp_path), "r")
    store(spark, paths, range(9))
    want = views(jobs.read_batches(spark, paths.of("alerts")))
    assert views(compaction.read_alerts(spark, paths)) == want

    def fails(*_):
        raise OSError("lost before the pointer")

    with monkeypatch.context() as m:  # the range is written, the pointer is not
        m.setattr(published, "publish", fails)
        with pytest.raises(OSError):
            compaction.compact_alerts(spark, paths)
    assert views(compaction.read_alerts(spark, paths)) == want
    planned = compaction.read_alerts(spark, paths)  # a reader from before
    assert compaction.compact_alerts(spark, paths, file_rows=5) == 7
    assert views(planned) == views(compaction.read_alerts(spark, paths)) == want
    assert compaction.compact_alerts(spark, paths) is None
    assert compaction.drop_compacted(spark, paths) == 8
    assert views(compaction.read_alerts(spark, paths)) == want

    store(spark, paths, [8, 9, 12])  # the newest is repeated, others follow, some batches had no alert
    all_ = jobs.RunPaths(str(tmp_path), "all")
    store(spark, all_, [*range(10), 12])
    want = views(jobs.read_batches(spark, all_.of("alerts")))
    assert views(compaction.read_alerts(spark, paths)) == want
    assert compaction.compact_alerts(spark, paths) == 9 and compaction.drop_compacted(spark, paths) == 2
    assert views(compaction.read_alerts(spark, paths)) == want
    assert published.current(spark, paths.of("alerts_compact"))[0] == 2


def test_a_run_without_alerts(spark, tmp_path):
    paths = jobs.RunPaths(str(tmp_path), "r")
    assert compaction.compact_alerts(spark, paths) is None and compaction.drop_compacted(spark, paths) == 0
    assert compaction.read_alerts(spark, paths, "batch_id long, transaction_id long").count() == 0
    store(spark, paths, [3])
    assert compaction.compact_alerts(spark, paths) is None  # it may still be repeated
    assert compaction.read_alerts(spark, paths).count() == 4


def test_a_filter_on_batches_reads_few_row_groups(spark, tmp_path):
    paths = jobs.RunPaths(str(tmp_path), "r")
    store(spark, paths, range(6))
    compaction.compact_alerts(spark, paths)
    text = compaction.read_alerts(spark, paths).filter("batch_id = 2")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(batch_id,2)" in text


@pytest.fixture(scope="module")
def two_models(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("input") / "t")
    fixture.features(spark, SMALL).write.parquet(path)
    split = sampling.split_by_hash(spark.read.parquet(path))
    fit = lambda trees: models.fit_models(split.filter("split = 'train'"), split.filter("split = 'val'"), trees=trees, rounds=2)
    return fit(2), fit(3)


def test_a_reader_during_a_save_sees_one_version(spark, two_models, tmp_path, monkeypatch):
    first, second = two_models
    path = str(tmp_path / "m")
    assert jobs.load_models(spark, path) is None
    first.save(path)
    seen = []

    def load(*_):
        seen.append(models.RiskModels.load(spark, path))

    write = published.publish

    def watched(*args):
        load()  # everything is written, nothing is published
        return write(*args)

    monkeypatch.setattr(published, "publish", watched)
    second.save(path)
    load()
    assert [m.forest.getNumTrees for m in seen] == [2, 3]
    assert [m.threshold for m in seen] == [first.threshold, second.threshold]

    def fails(*_):
        raise OSError("lost")

    monkeypatch.setattr(type(second.boost), "write", fails)
    with pytest.raises(OSError):
        first.save(path)
    monkeypatch.undo()
    assert models.RiskModels.load(spark, path).forest.getNumTrees == 3
    assert published.current(spark, path)[0] == 2
