import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from paywatch.operators import evaluate, models, sampling
from paywatch.plans.training import train_job
from paywatch.sources import fixture, schema
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model-input") / "t")
    fixture.features(spark, SMALL).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def trained(spark, table, tmp_path_factory):
    work = str(tmp_path_factory.mktemp("work"))
    return train_job(spark, table, work, cap_percent=8, trees=10, rounds=5), work


def test_training_job_writes_everything(spark, trained):
    fitted, work = trained
    report = spark.read.option("header", True).csv(f"{work}/report")
    assert report.count() == 5
    assert spark.read.parquet(f"{work}/auc").first().roc_auc > 0.8
    assert spark.read.parquet(f"{work}/confusion").agg(F.sum("rows")).first()[0] == \
        spark.read.parquet(f"{work}/splits").filter("split = 'test'").count()
    importance = spark.read.parquet(f"{work}/importance")
    assert {r.feature for r in importance.collect()} == set(schema.FEATURES)
    assert importance.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert 0 < fitted.threshold < 1


def test_save_and_load_score_the_same(spark, table, trained):
    fitted, work = trained
    again = models.RiskModels.load(spark, f"{work}/models")
    assert (again.threshold, again.weights, again.features) == (fitted.threshold, fitted.weights, fitted.features)
    assert again.score(table).exceptAll(fitted.score(table)).count() == 0


def test_ensemble_weights_and_serving_threshold(table, trained):
    fitted, _ = trained
    row = fitted.score(table).first()
    assert row.fraud_score == pytest.approx(0.7 * row.boost_score + 0.3 * row.forest_score)
    equal = models.serving_models(fitted, table)
    row = equal.score(table).first()
    assert row.fraud_score == pytest.approx((row.boost_score + row.forest_score) / 2)
    best = evaluate.best_threshold(equal.score(table)).first()
    assert equal.threshold == best.threshold


def test_unknown_and_missing_categories_get_code_zero(table, trained):
    fitted, _ = trained
    odd = table.limit(1).withColumns({"device_type": F.lit("unknown"), "location": F.lit(None).cast("string")})
    vector = fitted.vectors(odd).first()
    assert vector["device_type_code"] == 0.0 and vector["location_code"] == 0.0


def test_features_can_be_excluded(table):
    split = sampling.split_by_hash(table)
    fitted = models.fit_models(split.filter("split = 'train'"), split.filter("split = 'val'"),
                               exclude=["user_id", "merchant_id"], trees=3, rounds=2)
    assert len(fitted.features) == 14
    assert fitted.score(table).count() == table.count()


def test_models_score_in_a_session_that_observes(spark, table, tmp_path):
    """Observed metrics leave something in the session that cannot be shipped; models must not carry the session."""
    seen = Observation()
    table.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(str(tmp_path / "t"))
    assert seen.get["rows"] == table.count()
    split = sampling.split_by_hash(table)
    fitted = models.fit_models(split.filter("split = 'train'"), split.filter("split = 'val'"), trees=3, rounds=2)
    assert not fitted.forest.hasSummary and fitted.forest.getNumTrees == 3
    assert fitted.score(table).count() == table.count()
    assert fitted.score(table).filter("fraud_score is null").count() == 0
