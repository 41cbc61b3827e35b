"""The training job: raw transactions to saved models and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paywatch.operators.evaluate import (
    apply_threshold,
    classification_report,
    confusion_matrix,
    pr_curve,
    roc_auc,
    roc_curve,
)
from paywatch.operators.models import RiskModels, fit_models, round_losses
from paywatch.operators.sampling import cap_positives, split_by_hash, split_exact
from paywatch.sources.tables import write_report
from paywatch.sources.schema import LABEL


def train_job(
    spark: SparkSession,
    labelled: DataFrame,
    work_dir: str,
    exact_split: bool = False,
    cap_percent: int | None = None,
    **fit_options,
) -> RiskModels:
    """Split, fit, tune, evaluate and save under ``work_dir`` (shared storage).

    The labelled features are written once, by split; fitting reads that table, so the feature
    windows run once and a lost executor costs a re-read. With ``cap_percent`` positives are capped
    in the training rows only.
    """
    split = split_exact(labelled) if exact_split else split_by_hash(labelled)
    split.write.mode("overwrite").partitionBy("split").parquet(f"{work_dir}/splits")
    table = spark.read.parquet(f"{work_dir}/splits")
    part = {n: table.filter(F.col("split") == n).drop("split") for n in ("train", "val", "test")}
    train = cap_positives(part["train"], cap_percent) if cap_percent is not None else part["train"]
    models = fit_models(train, part["val"], **fit_options)
    models.save(f"{work_dir}/models")

    models.score(part["test"]).select(
        "transaction_id", LABEL, "fraud_score", "forest_score", "boost_score", "forest_pred", "boost_pred"
    ).write.mode("overwrite").parquet(f"{work_dir}/test_scores")
    scores = spark.read.parquet(f"{work_dir}/test_scores")
    models.score(part["val"]).select("transaction_id", LABEL, "forest_pred", "boost_pred").write.mode("overwrite").parquet(f"{work_dir}/val_scores")
    held = spark.read.parquet(f"{work_dir}/val_scores")
    called = apply_threshold(scores, models.threshold)
    write_report(classification_report(called), f"{work_dir}/report")
    for name, result in {
        "forest_report": classification_report(scores, pred="forest_pred"),
        "boost_report": classification_report(scores, pred="boost_pred"),
        "forest_val_report": classification_report(held, pred="forest_pred"),
        "boost_val_report": classification_report(held, pred="boost_pred"),
        "boost_val_loss": round_losses(models, part["val"]),
        "forest_auc": roc_auc(scores, "forest_score"),
        "boost_auc": roc_auc(scores, "boost_score"),
        "confusion": confusion_matrix(called),
        "auc": roc_auc(scores),
        "roc_curve": roc_curve(scores),
        "pr_curve": pr_curve(scores),
        "importance": models.importances(),
    }.items():
        result.write.mode("overwrite").parquet(f"{work_dir}/{name}")
    return models
