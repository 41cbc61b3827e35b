"""Every operator as a query over the provided tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from uuid import uuid4

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paywatch.functions.columns import micros
from paywatch.operators import batches, boosting, encode, evaluate, features, heavy, profiles, project, sampling, serving
from paywatch.operators.ensemble import SERVING_WEIGHTS, TRAINING_WEIGHTS, ensemble
from paywatch.operators.models import RiskModels, apply_model, fit_boost, fit_forest, fit_models, serving_models
from paywatch.session import apply_settings, cut_lineage, storage_dir
from paywatch.sources import fixture, messages, schema, tables
from paywatch.streaming import compaction, counters, jobs, live, replay, stateful

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

SEED = 42
TXN = "transaction_id"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(apply_settings(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    REGISTRY[fn.__name__] = run
    return run


@lru_cache(maxsize=8)
def _alert_table(app: str, sf_dir: str) -> tuple[str, StructType]:
    spark = SparkSession.active()
    hits = project.over_threshold(fixture.scored(spark, sf_dir), fixture.ALERT_THRESHOLD)
    rows = batches.with_batch_meta(hits, fixture.events_as_txns(spark, sf_dir))
    path = f"{storage_dir(spark)}/alerts-{uuid4().hex}"
    rows.repartition("batch_id").write.partitionBy("batch_id").parquet(path)
    return path, rows.schema


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert table: scored rows above the threshold with their batch metadata.

    Stored once per application and folder, by batch, as the streaming sink stores it; the serving
    queries read that table and only the batches they ask for.
    """
    path, kinds = _alert_table(spark.sparkContext.applicationId, sf_dir)
    return spark.read.schema(kinds).parquet(path)


def labelled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.orders_as_txns(spark, sf_dir).withColumn("is_fraud", (F.col("status") == "F").cast("int"))


# ---- scans, decoding, encoding ------------------------------------------------------------------


@query
def s1_scan(spark, sf):
    return fixture.events_as_txns(spark, sf)


@query
def s2_write_read(spark, sf):
    """Transactions written as CSV and read back with the fixed schema."""
    path = f"{storage_dir(spark)}/csv-{uuid4().hex}"
    rows = fixture.features(spark, sf).select(schema.TXN_COLUMNS)
    tables.write_txns(rows.withColumn("timestamp", F.col("timestamp").cast("timestamp")), path, "csv")
    return tables.read_txns(spark, path, "csv").withColumn("timestamp", micros(F.col("timestamp")))


@query
def s3_saved_splits(spark, sf):
    """Splits stored by folder, one of them read back."""
    path = f"{storage_dir(spark)}/splits-{uuid4().hex}"
    tables.save_splits(sampling.split_by_hash(fixture.features(spark, sf).select(schema.TXN_COLUMNS)), path)
    back = tables.read_split(spark, path, "val")
    return back.groupBy("is_fraud").agg(F.count(F.lit(1)).alias("row_count"), F.lit(len(back.columns)).alias("column_count"))


@query
def s3_splits(spark, sf):
    split = sampling.split_by_hash(fixture.features(spark, sf))
    return split.groupBy("split", "is_fraud").agg(F.count(F.lit(1)).alias("row_count"))


@query
def s5_json_decode(spark, sf):
    from pyspark.sql import types as T

    raw = fixture.table(spark, sf, "events").withColumn("value", F.col("props").cast("binary"))
    return messages.decode(raw, T.StructType([T.StructField("k", T.DoubleType())]), keep=["event_id"])


def _messages(spark, sf):
    txns = fixture.features(spark, sf).select(schema.TXN_COLUMNS)
    return messages.encode(txns).select(F.col("value").cast("binary").alias("value"))


@query
def s6_narrow_decode(spark, sf):
    rows = messages.decode(_messages(spark, sf), schema.NARROW_SCHEMA)
    return rows.select(*[F.col(c).cast("string" if c == "location" else "double").alias(c) for c in schema.NARROW_COLUMNS])


@query
def s7_json_encode(spark, sf):
    back = messages.typed(messages.readable(messages.decode(_messages(spark, sf))))
    return back.withColumn("timestamp", micros(F.col("timestamp")))


# ---- projections and filters --------------------------------------------------------------------


@query
def p1_fill_zero(spark, sf):
    device = F.when(F.col("device_type") != "error", F.col("device_type"))
    rows = fixture.features(spark, sf).select(TXN, "prior_avg", device.alias("device_type"))
    return project.fill_zero(rows)


@query
def p2_drop(spark, sf):
    return fixture.features(spark, sf).select(schema.TXN_COLUMNS).drop(*schema.NON_FEATURES)


@query
def p3_align(spark, sf):
    rows = fixture.features(spark, sf).select(schema.NARROW_COLUMNS)
    return project.align(rows, schema.FEATURES)


@query
def p4_alert_filter(spark, sf):
    hits = project.over_threshold(fixture.scored(spark, sf), fixture.ALERT_THRESHOLD)
    return hits.select(TXN, "fraud_score")


@query
def p5_rule_count(spark, sf):
    return project.rule_count(fixture.orders_as_txns(spark, sf))


@query
def p6_class_filter(spark, sf):
    return project.of_class(fixture.features(spark, sf), 1).select(TXN, "is_fraud")


@query
def p7_casts(spark, sf):
    return fixture.features(spark, sf).select(
        F.col(TXN).cast("double").alias("id_number"),
        F.col(TXN).cast("double").cast("long").cast("string").alias("id_text"),
        F.col("merchant_id").cast("int").alias("merchant_code"),
        (F.col("risk_score") > schema.RISK_LIMIT).cast("int").alias("over_limit"),
        F.expr("try_cast(device_type AS double)").alias("device_number"),
    )


def _replayed(spark, sf):
    return sampling.surrogate_ids(fixture.features(spark, sf))


@query
def p8_canary(spark, sf):
    return project.inject_canaries(_replayed(spark, sf)).select(TXN, "source_id", *project.CANARY_VALUES)


@query
def p9_surrogate_id(spark, sf):
    return sampling.surrogate_ids(fixture.events_as_txns(spark, sf)).select(TXN, "source_id")


@query
def p10_round(spark, sf):
    return fixture.features(spark, sf).select(
        TXN, F.round("user_avg", 2).alias("avg_2"), F.round("user_avg", 3).alias("avg_3"),
        F.round("risk_score", 3).alias("risk_3"),
    )


@query
def p11_clamp(spark, sf):
    return fixture.events_as_txns(spark, sf).select(TXN, project.clamp_low(F.col("amount")).alias("amount"))


@query
def p13_defaults(spark, sf):
    rows = fixture.events_as_txns(spark, sf).select(
        TXN,
        F.when(F.col("merchant_id") != 0, F.col("merchant_id")).alias("merchant_id"),
        F.when(F.col("device_type") != "error", F.col("location")).alias("location"),
    )
    return project.with_defaults(rows, {"merchant_id": 0, "location": "Unknown", "batch_id": 0})


ALERT_FIELDS = [TXN, "user_id", "amount", "device_type", "location", "fraud_score"]


@query
def p14_public_cols(spark, sf):
    return project.public_columns(alerts(spark, sf).select(*ALERT_FIELDS, *schema.SYSTEM_COLUMNS))


@query
def p15_alert_line(spark, sf):
    return project.alert_line(project.over_threshold(fixture.scored(spark, sf), fixture.ALERT_THRESHOLD))


@query
def p16_preview(spark, sf):
    return project.preview(fixture.events_as_txns(spark, sf).select(TXN, "user_id", "amount", "location"))


# ---- features -----------------------------------------------------------------------------------


def _profile(txns):
    return features.user_profile(txns).select(
        "user_id", "txn_count", "avg_amount", F.round("std_amount", 4).alias("std_amount"), "home_location",
        "primary_device", "txn_frequency",
    )


@query
def f1_user_profile(spark, sf):
    return _profile(fixture.events_as_txns(spark, sf))


@query
def f1_user_profile_orders(spark, sf):
    return _profile(fixture.orders_as_txns(spark, sf))


def _by_user(spark, sf, *columns, window_seconds=fixture.DAY):
    txns, hot = fixture.events_as_txns(spark, sf), fixture.hot_users(spark, sf)
    return features.user_features(txns, window_seconds, hot).select(TXN, *columns)


@query
def f2_user_avg(spark, sf):
    return _by_user(spark, sf, F.round("user_avg", 2).alias("user_avg_amount"))


@query
def f2_prior_avg(spark, sf):
    return _by_user(spark, sf, "prior_avg")


@query
def f3_deviation(spark, sf):
    return _by_user(spark, sf, F.round(features.amount_deviation(), 2).alias("amount_deviation"))


@query
def f4_high_amount(spark, sf):
    return _by_user(spark, sf, features.high_amount().alias("high_amount_flag"))


@query
def f5_new_device(spark, sf):
    return _by_user(spark, sf, "is_new_device")


@query
def f6_prev_location(spark, sf):
    return _by_user(spark, sf, "previous_location")


@query
def f7_location_change(spark, sf):
    return _by_user(spark, sf, "location_change")


@query
def f8_hour(spark, sf):
    return fixture.events_as_txns(spark, sf).select(TXN, features.hour_of_day().alias("hour"))


@query
def f9_night(spark, sf):
    return fixture.events_as_txns(spark, sf).select(
        TXN, features.is_night().alias("is_night"), features.is_night(night_from=22).alias("is_late"))


@query
def f10_gap(spark, sf):
    return _by_user(spark, sf, "time_since_last_txn")


@query
def f11_velocity_1h(spark, sf):
    return _by_user(spark, sf, "velocity", window_seconds=features.HOUR)


@query
def f11_velocity_24h(spark, sf):
    return _by_user(spark, sf, "velocity")


@query
def f5_f11_orders(spark, sf):
    """All user features on orders, whose dates repeat, so ids decide the order."""
    hot = fixture.hot_customers(spark, sf)
    return features.user_features(fixture.orders_as_txns(spark, sf), 30 * fixture.DAY, hot).select(
        TXN, "user_avg", "prior_avg", "is_new_device", "previous_location", "location_change",
        "time_since_last_txn", "velocity",
    )


@query
def f5_f11_sliced(spark, sf):
    """The same features with every user's rows cut into time slices."""
    txns = fixture.events_as_txns(spark, sf)
    return features.user_features(txns, fixture.DAY, features.hot_users(txns, 0)).select(
        TXN, "user_avg", "prior_avg", "is_new_device", "previous_location", "location_change",
        "time_since_last_txn", "velocity",
    )


LOADS = 3


@query
def f5_f11_heavy(spark, sf):
    """The same with users cut whom a sketch of each load, stored and combined, names as heavy."""
    txns = fixture.events_as_txns(spark, sf)
    folder = f"{storage_dir(spark)}/sketches-{uuid4().hex}"
    for n in range(LOADS):
        heavy.store_sketch(txns.filter(F.pmod(F.col(TXN), F.lit(LOADS)) == n), folder, str(n))
    hot = heavy.heavy_keys(heavy.stored_sketches(spark, folder), hot_rows=50)
    return features.user_features(txns, fixture.DAY, hot).select(
        TXN, "user_avg", "prior_avg", "is_new_device", "previous_location", "location_change",
        "time_since_last_txn", "velocity",
    )


@query
def f1_user_profile_merged(spark, sf):
    """Profiles from the stored partial aggregates of several loads, two of them compacted into one."""
    txns = fixture.events_as_txns(spark, sf)
    base = f"{storage_dir(spark)}/profiles-{uuid4().hex}"
    for n in range(LOADS):
        profiles.store_load(txns.filter(F.pmod(F.col(TXN), F.lit(LOADS)) == n), f"{base}/loads", f"load{n}")
    profiles.compact_loads(spark, f"{base}/loads", ["load0", "load1"], f"{base}/compact", "0-1")
    newest = profiles.stored_parts(spark, f"{base}/loads").filter("load = 'load2'")
    parts = profiles.stored_parts(spark, f"{base}/compact").unionByName(newest)
    return profiles.profile_of(parts).withColumn("std_amount", F.round("std_amount", 4)).drop("active_hours")


@query
def f12_merchant_risk(spark, sf):
    rows = sampling.split_by_hash(fixture.features(spark, sf)).select(TXN, "merchant_id", "is_fraud", "split")
    rows = cut_lineage(rows)
    return features.merchant_risk(rows, rows.filter("split = 'train'")).select(TXN, "merchant_risk_score")


@query
def f13_risk_score(spark, sf):
    return fixture.features(spark, sf).select(TXN, "risk_score")


@query
def f14_label(spark, sf):
    return fixture.features(spark, sf).select(TXN, "is_fraud")


@query
def f15_amount_tiers(spark, sf):
    return features.amount_tiers(labelled_orders(spark, sf))


# ---- sampling and splits ------------------------------------------------------------------------


@query
def b1_cap_positives(spark, sf):
    rows = cut_lineage(fixture.features(spark, sf).select(TXN, "is_fraud"))
    return sampling.cap_positives(rows)


@query
def b2_union(spark, sf):
    rows = labelled_orders(spark, sf).select(TXN, "amount", "is_fraud")
    return sampling.union_classes(project.of_class(rows, 0), project.of_class(rows, 1).select("is_fraud", "amount", TXN))


@query
def b3_shuffle(spark, sf):
    return sampling.shuffled(fixture.events_as_txns(spark, sf).select(TXN, "amount"))


@query
def b4_sample_n(spark, sf):
    return sampling.sample_n(fixture.events_as_txns(spark, sf).select(TXN, "amount"), schema.REPLAY_BATCH_ROWS)


@query
def b5_split_hash(spark, sf):
    return sampling.split_by_hash(labelled_orders(spark, sf)).select(TXN, "is_fraud", "split")


@query
def b5_split_exact(spark, sf):
    return sampling.split_exact(labelled_orders(spark, sf)).select(TXN, "is_fraud", "split")


@query
def b6_balance(spark, sf):
    return sampling.class_balance(fixture.features(spark, sf))


@query
def b7_class_weights(spark, sf):
    return sampling.class_weights(sampling.split_by_hash(fixture.features(spark, sf)).filter("split = 'train'"))


# ---- models -------------------------------------------------------------------------------------


@query
def m1_label_dict(spark, sf):
    txns = fixture.events_as_txns(spark, sf)
    parts = [
        encode.label_dictionary(txns, c).select(F.lit(c).alias("field"), "value", "code")
        for c in schema.CATEGORICAL
    ]
    return parts[0].unionByName(parts[1])


@query
def m2_encode(spark, sf):
    """Dictionaries learned from train, applied to all rows with one device made unknown."""
    txns = sampling.split_by_hash(fixture.events_as_txns(spark, sf))
    train = txns.filter("split = 'train'")
    rows = txns.select(
        TXN, F.when(F.col("device_type") == "view", "unknown").otherwise(F.col("device_type")).alias("device_type"),
        "location",
    )
    coded = encode.encode(rows, "device_type", encode.label_dictionary(train, "device_type"))
    coded = encode.encode(coded, "location", encode.label_dictionary(train, "location"))
    return coded.select(TXN, "device_type", "location")


@lru_cache(maxsize=4)
def _fitted(app: str, sf: str) -> tuple[RiskModels, DataFrame]:
    spark = SparkSession.active()
    rows = sampling.split_by_hash(fixture.features(spark, sf)).select(*schema.TXN_COLUMNS, "batch_id", "split")
    rows = cut_lineage(rows)
    models = fit_models(rows.filter("split = 'train'"), rows.filter("split = 'val'"))
    return models, rows


def fitted(spark: SparkSession, sf: str) -> tuple[RiskModels, DataFrame]:
    """Models of full size, fitted on the train split of a folder once per application."""
    return _fitted(spark.sparkContext.applicationId, sf)


def _scored_test(spark, sf):
    models, rows = fitted(spark, sf)
    return models.score(rows.filter("split = 'test'"))


@query
def m4_rf(spark, sf):
    return _scored_test(spark, sf).select(TXN, "forest_score")


@query
def m5_gbt(spark, sf):
    return _scored_test(spark, sf).select(TXN, "boost_score")


@query
def m6_proba(spark, sf):
    return _scored_test(spark, sf).select(TXN, "forest_score", "boost_score", "fraud_score")


@query
def m7_predict(spark, sf):
    """How many test rows there are, and how many break what must hold of scores and predictions."""
    rows = _scored_test(spark, sf)
    scores = [F.col(c) for c in ("forest_score", "boost_score", "fraud_score")]
    mean = 0.3 * F.col("forest_score") + 0.7 * F.col("boost_score")
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(~(scores[0].between(0, 1) & scores[1].between(0, 1) & scores[2].between(0, 1))).alias("out_of_range"),
        F.count_if(F.col("forest_pred") != (F.col("forest_score") > 0.5).cast("int")).alias("forest_wrong"),
        F.count_if(F.col("boost_pred") != (F.col("boost_score") > 0.5).cast("int")).alias("boost_wrong"),
        F.count_if(F.abs(F.col("fraud_score") - mean) > 1e-9).alias("mean_wrong"),
    )


def _on_new_device(spark, sf, fit, score):
    """One tree of depth 1 on the new-device flag: fitted on train, scored on test, simple enough for SQL."""
    rows = cut_lineage(sampling.split_by_hash(fixture.features(spark, sf)).select(TXN, "is_new_device", "is_fraud", "split"))
    vectors = VectorAssembler(inputCols=["is_new_device"], outputCol="features").transform(rows)
    model = fit(vectors.filter("split = 'train'").select("features", "is_fraud"))
    return apply_model(vectors.filter("split = 'test'"), model, score).select(
        TXN, F.round(f"{score}_score", 9).alias(f"{score}_score"), f"{score}_pred")


@query
def m4_stump(spark, sf):
    fit = lambda train: fit_forest(train, trees=1, depth=1, bootstrap=False, featureSubsetStrategy="all")
    return _on_new_device(spark, sf, fit, "forest")


@query
def m5_one_round(spark, sf):
    fit = lambda train: fit_boost(train, rounds=1, depth=1, subsamplingRate=1.0, featureSubsetStrategy="all")
    return _on_new_device(spark, sf, fit, "boost")


FLAGS = ["is_new_device", "location_change", "high_amount_flag"]


def _newton_on_flags(spark, sf):
    """One second-order tree of depth 2 on three flags, all rows and columns drawn: simple enough for SQL."""
    rows = cut_lineage(sampling.split_by_hash(fixture.features(spark, sf)).select(TXN, *FLAGS, "is_fraud", "split"))
    model = boosting.fit_newton(rows.filter("split = 'train'"), FLAGS, rounds=1, depth=2, row_share=1.0, column_share=1.0)
    return model, rows.filter("split = 'test'")


def _simple_scores(spark, sf):
    """The test split scored by one depth-1 tree on class weights and one second-order tree: checkable by SQL."""
    rows = cut_lineage(sampling.split_by_hash(fixture.features(spark, sf)).select(TXN, *FLAGS, "is_fraud", "batch_id", "split"))
    train = rows.filter("split = 'train'")
    vectors = VectorAssembler(inputCols=["is_new_device"], outputCol="features")
    forest = fit_forest(vectors.transform(train).select("features", "is_fraud"), trees=1, depth=1, bootstrap=False, featureSubsetStrategy="all")
    boost = boosting.fit_newton(train, FLAGS, rounds=1, depth=2, row_share=1.0, column_share=1.0)
    scored = apply_model(vectors.transform(rows.filter("split = 'test'")), forest, "forest").drop("features")
    return boost.score(scored, "boost")


@query
def m6_simple_proba(spark, sf):
    mean = _simple_scores(spark, sf).withColumn("fraud_score", ensemble(TRAINING_WEIGHTS))
    return mean.select(TXN, *(F.round(c, 9).alias(c) for c in ("forest_score", "boost_score", "fraud_score")))


@query
def t1_simple_score(spark, sf):
    """Alerts of the equal-weight mean with the size and time of their whole batch."""
    mean = _simple_scores(spark, sf).withColumn("fraud_score", F.round(ensemble(SERVING_WEIGHTS), 9))
    hits = project.over_threshold(mean, fixture.ALERT_THRESHOLD)
    return batches.with_batch_meta(hits, fixture.events_as_txns(spark, sf)).select(TXN, "fraud_score", *schema.SYSTEM_COLUMNS)


@query
def m5_newton_tree(spark, sf):
    model, test = _newton_on_flags(spark, sf)
    return model.score(test).select(TXN, F.round("newton_score", 9).alias("newton_score"), "newton_pred")


@query
def m8_newton_gain(spark, sf):
    model, _ = _newton_on_flags(spark, sf)
    return model.importances(spark).withColumn("importance", F.round("importance", 9))


@query
def m8_importance(spark, sf):
    return fitted(spark, sf)[0].importances()


@query
def s13_saved_models(spark, sf):
    """Rows of the test split that models, saved twice and loaded, score like the fitted ones, and others."""
    models, rows = fitted(spark, sf)
    path = f"{storage_dir(spark)}/models-{uuid4().hex}"
    RiskModels(models.stages, models.forest, models.boost, models.features, models.weights, 0.99).save(path)
    models.save(path)
    again = RiskModels.load(spark, path)
    test = rows.filter("split = 'test'")
    kept = cut_lineage(models.score(test).select(TXN, "fraud_score"))
    both = again.score(test).select(F.col(TXN).alias("id"), F.col("fraud_score").alias("again")).join(kept, F.col("id") == F.col(TXN), "full")
    same = F.col("fraud_score").eqNullSafe(F.col("again")) & F.lit(again.threshold == models.threshold)
    return both.agg(F.count_if(same).alias("same"), F.count_if(~same).alias("different"))


@query
def m9_ensemble_weighted(spark, sf):
    score = ensemble({"score_b": 0.7, "score_a": 0.3})
    return fixture.scored(spark, sf).select(TXN, score.alias("fraud_score"))


@query
def m10_ensemble_mean(spark, sf):
    score = ensemble({"score_b": 0.5, "score_a": 0.5})
    return fixture.scored(spark, sf).select(TXN, score.alias("fraud_score"))


# ---- evaluation ---------------------------------------------------------------------------------


@query
def e1_report(spark, sf):
    return evaluate.classification_report(fixture.scored(spark, sf))


@query
def s12_report_file(spark, sf):
    """The report as its one CSV file says it."""
    path = f"{storage_dir(spark)}/report-{uuid4().hex}"
    tables.write_report(evaluate.classification_report(fixture.scored(spark, sf)), path)
    kinds = "class string, precision double, recall double, f1 double, support long"
    return spark.read.schema(kinds).option("header", True).csv(path)


@query
def e2_roc_auc(spark, sf):
    return evaluate.roc_auc(fixture.scored(spark, sf))


@query
def e3_pr_curve(spark, sf):
    return evaluate.pr_curve(fixture.scored(spark, sf))


@query
def e4_best_threshold(spark, sf):
    return evaluate.best_threshold(fixture.scored(spark, sf))


@query
def e5_apply_threshold(spark, sf):
    """Threshold chosen on val, applied to test."""
    rows = sampling.split_by_hash(fixture.scored(spark, sf)).select(TXN, "is_fraud", "fraud_score", "split")
    rows = cut_lineage(rows)
    best = evaluate.best_threshold(rows.filter("split = 'val'")).select("threshold").scalar()
    return evaluate.apply_threshold(rows.filter("split = 'test'"), best).select(TXN, "pred")


@query
def e6_confusion(spark, sf):
    return evaluate.confusion_matrix(fixture.scored(spark, sf))


@query
def e7_roc_curve(spark, sf):
    return evaluate.roc_curve(fixture.scored(spark, sf))


# ---- batches ------------------------------------------------------------------------------------


@query
def t1_score(spark, sf):
    """Batch form of stream scoring: equal-weight mean of both models, alerts with batch metadata."""
    models, rows = fitted(spark, sf)
    equal = serving_models(models, rows.filter("split = 'val'"))
    hits = project.over_threshold(equal.score(rows.drop("split")), equal.threshold)
    return batches.with_batch_meta(hits, rows).select(TXN, "fraud_score", *schema.SYSTEM_COLUMNS)


@query
def t2_batch_meta(spark, sf):
    return alerts(spark, sf).select(TXN, *schema.SYSTEM_COLUMNS)


def _scored_once(spark, sf):
    """What the per-batch operators read of the scored table, stored, so that its features are computed once."""
    return cut_lineage(fixture.scored(spark, sf).select(TXN, "batch_id", "amount", "location", "fraud_score", "pred", "is_fraud"))


@query
def t3_batch_metrics(spark, sf):
    metrics = batches.batch_metrics(_scored_once(spark, sf))
    return metrics.select(
        "batch_id", "batch_size", "detected", "actual", "missed",
        F.size("alerts").alias("alert_count"), F.array_join("alerts.id", ",").alias("alert_ids"),
    )


@query
def t4_top2(spark, sf):
    return batches.top_by_amount(fixture.events_as_txns(spark, sf)).select("batch_id", "alert_rank", TXN, "amount")


@query
def t5_alert_structs(spark, sf):
    nested = batches.batch_alerts(fixture.scored(spark, sf))
    return nested.select("batch_id", F.posexplode("alerts").alias("position", "alert")).select(
        "batch_id", "position", "alert.*"
    )


@query
def t6_running_totals(spark, sf):
    counts = batches.batch_counts(fixture.scored(spark, sf))
    return batches.running_batch_totals(counts).drop("missed_total")


@query
def t7_missed(spark, sf):
    counts = batches.batch_counts(fixture.scored(spark, sf))
    return batches.running_batch_totals(counts).select("batch_id", "missed_total")


@query
def t8_latest10(spark, sf):
    return batches.latest_alerts(_scored_once(spark, sf)).select("batch_id", TXN, "amount", "fraud_score")


@query
def t9_snapshot(spark, sf):
    return batches.snapshot(_scored_once(spark, sf)).select(
        "total", "detected", "actual", "missed", F.array_join("alerts.id", ",").alias("alert_ids")
    )


@query
def t10_alert_rate(spark, sf):
    return batches.alerts_per_batch(project.over_threshold(fixture.scored(spark, sf), fixture.ALERT_THRESHOLD))


@query
def t10_window(spark, sf):
    hits = project.over_threshold(fixture.scored(spark, sf), fixture.ALERT_THRESHOLD)
    return batches.alerts_per_window(hits).select(
        micros(F.col("window_start")).alias("window_start_us"), "alert_count"
    )


# ---- the same on streams: the event table is read as a file stream -------------------------------


STREAM_PARTS = 4
STREAM_FILE_ROWS = 1_000_000
FAR_FUTURE = "2200-01-01 00:00:00"


def _time_parts(spark, txns):
    """Transactions in parts by time, the last of them one row of the far future.

    That row has no id. It moves the watermark past everything before it and stays in state itself. A part is as
    many files of a fixed size as its rows need.
    """
    txns = cut_lineage(txns.withColumn("timestamp", F.col("timestamp").cast("timestamp")))
    us = F.unix_micros("timestamp")
    shares = [i / STREAM_PARTS for i in range(1, STREAM_PARTS)]
    cut, rows = txns.agg(F.percentile_approx(us, shares).alias("c"), F.count(F.lit(1)).alias("n")).first()
    files = rows // (STREAM_PARTS * STREAM_FILE_ROWS) + 1
    place = sum((F.coalesce((us > c).cast("int"), F.lit(0)) for c in cut or []), F.lit(0))
    parts = [txns.filter(place == n).repartitionByRange(files, "timestamp") for n in range(STREAM_PARTS)]
    last = {"timestamp": F.lit(FAR_FUTURE).cast("timestamp"), "user_id": F.lit(-1), "amount": F.lit(1e9)}
    kinds = {f.name: f.dataType for f in txns.schema}
    return [*parts, spark.range(1).select(*[last.get(c, F.lit(None)).cast(t).alias(c) for c, t in kinds.items()])]


def _deliver(spark, parts, run):
    """Write the parts one after the other into a folder that is read as a stream.

    After each the query is started again from its checkpoint and works off what is new.
    """
    folder = f"{storage_dir(spark)}/stream-{uuid4().hex}"
    for n, part in enumerate(parts):
        part.write.parquet(f"{folder}/{n}")
        raw = spark.readStream.schema(parts[0].schema).parquet(f"{folder}/*")
        run(raw).awaitTermination()


def _paths(spark, name):
    return jobs.RunPaths(storage_dir(spark), f"{name}-{uuid4().hex}")


def _appended(spark, parts, transform, name):
    """What a stream appends to a table over all its restarts."""
    paths = _paths(spark, name)

    def run(raw):
        writer = transform(raw).writeStream.outputMode("append").format("parquet").option("path", paths.of("out"))
        return jobs.start(writer, paths.checkpoint("out"), trigger=None)

    _deliver(spark, parts, run)
    return spark.read.parquet(paths.of("out"))


@query
def t6_stream_totals(spark, sf):
    paths = _paths(spark, "totals")

    def run(raw):
        predicted = jobs.with_prediction(raw.filter(F.col(TXN).isNotNull()), None, limit=100.0)
        writer = jobs.totals(predicted).writeStream.outputMode("complete").foreachBatch(jobs.totals_sink(paths.of("out")))
        return jobs.start(writer, paths.checkpoint("out"), trigger=None)

    _deliver(spark, _time_parts(spark, fixture.features(spark, sf)), run)
    rows = jobs.read_batches(spark, paths.of("out"))
    newest = rows.agg(F.max("batch_id").alias("b")).scalar()
    return rows.filter(F.col("batch_id") == newest).drop("batch_id")


def _live_rows(spark, sf):
    """The live view after the scored table has come in as a stream, whose parts cut through batches."""
    paths = _paths(spark, "live")
    scored = _scored_once(spark, sf)
    parts = [scored.filter(F.pmod(F.col(TXN), F.lit(STREAM_PARTS)) == n) for n in range(STREAM_PARTS)]
    _deliver(spark, parts, lambda raw: live.live_stream(raw, paths, trigger=None))
    return live.read_live(spark, paths)


@query
def t8_stream_latest10(spark, sf):
    return _live_rows(spark, sf).select("batch_id", TXN, "amount", "fraud_score")


@query
def t9_stream_snapshot(spark, sf):
    entry = F.struct("position", F.col(TXN).cast("string").alias("id"))
    ids = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["id"])
    return _live_rows(spark, sf).groupBy(*live.TOTALS).agg(F.array_join(ids, ",").alias("alert_ids"))


@query
def s15_run_counters(spark, sf):
    """Rows and alerts of a run as its micro-batches reported them."""
    paths = _paths(spark, "counters")
    table = counters.CounterTable(spark, paths.of("counters"))
    scored = _scored_once(spark, sf)
    parts = [scored.filter(F.pmod(F.col(TXN), F.lit(STREAM_PARTS)) == n) for n in range(STREAM_PARTS)]
    started = []

    def run(raw):
        rows = counters.observed(raw, F.col("fraud_score") > fixture.ALERT_THRESHOLD)
        writer = rows.writeStream.foreachBatch(jobs.alert_sink(paths.of("alerts"), fixture.ALERT_THRESHOLD))
        started.append(jobs.start(writer, paths.checkpoint("alerts"), trigger=None))
        return started[-1]

    try:
        _deliver(spark, parts, run)
        for each in started:
            table.settle(each)
    finally:
        table.close()
    found = counters.read_counters(spark, paths.of("counters")).withColumn("has_rate", F.col("rows_per_second") > 0)
    return found.select("batch_id", "rows", "alerts", "has_rate")


@query
def s8_compaction(spark, sf):
    """The stored alerts, read while some of their batches are compacted, some dropped after that, and some are new."""
    paths = _paths(spark, "compaction")
    stored = alerts(spark, sf)
    upto = stored.agg(F.percentile_approx("batch_id", [0.3, 0.6]).alias("c")).first()["c"] or [0, 0]
    for low, high in zip([None, *upto], [*upto, None]):
        here = F.lit(True) if low is None else F.col("batch_id") > low
        here = here if high is None else here & (F.col("batch_id") <= high)
        stored.filter(here).repartition("batch_id").write.mode("append").partitionBy("batch_id").parquet(paths.of("alerts"))
        if high is not None:
            compaction.compact_alerts(spark, paths)
    compaction.drop_compacted(spark, paths)
    return compaction.read_alerts(spark, paths).select(TXN, *schema.SYSTEM_COLUMNS)


@query
def s8_redelivery(spark, sf):
    """A producer that sends every transaction twice: each is kept once."""
    txns = fixture.events_as_txns(spark, sf).select(TXN, "timestamp", "amount")
    parts = [part.unionAll(part) for part in _time_parts(spark, txns)]
    return _appended(spark, parts, lambda raw: jobs.once(raw, "40 days"), "once").filter(F.col(TXN).isNotNull()).select(TXN, "amount")


def _replayed_stream(spark, sf):
    """The full records replayed by a stream in parts, numbered across micro-batches, with canaries."""
    paths = _paths(spark, "replay")
    rows = cut_lineage(fixture.features(spark, sf))
    parts = [rows.filter(F.pmod(F.col(TXN), F.lit(STREAM_PARTS)) == n) for n in range(STREAM_PARTS)]
    _deliver(spark, parts, lambda raw: replay.replay_stream(raw, paths, trigger=None))
    return replay.read_replayed(spark, paths)


@query
def p9_stream_ids(spark, sf):
    return _replayed_stream(spark, sf).select(TXN, "source_id")


@query
def t12_stream_recall(spark, sf):
    injected = _replayed_stream(spark, sf)
    rescored = fixture.with_scores(injected.withColumn("risk_score", features.rule_score(features.id_noise("source_id"))))
    return batches.canary_recall(rescored)


@query
def t10_stream_window(spark, sf):
    """Hourly count of rows over the rule amount, every window of the table."""
    rows = _appended(
        spark, _time_parts(spark, fixture.events_as_txns(spark, sf)),
        lambda raw: batches.alerts_per_window(raw.filter(project.rule_hit(limit=100.0))), "windows",
    )
    return rows.select(micros(F.col("window_start")).alias("window_start_us"), "alert_count")


@query
def t11_stream_features(spark, sf):
    """The user features on a stream, with homes and averages from the stored profiles."""
    txns = fixture.events_as_txns(spark, sf)
    known = cut_lineage(features.user_profile(txns))
    rows = _appended(
        spark, _time_parts(spark, txns), lambda raw: stateful.stream_features(raw, "1 hour", fixture.DAY, known), "features"
    )
    return rows.select(
        TXN, "user_avg", "prior_avg", "is_new_device", "previous_location", "location_change",
        "time_since_last_txn", "velocity",
    )


@query
def t12_canary_recall(spark, sf):
    injected = project.inject_canaries(_replayed(spark, sf))
    rescored = fixture.with_scores(injected.withColumn("risk_score", features.rule_score(features.id_noise("source_id"))))
    return batches.canary_recall(rescored)


# ---- serving ------------------------------------------------------------------------------------


@query
def v1_latest_alert(spark, sf):
    return serving.latest_alert(alerts(spark, sf)).select(TXN, "fraud_score", *schema.SYSTEM_COLUMNS)


@query
def v2_latest_batch(spark, sf):
    return serving.latest_batch(alerts(spark, sf)).select(TXN, "batch_id", "amount", "fraud_score")


@query
def v3_latest_summary(spark, sf):
    return serving.latest_summary(alerts(spark, sf))


@query
def v4_last_five(spark, sf):
    return serving.last_batches(alerts(spark, sf))


def _nested(spark, sf):
    stored = alerts(spark, sf).select(F.hex(TXN).alias("_id"), *ALERT_FIELDS, *schema.SYSTEM_COLUMNS)
    return serving.strip_store_id(serving.last_batches_nested(stored))


@query
def v4_nested(spark, sf):
    """The newest batches as nested rows, one per batch."""
    return _nested(spark, sf).select(
        "batch_id", "chunk", "total_txns", "detected_at", F.size("frauds").alias("fraud_count"),
        F.array_join(F.transform(F.array_sort(f"frauds.{TXN}"), lambda x: x.cast("string")), ",").alias("fraud_ids"),
    )


@query
def v5_strip_nested(spark, sf):
    return _nested(spark, sf).select(F.inline("frauds")).drop("pipeline_detected_at")


@query
def v6_chronological(spark, sf):
    return serving.chronological(serving.last_batches(alerts(spark, sf))).select("position", "batch_id", "fraud_count")


@query
def v7_device_counts(spark, sf):
    return serving.device_counts(alerts(spark, sf))


@query
def v8_top_locations(spark, sf):
    return serving.top_locations(alerts(spark, sf))


@query
def v9_history(spark, sf):
    return serving.history_lines(serving.last_batches(alerts(spark, sf)))


@query
def v10_detail(spark, sf):
    return serving.detail_table(serving.latest_batch(alerts(spark, sf).select(
        TXN, "amount", "device_type", "location", "velocity", *schema.SYSTEM_COLUMNS
    )))
