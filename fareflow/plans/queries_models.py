"""Catalog entries for model training and scoring on the modelling table
(M4-M8, M10-M14, M20-M22, M25-M27).  Model outputs are not bit-comparable
across engines, so these carry no SQL twin (rows-only checks); the exact
metric operators are checked separately in ``queries_ml``."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareflow.ml import pipeline as P
from fareflow.operators.ranking import stratified_folds
from fareflow.operators.splits import time_split
from fareflow.plans.catalog import register
from fareflow.plans.model_table import build_model_table
from fareflow.plans.quote_view import model_source, quote_view
from fareflow.plans.reports import materialize
from fareflow.session import stage_path

FEATURES = ["leadTime", "leg1_stops", "leg2_stops", "leg1_noOfTicketsLeft", "leg2_noOfTicketsLeft",
            "leg1_departureTime_hour", "leg2_departureTime_hour", "depWeekOfYear", "retWeekOfYear",
            "fromCity", "toCity", "depDayOfWeek", "searchDayOfWeek", "leg1_cabinClass_0", "trip"]
KEEP = ["routeCombKey", "searchDate", "price", "label"]


HOLD_OUT_FROM = "2000-04-01"


def _held_out(mt):
    """Searches from ``HOLD_OUT_FROM`` on are held out (split 1): the label
    looks ahead, so later quotes must not train.  Written once, as indexers,
    fit and evaluation all read it, with the columns that they read."""
    used = {*FEATURES, *KEEP} if "label" in mt.columns else {*FEATURES, *KEEP, "saving"}
    mt = mt.select(*[c for c in mt.columns if c in used])
    d = time_split(mt, "searchDate", HOLD_OUT_FROM)
    return materialize(d.withColumn("split", (F.col("split") == "test").cast("int")), "model-data")


def _model_data(spark, sf_dir):
    mt = build_model_table(model_source(quote_view(spark, sf_dir)))
    mt = mt.withColumnRenamed("priceWillDrop", "label")
    return _held_out(mt)


@register("M4_M5_M7_M8_logistic_pipeline")
def m7(spark, sf_dir):
    d = _model_data(spark, sf_dir)
    model = P.train_classifier(d.filter("split = 0"), FEATURES, "logreg")
    roc = model.stages[-1].summary.roc  # training summary: ROC curve (M8)
    return roc.select("FPR", "TPR")


@register("M8_training_summary")
def m8(spark, sf_dir):
    """Objective after each iteration, area under the curve and the threshold of the best F-measure."""
    d = _model_data(spark, sf_dir)
    model = P.train_classifier(d.filter("split = 0"), FEATURES, "logreg")
    return P.training_summary(spark, model)


@register("M10_M16_gbt_auc")
def m10(spark, sf_dir):
    d = _model_data(spark, sf_dir)
    model = P.train_classifier(d.filter("split = 0"), FEATURES, "gbt")
    test = model.transform(P.impute_zero(d.filter("split = 1"), FEATURES))
    auc = P.evaluate_auc(test)
    return spark.createDataFrame([("gbt", float(auc))], "model string, auc double")


@register("M11_gbt_regressor_rmse")
def m11(spark, sf_dir):
    mt = build_model_table(model_source(quote_view(spark, sf_dir)))
    d = _held_out(mt)
    model = P.train_regressor(d.filter("split = 0"), FEATURES, "saving")
    pred = model.transform(P.impute_zero(d.filter("split = 1"), FEATURES))
    return spark.createDataFrame([("gbt_regressor", float(P.evaluate_rmse(pred, "saving")))],
                                 "model string, rmse double")


@register("M12_M6_random_forest_scores")
def m12(spark, sf_dir):
    d = _model_data(spark, sf_dir)
    model = P.train_classifier(d.filter("split = 0"), FEATURES, "rf", one_hot=False, vector_index_max=60,
                               maxDepth=6, maxBins=64)
    return P.score(model, d.filter("split = 1"), FEATURES, KEEP)


@register("M13_M20_gbt_early_stopping_importance")
def m13(spark, sf_dir):
    d = _model_data(spark, sf_dir).withColumn("isVal", F.col("split") == 1)
    model = P.train_classifier(d, FEATURES, "gbt", maxIter=1000, maxDepth=18, stepSize=0.2,
                               minInstancesPerNode=512, validationIndicatorCol="isVal", validationTol=0.01)
    scored = model.transform(P.impute_zero(d.limit(1), FEATURES))
    return P.importance_table(model, scored, "features", min_importance=0.01)


@register("M14_H9_fold_ensemble")
def m14(spark, sf_dir):
    d = _model_data(spark, sf_dir)
    train = stratified_folds(d.filter("split = 0"), "label", 2, ["routeCombKey", "searchDate", "price"])
    models = P.train_folds(train, FEATURES, "fold", 2, "gbt")
    return P.ensemble_score(models, d.filter("split = 1"), FEATURES, KEEP)


@register("M21_partial_dependence")
def m21(spark, sf_dir):
    d = _model_data(spark, sf_dir)
    model = P.train_classifier(d.filter("split = 0"), FEATURES, "logreg")
    grid = [float(x) for x in range(-100, 401, 25)]  # 21 points of lead time
    return P.partial_dependence(model, d.filter("split = 1"), "leadTime", grid, FEATURES)


@register("M25_M26_M27_persist_and_batch_score")
def m25(spark, sf_dir):
    d = _model_data(spark, sf_dir)
    model = P.train_classifier(d.filter("split = 0"), FEATURES, "logreg")
    path = stage_path(spark, "model")
    P.save_model(model, path)
    scored = P.score(P.load_model(path), d.filter("split = 1"), FEATURES, KEEP)
    out = stage_path(spark, "predictions")
    from fareflow.sinks import write_csv
    write_csv(scored.select("label", "prediction", "p1"), out)
    return spark.read.option("header", True).schema("label int, prediction double, p1 double").csv(out)
