"""ML properties and end-to-end jobs on the sf0.001 driver tables."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from pitwall import constants as K
from pitwall.operators import attribution as AT
from pitwall.operators import trees as TR
from pitwall.operators.calibration import apply_calibration, calibrated_metrics, fit_linear_calibration
from pitwall.plans import q_ml
from pitwall.plans.common import field, linear_preds
from helpers import SF_SMALL

SMALL = TR.TreeParams(max_iter=8, max_depth=3, subsample=0.8, seed=3)


@pytest.fixture(scope="module")
def data(spark):
    train, val, test = q_ml.splits(spark, SF_SMALL)
    return train, val, test


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"Season", "Round", "DriverNumber", "PredictedPosition"} <= set(df.columns)


def test_oof_covers_each_key_once(spark, data):
    train, _, _ = data
    ens, oof = TR.oof_ensemble(train, K.MINIMAL_FEATURES, SMALL, k=3)
    assert oof.count() == train.count()
    assert oof.groupBy(*K.KEY).count().filter("count > 1").count() == 0
    assert len(ens.models) == 3


def test_tree_shap_additivity(spark, data):
    train, val, _ = data
    med = TR.train_medians(train, K.MINIMAL_FEATURES)
    vtr = TR.assemble(TR.impute(train, med, K.MINIMAL_FEATURES), K.MINIMAL_FEATURES)
    model = TR.fit_gbt(vtr, SMALL)
    vi = TR.impute(val, med, K.MINIMAL_FEATURES)
    c = AT.contributions(model, vi, K.MINIMAL_FEATURES)
    tot = c.groupBy(*K.KEY).agg(F.sum("contribution").alias("s"))
    pred = TR.predict(model, TR.assemble(vi, K.MINIMAL_FEATURES)).select(*K.KEY, "prediction")
    worst = tot.join(pred, list(K.KEY)).agg(F.max(F.abs(F.col("s") - F.col("prediction")))).first()[0]
    assert worst < 1e-6


def test_save_load_same_predictions(spark, data, tmp_path):
    from pyspark.ml.regression import GBTRegressionModel
    train, val, _ = data
    med = TR.train_medians(train, K.MINIMAL_FEATURES)
    vtr = TR.assemble(TR.impute(train, med, K.MINIMAL_FEATURES), K.MINIMAL_FEATURES)
    vva = TR.assemble(TR.impute(val, med, K.MINIMAL_FEATURES), K.MINIMAL_FEATURES)
    m = TR.fit_gbt(vtr, SMALL)
    m.write().overwrite().save(str(tmp_path / "m"))
    m2 = GBTRegressionModel.load(str(tmp_path / "m"))
    a = TR.predict(m, vva).select(*K.KEY, F.col("prediction").alias("a"))
    b = TR.predict(m2, vva).select(*K.KEY, F.col("prediction").alias("b"))
    assert a.join(b, list(K.KEY)).filter(F.col("a") != F.col("b")).count() == 0


def test_patience_rule():
    assert TR.patience_argmin([5, 4, 3, 3.5, 3.6, 3.7, 1.0], 3) == 3
    assert TR.patience_argmin([5, 4, 3], 10) == 3


def test_calibration_does_not_hurt_validation(spark):
    p = linear_preds(field(spark, SF_SMALL)).filter(F.col("model") == "grid_linear")
    r = {row["type"]: row["rmse"] for row in calibrated_metrics(apply_calibration(p, fit_linear_calibration(p))).collect()}
    assert set(r) == {"calibrated", "uncalibrated"} and 0 < r["calibrated"] <= r["uncalibrated"] + 1e-9


@pytest.mark.parametrize("key", ["Q5_cluster_report", "M3_cluster_centres", "S4_html_results_table",
                                 "A21_artifact_groups", "P5_pit_stop_seconds"])
def test_registered_queries_run(spark, key):
    assert E.queries()[key](spark, SF_SMALL).count() > 0


def test_every_query_has_a_callable_and_sql_keys_subset():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 90
