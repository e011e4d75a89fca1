"""ML-dataflow queries (M1-M19) and the composite jobs Q2-Q7.

Training runs on the nation-grain feature table (seasons 1995-1998 train,
1999 validation, 2000 test).  Iterative/ML outputs have no SQL oracle
(rows-only check); M1 and the cluster description (P14) do.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from pitwall import constants as K
from pitwall.operators import aggregates as A
from pitwall.operators import attribution as AT
from pitwall.operators import clustering as CL
from pitwall.operators import filters as FL
from pitwall.operators import trees as TR
from pitwall.operators import windows as W
from pitwall.operators.bundle import load_bundle, save_bundle
from pitwall.operators.calibration import apply_calibration, calibrated_metrics, fit_linear_calibration
from pitwall.operators.joins import attach_labels, map_rare_join
from pitwall.operators.sampling import entry_id, top_k
from pitwall.oracles import features_ctes
from pitwall.plans.common import KEY_SQL, KEYS, RULE_CLUSTER_SQL, TEST, TRAIN, VAL, feat, q, round_doubles, rule_cluster
from pitwall.plans.features import features_memo
from pitwall.plans.registry import query
from pitwall.sources import files as IO

FEAT_SQL = features_ctes("nation")
K_CLUSTERS = 6
RESTARTS = 20
FEATURES = K.MINIMAL_FEATURES
PARAMS = TR.TreeParams(max_iter=30, step_size=0.1, max_depth=3, subsample=0.8, seed=42)
FOLDS = 5


# ------------------------------------------------------------ shared tables
def clustered(spark, sf):
    """Feature table + KMeans weather/tyre cluster (Q4 core), memoised per app."""
    def build():
        f = feat(spark, sf)
        labels, model, cost = CL.cluster_table(f, K_CLUSTERS, RESTARTS)
        lab = labels.select(*KEYS, "weather_tire_cluster")
        from pitwall.session import write_table
        return write_table(attach_labels(f, lab), "race_clustered", ["Season"]), model, cost
    return features_memo(("clustered", spark.sparkContext.applicationId, sf), build)


def ml_table(spark, sf):
    return clustered(spark, sf)[0]


def splits(spark, sf):
    t = ml_table(spark, sf)
    train = FL.drop_null_target(t.filter(F.col("Season").isin(list(TRAIN))))
    val = FL.drop_null_target(t.filter(F.col("Season") == VAL))
    test = FL.drop_null_target(t.filter(F.col("Season") == TEST))
    return train, val, test


def vectors(spark, sf, features=FEATURES):
    train, val, test = splits(spark, sf)
    med = TR.train_medians(train, features)
    vec = [TR.assemble(TR.impute(d, med, features), features) for d in (train, val, test)]
    return (*vec, med)


# ================================================================ clusters
_Z_SQL = FEAT_SQL + ", zin AS (SELECT " + KEY_SQL + ", " + ", ".join(
    [f"{q(c)}" for c in (*K.WEATHER_COLUMNS, *K.TYRES)] +
    ["sin(radians(COALESCE(WindDirection_deg, 0))) AS WindDir_sin",
     "cos(radians(COALESCE(WindDirection_deg, 0))) AS WindDir_cos"]) + " FROM feat) SELECT " + KEY_SQL + ", " + \
    ", ".join(f"round(({q(c)} - AVG({q(c)}) OVER ()) / CASE WHEN COALESCE(stddev_pop({q(c)}) OVER (), 0) = 0 "
              f"THEN 1 ELSE stddev_pop({q(c)}) OVER () END, 6) AS {q(c + '_z')}" for c in CL.CLUSTER_FEATURES) + \
    " FROM zin"


@query("M1_standardize", sql=_Z_SQL)
def m1(spark, sf):
    z = CL.standardize(CL.cluster_inputs(feat(spark, sf)), CL.CLUSTER_FEATURES)
    return round_doubles(z.select(*KEYS, *[F.col(f"`{c}_z`") for c in CL.CLUSTER_FEATURES]))


@query("M2_kmeans_clusters")
def m2(spark, sf):
    return ml_table(spark, sf).select(*KEYS, "weather_tire_cluster")


@query("M3_cluster_centres")
def m3(spark, sf):
    labelled = CL.cluster_inputs(ml_table(spark, sf))
    return round_doubles(CL.cluster_centres(labelled))


@query("M4_elbow_sweep")
def m4(spark, sf):
    inp = CL.cluster_inputs(feat(spark, sf))
    zc = [f"{c}_z" for c in CL.CLUSTER_FEATURES]
    vec = CL.assemble(CL.standardize(inp, CL.CLUSTER_FEATURES), zc)
    return CL.elbow(vec, range(2, 11), restarts=RESTARTS)


def _pca(spark, sf):
    t = CL.cluster_inputs(ml_table(spark, sf))
    zc = [f"{c}_z" for c in CL.CLUSTER_FEATURES]
    vec = CL.assemble(CL.standardize(t, CL.CLUSTER_FEATURES), zc)
    return CL.pca_2d(vec)[0]


@query("M5_pca_projection")
def m5(spark, sf):
    return round_doubles(_pca(spark, sf).select(*KEYS, "weather_tire_cluster", "pc1", "pc2"))


@query("A8_pca_cluster_centroids")
def a8(spark, sf):
    return round_doubles(CL.pca_centroids(_pca(spark, sf)))


@query("Q5_cluster_report")
def q5(spark, sf):
    return round_doubles(CL.cluster_report(ml_table(spark, sf)))


_DESC_COLS = (*K.WEATHER_COLUMNS, *K.TYRES)


@query("P14_cluster_description", sql=FEAT_SQL + f"""
, med AS (SELECT {RULE_CLUSTER_SQL} AS weather_tire_cluster, COUNT(*) AS n,
  {', '.join(f'median({q(c)}) AS {q(c)}' for c in _DESC_COLS)} FROM feat GROUP BY 1)
SELECT weather_tire_cluster, 'Cluster ' || CAST(weather_tire_cluster AS VARCHAR) || ': ' || CAST(n AS VARCHAR) || ' rows — '
  || CASE WHEN AirTemp_C >= 30 THEN 'hot' WHEN AirTemp_C >= 20 THEN 'warm' WHEN AirTemp_C >= 10 THEN 'mild' ELSE 'cool' END
  || ', ' || CASE WHEN "Humidity_%" >= 80 THEN 'very humid' WHEN "Humidity_%" >= 60 THEN 'humid'
                  WHEN "Humidity_%" >= 30 THEN 'moderate humidity' ELSE 'dry' END
  || ', dominant tyre: ' || CASE GREATEST(SOFT, MEDIUM, HARD, INTERMEDIATE, WET) WHEN SOFT THEN 'SOFT'
       WHEN MEDIUM THEN 'MEDIUM' WHEN HARD THEN 'HARD' WHEN INTERMEDIATE THEN 'INTERMEDIATE' ELSE 'WET' END AS description
FROM med""")
def p14(spark, sf):
    rep = CL.cluster_report(rule_cluster(feat(spark, sf)))
    return rep.select("weather_tire_cluster", "description")


@query("Q4_feature_table")
def q4(spark, sf):
    """Canonical table: points + prior form + clusters + rare-mapped categoricals."""
    t = ml_table(spark, sf).withColumn("Laps", F.col("Laps").cast("string"))
    rare = A.rare_categories(t, ["Laps", "Status", "TeamName"], 20)
    for c in ("Laps", "Status", "TeamName"):
        t = map_rare_join(t, rare, c)
    return round_doubles(FL.drop_helpers(t, (*K.DROP_ROLE, "first_order", "DriverRaw", "RainRaw")))


# =================================================================== trees
def base_model(spark, sf):
    """The single GBT on the training seasons, fitted once per application."""
    from pitwall.session import right_size
    return features_memo(("gbt", spark.sparkContext.applicationId, sf),
                         lambda: TR.fit_gbt(right_size(vectors(spark, sf)[0]), PARAMS))


@query("M6_gbt_fit_predict")
def m6(spark, sf):
    vtr, vva, _, _ = vectors(spark, sf)
    model = base_model(spark, sf)
    return round_doubles(TR.predict(model, vva).select(*KEYS, F.col(K.TARGET).alias("y_true"),
                                                       F.col("prediction").alias("y_pred")))


FORM_FEATURES = (*FEATURES, "DeviationFromAvg_s_last1", "DeviationFromAvg_s_last2", "DeviationFromAvg_s_last5")


@query("M6_gbt_missing_values")
def m6b(spark, sf):
    """Prior form is missing for a driver's first races: left to the trees."""
    train, val, _ = splits(spark, sf)
    (tr, names), (va, _) = TR.missing_as_values(train, FORM_FEATURES), TR.missing_as_values(val, FORM_FEATURES)
    model = TR.fit_gbt(TR.assemble(tr, names), PARAMS)
    return round_doubles(TR.predict(model, TR.assemble(va, names)).select(
        *KEYS, F.col(K.TARGET).alias("y_true"), F.col("prediction").alias("y_pred")))


@query("M7_score_saved_model")
def m7(spark, sf):
    """K4 + M7: persist the model, reload it, score the test season."""
    from pyspark.ml.regression import GBTRegressionModel
    from pitwall.session import ensure_checkpoint_dir
    import uuid
    vtr, _, vte, _ = vectors(spark, sf)
    model = base_model(spark, sf)
    path = f"{ensure_checkpoint_dir(spark)}/models/{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    loaded = GBTRegressionModel.load(path)
    return round_doubles(TR.predict(loaded, vte).select(*KEYS, F.col("prediction").alias("y_pred")))


@query("M8_early_stopping_curve")
def m8(spark, sf):
    vtr, vva, _, _ = vectors(spark, sf)
    model, rounds, curve = TR.early_stopped(vtr, vva, PARAMS, patience=20)
    rows = [(i + 1, float(c) ** 0.5, i + 1 == rounds) for i, c in enumerate(curve)]
    return spark.createDataFrame(rows, "iteration int, val_rmse double, chosen boolean")


@query("M9_random_search_validation")
def m9(spark, sf):
    vtr, vva, _, _ = vectors(spark, sf)
    trials = TR.draw_trials(20, 42, TR.SEARCH_SPACE)
    return TR.random_search_val(vtr, vva, trials, patience=20, parallelism=8)


def _cv_vectors(spark, sf):
    vtr, _, _, _ = vectors(spark, sf)
    from pitwall.operators.sampling import assign_folds
    return assign_folds(vtr.withColumn("_eid", entry_id()), F.col("_eid"), 3, 42)


def cv_trials(spark, sf):
    """The searched trials, once per application; the training run takes the best."""
    return features_memo(("trials", spark.sparkContext.applicationId, sf), lambda: TR.random_search_cv(
        _cv_vectors(spark, sf), TR.draw_trials(3, 7, TR.SEARCH_SPACE), k=3, patience=50))


@query("M10_random_search_cv")
def m10(spark, sf):
    return cv_trials(spark, sf)


@query("A13_best_cv_trial")
def a13b(spark, sf):
    return A.best_row(cv_trials(spark, sf), "cv_rmse", "trial")


@query("M12_cv_rounds_refit")
def m12(spark, sf):
    vcv = _cv_vectors(spark, sf).cache()
    curve = TR.cv_curve(vcv, PARAMS, k=3)
    rounds = TR.patience_argmin(curve, 50)
    model = TR.fit_gbt(vcv, replace(PARAMS, max_iter=rounds))
    _, vva, _, _ = vectors(spark, sf)
    pred = TR.predict(model, vva)
    return round_doubles(A.regression_metrics(pred, K.TARGET, "prediction")
                         .withColumn("rounds", F.lit(rounds)))


TRUTH = [*KEYS, K.TARGET]


def training_run(spark, sf):
    """The training run, once per application: lapped entries out (F4), the
    best trial's parameters (A13), out-of-fold ensemble (M13), calibrator
    fitted on validation (C1), everything stored as a bundle (K4).  Returns
    (places to look for the bundle, out-of-fold predictions)."""
    from pitwall.session import write_table

    def build():
        train, val, _ = (FL.drop_lapped(d, must_keep=True) for d in splits(spark, sf))
        best = A.best_row(cv_trials(spark, sf), "cv_rmse", "trial").first()
        params = TR.params_from_row(best) if best["trial"] else PARAMS
        ens, oof = TR.oof_ensemble(train, FEATURES, params, k=FOLDS, seed=42)
        ens.calibrator = fit_linear_calibration(ens.predict_mean(val, TRUTH), y=K.TARGET)
        root = IO.run_folder(spark, "bundles")
        save_bundle(ens, f"{root}/remove_lapped")
        return [f"{root}/remove_lapped", f"{root}/all_rows", f"{root}/single"], write_table(oof, "oof")

    return features_memo(("training", spark.sparkContext.applicationId, sf), build)


def _ensemble(spark, sf):
    """The stored ensemble, loaded from its bundle, and its out-of-fold rows."""
    places, oof = training_run(spark, sf)
    ens = features_memo(("bundle", spark.sparkContext.applicationId, sf), lambda: load_bundle(spark, places))
    return ens, oof


def _scored(spark, sf, which: int):
    """Raw and calibrated predictions with truth of a season split's entries that are not lapped."""
    ens, _ = _ensemble(spark, sf)
    rows = FL.drop_lapped(splits(spark, sf)[which], must_keep=True)
    return apply_calibration(ens.predict_mean(rows, TRUTH), ens.calibrator).withColumnRenamed(K.TARGET, "y_true")


@query("M13_oof_ensemble")
def m13(spark, sf):
    _, oof = _ensemble(spark, sf)
    return round_doubles(oof)


@query("M14_ensemble_average")
def m14(spark, sf):
    return round_doubles(_scored(spark, sf, 1).select(*KEYS, "y_pred"))


def wide_roles(df):
    """The categorical roles, all six, and the numeric ones that do not leak."""
    df = df.withColumns({"TeamId": F.lower("TeamName"), "ClassifiedPosition": F.when(
        F.col("Status") == "Retired", "R").otherwise(F.col("Position").cast("string"))})
    numeric = [c for c in FL.numeric_columns(df) if c in K.NUMERIC_ROLE and not FL.is_leakage(c)]
    return df, numeric, list(K.CATEGORICAL_ROLE)


@query("M15_categorical_pipeline")
def m15(spark, sf):
    """Rare values of the training seasons become OTHER (P11), all roles one
    named sparse matrix; validation must give the training matrix's names."""
    train, val, _ = splits(spark, sf)
    (train, num, cat), (val, _, _) = wide_roles(train), wide_roles(val)
    rare = A.rare_categories(train, cat, 20)
    for c in cat:
        train, val = map_rare_join(train, rare, c), map_rare_join(val, rare, c)
    med = TR.train_medians(train, num)
    tr, va = (TR.wide_inputs(TR.impute(d, med, num), num, cat, TRUTH) for d in (train, val))
    model = TR.categorical_pipeline(num, cat, PARAMS).fit(tr)
    pred = model.transform(va)
    FL.assert_contract(TR.matrix_names(pred), TR.matrix_names(model.transform(tr)), exact=True)
    return round_doubles(pred.select(*KEYS, F.col(K.TARGET).alias("y_true"), F.col("prediction").alias("y_pred")))


@query("M16_tree_contributions")
def m16(spark, sf):
    _, _, _, med = vectors(spark, sf)
    rows = TR.impute(ml_table(spark, sf), med, FEATURES)      # every entry of every season
    return round_doubles(AT.contributions(base_model(spark, sf), rows, FEATURES))


@query("M17_permutation_importance")
def m17(spark, sf):
    _, _, _, med = vectors(spark, sf)
    model = base_model(spark, sf)
    _, val, _ = splits(spark, sf)
    v = TR.impute(val, med, FEATURES).withColumn("_eid", entry_id())
    return round_doubles(AT.permutation_importance(model, v, FEATURES))


def _comparison_preds(spark, sf):
    vtr, vva, _, _ = vectors(spark, sf)
    preds = []
    models = {"gbt": base_model(spark, sf)}
    for name, est in TR.comparison_learners().items():
        models[name] = est.fit(vtr)
    for name, m in models.items():
        preds.append(TR.predict(m, vva).select(F.lit(name).alias("model"), *KEYS,
                                               F.col(K.TARGET).alias("y_true"), F.col("prediction").alias("y_pred")))
    out = preds[0]
    for p in preds[1:]:
        out = out.unionByName(p)
    return out, models


@query("M18_comparison_learners")
def m18(spark, sf):
    preds, _ = _comparison_preds(spark, sf)
    return round_doubles(A.metrics_by_model(preds))


@query("M19_model_param_table")
def m19(spark, sf):
    _, models = _comparison_preds(spark, sf)
    return TR.param_table(spark, models)


# ======================================================== composite jobs
@query("Q2_batch_scoring")
def q2(spark, sf):
    """Score the test season from the stored bundle: normalise, drop lapped,
    contract report (U4/V1/V6), mean over folds, the bundle's own calibrator;
    metrics calibrated vs uncalibrated where truth exists."""
    ens, _ = _ensemble(spark, sf)
    inp = _scoring_input(spark, sf)
    report = FL.contract_report(inp, ens.features, keep=[*TRUTH, "Status"]).agg(
        *[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("present", "missing", "extra")],
        F.sum(F.when(F.col("status") == "present", F.col("n_missing"))).alias("n_null_inputs"))
    scored = apply_calibration(ens.predict_mean(inp, TRUTH), ens.calibrator).withColumnRenamed(K.TARGET, "y_true")
    return round_doubles(calibrated_metrics(scored).crossJoin(F.broadcast(report)))   # one row


def _scoring_input(spark, sf):
    from pitwall.plans.features import normalize_minimal
    return FL.drop_lapped(normalize_minimal(ml_table(spark, sf).filter(F.col("Season") == TEST)), must_keep=True)


_U4_IN = (*KEYS, "GridPosition", "AvgQualiTime", "SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "races_prior_this_season",
          "Rain", "PointsProp", "Status", "Q1")


@query("U4_contract_report", sql=FEAT_SQL + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({'NULL' if i is None else i} AS INTEGER) AS position, '{s}' AS status, COUNT(*) AS n_rows, "
    f"COUNT(*) FILTER ({'TRUE' if s == 'missing' else c + ' IS NULL'}) AS n_missing FROM feat"
    for c, i, s in [(c, i, "present" if c in _U4_IN else "missing") for i, c in enumerate(FEATURES)]
    + [(c, None, "extra") for c in _U4_IN if c not in FEATURES and c not in KEYS]))
def u4(spark, sf):
    """The entry table against the model contract: two features lack, two columns are extra."""
    return FL.contract_report(feat(spark, sf).select(*_U4_IN), FEATURES, keep=KEYS)


@query("Q3_ensemble_training")
def q3(spark, sf):
    """Report of the stored training run, (section, name, measure, value):
    out-of-fold / validation / test / calibrated test metrics, both ensemble
    importances (A10) and the validation tertile table (A11)."""
    ens, oof = _ensemble(spark, sf)
    pv, pt = _scored(spark, sf, 1), _scored(spark, sf, 2)
    parts = [A.regression_metrics(oof, "y_true", "y_oof").withColumn("name", F.lit("oof")),
             A.regression_metrics(pv).withColumn("name", F.lit("val")),
             A.regression_metrics(pt).withColumn("name", F.lit("test")),
             A.regression_metrics(pt, p="y_pred_cal").withColumn("name", F.lit("test_calibrated"))]
    met = parts[0]
    for p in parts[1:]:
        met = met.unionByName(p)

    def long(df, section, measures):
        return df.select(F.lit(section).alias("section"), F.col("name").cast("string").alias("name"), *[
            F.col(m).cast("double").alias(m) for m in measures]).unpivot(
            ["section", "name"], list(measures), "measure", "value")

    imp = fold_importance(spark, sf).withColumnRenamed("feature", "name")
    tab = tertile_table(spark, sf).withColumnRenamed("t_true", "name")
    return round_doubles(long(met, "metrics", ("rmse", "mae", "r2", "n"))
                         .unionByName(long(imp, "importance", ("pooled", "per_fold_mean")))
                         .unionByName(long(tab, "tertiles", K.TERTILE_LABELS)))


def fold_importance(spark, sf):
    ens, oof = _ensemble(spark, sf)
    train = FL.drop_lapped(splits(spark, sf)[0]).join(oof.select(*KEYS, "fold"), KEYS)
    rows = ens.inputs(train, ["fold"])
    return AT.ensemble_importance(ens.models, rows, ens.features)


@query("A10_fold_importance")
def a10b(spark, sf):
    """Both variants over the fold models' TreeSHAP contributions."""
    return round_doubles(fold_importance(spark, sf))


def tertile_table(spark, sf):
    from pitwall.session import write_table
    p = write_table(_scored(spark, sf, 1).select("y_true", "y_pred"), "val_scored")
    lab = W.tertile_label(W.tertile_label(p, "y_true", "t_true"), "y_pred", "t_pred")
    return A.contingency(lab, "t_true", "t_pred", K.TERTILE_LABELS, row_name="t_true")


@query("A11_ensemble_tertile_crosstab")
def a11b(spark, sf):
    return tertile_table(spark, sf).withColumnRenamed("t_true", "row_0")


@query("Q6_model_comparison_report")
def q6(spark, sf):
    preds, models = _comparison_preds(spark, sf)
    met = A.metrics_by_model(preds)
    params = TR.param_table(spark, models).groupBy("model").agg(F.count(F.lit(1)).alias("n_params"))
    return round_doubles(met.join(params, "model", "left"))


@query("Q7_attribution_report")
def q7(spark, sf):
    """Global top-10 mean |contribution| (A9/T2) with every entry's ten largest
    contributions (W7/U3), feature values (J9), y_true and y_pred (J3), over
    all seasons."""
    from pitwall.session import write_table
    _, _, _, med = vectors(spark, sf)
    model = base_model(spark, sf)
    rows = TR.impute(FL.drop_null_target(ml_table(spark, sf)), med, FEATURES)
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in FEATURES])
    rows = TR.predict(model, TR.assemble(rows.withColumn("values", values), FEATURES)).withColumnRenamed("prediction", "y_pred")
    keep = [*KEYS, K.TARGET, "y_pred", "values"]
    contrib = write_table(AT.contribution_arrays(model, rows, FEATURES, keep), "contributions")
    glob = top_k(AT.mean_abs_contributions(contrib, FEATURES), 10, "mean_abs_shap", "feature")
    local = AT.top_contributions(contrib, FEATURES, keep, 10)
    value = F.element_at("values", F.array_position(F.lit(list(FEATURES)), F.col("feature")).cast("int"))
    local = local.select(*KEYS, F.col(K.TARGET).alias("y_true"), "y_pred", "rank", "feature", value.alias("value"), "contribution")
    return round_doubles(local.join(F.broadcast(glob), "feature", "left"))   # ten rows


M11_SPACE = {
    "step_size": (0.02, 0.05, 0.1, 0.2),
    "max_depth": (2, 3, 4, 6),
    "subsample": (0.6, 0.8, 1.0),
    "col_sample": ("all", "sqrt", "0.5"),
}


@query("M11_random_search_3fold")
def m11(spark, sf):
    """Randomised search, 3-fold CV, scored by (negated) mean RMSE."""
    trials = TR.draw_trials(3, 11, M11_SPACE)
    res = TR.random_search_cv(_cv_vectors(spark, sf), trials, k=3, patience=50)
    return res.withColumn("neg_rmse", -F.col("cv_rmse"))


@query("Q1_race_prediction_ensemble")
def q1_ensemble(spark, sf):
    """The interactive prediction flow on the test-season grids.

    grid (names P2, lap times P1/P3, text grid position P21) -> PointsProp
    from prior rounds with per-driver overrides (W1 + J8, default 0.5) ->
    race-day settings frame (F7 with tyre one-hot P16) -> normalisation
    (P6/P8) -> drop lapped (F4) -> mean of the stored bundle's fold models
    (S6/V4/M7/A12) -> its calibrator (C2) -> rank per race (W3) -> podium
    flag (T3).
    """
    from pitwall.functions import scalars as S
    from pitwall.operators.joins import override_values
    from pitwall.plans.features import normalize_minimal
    from pitwall.plans.q_relational import _race_settings

    t = ml_table(spark, sf)
    grid = t.filter(F.col("Season") == TEST).select(
        *KEYS, S.clean_driver_name("DriverRaw").alias("Driver"), F.col("TeamName").alias("Team"),
        S.grid_position(F.col("GridPosition").cast("string")).alias("GridPosition"),
        S.avg_quali_time("Q1", "Q2", "Q3").alias("AvgQualiTime"), "PointsProp", "Status",
        "weather_tire_cluster")
    # a user override for every fifth driver (e.g. set from the UI)
    overrides = grid.filter(F.pmod("DriverNumber", F.lit(5)) == 0).select(
        *KEYS, F.lit(K.DEFAULT_POINTS_PROP).alias("PointsProp"))
    grid = override_values(grid, overrides)
    frame = FL.settings_frame(grid.drop("Status"), _race_settings(t), on=["Season", "Round"])
    frame = frame.join(grid.select(*KEYS, "Status", F.col("weather_tire_cluster").alias("_wc")), KEYS) \
                 .withColumn("weather_tire_cluster", F.col("_wc")).drop("_wc")
    inp = FL.drop_lapped(normalize_minimal(frame))
    ens, _ = _ensemble(spark, sf)
    scored = apply_calibration(ens.predict_mean(inp, [*KEYS, "Driver", "Team", "GridPosition"]), ens.calibrator,
                               p="y_pred", out="PredictedDeviation")
    ranked = W.rank_predictions(scored, "PredictedDeviation")
    return round_doubles(ranked.select(*KEYS, "Driver", "Team", "GridPosition", "PredictedDeviation",
                                    "PredictedPosition", (F.col("PredictedPosition") <= 3).alias("podium")))
