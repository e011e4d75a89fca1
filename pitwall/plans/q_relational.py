"""Relational operator queries: filters (F), contracts (V), joins (J),
aggregates (A), windows (W), sorts/samples (T), reshaping (U), calibration (C).

All queries read the customer-grain race feature table (derived from the
whole orders/lineitem/customer/nation tables, and growing with them).  Double outputs are rounded
to 6 decimals on both sides.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pitwall import constants as K
from pitwall.functions import scalars as S
from pitwall.operators import aggregates as A
from pitwall.operators import filters as FL
from pitwall.operators import joins as J
from pitwall.operators import sampling as SM
from pitwall.operators import windows as W
from pitwall.operators.calibration import apply_calibration, calibrated_metrics, fit_linear_calibration
from pitwall.oracles import features_ctes
from pitwall.plans.common import (CONTRIB, CONTRIB_LONG_SQL, ENTRY_ID_SQL, KEY_SQL, KEYS,
                                  MEANS_SQL, MODELS_SQL, RULE_CLUSTER_SQL, TEST, TRAIN, TRAIN_SQL, VAL,
                                  VALUES_LONG_SQL, bq, contributions_long, contributions_wide,
                                  field as feat, hash_sql, linear_models, linear_preds, preds_sql, q, round_doubles,
                                  rule_cluster, with_entry_id)
from pitwall.plans.registry import query

FEAT = features_ctes("customer")
R = round_doubles


def _r(cols):
    return ", ".join(f"round({q(c)}, 6) AS {q(c)}" for c in cols)


# =========================================================== F: filters
@query("F1_season_split", sql=FEAT + f"""
SELECT {KEY_SQL}, CASE WHEN {TRAIN_SQL} THEN 'train' WHEN Season = {VAL} THEN 'val'
  WHEN Season = {TEST} THEN 'test' END AS split FROM feat""")
def f1(spark, sf):
    return FL.season_split(feat(spark, sf), TRAIN, (VAL,), (TEST,)).select(*KEYS, "split")


@query("F2_val_season_fallback", sql=FEAT + """
SELECT r.requested, COALESCE((SELECT MAX(Season) FROM feat WHERE Season = r.requested),
  (SELECT Season FROM (SELECT DISTINCT Season FROM feat) ORDER BY Season DESC LIMIT 1 OFFSET 1)) AS val_season
FROM (SELECT 1999 AS requested UNION ALL SELECT 2002) r""")
def f2(spark, sf):
    f = feat(spark, sf)
    return (FL.val_season_or_fallback(f, 1999).select(F.lit(1999).alias("requested"), "val_season")
            .unionByName(FL.val_season_or_fallback(f, 2002).select(F.lit(2002).alias("requested"), "val_season")))


@query("F3_drop_null_target", sql=FEAT + f"""
SELECT {KEY_SQL}, round(DeviationFromAvg_s_last1, 6) AS DeviationFromAvg_s_last1
FROM feat WHERE DeviationFromAvg_s_last1 IS NOT NULL""")
def f3(spark, sf):
    return R(FL.drop_null_target(feat(spark, sf), "DeviationFromAvg_s_last1")
             .select(*KEYS, "DeviationFromAvg_s_last1"))


@query("F4_drop_lapped", sql=FEAT + f"SELECT {KEY_SQL}, Status FROM feat WHERE Status IS DISTINCT FROM 'Lapped'")
def f4(spark, sf):
    return FL.drop_lapped(feat(spark, sf)).select(*KEYS, "Status")


@query("F5_feature_projection", sql=FEAT + f"SELECT {KEY_SQL}, {_r(K.WEATHER13_FEATURES)} FROM feat")
def f5(spark, sf):
    f = feat(spark, sf)
    return R(f.select(*KEYS, *[bq(c) for c in FL.project(f, K.WEATHER13_FEATURES).columns]))


_F6_DROP = ("DriverId", "first_order", "FinishTime_s", "ParsedTime_s", "Time", "DeltaFromAhead_s",
            "Position", "Points", "DriverRaw", "RainRaw", "Q1", "Q2", "Q3")
_F6_KEEP_DOUBLES = ("AirTemp_C", "TrackTemp_C", "Humidity_%", "Pressure_hPa", "WindSpeed_mps",
                    "WindDirection_deg", "SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET", "AvgQualiTime",
                    "races_prior_this_season", "PointsProp", "DeviationFromAvg_s", "DeviationFromAvg_s_last1",
                    "DeviationFromAvg_s_last2", "DeviationFromAvg_s_last5", "DeviationFromAvg_s_season_to_date")


@query("F6_drop_helper_columns", sql=FEAT + f"""
SELECT * EXCLUDE ({', '.join(_F6_DROP)}) REPLACE ({_r(_F6_KEEP_DOUBLES)}) FROM feat""")
def f6(spark, sf):
    return R(FL.drop_helpers(feat(spark, sf), _F6_DROP))


def _race_settings(f):
    """One row per race: the race-day settings of the app (weather, races
    prior, Rain, tyre choice = the race's dominant selectable tyre)."""
    tyre = S.argmax_name(K.TYRES)
    return f.select("Season", "Round", *[bq(c) for c in K.WEATHER_COLUMNS], "WindDirection_deg",
                    "races_prior_this_season", "Rain", tyre.alias("tire")).distinct() \
            .select("Season", "Round", *[bq(c) for c in K.WEATHER_COLUMNS], "WindDirection_deg",
                    "races_prior_this_season", "Rain",
                    *[S.tyre_flag("tire", t).alias(t) for t in K.SELECTABLE_TYRES],
                    F.lit(0).alias("INTERMEDIATE"), F.lit(0).alias("WET"))


_SETTINGS_SQL = f"""
settings AS (
  SELECT Season, Round, AirTemp_C, TrackTemp_C, "Humidity_%", Pressure_hPa, WindSpeed_mps, WindDirection_deg,
         races_prior_this_season, Rain, CAST(t = 'SOFT' AS INTEGER) AS SOFT, CAST(t = 'MEDIUM' AS INTEGER) AS MEDIUM,
         CAST(t = 'HARD' AS INTEGER) AS HARD, 0 AS INTERMEDIATE, 0 AS WET
  FROM (SELECT DISTINCT Season, Round, AirTemp_C, TrackTemp_C, "Humidity_%", Pressure_hPa, WindSpeed_mps,
          WindDirection_deg, races_prior_this_season, Rain,
          CASE GREATEST(SOFT, MEDIUM, HARD, INTERMEDIATE, WET) WHEN SOFT THEN 'SOFT' WHEN MEDIUM THEN 'MEDIUM'
            WHEN HARD THEN 'HARD' WHEN INTERMEDIATE THEN 'INTERMEDIATE' ELSE 'WET' END AS t FROM feat))"""


@query("F7_settings_frame", sql=FEAT + f""", {_SETTINGS_SQL}
SELECT g.Season, g.Round, g.DriverNumber, g.GridPosition, round(g.AvgQualiTime, 6) AS AvgQualiTime,
       0 AS weather_tire_cluster, {', '.join(f'round(s.{q(c)}, 6) AS {q(c)}' for c in K.WEATHER_COLUMNS)},
       round(s.WindDirection_deg, 6) AS WindDirection_deg, round(s.races_prior_this_season, 6) AS races_prior_this_season,
       s.Rain, g.Driver, g.TeamName AS Team, round(g.PointsProp, 6) AS PointsProp,
       s.SOFT, s.MEDIUM, s.HARD, s.INTERMEDIATE, s.WET
FROM feat g LEFT JOIN settings s ON s.Season = g.Season AND s.Round = g.Round WHERE g.Season = {TEST}""")
def f7(spark, sf):
    f = feat(spark, sf)
    grid = f.filter(F.col("Season") == TEST).select(
        *KEYS, "GridPosition", "AvgQualiTime", "Driver", F.col("TeamName").alias("Team"), "PointsProp")
    return R(FL.settings_frame(grid, _race_settings(f), on=["Season", "Round"]))


_F9_COLS = ("GridPosition", "Position", "Laps", "Points", "AvgQualiTime", "FinishTime_s", "ParsedTime_s",
            "DeltaFromAhead_s", "DeviationFromAvg_s", "DeviationFromAvg_s_last1", "PointsProp", "AirTemp_C", "Rain")


def _f9_sql():
    out = []
    for c in _F9_COLS:
        out.append(f"CAST(0.0 AS DOUBLE) AS {q(c)}" if FL.is_leakage(c) else
                   (f"round({q(c)}, 6) AS {q(c)}" if c in ("DeltaFromAhead_s", "PointsProp", "AirTemp_C", "Points")
                    else q(c)))
    return ", ".join(out)


@query("F9_leakage_mask", sql=FEAT + f"SELECT {KEY_SQL}, {_f9_sql()} FROM feat")
def f9(spark, sf):
    f = feat(spark, sf).select(*KEYS, *_F9_COLS)
    return R(FL.mask_leakage(f, keep=KEYS))


_F10_COLS = ("Season", "Round", "DriverNumber", "Position", "GridPosition", "Laps", "Points", "FinishTime_s",
             "ParsedTime_s", "AvgQualiTime", "DeltaFromAhead_s", "DeviationFromAvg_s", "DeviationFromAvg_s_last1",
             "PointsProp", "AirTemp_C", "Humidity_%", "SOFT", "races_prior_this_season")


@query("F10_summary_row_filter", sql=FEAT + ", m AS (SELECT " + ", ".join(
    f"AVG(CAST({q(c)} AS DOUBLE)) AS m{i}" for i, c in enumerate(_F10_COLS)) + " FROM feat), long AS (" +
    " UNION ALL ".join(f"SELECT '{c}' AS feature, AVG(ABS(CAST({q(c)} AS DOUBLE) - m{i})) AS mean_abs "
                       f"FROM feat CROSS JOIN m GROUP BY m{i}" for i, c in enumerate(_F10_COLS)) + """)
SELECT feature, round(mean_abs, 6) AS mean_abs FROM long
WHERE feature NOT IN ('num__DeviationFromAvg_s','DeviationFromAvg_s','ParsedTime_s','ParsedTime','Position',
  'DriverNumber','Laps','Unnamed: 0','Round')
  AND NOT (starts_with(feature, 'cat__Driver_') OR starts_with(feature, 'Driver__') OR starts_with(feature, 'cat__TeamName')
    OR starts_with(feature, 'TeamName__') OR starts_with(feature, 'cat__TeamId') OR starts_with(feature, 'TeamId__')
    OR starts_with(feature, 'cat__Team') OR starts_with(feature, 'Team__') OR starts_with(feature, 'ClassifiedPosition'))
  AND NOT contains(feature, 'DeviationFromAvg') AND NOT contains(lower(feature), 'time')""")
def f10(spark, sf):
    f = feat(spark, sf)
    means = F.broadcast(f.agg(*[F.avg(bq(c).cast("double")).alias(f"_m{i}") for i, c in enumerate(_F10_COLS)]))
    wide = f.crossJoin(means).agg(*[F.avg(F.abs(bq(c).cast("double") - F.col(f"_m{i}"))).alias(c)
                                    for i, c in enumerate(_F10_COLS)])
    long = wide.unpivot([], list(_F10_COLS), "feature", "mean_abs")
    return R(long.filter(FL.summary_name_filter("feature")))


@query("F11_head_preview", sql=FEAT + f"""
SELECT {KEY_SQL}, round(PointsProp, 6) AS PointsProp FROM feat ORDER BY {KEY_SQL} LIMIT 20""")
def f11(spark, sf):
    return R(FL.head(feat(spark, sf).select(*KEYS, "PointsProp"), 20, KEYS))


# ========================================================= V: contracts
@query("V2_fill_absent_from_medians", sql=FEAT + f"""
, med AS (SELECT median(AvgQualiTime) AS m1, median(races_prior_this_season) AS m2 FROM feat WHERE {TRAIN_SQL})
SELECT {KEY_SQL}, GridPosition, round(COALESCE(m1, 0.0), 6) AS AvgQualiTime,
       round(COALESCE(m2, 0.0), 6) AS races_prior_this_season, CAST(0.0 AS DOUBLE) AS weather_tire_cluster
FROM feat CROSS JOIN med WHERE Season = {TEST}""")
def v2(spark, sf):
    f = feat(spark, sf)
    ref = f.filter(F.col("Season").isin(list(TRAIN)))
    inp = f.filter(F.col("Season") == TEST).select(*KEYS, "GridPosition")
    out = FL.fill_absent_from_medians(inp, ref, ("GridPosition", "AvgQualiTime", "races_prior_this_season",
                                                 "weather_tire_cluster"))
    return R(out.select(*KEYS, "GridPosition", "AvgQualiTime", "races_prior_this_season", "weather_tire_cluster"))


@query("V3_align_to_contract", sql=FEAT + f"""
SELECT {KEY_SQL}, CAST(GridPosition AS DOUBLE) AS GridPosition, round(AvgQualiTime, 6) AS AvgQualiTime,
       CAST(0.0 AS DOUBLE) AS weather_tire_cluster, {_r(K.TYRES)}, round(races_prior_this_season, 6) AS races_prior_this_season,
       CAST(Rain AS DOUBLE) AS Rain, round(PointsProp, 6) AS PointsProp FROM feat""")
def v3(spark, sf):
    return R(FL.align_to_contract(feat(spark, sf), K.MINIMAL_FEATURES, keep=KEYS))


# ============================================================= J: joins
@query("J1_attach_cluster_labels", sql=FEAT + f"""
, labels AS (SELECT {KEY_SQL}, {RULE_CLUSTER_SQL} AS weather_tire_cluster FROM feat)
SELECT f.Season, f.Round, f.DriverNumber, l.weather_tire_cluster
FROM feat f LEFT JOIN labels l USING (Season, Round, DriverNumber)""")
def j1(spark, sf):
    f = feat(spark, sf)
    labels = rule_cluster(f).select(*KEYS, "weather_tire_cluster")
    return J.attach_labels(f.select(*KEYS), labels)


@query("J2_fallback_key_join", sql=FEAT + f"""
SELECT l.Season, l.Round, l.DriverNumber, l.Points, round(r.PointsProp, 6) AS PointsProp
FROM (SELECT {KEY_SQL}, Points FROM feat) l
LEFT JOIN (SELECT {KEY_SQL}, PointsProp FROM feat) r USING (DriverNumber, Season, Round)""")
def j2(spark, sf):
    f = feat(spark, sf)
    left = f.select(*KEYS, "Points")
    right = f.select(*KEYS, "PointsProp")
    return R(J.fallback_join(left, right).select(*KEYS, "Points", "PointsProp"))


@query("J3_truth_prediction_join", sql=FEAT + f""", {MODELS_SQL}, {preds_sql()}
SELECT f.Season, f.Round, f.DriverNumber, round(f.DeviationFromAvg_s, 6) AS y_true, round(p.y_pred, 6) AS y_pred
FROM feat f JOIN (SELECT * FROM preds WHERE model = 'grid_linear') p USING (Season, Round, DriverNumber)
WHERE f.DeviationFromAvg_s IS NOT NULL""")
def j3(spark, sf):
    f = feat(spark, sf)
    p = linear_preds(f).filter(F.col("model") == "grid_linear").select(*KEYS, "y_pred")
    return R(J.truth_pred_join(f, p).select(*KEYS, "y_true", "y_pred"))


@query("J4_prediction_grid_attach", sql=FEAT + f""", {MODELS_SQL}, {preds_sql(None)}
SELECT p.Season, p.Round, p.DriverNumber, f.Driver, round(p.y_pred, 6) AS y_pred
FROM (SELECT * FROM preds WHERE model = 'grid_linear') p JOIN feat f USING (Season, Round, DriverNumber)""")
def j4(spark, sf):
    f = feat(spark, sf)
    p = linear_preds(f, None).filter(F.col("model") == "grid_linear").select(*KEYS, "y_pred")
    return R(p.join(f.select(*KEYS, "Driver"), KEYS).select(*KEYS, "Driver", "y_pred"))


@query("J5_rare_value_semi_join", sql=FEAT + f"""
, rare AS (SELECT v FROM (SELECT COALESCE(CAST(Laps AS VARCHAR), 'missing') AS v FROM feat) GROUP BY v HAVING COUNT(*) < 20)
SELECT {KEY_SQL}, Laps FROM feat WHERE COALESCE(CAST(Laps AS VARCHAR), 'missing') IN (SELECT v FROM rare)""")
def j5(spark, sf):
    f = feat(spark, sf)
    rare = A.rare_categories(f.withColumn("Laps", F.col("Laps").cast("string")), ["Laps"], 20)
    return J.in_rare(f, rare, "Laps").select(*KEYS, "Laps")


def _metrics_sql(pred_cte="preds", group="model", where=""):
    return f"""SELECT {group}, round(sqrt(AVG((y_true - y_pred) * (y_true - y_pred))), 6) AS rmse,
       round(AVG(ABS(y_true - y_pred)), 6) AS mae, round(AVG((y_true - y_pred) * (y_true - y_pred)), 6) AS mse,
       round(CASE WHEN SUM((y_true - ybar) * (y_true - ybar)) > 0
             THEN 1 - SUM((y_true - y_pred) * (y_true - y_pred)) / SUM((y_true - ybar) * (y_true - ybar))
             WHEN SUM((y_true - y_pred) * (y_true - y_pred)) = 0 THEN 1.0 ELSE 0.0 END, 6) AS r2,
       COUNT(*) AS n
FROM (SELECT *, AVG(y_true) OVER (PARTITION BY {group}) AS ybar FROM {pred_cte}
      WHERE y_true IS NOT NULL AND y_pred IS NOT NULL {where}) GROUP BY {group}"""


@query("J6_model_artifact_match", sql=FEAT + f""", {MODELS_SQL}, {preds_sql()}, met AS ({_metrics_sql()})
SELECT m.model, m.feature, round(m.intercept, 6) AS intercept, round(m.slope, 6) AS slope, met.rmse
FROM models m LEFT JOIN met USING (model)""")
def j6(spark, sf):
    f = feat(spark, sf)
    models = linear_models(f)
    met = A.regression_metrics(linear_preds(f, models=models), group=["model"]).select("model", "rmse")
    return R(J.match_artifacts(models, met))


@query("J8_override_join", sql=FEAT + f"""
, ov AS (SELECT {KEY_SQL}, round(1 - PointsProp, 2) AS pp FROM feat WHERE DriverNumber % 5 = 0)
SELECT f.Season, f.Round, f.DriverNumber, round(COALESCE(ov.pp, f.PointsProp, 0.5), 6) AS PointsProp
FROM feat f LEFT JOIN ov USING (Season, Round, DriverNumber)""")
def j8(spark, sf):
    f = feat(spark, sf)
    ov = f.filter(F.pmod("DriverNumber", F.lit(5)) == 0).select(
        *KEYS, F.round(1 - F.col("PointsProp"), 2).alias("PointsProp"))
    return R(J.override_values(f.select(*KEYS, "PointsProp"), ov))


@query("J9_dependence_table", sql=FEAT + f""", {MEANS_SQL}, {CONTRIB_LONG_SQL}, {VALUES_LONG_SQL}
SELECT v.Season, v.Round, v.DriverNumber, v.feature, round(v.value, 6) AS value,
       round(c.contribution, 6) AS contribution
FROM vals v JOIN contrib c USING (Season, Round, DriverNumber, feature)""")
def j9(spark, sf):
    f = feat(spark, sf)
    vals = f.select(*KEYS, *[bq(c).cast("double").alias(c) for c in CONTRIB])
    return R(J.dependence_table(vals, contributions_wide(f), KEYS, CONTRIB))


# ======================================================== A: aggregates
@query("A1_column_medians", sql=FEAT + f"""
SELECT {', '.join(f'round(median(CAST({q(c)} AS DOUBLE)), 6) AS {q(c)}' for c in K.WEATHER13_FEATURES)}
FROM feat WHERE {TRAIN_SQL}""")
def a1(spark, sf):
    f = feat(spark, sf).filter(F.col("Season").isin(list(TRAIN)))
    return R(A.column_medians(f, K.WEATHER13_FEATURES))


@query("A2_regression_metrics", sql=FEAT + f""", {MODELS_SQL}, {preds_sql()}
SELECT rmse, mae, mse, r2, n FROM ({_metrics_sql(where="AND model = 'grid_linear'")})""")
def a2(spark, sf):
    f = feat(spark, sf)
    p = linear_preds(f).filter(F.col("model") == "grid_linear")
    return R(A.regression_metrics(p))


@query("A3_metrics_by_model", sql=FEAT + f""", {MODELS_SQL}, {preds_sql()}
SELECT model, rmse, mae, mse, r2, n AS rows FROM ({_metrics_sql()})""")
def a3(spark, sf):
    f = feat(spark, sf)
    return R(A.metrics_by_model(linear_preds(f)))


_A5_COLS = (*K.WEATHER_COLUMNS, *K.TYRES)


@query("A5_cluster_medians", sql=FEAT + f"""
SELECT {RULE_CLUSTER_SQL} AS weather_tire_cluster, COUNT(*) AS n,
       {', '.join(f'round(median({q(c)}), 6) AS {q(c)}' for c in _A5_COLS)}
FROM feat GROUP BY 1""")
def a5(spark, sf):
    return R(A.group_medians(rule_cluster(feat(spark, sf)), "weather_tire_cluster", _A5_COLS))


_A6_COLS = ("GridPosition", "AvgQualiTime", *K.TYRES, "races_prior_this_season", "Rain", "PointsProp")


@query("A6_cluster_feature_means", sql=FEAT + f"""
SELECT {RULE_CLUSTER_SQL} AS weather_tire_cluster,
       {', '.join(f'round(AVG(COALESCE(TRY_CAST({q(c)} AS DOUBLE), 0.0)), 6) AS {q(c)}' for c in _A6_COLS)}
FROM feat GROUP BY 1""")
def a6(spark, sf):
    return R(A.group_means_coerced(rule_cluster(feat(spark, sf)), "weather_tire_cluster", _A6_COLS))


@query("A7_cluster_time_summary", sql=FEAT + f"""
SELECT {RULE_CLUSTER_SQL} AS weather_tire_cluster, COUNT(FinishTime_s) AS count, round(AVG(FinishTime_s), 6) AS mean,
       round(median(FinishTime_s), 6) AS median, round(stddev_samp(FinishTime_s), 6) AS std,
       round(MIN(FinishTime_s), 6) AS min, round(MAX(FinishTime_s), 6) AS max
FROM feat GROUP BY 1""")
def a7(spark, sf):
    return R(A.group_summary(rule_cluster(feat(spark, sf)), "weather_tire_cluster", "FinishTime_s"))


@query("A9_mean_abs_contribution", sql=FEAT + f""", {MEANS_SQL}, {CONTRIB_LONG_SQL}
SELECT feature, round(AVG(ABS(contribution)), 6) AS mean_abs_shap FROM contrib GROUP BY feature""")
def a9(spark, sf):
    return R(A.mean_abs_by_feature(contributions_long(feat(spark, sf))))


@query("A10_ensemble_importance", sql=FEAT + f""", {MEANS_SQL}, {CONTRIB_LONG_SQL}
SELECT feature, round(AVG(m), 6) AS mean_abs_shap FROM (
  SELECT {hash_sql(ENTRY_ID_SQL, 5, 42)} AS fold, feature, AVG(ABS(contribution)) AS m
  FROM contrib GROUP BY 1, 2) GROUP BY feature""")
def a10(spark, sf):
    long = SM.assign_folds(with_entry_id(contributions_long(feat(spark, sf))), F.col("entry_id"), 5, 42)
    return R(A.ensemble_importance(long))


_TERT_SQL = """CASE WHEN {v} IS NULL THEN NULL WHEN {v} <= e1 THEN 'low' WHEN {v} <= e2 THEN 'med' ELSE 'high' END"""


@query("A11_tertile_crosstab", sql=FEAT + f""", {MODELS_SQL}, {preds_sql()},
p AS (SELECT * FROM preds WHERE model = 'grid_linear'),
et AS (SELECT quantile_cont(y_true, 1/3) AS e1, quantile_cont(y_true, 2/3) AS e2 FROM p),
ep AS (SELECT quantile_cont(y_pred, 1/3) AS e1, quantile_cont(y_pred, 2/3) AS e2 FROM p),
lab AS (SELECT {_TERT_SQL.format(v='y_true')} AS t_true FROM p CROSS JOIN et),
lab2 AS (SELECT p.Season, p.Round, p.DriverNumber,
  (SELECT {_TERT_SQL.format(v='p.y_true')} FROM et) AS t_true,
  (SELECT {_TERT_SQL.format(v='p.y_pred')} FROM ep) AS t_pred FROM p)
SELECT t_true AS row_0, COUNT(*) FILTER (WHERE t_pred = 'low') AS low,
       COUNT(*) FILTER (WHERE t_pred = 'med') AS med, COUNT(*) FILTER (WHERE t_pred = 'high') AS high
FROM lab2 GROUP BY t_true""")
def a11(spark, sf):
    p = linear_preds(feat(spark, sf)).filter(F.col("model") == "grid_linear")
    lab = W.tertile_label(W.tertile_label(p, "y_true", "t_true"), "y_pred", "t_pred")
    return A.contingency(lab, "t_true", "t_pred", K.TERTILE_LABELS)


def _fold_models(f, k=5, seed=42):
    """Leave-one-fold-out linear fits from per-fold sufficient statistics:
    one aggregation pass, no k-fold duplication of the training rows."""
    tr = SM.assign_folds(with_entry_id(f.filter(F.col("Season").isin(list(TRAIN))
                                                & F.col(K.TARGET).isNotNull())), F.col("entry_id"), k, seed)
    x, y = F.col("GridPosition").cast("double"), F.col(K.TARGET)
    ok = x.isNotNull() & y.isNotNull()
    stats = tr.filter(ok).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
        F.sum(x * y).alias("sxy"), F.sum(x * x).alias("sxx"))
    tot = stats.agg(*[F.sum(c).alias(f"t_{c}") for c in ("n", "sx", "sy", "sxy", "sxx")])
    m = stats.crossJoin(F.broadcast(tot)).select(
        "fold", *[(F.col(f"t_{c}") - F.col(c)).alias(c) for c in ("n", "sx", "sy", "sxy", "sxx")])
    slope = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.col("n") * F.col("sxx") - F.col("sx") ** 2)
    return m.select("fold", slope.alias("slope"),
                    ((F.col("sy") - slope * F.col("sx")) / F.col("n")).alias("intercept"))


def _fold_preds(f):
    models = F.broadcast(_fold_models(f))   # exactly k rows
    rows = f.filter(F.col("Season") == VAL).select(*KEYS, "GridPosition")
    return rows.crossJoin(models).select(
        *KEYS, "fold", (F.col("intercept") + F.col("slope") * F.col("GridPosition")).alias("prediction"))


_FOLD_SQL = f"""
tr AS (SELECT *, CAST({hash_sql(ENTRY_ID_SQL, 5, 42)} AS INTEGER) AS fold FROM feat
       WHERE {TRAIN_SQL} AND DeviationFromAvg_s IS NOT NULL),
fm AS (SELECT k.fold, regr_intercept(t.DeviationFromAvg_s, t.GridPosition) AS intercept,
              regr_slope(t.DeviationFromAvg_s, t.GridPosition) AS slope
       FROM (SELECT DISTINCT fold FROM tr) k JOIN tr t ON t.fold <> k.fold GROUP BY k.fold),
fp AS (SELECT f.Season, f.Round, f.DriverNumber, fm.fold, fm.intercept + fm.slope * f.GridPosition AS prediction
       FROM feat f CROSS JOIN fm WHERE f.Season = {VAL})"""


@query("U1_union_fold_predictions", sql=FEAT + f", {_FOLD_SQL} SELECT {KEY_SQL}, fold, round(prediction, 6) AS prediction FROM fp")
def u1(spark, sf):
    return R(_fold_preds(feat(spark, sf)))


@query("A12_fold_mean_prediction", sql=FEAT + f", {_FOLD_SQL} SELECT {KEY_SQL}, round(AVG(prediction), 6) AS y_pred FROM fp GROUP BY {KEY_SQL}")
def a12(spark, sf):
    return R(A.mean_over_folds(_fold_preds(feat(spark, sf)), KEYS))


_TRIAL_FEATURES = ("GridPosition", "AvgQualiTime", "PointsProp", "AirTemp_C", "Humidity_%", "races_prior_this_season")


def _trials(f):
    """A search over single-feature linear models: fit all trials in one
    training pass, score all on validation in one pass."""
    train = f.filter(F.col("Season").isin(list(TRAIN)) & F.col(K.TARGET).isNotNull())
    y = F.col(K.TARGET)
    fits = train.agg(*[e for i, c in enumerate(_TRIAL_FEATURES) for e in (
        F.regr_intercept(y, bq(c).cast("double")).alias(f"a{i}"), F.regr_slope(y, bq(c).cast("double")).alias(f"b{i}"))])
    trials = fits.select(F.explode(F.array(*[F.struct(
        F.lit(i + 1).alias("trial"), F.lit(c).alias("feature"),
        F.struct(F.col(f"a{i}").alias("intercept"), F.col(f"b{i}").alias("slope")).alias("params"))
        for i, c in enumerate(_TRIAL_FEATURES)])).alias("_t")).select("_t.*")
    val = f.filter(F.col("Season") == VAL)
    xv = None
    for c in _TRIAL_FEATURES:
        v = bq(c).cast("double")
        xv = F.when(F.col("feature") == c, v) if xv is None else xv.when(F.col("feature") == c, v)
    scored = val.crossJoin(F.broadcast(trials)).select(
        "trial", y.alias("y_true"), (F.col("params.intercept") + F.col("params.slope") * xv).alias("y_pred"))
    rmse = A.regression_metrics(scored, group=["trial"]).select("trial", F.col("rmse").alias("val_rmse"))
    return trials.join(rmse, "trial", "left")


_TRIALS_SQL = "fits AS (" + " UNION ALL ".join(
    f"SELECT {i + 1} AS trial, '{c}' AS feature, regr_intercept(DeviationFromAvg_s, {q(c)}) AS intercept, "
    f"regr_slope(DeviationFromAvg_s, {q(c)}) AS slope FROM feat WHERE {TRAIN_SQL} AND DeviationFromAvg_s IS NOT NULL"
    for i, c in enumerate(_TRIAL_FEATURES)) + "), scored AS (" + " UNION ALL ".join(
    f"SELECT {i + 1} AS trial, DeviationFromAvg_s AS y_true, intercept + slope * CAST({q(c)} AS DOUBLE) AS y_pred "
    f"FROM feat CROSS JOIN (SELECT * FROM fits WHERE trial = {i + 1}) WHERE Season = {VAL}"
    for i, c in enumerate(_TRIAL_FEATURES)) + """), trials AS (
SELECT f.trial, f.feature, f.intercept, f.slope, s.val_rmse FROM fits f LEFT JOIN (
  SELECT trial, sqrt(AVG((y_true - y_pred) * (y_true - y_pred))) AS val_rmse FROM scored
  WHERE y_true IS NOT NULL AND y_pred IS NOT NULL GROUP BY trial) s USING (trial))"""


@query("A13_best_trial", sql=FEAT + f""", {_TRIALS_SQL}
SELECT trial, feature, round(intercept, 6) AS intercept, round(slope, 6) AS slope, round(val_rmse, 6) AS val_rmse
FROM trials WHERE val_rmse IS NOT NULL ORDER BY val_rmse, trial LIMIT 1""")
def a13(spark, sf):
    best = A.best_row(_trials(feat(spark, sf)), "val_rmse", "trial")
    return R(SM.flatten_struct(best, "params", keep=["trial", "feature"]).join(
        best.select("trial", "val_rmse"), "trial"))


@query("U5_flatten_trial_params", sql=FEAT + f""", {_TRIALS_SQL}
SELECT trial, feature, round(intercept, 6) AS intercept, round(slope, 6) AS slope, round(val_rmse, 6) AS val_rmse FROM trials""")
def u5(spark, sf):
    t = _trials(feat(spark, sf))
    return R(SM.flatten_struct(t, "params", keep=["trial", "feature", "val_rmse"]))


_A15_COLS = ("Status", "TeamName", "Q1", "RainRaw", "Laps")


@query("A15_distinct_and_nonnull_counts", sql=FEAT + "SELECT " + ", ".join(
    f"COUNT(DISTINCT {c}) AS {c}__distinct" for c in _A15_COLS) + ", " + ", ".join(
    f"COUNT({c}) AS {c}__nonnull" for c in _A15_COLS) + " FROM feat")
def a15(spark, sf):
    return A.distinct_and_counts(feat(spark, sf), _A15_COLS)


_RESID_SQL = "res AS (SELECT y_true - y_pred AS resid FROM preds WHERE model = 'grid_linear' AND y_true IS NOT NULL AND y_pred IS NOT NULL)"


def _resid(spark, sf):
    p = linear_preds(feat(spark, sf)).filter(F.col("model") == "grid_linear")
    return p.select((F.col("y_true") - F.col("y_pred")).alias("resid")).filter(F.col("resid").isNotNull())


@query("A17_residual_histogram", sql=FEAT + f""", {MODELS_SQL}, {preds_sql()}, {_RESID_SQL},
ext AS (SELECT MIN(resid) AS lo, MAX(resid) AS hi FROM res),
b AS (SELECT LEAST(40, CAST(floor((resid - lo) / ((hi - lo) / 40)) AS BIGINT) + 1) AS bin, lo, (hi - lo) / 40 AS w
      FROM res CROSS JOIN ext)
SELECT bin, round(lo + (bin - 1) * w, 6) AS bin_lo, round(lo + bin * w, 6) AS bin_hi, COUNT(*) AS count
FROM b GROUP BY bin, lo, w""")
def a17(spark, sf):
    return R(A.histogram(_resid(spark, sf), "resid", 40))


@query("A18_value_extent", sql=FEAT + f""", {MODELS_SQL}, {preds_sql()}
SELECT round(LEAST(MIN(y_true), MIN(y_pred)), 6) AS lo, round(GREATEST(MAX(y_true), MAX(y_pred)), 6) AS hi
FROM preds WHERE model = 'grid_linear'""")
def a18(spark, sf):
    p = linear_preds(feat(spark, sf)).filter(F.col("model") == "grid_linear")
    return R(A.value_extent(p, "y_true", "y_pred"))


@query("A19_residual_population_std", sql=FEAT + f""", {MODELS_SQL}, {preds_sql()}, {_RESID_SQL}
SELECT round(stddev_pop(resid), 6) AS sigma FROM res""")
def a19(spark, sf):
    return R(A.population_std(_resid(spark, sf), "resid"))


@query("P15_residual_bins", sql=FEAT + f""", {MODELS_SQL}, {preds_sql()}, {_RESID_SQL},
sd AS (SELECT stddev_pop(resid) AS s FROM res)
SELECT CASE WHEN resid <= -s THEN 'overperform' WHEN resid <= s THEN 'close' ELSE 'underperform' END AS bin,
       COUNT(*) AS count FROM res CROSS JOIN sd GROUP BY 1""")
def p15(spark, sf):
    r = _resid(spark, sf)
    sigma = F.broadcast(A.population_std(r, "resid"))   # 1 row
    return (r.crossJoin(sigma).groupBy(S.residual_bin("resid", "sigma").alias("bin"))
             .agg(F.count(F.lit(1)).alias("count")))


@query("A21_artifact_groups", sql=FEAT + f""", {MODELS_SQL}, {preds_sql()},
top AS (SELECT model, row_number() OVER (PARTITION BY model ORDER BY ABS(y_true - y_pred) DESC, {KEY_SQL}) - 1 AS r
        FROM preds WHERE y_true IS NOT NULL AND y_pred IS NOT NULL QUALIFY r < 5),
stems AS (SELECT 'shap_local_' || model || '_row' || CAST(r AS VARCHAR) AS stem FROM top
          UNION ALL SELECT DISTINCT 'shap_local_' || model FROM preds)
SELECT regexp_extract(stem, '^shap_local_(.+?)(?:_row(\\d+))?$', 1) AS model,
       list_sort(list(COALESCE(CAST(NULLIF(regexp_extract(stem, '^shap_local_(.+?)(?:_row(\\d+))?$', 2), '') AS INTEGER), 0))) AS rows
FROM stems GROUP BY 1""")
def a21(spark, sf):
    p = linear_preds(feat(spark, sf)).filter(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull())
    w = Window.partitionBy("model").orderBy(F.abs(F.col("y_true") - F.col("y_pred")).desc(), *KEYS)
    # filtered on the rank itself: each task keeps five rows per model before the shuffle
    top = p.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= 5).withColumn("_r", F.col("_r") - 1)
    stems = (top.select(F.concat(F.lit("shap_local_"), "model", F.lit("_row"), F.col("_r").cast("string")).alias("stem"))
             .unionByName(p.select(F.concat(F.lit("shap_local_"), "model").alias("stem")).distinct()))
    pat = r"^shap_local_(.+?)(?:_row(\d+))?$"
    row = F.coalesce(F.nullif(F.regexp_extract("stem", pat, 2), F.lit("")).cast("int"), F.lit(0))
    return (stems.groupBy(F.regexp_extract("stem", pat, 1).alias("model"))
                 .agg(F.sort_array(F.collect_list(row)).alias("rows")))


# =========================================================== W: windows
@query("W1_points_prop", sql=FEAT + f"""
SELECT {KEY_SQL}, Points, round(races_prior_this_season, 6) AS races_prior_this_season,
       round(PointsProp, 6) AS PointsProp FROM feat""")
def w1(spark, sf):
    return R(feat(spark, sf).select(*KEYS, "Points", "races_prior_this_season", "PointsProp"))


@query("W2_races_prior", sql=FEAT + f"""
SELECT {KEY_SQL}, races_prior_this_season,
       COUNT(*) OVER (PARTITION BY Season, DriverId ORDER BY Round, DriverNumber
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS races_prior_counted FROM feat""")
def w2(spark, sf):
    f = W.races_prior_counted(feat(spark, sf))
    return R(f.select(*KEYS, "races_prior_this_season", "races_prior_counted"))


_RANK_SQL = f""", {MODELS_SQL}, {preds_sql(None)},
rk AS (SELECT {KEY_SQL}, y_pred, row_number() OVER (PARTITION BY Season, Round ORDER BY y_pred NULLS LAST, DriverNumber)
         AS PredictedPosition FROM preds WHERE model = 'grid_linear')"""


def _ranked(spark, sf):
    p = linear_preds(feat(spark, sf), None).filter(F.col("model") == "grid_linear").select(*KEYS, "y_pred")
    return W.rank_predictions(p, "y_pred")


@query("W3_rank_predictions", sql=FEAT + _RANK_SQL + f" SELECT {KEY_SQL}, round(y_pred, 6) AS y_pred, PredictedPosition FROM rk")
def w3(spark, sf):
    return R(_ranked(spark, sf))


@query("T3_podium", sql=FEAT + _RANK_SQL + f" SELECT {KEY_SQL}, round(y_pred, 6) AS y_pred, PredictedPosition FROM rk WHERE PredictedPosition <= 3")
def t3(spark, sf):
    return R(W.podium(_ranked(spark, sf)))


_FORM = ("DeviationFromAvg_s_last1", "DeviationFromAvg_s_last2", "DeviationFromAvg_s_last5",
         "DeviationFromAvg_s_season_to_date")


@query("W4_prior_form", sql=FEAT + f"SELECT {KEY_SQL}, {_r(_FORM)} FROM feat")
def w4(spark, sf):
    return R(feat(spark, sf).select(*KEYS, *_FORM))


@query("W5_race_targets", sql=FEAT + f"SELECT {KEY_SQL}, {_r(('DeviationFromAvg_s', 'DeltaFromAhead_s'))} FROM feat")
def w5(spark, sf):
    return R(feat(spark, sf).select(*KEYS, "DeviationFromAvg_s", "DeltaFromAhead_s"))


@query("W6_tertile_labels", sql=FEAT + f"""
, e AS (SELECT quantile_cont(FinishTime_s, 1/3) AS e1, quantile_cont(FinishTime_s, 2/3) AS e2 FROM feat)
SELECT {KEY_SQL}, {_TERT_SQL.format(v='FinishTime_s')} AS tertile FROM feat CROSS JOIN e""")
def w6(spark, sf):
    return W.tertile_label(feat(spark, sf), "FinishTime_s", "tertile").select(*KEYS, "tertile")


@query("W7_top_k_contributions", sql=FEAT + f""", {MEANS_SQL}, {CONTRIB_LONG_SQL}
SELECT {KEY_SQL}, feature, round(contribution, 6) AS contribution,
       row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY ABS(contribution) DESC, feature) AS rank
FROM contrib QUALIFY rank <= 10""")
def w7(spark, sf):
    return R(W.top_k_per_row(contributions_wide(feat(spark, sf)), KEYS, CONTRIB, 10))


# ==================================================== T: sorts / samples
@query("T1_multi_key_sort", sql=FEAT + "SELECT Season, DriverId, Round, round(PointsProp, 6) AS PointsProp FROM feat ORDER BY Season, DriverId, Round")
def t1(spark, sf):
    return R(feat(spark, sf).select("Season", "DriverId", "Round", "PointsProp")
             .orderBy("Season", "DriverId", "Round"))


@query("T2_global_top_k_features", sql=FEAT + f""", {MEANS_SQL}, {CONTRIB_LONG_SQL}
SELECT feature, round(AVG(ABS(contribution)), 6) AS mean_abs_shap FROM contrib GROUP BY feature
ORDER BY AVG(ABS(contribution)) DESC, feature LIMIT 10""")
def t2(spark, sf):
    return R(SM.top_k(A.mean_abs_by_feature(contributions_long(feat(spark, sf))), 10, "mean_abs_shap", "feature"))


@query("T4_seeded_sample", sql=FEAT + f"""
SELECT {KEY_SQL} FROM feat
QUALIFY row_number() OVER (ORDER BY {hash_sql(ENTRY_ID_SQL, 2147483647, 7)}, {ENTRY_ID_SQL})
  <= (SELECT LEAST(200, GREATEST(1, CAST(floor(0.2 * COUNT(*)) AS BIGINT))) FROM feat)""")
def t4(spark, sf):
    f = with_entry_id(feat(spark, sf))
    n = SM.sample_size(f.count(), 0.2, 200)   # driver-side scalar (a row count)
    return SM.seeded_sample(f, n, F.col("entry_id"), seed=7).select(*KEYS)


@query("T5_seeded_split", sql=FEAT + f"""
SELECT {KEY_SQL}, CASE WHEN {hash_sql(ENTRY_ID_SQL, 1000003, 11)} / 1000003.0 < 0.2 THEN 'test' ELSE 'train' END AS split
FROM feat""")
def t5(spark, sf):
    f = with_entry_id(feat(spark, sf))
    return SM.seeded_split(f, F.col("entry_id"), 0.2, 11).select(*KEYS, "split")


@query("T6_fold_assignment", sql=FEAT + f"SELECT {KEY_SQL}, CAST({hash_sql(ENTRY_ID_SQL, 5, 42)} AS INTEGER) AS fold FROM feat")
def t6(spark, sf):
    f = with_entry_id(feat(spark, sf))
    return SM.assign_folds(f, F.col("entry_id"), 5, 42).select(*KEYS, "fold")


# ========================================================= U: reshaping
@query("U3_transpose_row", sql=FEAT + f""", {MEANS_SQL}, {CONTRIB_LONG_SQL}
SELECT feature, round(contribution, 6) AS value FROM contrib
WHERE (Season, Round, DriverNumber) = (SELECT (Season, Round, DriverNumber) FROM feat ORDER BY {KEY_SQL} LIMIT 1)""")
def u3(spark, sf):
    first = FL.head(contributions_wide(feat(spark, sf)), 1, KEYS)
    return R(SM.unpivot_wide(first, [], CONTRIB, "feature", "value"))


# ======================================================= C: calibration
_CAL_SQL = f""", {MODELS_SQL}, {preds_sql(VAL, 'pv')}, {preds_sql(TEST, 'pt')},
cal AS (SELECT regr_intercept(y_true, y_pred) AS a, regr_slope(y_true, y_pred) AS b FROM pv WHERE model = 'grid_linear'),
ct AS (SELECT pt.Season, pt.Round, pt.DriverNumber, y_true, y_pred, COALESCE(a + b * y_pred, y_pred) AS y_pred_cal
       FROM pt CROSS JOIN cal WHERE model = 'grid_linear')"""


def _cal_parts(spark, sf):
    f = feat(spark, sf)
    models = linear_models(f)
    pv = linear_preds(f, VAL, models).filter(F.col("model") == "grid_linear")
    pt = linear_preds(f, TEST, models).filter(F.col("model") == "grid_linear")
    cal = fit_linear_calibration(pv)
    return cal, apply_calibration(pt, cal)


@query("C1_calibration_fit", sql=FEAT + _CAL_SQL + " SELECT round(a, 6) AS intercept, round(b, 6) AS slope FROM cal")
def c1(spark, sf):
    return R(_cal_parts(spark, sf)[0])


@query("C2_apply_calibration", sql=FEAT + _CAL_SQL + f"""
SELECT {KEY_SQL}, round(y_true, 6) AS y_true, round(y_pred, 6) AS y_pred, round(y_pred_cal, 6) AS y_pred_cal FROM ct""")
def c2(spark, sf):
    return R(_cal_parts(spark, sf)[1].select(*KEYS, "y_true", "y_pred", "y_pred_cal"))


@query("C3_calibrated_metrics", sql=FEAT + _CAL_SQL + """,
cmp AS (SELECT 'uncalibrated' AS type, y_true, y_pred FROM ct UNION ALL SELECT 'calibrated', y_true, y_pred_cal FROM ct)
""" + _metrics_sql("cmp", "type"))
def c3(spark, sf):
    return R(calibrated_metrics(_cal_parts(spark, sf)[1]))


# ===================================================== more folded items
_P10_COLS = ("AvgQualiTime", "DeviationFromAvg_s_last1", "DeviationFromAvg_s_last2", "DeltaFromAhead_s")


@query("P10_train_median_imputation", sql=FEAT + f"""
, med AS (SELECT {', '.join(f'median({c}) AS m_{c}' for c in _P10_COLS)} FROM feat WHERE {TRAIN_SQL})
SELECT {KEY_SQL}, {', '.join(f'round(COALESCE({c}, m_{c}, 0.0), 6) AS {c}' for c in _P10_COLS)}
FROM feat CROSS JOIN med WHERE Season = {TEST}""")
def p10(spark, sf):
    from pitwall.operators.trees import impute, train_medians
    f = feat(spark, sf)
    med = train_medians(f.filter(F.col("Season").isin(list(TRAIN))), _P10_COLS)
    out = impute(f.filter(F.col("Season") == TEST), med, _P10_COLS)
    return R(out.select(*KEYS, *_P10_COLS))


@query("A4_metrics_dropna", sql=FEAT + f""", {MODELS_SQL}, {preds_sql()},
p4 AS (SELECT p.model, f.DeviationFromAvg_s_last1 AS y_true, p.y_pred FROM preds p
       JOIN feat f USING (Season, Round, DriverNumber))
SELECT model, rmse, mae, mse, r2, n FROM ({_metrics_sql('p4')})""")
def a4(spark, sf):
    """Metrics against a target with gaps: rows NULL in either column dropped."""
    f = feat(spark, sf)
    p = linear_preds(f).drop("y_true").join(
        f.select(*KEYS, F.col("DeviationFromAvg_s_last1").alias("y_true")), KEYS)
    return R(A.regression_metrics(p, group=["model"], dropna=True))
