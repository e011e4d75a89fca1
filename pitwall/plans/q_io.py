"""Source/sink round-trip queries (S1-S5, K1-K4) and the streaming
scoring query.  Each writes data derived from the input tables into a
fresh run folder on the shared file system and reads it back through the
source under test."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall import constants as K
from pitwall.oracles import features_ctes, p2_sql
from pitwall.plans.common import (KEYS, MODELS_SQL, TEST, field as feat, linear_models, linear_preds,
                                  preds_sql, round_doubles)
from pitwall.plans.registry import query
from pitwall.sources import files as IO
from pitwall.sources import html_tables as H
from pitwall.streaming.scoring import read_scored, score_stream
from pitwall.operators import aggregates as A

FEAT = features_ctes("customer")
_S1_COLS = ("Season", "Round", "DriverNumber", "Driver", "Status", "Q1", "PointsProp", "AvgQualiTime")
_S1_SCHEMA = ("Season bigint, Round bigint, DriverNumber bigint, Driver string, Status string, Q1 string, "
              "PointsProp double, AvgQualiTime double")


@query("S1_csv_scan", sql=FEAT + """
SELECT Season, Round, DriverNumber, Driver, Status, NULLIF(Q1, '') AS Q1,
       round(PointsProp, 6) AS PointsProp, round(AvgQualiTime, 6) AS AvgQualiTime FROM feat""")
def s1(spark, sf):
    path = IO.write_csv(feat(spark, sf).select(*_S1_COLS), IO.run_folder(spark, "s1") + "/entries.csv")
    return round_doubles(IO.read_csv(spark, path, _S1_SCHEMA))


_RARE_SQL = """
SELECT 'Laps' AS "column", v AS value FROM (SELECT COALESCE(CAST(Laps AS VARCHAR), 'missing') AS v FROM feat)
GROUP BY v HAVING COUNT(*) < 20
UNION ALL
SELECT 'Status', v FROM (SELECT COALESCE(Status, 'missing') AS v FROM feat) GROUP BY v HAVING COUNT(*) < 20"""


@query("S2_json_category_map_scan", sql=FEAT + _RARE_SQL)
def s2(spark, sf):
    f = feat(spark, sf).withColumn("Laps", F.col("Laps").cast("string"))
    rare = A.rare_categories(f, ["Laps", "Status"], 20)
    path = IO.write_category_map(rare, IO.run_folder(spark, "s2") + "/category_mappings")
    return IO.read_category_map(spark, path)


def _metrics_sql():
    return f"""SELECT model, round(sqrt(AVG((y_true - y_pred) * (y_true - y_pred))), 6) AS rmse,
       round(AVG(ABS(y_true - y_pred)), 6) AS mae, round(AVG((y_true - y_pred) * (y_true - y_pred)), 6) AS mse,
       round(1 - SUM((y_true - y_pred) * (y_true - y_pred)) / SUM((y_true - ybar) * (y_true - ybar)), 6) AS r2,
       COUNT(*) AS rows
FROM (SELECT *, AVG(y_true) OVER (PARTITION BY model) AS ybar FROM preds
      WHERE y_true IS NOT NULL AND y_pred IS NOT NULL) GROUP BY model"""


@query("S3_multi_file_prediction_scan", sql=FEAT + f", {MODELS_SQL}, {preds_sql()} " + _metrics_sql())
def s3(spark, sf):
    """K1 writes one prediction CSV per model (plus a file without
    ``y_pred`` that must be skipped); S3 reads them back tagged by model."""
    folder = IO.run_folder(spark, "s3")
    p = linear_preds(feat(spark, sf)).cache()
    for (m,) in p.select("model").distinct().collect():          # 3 model names
        IO.write_csv(p.filter(F.col("model") == m).select("y_true", "y_pred"),
                     f"{folder}/val_predictions_{m}.csv")
    IO.write_csv(p.select("y_true"), f"{folder}/val_predictions_broken.csv")
    back = IO.read_prediction_files(spark, f"{folder}/val_predictions_*.csv",
                                    r"val_predictions_([^/]+)\.csv/")
    return round_doubles(A.metrics_by_model(back))


PAGE_ROWS = 25
_HEADERS = ["Pos.", "No.", "Driver", "Team", "Q1", "Q2", "Q3", "Laps"]


@query("S4_html_results_table", sql=FEAT + f"""
SELECT (Season * 100 + Round) * 1000000 + (GridPosition - 1) // {PAGE_ROWS} AS page_id,
       CAST((GridPosition - 1) % {PAGE_ROWS} AS INTEGER) AS row,
       CAST(GridPosition AS VARCHAR) AS "Pos.", CAST(DriverNumber AS VARCHAR) AS "No.",
       {p2_sql('DriverRaw')} AS Driver, TeamName AS Team, COALESCE(Q1, '') AS Q1, COALESCE(Q2, '') AS Q2,
       COALESCE(Q3, '') AS Q3, CAST(Laps AS VARCHAR) AS Laps
FROM feat""")
def s4(spark, sf):
    """All grids as pages of ``PAGE_ROWS`` places, extracted again."""
    place = F.col("GridPosition") - 1
    g = feat(spark, sf).select(
        ((F.col("Season") * 100 + F.col("Round")) * 1000000 + F.floor(place / PAGE_ROWS)).alias("page"), F.col("GridPosition").alias("Pos."),
        F.col("DriverNumber").alias("No."), F.col("DriverRaw").alias("Driver"), F.col("TeamName").alias("Team"),
        "Q1", "Q2", "Q3", "Laps", F.col("GridPosition").alias("_o"))
    pages = H.table_html(g, "page", "_o", _HEADERS)
    return H.extract_tables(pages, _HEADERS)


@query("S5_artifact_manifest")
def s5(spark, sf):
    folder = IO.run_folder(spark, "s5")
    IO.write_csv(feat(spark, sf).select(*KEYS, "PointsProp"), f"{folder}/entries.csv", ["Season"])
    return IO.manifest(spark, f"{folder}/entries.csv/*/*.csv")


@query("K2_backup_once", sql=FEAT + """
SELECT Season, Round, DriverNumber, round(PointsProp, 6) AS PointsProp FROM feat""")
def k2(spark, sf):
    """The first write wins; a second backup of different data is ignored."""
    path = IO.run_folder(spark, "k2") + "/premodel.bak"
    f = feat(spark, sf)
    IO.write_backup_once(f.select(*KEYS, "PointsProp"), path)
    IO.write_backup_once(f.select(*KEYS, F.lit(0.0).alias("PointsProp")), path)
    return round_doubles(spark.read.parquet(path))


@query("K3_json_summary_sink", sql=FEAT + f", {MODELS_SQL}, {preds_sql()} " + _metrics_sql())
def k3(spark, sf):
    path = IO.run_folder(spark, "k3") + "/metrics.json"
    IO.write_json_summary(A.metrics_by_model(linear_preds(feat(spark, sf))), path)
    return round_doubles(spark.read.schema("model string, rmse double, mae double, mse double, r2 double, "
                                           "rows long").json(path))


@query("Q1_streaming_scoring", sql=FEAT + f""", {MODELS_SQL}
SELECT f.Season, f.Round, f.DriverNumber, round(m.intercept + m.slope * f.GridPosition, 6) AS prediction
FROM feat f CROSS JOIN (SELECT * FROM models WHERE model = 'grid_linear') m
WHERE f.Season = {TEST} AND f.Status IS DISTINCT FROM 'Lapped'""")
def q1_stream(spark, sf):
    """Entry files of the test season land in a folder; a file-stream query
    scores them with the grid model and appends to a parquet sink."""
    f = feat(spark, sf)
    folder = IO.run_folder(spark, "stream")
    src = f.filter(F.col("Season") == TEST).select(*KEYS, "GridPosition", "Status")
    src.repartition(4, "Round").write.mode("overwrite").parquet(f"{folder}/in")
    model = linear_models(f).filter(F.col("model") == "grid_linear").select("intercept", "slope")
    qry = score_stream(spark, f"{folder}/in", src.schema, model, f"{folder}/out", f"{folder}/_ckpt")
    qry.awaitTermination()
    return round_doubles(read_scored(spark, f"{folder}/out"))


@query("K1_partitioned_csv_sink", sql=FEAT + """
SELECT Season, Round, DriverNumber, round(PointsProp, 6) AS PointsProp FROM feat""")
def k1(spark, sf):
    """Write partitioned by Season (overwrite, no index) and read back with
    partition discovery."""
    path = IO.write_csv(feat(spark, sf).select(*KEYS, "PointsProp"),
                        IO.run_folder(spark, "k1") + "/entries.csv", ["Season"])
    back = IO.read_csv(spark, path, "Round bigint, DriverNumber bigint, PointsProp double")
    return round_doubles(back.select(F.col("Season").cast("bigint").alias("Season"), "Round", "DriverNumber",
                                     "PointsProp"))


_V1_ABSENT = ("weather_tire_cluster",)     # made by the clustering, not by the feature table


@query("V1_missing_column_report", sql=FEAT + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c not in _V1_ABSENT} AS present, COUNT(*) AS n_rows, "
    f"COUNT(*) FILTER ({'TRUE' if c in _V1_ABSENT else c + ' IS NULL'}) AS n_missing FROM feat"
    for c in K.EXPECTED_INPUT_COLUMNS))
def v1(spark, sf):
    """Expected minimal-input columns: is the column there, how many of its rows lack a value."""
    from pitwall.operators.filters import missing_column_report
    return missing_column_report(feat(spark, sf))
