"""Shared building blocks of the registered queries: the nation-grain
feature table, linear grid/quali/points predictors, stand-in contributions
and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall import constants as K
from pitwall.operators.sampling import entry_id
from pitwall.plans.features import race_table

TRAIN = (1995, 1996, 1997, 1998)
VAL = 1999
TEST = 2000
KEYS = ["Season", "Round", "DriverNumber"]
KEY_SQL = "Season, Round, DriverNumber"
TRAIN_SQL = "Season IN (1995, 1996, 1997, 1998)"

# (model name, input feature) of the single-feature linear predictors.
LINEAR = (("grid_linear", "GridPosition"), ("quali_linear", "AvgQualiTime"),
          ("points_linear", "PointsProp"))
# Features whose centred values stand in for per-row contributions.
CONTRIB = ("GridPosition", "AvgQualiTime", "PointsProp", "AirTemp_C", "TrackTemp_C",
           "Humidity_%", "Pressure_hPa", "WindSpeed_mps", "SOFT", "MEDIUM", "HARD",
           "INTERMEDIATE", "WET", "races_prior_this_season")


def q(name: str) -> str:
    return f'"{name}"'


def bq(name: str):
    return F.col(f"`{name}`")


def feat(spark, sf) -> DataFrame:
    """Nation grain: 25 drivers with deep history (training)."""
    return race_table(spark, sf, "nation")


def field(spark, sf) -> DataFrame:
    """Customer grain: grows with the tables."""
    return race_table(spark, sf, "customer")


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[
        F.round(bq(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else bq(f.name) for f in df.schema.fields])


def with_entry_id(df: DataFrame) -> DataFrame:
    return df.withColumn("entry_id", entry_id())


ENTRY_ID_SQL = "concat_ws(':', Season, Round, DriverNumber)"


def hash_sql(key: str, m: int, seed: int) -> str:
    return f"(CAST('0x' || substr(md5('{seed}:' || {key}), 1, 15) AS BIGINT) % {m})"


# ------------------------------------------------------------ linear models
def linear_models(f: DataFrame) -> DataFrame:
    """3 rows ``(model, feature, intercept, slope)`` fitted on the training
    seasons in one aggregation pass."""
    train = f.filter(F.col("Season").isin(list(TRAIN)) & F.col(K.TARGET).isNotNull())
    y = F.col(K.TARGET)
    row = train.agg(*[e for m, x in LINEAR for e in (
        F.regr_intercept(y, bq(x).cast("double")).alias(f"a_{m}"),
        F.regr_slope(y, bq(x).cast("double")).alias(f"b_{m}"))])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(x).alias("feature"),
                 F.col(f"a_{m}").alias("intercept"), F.col(f"b_{m}").alias("slope"))
        for m, x in LINEAR])).alias("_m")).select("_m.*")


def feature_value(feature_col: str = "feature"):
    expr = None
    for _, x in LINEAR:
        v = bq(x).cast("double")
        expr = F.when(F.col(feature_col) == x, v) if expr is None else expr.when(F.col(feature_col) == x, v)
    return expr


def linear_preds(f: DataFrame, season: int | None = VAL, models: DataFrame | None = None) -> DataFrame:
    """Long predictions ``(key, model, y_true, y_pred)`` for one season (None:
    all).  The model table has exactly len(LINEAR) rows, so broadcasting it is safe."""
    m = F.broadcast(models if models is not None else linear_models(f))
    rows = f if season is None else f.filter(F.col("Season") == season)
    return (rows.crossJoin(m)
                .select(*KEYS, "model", F.col(K.TARGET).alias("y_true"),
                        (F.col("intercept") + F.col("slope") * feature_value()).alias("y_pred")))


MODELS_SQL = "models AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{x}' AS feature, regr_intercept(DeviationFromAvg_s, {x}) AS intercept, "
    f"regr_slope(DeviationFromAvg_s, {x}) AS slope FROM feat WHERE {TRAIN_SQL} AND DeviationFromAvg_s IS NOT NULL"
    for m, x in LINEAR) + ")"


def preds_sql(season: int | None = VAL, name: str = "preds") -> str:
    case = "CASE m.feature " + " ".join(
        f"WHEN '{x}' THEN CAST(f.{x} AS DOUBLE)" for _, x in LINEAR) + " END"
    return (f"{name} AS (SELECT f.Season, f.Round, f.DriverNumber, m.model, f.DeviationFromAvg_s AS y_true, "
            f"m.intercept + m.slope * {case} AS y_pred FROM feat f CROSS JOIN models m{'' if season is None else f' WHERE f.Season = {season}'})")


# ------------------------------------------------------------ contributions
def contributions_wide(f: DataFrame) -> DataFrame:
    """Stand-in per-row contributions: centred feature values (NULL -> 0)."""
    means = F.broadcast(f.agg(*[F.avg(bq(c).cast("double")).alias(f"_m{i}") for i, c in enumerate(CONTRIB)]))
    return f.crossJoin(means).select(*KEYS, *[
        (F.coalesce(bq(c).cast("double"), F.col(f"_m{i}")) - F.col(f"_m{i}")).alias(c)
        for i, c in enumerate(CONTRIB)])


def contributions_long(f: DataFrame) -> DataFrame:
    return contributions_wide(f).unpivot(KEYS, list(CONTRIB), "feature", "contribution")


MEANS_SQL = "means AS (SELECT " + ", ".join(
    f"AVG(CAST({q(c)} AS DOUBLE)) AS m{i}" for i, c in enumerate(CONTRIB)) + " FROM feat)"
CONTRIB_LONG_SQL = "contrib AS (" + " UNION ALL ".join(
    f"SELECT {KEY_SQL}, '{c}' AS feature, COALESCE(CAST({q(c)} AS DOUBLE), m{i}) - m{i} AS contribution "
    f"FROM feat CROSS JOIN means" for i, c in enumerate(CONTRIB)) + ")"
VALUES_LONG_SQL = "vals AS (" + " UNION ALL ".join(
    f"SELECT {KEY_SQL}, '{c}' AS feature, CAST({q(c)} AS DOUBLE) AS value FROM feat"
    for c in CONTRIB) + ")"


def rule_cluster(f: DataFrame) -> DataFrame:
    """Deterministic per-race cluster id used where the operator under test
    is the per-cluster aggregation rather than the clustering itself."""
    return f.withColumn("weather_tire_cluster",
                        F.pmod(F.col("Season") * 100 + F.col("Round"), F.lit(6)).cast("int"))


RULE_CLUSTER_SQL = "CAST(((Season * 100 + Round) % 6) AS INTEGER)"
