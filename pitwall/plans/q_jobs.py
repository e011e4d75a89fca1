"""Composite jobs (Q1-Q7) registered as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall import constants as K
from pitwall import oracles as O
from pitwall.operators import filters as FL
from pitwall.operators import windows as W
from pitwall.operators.calibration import fit_linear_calibration
from pitwall.plans.features import race_table
from pitwall.plans.registry import query

# Season roles of the test rig (dates run 1995-2001).
TRAIN_SEASONS = (1995, 1996, 1997, 1998)
VAL_SEASONS = (1999,)
TEST_SEASONS = (2000,)


def race_prediction(feat, train_seasons=TRAIN_SEASONS, race_seasons=TEST_SEASONS,
                    rank_method="range"):
    """Q1 with a linear grid-position score: fit on training seasons, score
    the upcoming races, drop lapped entries, rank per race."""
    train = FL.drop_null_target(feat.filter(F.col("Season").isin(list(train_seasons))))
    model = fit_linear_calibration(train, y=K.TARGET, p="GridPosition")
    grid = FL.drop_lapped(feat.filter(F.col("Season").isin(list(race_seasons))))
    scored = grid.crossJoin(F.broadcast(model)).withColumn(
        "prediction", F.col("intercept") + F.col("slope") * F.col("GridPosition"))
    ranked = W.rank_predictions(scored, "prediction", method=rank_method)
    return ranked.select("Season", "Round", "DriverNumber", "Driver", "GridPosition",
                         F.round("AvgQualiTime", 6).alias("AvgQualiTime"),
                         F.round("prediction", 6).alias("PredictedDeviation"),
                         "PredictedPosition")


Q1_SQL = O.features_ctes("customer") + """,
m AS (SELECT regr_intercept(DeviationFromAvg_s, GridPosition) AS a,
             regr_slope(DeviationFromAvg_s, GridPosition) AS b
      FROM feat WHERE Season IN (1995, 1996, 1997, 1998) AND DeviationFromAvg_s IS NOT NULL),
s AS (SELECT f.*, m.a + m.b * f.GridPosition AS prediction
      FROM feat f CROSS JOIN m
      WHERE f.Season = 2000 AND f.Status IS DISTINCT FROM 'Lapped')
SELECT Season, Round, DriverNumber, Driver, GridPosition,
       round(AvgQualiTime, 6) AS AvgQualiTime, round(prediction, 6) AS PredictedDeviation,
       row_number() OVER (PARTITION BY Season, Round ORDER BY prediction NULLS LAST, DriverNumber)
         AS PredictedPosition
FROM s"""


@query("Q1_race_prediction", sql=Q1_SQL)
def q1_race_prediction(spark, sf):
    return race_prediction(race_table(spark, sf, "customer"))
