"""Linear calibration y = a + b * p.

The calibrator is a 1-row DataFrame ``(intercept, slope)`` computed with
the ``regr_*`` aggregates (partial aggregation, no collect).  Applying it is
a cross join with a single row — a broadcast whose size is fixed at one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.operators.aggregates import regression_metrics


def fit_linear_calibration(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """Least-squares fit of ``y`` on ``p`` over rows where both are non-null."""
    return df.agg(F.regr_intercept(F.col(y), F.col(p)).alias("intercept"),
                  F.regr_slope(F.col(y), F.col(p)).alias("slope"))


def apply_calibration(df: DataFrame, calibrator: DataFrame | None, p: str = "y_pred",
                      out: str = "y_pred_cal") -> DataFrame:
    """``a + b * p``; identity when there is no calibrator (or it is degenerate)."""
    if calibrator is None:
        return df.withColumn(out, F.col(p))
    cal = F.broadcast(calibrator.select(F.col("intercept").alias("_a"), F.col("slope").alias("_b")))
    return (df.crossJoin(cal)
              .withColumn(out, F.coalesce(F.col("_a") + F.col("_b") * F.col(p), F.col(p)))
              .drop("_a", "_b"))


def calibrated_metrics(df: DataFrame, y: str = "y_true", p: str = "y_pred",
                       cal: str = "y_pred_cal") -> DataFrame:
    """Uncalibrated and calibrated metrics side by side (``type`` column)."""
    raw = regression_metrics(df, y, p).withColumn("type", F.lit("uncalibrated"))
    calm = regression_metrics(df, y, cal).withColumn("type", F.lit("calibrated"))
    return raw.unionByName(calm)
