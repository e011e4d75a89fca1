"""Keyed joins.

Every join is an equi-join on explicit keys; Catalyst/AQE choose broadcast
or sort-merge from size statistics.  We never attach rows by position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall import constants as K


# --------------------------------------------------------------------- J1
def attach_labels(df: DataFrame, labels: DataFrame, key: Sequence[str] = K.KEY) -> DataFrame:
    """Cluster labels by key (left join) — never by row position."""
    return df.join(labels, list(key), "left")


# --------------------------------------------------------------------- J2
def unique_right(right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Right side with an in-plan uniqueness assertion: a duplicated key
    makes the job fail (``raise_error``) instead of fanning out rows.  No
    driver round trip; the check runs inside the same shuffle as the join."""
    cnt = right.groupBy(*key).agg(F.count(F.lit(1)).alias("_dup"))
    # the guard sits in a filter predicate so column pruning cannot drop it
    guard = F.when(F.col("_dup") > 1, F.raise_error(F.lit("duplicate join key on right side")))
    return right.join(cnt, list(key)).filter(guard.isNull()).drop("_dup")


def fallback_join(left: DataFrame, right: DataFrame,
                  candidates: Sequence[str] = ("DriverNumber", "Season", "Round")) -> DataFrame:
    """Left join on the candidate key columns present on both sides."""
    key = [c for c in candidates if c in left.columns and c in right.columns]
    if not key:
        raise ValueError("no common key columns")
    return left.join(unique_right(right, key), key, "left")


# --------------------------------------------------------------------- J3
def truth_pred_join(truth: DataFrame, preds: DataFrame, key: Sequence[str] = K.KEY,
                    y: str = K.TARGET) -> DataFrame:
    return (truth.select(*key, F.col(y).alias("y_true"))
                 .filter(F.col("y_true").isNotNull())
                 .join(preds, list(key)))


# --------------------------------------------------------------------- J5
def map_rare_join(df: DataFrame, rare_long: DataFrame, col: str, flag: str | None = None) -> DataFrame:
    """P11 for long rare lists: NULL -> 'missing', value in the rare table ->
    'OTHER', via a left equi-join (broadcast only when stats say it is small)."""
    v = F.coalesce(F.col(col).cast("string"), F.lit("missing"))
    rare = (rare_long.filter(F.col("column") == col)
            .select(F.col("value").alias("_rare")).distinct())
    out = (df.join(rare, v == F.col("_rare"), "left")
             .withColumn(col, F.when(F.col("_rare").isNotNull(), F.lit("OTHER")).otherwise(v)))
    if flag:
        out = out.withColumn(flag, F.col("_rare").isNotNull())
    return out.drop("_rare")


def in_rare(df: DataFrame, rare_long: DataFrame, col: str) -> DataFrame:
    """J5 semi-join: rows whose value is in the rare list."""
    rare = rare_long.filter(F.col("column") == col).select(F.col("value").alias("_v"))
    return df.join(rare, F.coalesce(F.col(col).cast("string"), F.lit("missing")) == F.col("_v"),
                   "left_semi")


# --------------------------------------------------------------------- J6
def match_artifacts(models: DataFrame, artifacts: DataFrame, model: str = "model") -> DataFrame:
    """Exact equi-join on an explicit model column (no substring matching)."""
    return models.join(artifacts, model, "left")


# --------------------------------------------------------------------- J8
def override_values(df: DataFrame, overrides: DataFrame, col: str = "PointsProp",
                    key: Sequence[str] = K.KEY, default: float = K.DEFAULT_POINTS_PROP) -> DataFrame:
    """Per-driver override: override value, else the computed value, else default."""
    o = overrides.select(*key, F.col(col).alias("_override"))
    return (df.join(unique_right(o, key), list(key), "left")
              .withColumn(col, F.coalesce(F.col("_override"), F.col(col), F.lit(default)))
              .drop("_override"))


# --------------------------------------------------------------------- J9
def dependence_table(values: DataFrame, contrib: DataFrame, key: Sequence[str], features: Sequence[str],
                     feature: str = "feature") -> DataFrame:
    """Feature value paired with its contribution per row: equi-join of the
    wide rows on ``key``, long rows ``(key, feature)`` after it."""
    cols = [F.col(f"`{c}`") for c in features]
    both = values.select(*key, F.struct(*cols).alias("_v")).join(contrib.select(*key, F.struct(*cols).alias("_c")), list(key))
    return both.select(*key, F.inline(F.array(*[
        F.struct(F.lit(c).alias(feature), F.col("_v")[c].alias("value"), F.col("_c")[c].alias("contribution"))
        for c in features])))
